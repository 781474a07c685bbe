"""License scan by diagonal voting, in DataFrame operations only.

All word k-grams of all texts are joined, by hash and then word for word, to the k-gram positions of
license templates: notices, whole paragraphs of licenses, and the Creative Commons names in all
versions. A hit votes for its diagonal (place in the text minus place in the template); diagonals at
most `drift` apart are one region, so a few added or dropped words do not split it. A region is
judged by its words, not by its k-grams: those of the template that its hits cover are its matching
words, and their share of the template, or of the region where that is longer, has to reach `min_share`
within a span of `max_stretch` template lengths. So a changed word costs a long template one word and
not k k-grams. Of spans that overlap only the best stay, as names of related licenses differ in a word.
Phrases are looked up besides, as the base.

The k-grams live for one row each inside the scan stage; only hits are shuffled, by document.

Nulls: a null text is empty and gives no words, no span and score 0; a null id is kept. Repeated
rows are scanned alike and each keeps its row. Other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SEPARATORS, once
from .license_texts import PARAGRAPHS, creative_commons

K, DRIFT, MIN_SHARE, MAX_STRETCH = 4, 4, 0.75, 1.5
BROADCAST_GRAMS = 100_000

#: Base phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Notices as their licenses word them, already as words; then paragraphs and names.
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and"
            " associated documentation files"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is"
            " hereby granted"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided"
            " that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    *((label, " ".join(re.findall("[a-z0-9]+", text.lower()))) for label, text in (*PARAGRAPHS, *creative_commons())),
)


def template_grams(spark: SparkSession, templates: Sequence[tuple[str, str]] = TEMPLATES, k: int = K) -> DataFrame:
    """(template, label, grams, length, tpos, t0..tk-1): one row per k-gram of each template."""
    rows = []
    for number, (label, text) in enumerate(templates):
        words = text.split()
        if len(words) < k:
            raise ValueError(f"a template needs {k} words: {text!r}")
        for at in range(len(words) - k + 1):
            rows.append((number, label, len(words) - k + 1, len(words), at, *words[at : at + k]))
    names = ", ".join(f"t{i} string" for i in range(k))
    known = spark.createDataFrame(rows, f"template int, label string, grams int, length int, tpos int, {names}").select(
        "*", F.xxhash64(*(F.col(f"t{i}") for i in range(k))).alias("tgram")
    )
    # Larger template sets are joined by shuffle; the rows above are counted, so this bound is exact.
    return F.broadcast(known) if len(rows) <= BROADCAST_GRAMS else known


def plain_text(text: Column) -> Column:
    """The words of a text with one blank between them."""
    folded = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(folded, SEPARATORS, " "))


def words(plain: Column) -> Column:
    """Words of a plain text; an empty array if there are none."""
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def base_places(plain: Column, w: Column, phrase: str) -> Column:
    """Starts (from 0) at which the phrase's words stand consecutively."""
    wanted = phrase.split()
    # A substring test spares most texts the search by words.
    there = plain.contains(phrase) & (F.size(w) >= len(wanted))
    starts = F.filter(
        F.sequence(F.lit(0), F.size(w) - len(wanted)),
        lambda i: F.slice(w, i + 1, len(wanted)) == F.array(*(F.lit(x) for x in wanted)),
    )
    return F.when(there, starts).otherwise(F.array().cast("array<int>"))


def spans(
    docs: DataFrame, keys: Sequence[str], text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES,
    k: int = K, drift: int = DRIFT, min_share: float = MIN_SHARE, max_stretch: float = MAX_STRETCH,
) -> DataFrame:
    """Verified spans: keys, label, template, first_word, end_word (exclusive), share."""
    w = F.col("_w")
    shifted = [w if i == 0 else F.slice(w, i + 1, F.greatest(F.size(w) - i, F.lit(0))) for i in range(k)]
    grams = (
        docs.select(*keys, once(plain_text(F.col(text))).alias("_plain"))
        .select(*keys, once(words(F.col("_plain"))).alias("_w"))
        .where(F.size("_w") >= k)
        .select(*keys, F.posexplode(F.arrays_zip(*(c.alias(f"w{i}") for i, c in enumerate(shifted)))).alias("dpos", "g"))
        .select(*keys, "dpos", *(F.col(f"g.w{i}").alias(f"w{i}") for i in range(k)))
        .withColumn("gram", F.xxhash64(*(F.col(f"w{i}") for i in range(k))))
    )
    known = template_grams(docs.sparkSession, templates, k)
    # The hash alone is the join key (a long); the words are compared on the few rows that meet.
    words_equal = F.coalesce(F.expr(" and ".join(f"w{i} = t{i}" for i in range(k))), F.lit(False))
    votes = grams.join(known, (F.col("gram") == F.col("tgram")) & words_equal).select(*keys, "template", "label", "grams", "length", "dpos", "tpos",
                                           (F.col("dpos") - F.col("tpos")).alias("diagonal"))
    by = Window.partitionBy(*keys, "template").orderBy("diagonal", "dpos")
    gap = F.when(F.col("diagonal") - F.lag("diagonal").over(by) > drift, 1).otherwise(0)
    regions = (
        votes.withColumn("_gap", gap)
        .withColumn("region", F.sum("_gap").over(by))
        .groupBy(*keys, "template", "label", "grams", "length", "region")
        .agg(F.collect_set("tpos").alias("places"), F.min("dpos").alias("first_word"),
             (F.max("dpos") + k).alias("end_word"))
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + k - 1)))))
    share = covered / F.greatest(F.col("length"), F.col("end_word") - F.col("first_word"))
    verified = regions.where(
        (share >= min_share) & (F.col("end_word") - F.col("first_word") <= max_stretch * F.col("length"))
    ).select(*keys, "label", "template", "first_word", "end_word", share.alias("share"))
    # Spans are not longer than this, so those that overlap one begin within it on either side.
    reach = int(max_stretch * max(len(text.split()) for _, text in templates)) + 1
    near = Window.partitionBy(*keys).orderBy("first_word").rangeBetween(-reach, reach)
    better = F.exists("_near", lambda o: (o["share"] > F.col("share")) & (o["first_word"] < F.col("end_word")) & (F.col("first_word") < o["end_word"]))
    around = F.collect_list(F.struct("share", "first_word", "end_word")).over(near)
    return verified.withColumn("_near", around).where(~better).drop("_near")


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def scan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", phrases: Sequence[tuple[str, str]] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES, options: Mapping | None = None,
) -> DataFrame:
    """One row per document: base phrases, the method's labels, and a score.

    The score is the largest share of matching words of a verified span, at least 0.5 where a base
    phrase stands.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"),
                       F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_row"))
    places = [base_places(F.col("_plain"), F.col("_w"), phrase) for phrase, _ in phrases]
    found = (
        rows.select("doc_id", "_row", once(plain_text(F.col("_text"))).alias("_plain"))
        .select("doc_id", "_row", "_plain", once(words(F.col("_plain"))).alias("_w"))
        .select("doc_id", "_row", F.size("_w").cast("long").alias("n_words"),
                once(F.array(*places)).alias("_ps"))
        .select("doc_id", "_row", "n_words", *(F.get("_ps", F.lit(i)).alias(f"_p{i}") for i in range(len(phrases))))
        .select("doc_id", "_row", "n_words", F.concat(*(F.col(f"_p{i}") for i in range(len(phrases)))).alias("_all"),
                F.filter(F.array(*(F.when(F.size(f"_p{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(phrases))),
                         lambda x: x.isNotNull()).alias("_base"))
    )
    per_doc = (
        spans(rows.withColumn("_id", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), ["_id", "_row"], "_text",
              templates, **(options or {}))
        .groupBy("_id", "_row")
        .agg(F.collect_set("label").alias("_own"), F.max("share").alias("_share"))
        .withColumnRenamed("_row", "_row2")
    )
    joined = found.join(
        per_doc,
        (F.coalesce(found["doc_id"].cast("string"), F.lit("")) == per_doc["_id"]) & (found["_row"] == per_doc["_row2"]),
        "left",
    )
    own = F.coalesce(F.col("_own"), F.array().cast("array<string>"))
    n_base = F.size("_all").cast("long")
    return joined.select(
        "doc_id", "n_words", n_base.alias("n_base"),
        F.array_min("_all").cast("long").alias("first_word"), F.array_max("_all").cast("long").alias("last_word"),
        _joined(F.col("_base")).alias("base_labels"), _joined(F.concat("_base", own)).alias("labels"),
        F.greatest(F.coalesce("_share", F.lit(0.0)), F.when(n_base > 0, 0.5).otherwise(0.0)).alias("score"),
    )
