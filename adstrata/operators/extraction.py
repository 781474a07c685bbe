"""Dictionary term extraction from two text fields, one row per (ad, term).

Everything happens inside the ad's own row: the text is cut into words once, words unknown to the
dictionary are dropped by hash lookup, the few candidates are confirmed, and the longest alias of
each term is kept. No row id, no shuffle, no regex scan per alias.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstrata.functions.numeric import share_pct
from adstrata.sources.terms import ALNUM, WORD

_FIELDS = ["skill", "prio", "famille", "alias", "pattern", "loose", "plain", "anchor"]

BOTH, RAW_ONLY, TEXT_ONLY = "both", "competences_brut", "description"

# Output column -> column of the clean ads.
AD_CONTEXT = {
    "profil_normalise": "profil_normalise",
    "ville": "ville",
    "type_contrat": "type_contrat",
    "annee_publication": "annee_publication",
    "mois_publication": "mois_publication",
    "source_offre": "source",
}


def extract_terms(
    ads: DataFrame,
    dictionary: DataFrame,
    ad_id: str = "id_offre",
    listed: str = "competences_brut",
    text: str = "description",
    context: Mapping[str, str] | None = None,
    keep_unmatched: bool = False,
) -> DataFrame:
    """Terms found in ``listed`` or ``text`` of each row.

    Per (row, skill) the longest alias found in *either* field wins, ties by dictionary order;
    ``source`` and ``nb_mentions_desc`` describe the winning alias only. ``context`` columns are
    carried along. ``keep_unmatched`` keeps rows without any term, with null term columns.

    The dictionary is one JSON document, read by one task, so it always fits a task and becomes a
    literal of the expression: entries in hash slots of their anchor word, of which a hit word reads
    one; rows carry the entries' numbers. Whatever its size, no text is shuffled.
    """
    context = dict(AD_CONTEXT if context is None else context)
    entries = dictionary.withColumn(
        "plain", ~F.col("loose") & (F.col("alias") == F.col("anchor"))
    ).select(*_FIELDS, F.xxhash64("anchor").alias("hash"))
    small = [r.asDict(recursive=True) for r in entries.collect()]

    rows = ads.select(
        F.col(ad_id).alias("id_offre"),
        *[F.col(col).alias(name) for name, col in context.items()],
        F.lower(F.coalesce(F.col(listed), F.lit(""))).alias("_listed"),
        F.lower(F.coalesce(F.col(text), F.lit(""))).alias("_text"),
    ).withColumns(
        {
            # Collected, as a split compiles its pattern for every row.
            "_listed_words": F.regexp_extract_all("_listed", F.lit(f"[{WORD}]+"), F.lit(0)),
            "_text_words": F.regexp_extract_all("_text", F.lit(f"[{WORD}]+"), F.lit(0)),
        }
    )
    known = _Entries(small)
    found = _winners(_candidates(rows, known), known)

    term = found.withColumn("_e", F.explode_outer("_winners"))
    if not keep_unmatched:
        term = term.where(F.col("_e").isNotNull())
    fields = ("skill", "famille", "alias", "plain", "pattern")
    term = term.withColumn("_t", F.struct(*[known.of(f, F.col("_e")).alias(f) for f in fields]))
    # One pass over the words per winner: presence in the text follows from the count.
    counted = term.withColumns(
        {
            "_in_listed": _found_in("_listed", "_listed_words"),
            "_mentions": _mentions("_text", "_text_words"),
        }
    )
    in_listed, in_text = F.col("_in_listed"), F.col("_mentions") > 0
    return counted.select(
        "id_offre",
        F.col("_t.skill").alias("skill_normalise"),
        F.col("_t.famille").alias("famille"),
        F.col("_t.alias").alias("alias_trouve"),
        F.when(in_listed & in_text, BOTH)
        .when(in_listed, RAW_ONLY)
        .when(in_text, TEXT_ONLY)
        .alias("source"),
        F.col("_mentions").alias("nb_mentions_desc"),
        *context,
    )


def _slot(word: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(n)).cast("int")


class _Entries:
    """The dictionary as literal arrays, one per field, in the order in which candidates are tried.

    A row carries the entries' places in these arrays only, which are integers that sort by skill, then priority.
    """

    def __init__(self, entries: list[dict]):
        def rank(r: dict) -> tuple:
            prio = r["prio"]
            texts = [r[f].encode() for f in ("famille", "alias", "pattern")]
            return r["skill"].encode(), [prio[f] for f in ("len", "f", "s", "a")], texts, r["loose"], r["plain"]

        self.rows = sorted(entries, key=rank)
        skills = {s: i for i, s in enumerate(dict.fromkeys(r["skill"] for r in self.rows))}
        self.skill_number = self._literal([skills[r["skill"]] for r in self.rows], "int")

    @staticmethod
    def _literal(values: list, kind: str) -> Column:
        return F.from_json(F.lit(json.dumps(values, ensure_ascii=False)), f"array<{kind}>")

    def of(self, field: str, entry: Column) -> Column:
        kind = "boolean" if field in ("plain", "loose") else "string"
        return F.get(self._literal([r[field] for r in self.rows], kind), entry)

    def places(self, keep) -> list[int]:
        return [i for i, r in enumerate(self.rows) if keep(r)]


def _candidates(rows: DataFrame, entries: _Entries) -> DataFrame:
    """Entries whose anchor word stands in a row, and those without anchor whose literal does."""
    all_rows = entries.rows
    anchored = entries.places(lambda r: r["anchor"] is not None)
    free = entries.places(lambda r: r["anchor"] is None)
    n = len({(all_rows[i]["anchor"], all_rows[i]["loose"]) for i in anchored})
    table: list[list[dict]] = [[] for _ in range(n)]
    for i in anchored:
        # Numbered as the scan numbers its words.
        r = all_rows[i]
        table[r["hash"] % n].append({"anchor": r["anchor"], "loose": r["loose"], "place": i})
    literal = F.from_json(F.lit(json.dumps(table, ensure_ascii=False)), "array<array<struct<anchor:string,loose:boolean,place:int>>>")

    def known(words: Column, loose: bool) -> Column:
        # A long literal list is looked up by hash. Repeats are kept: they are the mentions.
        names = [all_rows[i]["anchor"] for i in anchored if all_rows[i]["loose"] == loose]
        return F.filter(words, lambda w: w.isin(names)) if names else F.array().cast("array<string>")

    def announced(words: Column, loose: bool) -> Column:
        found = F.flatten(
            F.transform(
                F.array_distinct(words),
                lambda w: F.filter(F.get(literal, _slot(w, n)), lambda e: (e["anchor"] == w) & (e["loose"] == F.lit(loose))),
            )
        )
        return F.transform(found, lambda e: e["place"])

    rows = rows.withColumns(
        {
            "_listed_words": known(F.col("_listed_words"), False),
            "_text_words": known(F.col("_text_words"), False),
        }
    )
    found = [F.array().cast("array<int>")]
    if any(not all_rows[i]["loose"] for i in anchored):
        found.append(announced(F.concat("_listed_words", "_text_words"), False))
    if any(all_rows[i]["loose"] for i in anchored):
        # Punctuation-edged aliases have their own idea of a boundary, hence their own words. They are
        # collected, as splitting at a negated class of several ranges is some twenty times slower in Java.
        pieces = F.concat(*[F.regexp_extract_all(c, F.lit(f"[{ALNUM}]+"), F.lit(0)) for c in ("_listed", "_text")])
        found.append(announced(known(pieces, True), True))
    if free:
        # No word can announce them: all their characters are punctuation.
        marks = F.array(*[F.lit(i) for i in free])
        found.append(
            F.filter(
                marks,
                lambda e: F.contains(F.col("_listed"), entries.of("alias", e))
                | F.contains(F.col("_text"), entries.of("alias", e)),
            )
        )
    return rows.withColumn("_candidates", F.concat(*found))


def _winners(rows: DataFrame, entries: _Entries) -> DataFrame:
    """Confirm the candidates and keep the best alias of each skill."""

    def in_field(field: str, entry: Column) -> Column:
        # The plain substring test spares compiling the pattern for most misses.
        return F.contains(F.col(field), entries.of("alias", entry)) & F.rlike(F.col(field), entries.of("pattern", entry))

    confirmed = rows.withColumn(
        "_confirmed",
        F.sort_array(
            F.filter(
                "_candidates",
                lambda e: entries.of("plain", e) | in_field("_listed", e) | in_field("_text", e),
            )
        ),
    )
    skill = lambda e: F.get(entries.skill_number, e)
    return confirmed.withColumn(
        "_winners",
        F.filter(
            "_confirmed",
            lambda e, i: F.coalesce(skill(F.get(F.col("_confirmed"), i - 1)) != skill(e), F.lit(True)),
        ),
    )


def _found_in(field: str, words: str) -> Column:
    t = F.col("_t")
    return F.when(t["plain"], F.array_contains(F.col(words), t["alias"])).otherwise(
        F.contains(F.col(field), t["alias"]) & F.rlike(F.col(field), t["pattern"])
    )


def _mentions(field: str, words: str) -> Column:
    t = F.col("_t")
    by_word = F.size(words) - F.size(F.array_remove(F.col(words), t["alias"]))
    by_pattern = F.when(
        F.contains(F.col(field), t["alias"]), F.regexp_count(F.col(field), t["pattern"])
    ).otherwise(F.lit(0))
    return F.when(t["plain"], by_word).otherwise(by_pattern).cast("int")


# --- Statistics over the long table -------------------------------------------------------


def coverage(matches: DataFrame, ads: DataFrame) -> DataFrame:
    """One row: matches, ads, ads with at least one term, ads without, terms, averages.

    Ads are counted as rows, so repeated ids stay apart; ``matches`` must come from
    ``extract_terms(..., keep_unmatched=True)``.
    """
    total = ads.agg(F.count(F.lit(1))).scalar()
    per_term = matches.groupBy("skill_normalise").agg(F.count(F.lit(1)).alias("n"))
    is_term = F.col("skill_normalise").isNotNull()
    return (
        per_term.agg(
            F.coalesce(F.sum(F.when(is_term, F.col("n"))), F.lit(0)).alias("nb_correspondances"),
            F.count_if(is_term).alias("nb_competences"),
            F.coalesce(F.sum(F.when(~is_term, F.col("n"))), F.lit(0)).alias("nb_offres_sans"),
        )
        .withColumn("nb_offres", total)
        .withColumn("nb_offres_avec", F.col("nb_offres") - F.col("nb_offres_sans"))
        .withColumn(
            "moyenne_par_offre",
            F.try_divide(F.col("nb_correspondances").cast("double"), F.col("nb_offres")),
        )
        .withColumn(
            "moyenne_par_offre_avec",
            F.try_divide(F.col("nb_correspondances").cast("double"), F.col("nb_offres_avec")),
        )
    )


def ads_per(
    matches: DataFrame, key: str, ad_id: str = "id_offre", k: int | None = None
) -> DataFrame:
    """Distinct ads per value of ``key`` with their share of all matched ads; top ``k``."""
    whole = matches.agg(F.count_distinct(ad_id)).scalar()
    counted = (
        matches.groupBy(key)
        .agg(F.count_distinct(ad_id).alias("nb_offres"))
        .withColumn("pct_offres", share_pct(F.col("nb_offres"), whole))
    )
    if k is None:
        return counted
    return counted.orderBy(F.desc("nb_offres"), key).limit(k)
