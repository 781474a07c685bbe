"""Work that must grow no faster than the input: reads, tasks, patterns and pairs."""

import contextlib
import io
import json
import random
import re

from pyspark.sql import functions as F

from adstrata.operators.cubes import grouping_sets
from adstrata.operators.extraction import extract_terms
from adstrata.operators.intervals import overlap_counts
from adstrata.plans import silver
from adstrata.sources.envelope import read_envelope_records, read_lines, typed_ads
from adstrata.sources.terms import dictionary_from_mapping
from workload import cases as K
from workload import queries, relations
from workload.ads import messy_ads


def test_envelope_is_read_once(spark, tmp_path):
    records = ['{"a": 1.0 ,  "b": [1,2]}', *[json.dumps({"n": i, "t": "é" * 40}) for i in range(3000)]]
    (tmp_path / "e.json").write_text('{"offres": [' + ",\n".join(records) + "]}", encoding="utf-8")
    statistics = spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file")
    before = statistics.getLong("bytesRead")
    got = [r["raw"] for r in read_envelope_records(spark, str(tmp_path)).collect()]
    assert got == records
    assert statistics.getLong("bytesRead") - before < 4 * (tmp_path / "e.json").stat().st_size


def test_ads_of_one_row_group_are_dealt(spark, sf_dir):
    plan = messy_ads(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan


def test_extraction_has_no_slow_split(spark):
    ads = spark.createDataFrame([("1", "c++, .net", "C# et c++")], "id string, listed string, text string")
    found = extract_terms(ads, dictionary_from_mapping(spark, {"f": {"c": ["c++"], "s": ["c#", ".net"]}}), "id", "listed", "text", {})
    assert {(r["skill_normalise"], r["alias_trouve"], r["source"]) for r in found.collect()} == {
        ("c", "c++", "both"), ("s", ".net", "competences_brut")
    }
    assert "[^a-zA-Z0-9]+" not in found._jdf.queryExecution().executedPlan().toString()


def test_overlap_counts(spark):
    rng = random.Random(3)
    rows = [
        (i, rng.choice(["a", "b", None]), rng.choice([None, *range(12)]), rng.choice([None, *range(12)]), rng.randint(1, 3))
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, "id int, k string, a long, b long, w long")
    got = {r["id"]: r["n"] for r in overlap_counts(df, ("a", "b"), ["k"], "w", "n").collect()}
    low, high = float("-inf"), float("inf")
    whole = [(i, k, low if a is None else a, high if b is None else b, w) for i, k, a, b, w in rows if k is not None]
    whole = [r for r in whole if r[2] <= r[3]]
    assert got == {i: sum(w for _, j, c, d, w in whole if j == k and c <= b and a <= d) for i, k, a, b, _ in whole}


def test_customer_spans_form_no_pairs(spark, sf_dir):
    found = relations.customer_spans(spark, sf_dir)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "(l_start" not in plan and "__started" in plan
    assert found.where(F.col("nb_others") <= 0).isEmpty()


def test_distinct_keys_are_not_expanded(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.choice([None, *range(40)])) for _ in range(400)]
    df = spark.createDataFrame(rows, "d string, e int, k long")
    found = grouping_sets(df, ["d", "e"], "k", "nb", rows="n")
    sides = {0: lambda d, e: (d, e), 1: lambda d, e: (d, None), 2: lambda d, e: (None, e), 3: lambda d, e: (None, None)}
    want = {}
    for i, side in sides.items():
        for d, e, k in rows:
            want.setdefault((*side(d, e), i), []).append(k)
    got = {(r["d"], r["e"], r["grouping_id"]): (r["n"], r["nb"]) for r in found.collect()}
    assert got == {g: (len(ks), len(set(ks) - {None})) for g, ks in want.items()}
    # The keys are not among the columns that an aggregate over the sets groups by.
    expand = [x for x in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Expand" in x]
    assert expand and "__key" not in expand[0]


def test_feed_of_lines_is_compressed(spark, sf_dir, monkeypatch):
    paths = []
    monkeypatch.setattr(queries, "_landed", {})
    monkeypatch.setattr(queries, "read_lines", lambda s, path: paths.append(path) or read_lines(s, path))
    queries.bronze_manifest(spark, sf_dir)
    names = [r["name"] for r in spark.read.format("binaryFile").load(paths[0]).select(F.col("path").alias("name")).collect()]
    assert names and all(n.endswith(".txt.gz") for n in names)


def test_marts_of_ads_do_not_wait_for_terms(spark, sf_dir, monkeypatch):
    found = queries.queries()
    monkeypatch.setattr(queries, "ad_terms", lambda s, d: (_ for _ in ()).throw(AssertionError("terms")))
    monkeypatch.setattr("workload.ads._stored", {})
    for name in ("summary_cities", "city_volume_pivot", "top_recruiters"):
        assert found[name](spark, sf_dir).count() > 0


def _explained(df, mode):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def test_text_stages_are_compiled(spark, sf_dir):
    """The JVM interprets methods of more than 8000 bytes, so no projection of the ads may become one."""
    ads = messy_ads(spark, sf_dir)
    raw = ads.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("raw"))
    stored = raw.localCheckpoint()
    silver_plan = silver.clean_ads(typed_ads(stored))
    terms = extract_terms(silver_plan, dictionary_from_mapping(spark, K.AD_TERMS))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (raw, silver_plan, terms):
            sizes = re.findall(r"maxMethodCodeSize:(\d+)", _explained(df, "codegen"))
            assert sizes and max(map(int, sizes)) <= 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_keys_of_a_record_are_read_once(spark):
    df = typed_ads(spark.createDataFrame([('{"id_offre": "a", "nb_postes": null}',), ("[1]",), ("x",), (None,)], "raw string"))
    assert [(r.id_offre, r.nb_postes, r.ville) for r in df.collect()] == [("a", None, "")]
    assert _explained(df, "formatted").count("jsonObjectKeys") == 1
    kept = typed_ads(spark.createDataFrame([('{"id_offre": "a"}', "k")], "raw string, part string"), keep=("raw", "part"))
    assert [(r.raw, r.part, r.id_offre) for r in kept.collect()] == [('{"id_offre": "a"}', "k", "a")]


def test_extraction_carries_numbers_of_entries(spark):
    """Entries are tried by skill and priority, with those of equal skill in two families as one skill."""
    terms = {"f": {"é": ["data lake", "data"], "z": ["c++", "+++"]}, "g": {"é": ["lake"], "a": ["data lake x"]}}
    rows = [("1", "data lake", "+++ c++ c++"), ("2", "", "a lake, Data lake data"), ("3", None, None)]
    ads = spark.createDataFrame(rows, "id string, listed string, text string")
    found = extract_terms(ads, dictionary_from_mapping(spark, terms), "id", "listed", "text", {}, keep_unmatched=True)
    got = sorted(tuple(r) for r in found.where("famille is not null").collect())
    assert got == [
        ("1", "z", "f", "c++", "description", 2), ("1", "é", "f", "data lake", "competences_brut", 0),
        ("2", "é", "f", "data lake", "description", 1),
    ]
    assert [tuple(r) for r in found.where("famille is null").collect()] == [("3", None, None, None, None, 0)]
    plan = _explained(found, "extended")
    assert "_candidates" in plan and "split(" not in plan
