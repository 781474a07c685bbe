"""Percentiles, ranks, pivots, joins and distributions."""

import random

import pytest
from pyspark.sql import functions as F

from adstrata.operators.distribution import member_counts, value_counts
from adstrata.operators.joins import literal_dimension, lookup_join, ratio_to_base
from adstrata.operators.percentiles import exact_percentiles
from adstrata.operators.pivots import pivot
from adstrata.operators.ranking import rank_within, top_k, top_k_ranked
from adstrata.operators.spread import spread
from adstrata.plans import analytics


def interpolated(values, p):
    values = sorted(values)
    pos = (len(values) - 1) * p
    low = int(pos)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (pos - low)


@pytest.mark.parametrize("accuracy", [10_000, 40])
def test_exact_percentiles(spark, accuracy):
    """With accuracy 40 groups above 160 rows go through a real bracket."""
    rng = random.Random(3)
    data = [("hot", rng.gauss(0, 1e5)) for _ in range(4000)]
    data += [("ties", float(rng.randint(0, 3))) for _ in range(700)]
    data += [(None, rng.random()) for _ in range(300)]
    data += [(f"k{i % 40}", float(rng.randint(0, 50))) for i in range(90)]
    data += [("hot", None), ("empty", None), ("one", 5.0)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, v double").repartition(6)
    probs = {"q1": 0.25, "q2": 0.5, "q3": 0.75, "lo": 0.0, "hi": 1.0}
    got = {r["k"]: r for r in exact_percentiles(df, ["k"], "v", probs, accuracy).collect()}
    groups = {}
    for k, v in data:
        if v is not None:
            groups.setdefault(k, []).append(v)
    assert set(got) == set(groups)
    for k, values in groups.items():
        for name, p in probs.items():
            assert got[k][name] == pytest.approx(interpolated(values, p)), (k, name)


def test_top_k_ranked_is_the_global_rank(spark):
    df = spark.createDataFrame(
        [("a", 5), ("b", 9), ("c", 5), ("d", 1), ("e", None)], "k string, n int"
    )
    rows = top_k_ranked(df, "n", 3, ["k"], "r").collect()
    assert sorted((r.k, r.n, r.r) for r in rows) == [("a", 5, 2), ("b", 9, 1), ("c", 5, 2)]
    assert [r.k for r in top_k(df, "n", 5, ["k"]).collect()] == ["b", "a", "c", "d", "e"]
    plan = top_k(df, "n", 3, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_dense_and_plain_rank(spark):
    df = spark.createDataFrame([("x", 3), ("x", 3), ("x", 1), ("y", 2)], "g string, n int")
    assert sorted(r.r for r in rank_within(df, "g", "n", "r").collect()) == [1, 1, 1, 3]
    assert sorted(r.r for r in rank_within(df, "g", "n", "r", dense=True).collect()) == [
        1, 1, 1, 2,
    ]


def test_pivot(spark):
    df = spark.createDataFrame(
        [("x", "a", 3), ("x", "a", 5), ("x", "b", 1), ("y", "c", 7), ("y", "b", 2)],
        "i string, c string, n int",
    )
    rows = pivot(df, "i", "c", {"a": "A", "b": "B"}, "n", "sum", 0).collect()
    assert sorted(map(tuple, rows)) == [("x", 8, 1), ("y", 0, 2)]
    rows = pivot(df, "i", "c", {"a": "A"}, "n", "avg").collect()
    assert list(map(tuple, rows)) == [("x", 4.0)]


def test_lookup_join_keeps_rows_and_defaults(spark):
    df = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "n int, k string")
    dim = literal_dimension(spark, [("a", 1.5)], "k string, lat double")
    out = lookup_join(df, F.col("k"), dim, "k", {"lat": "lat"}, {"lat": 0.0})
    assert sorted(map(tuple, out.collect()), key=str) == [
        (1, "a", 1.5), (2, "z", 0.0), (3, None, 0.0),
    ]


def test_ratio_to_base_without_base_is_null(spark):
    df = spark.createDataFrame(
        [("p", "t", 5), ("p", "c", 20), ("q", "t", 1)], "g string, m string, n int"
    )
    out = ratio_to_base(df, "g", "m", "n", "t", "c").collect()
    assert sorted(map(tuple, out)) == [("p", 5, 25.0), ("q", 1, None)]


def test_distributions(spark):
    df = spark.createDataFrame([("a, b",), ("b",), ("",), ("a, b",)], "x string")
    assert [tuple(r) for r in value_counts(df, "x", k=1).collect()] == [("a, b", 2, 50.0)]
    got = member_counts(df, F.split("x", ", "), "m", 5).collect()
    assert [tuple(r) for r in got] == [("b", 3), ("a", 2)]


def test_spread_deals_rows_only_when_asked(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert spread(docs, 5, "doc_id").rdd.getNumPartitions() == 5
    assert spread(docs, None, "doc_id") is docs


def test_percentiles_of_infinity_and_null_keys(spark):
    rows = [("a", 1.0), ("a", float("inf")), ("a", float("inf")), (None, 2.0), (None, 4.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r["m"] for r in exact_percentiles(df, ["k"], "v", {"m": 0.5}).collect()}
    assert got == {"a": float("inf"), None: 3.0}


def test_null_group_keeps_its_median(spark):
    rows = [(None, 1, 100, True), (None, 1, 300, True), ("p", 1, 5, True)]
    ads = spark.createDataFrame(rows, "profil string, years int, mid int, known boolean")
    got = analytics.salary_by_experience(ads, None, "profil", "years", "mid", "known").collect()
    assert {r["profil"]: (r["nb_offres"], r["salaire_median"]) for r in got} == {None: (2, 200.0), "p": (1, 5.0)}
