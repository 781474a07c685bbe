"""Time, interval and set operators against plain Python on small, awkward rows."""

import bisect
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from adstrata.operators import changes, cubes, intervals, members, running, sketches
from adstrata.operators.asof import asof_join

NONE = object()


def key(row):
    return str(tuple(row))


# --- As of ----------------------------------------------------------------------------------


def sides(seed, hot=False):
    rng = random.Random(seed)
    pick = lambda: 1 if hot and rng.random() < 0.7 else rng.choice([1, 2, 3, None])
    left = [(i, pick(), rng.choice([None, *range(-40, 300)])) for i in range(120)]
    right = [(1000 + i, pick(), rng.choice([None, *range(-40, 300)])) for i in range(100)]
    return left + left[:3], right + right[:3]


def last_before(left, right, forward, equal, tolerance):
    out = []
    for i, k, t in left:
        best = None
        for j, rk, rt in right:
            if None in (k, t, rk, rt) or k != rk or (rt == t and not equal) or (rt < t if forward else rt > t):
                continue
            place = (-rt if forward else rt, j)
            best = max(best or (place, j, rt), (place, j, rt))
        near = best and (tolerance is None or abs(best[2] - t) <= tolerance)
        out.append((i, k, t, best[1] if near else None))
    return sorted(out, key=key)


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("equal", [False, True])
@pytest.mark.parametrize("width,tolerance,hot", [(1, None, False), (16, None, True), (1000, 20, False)])
def test_asof(spark, forward, equal, width, tolerance, hot):
    left, right = sides(width, hot)
    l_df = spark.createDataFrame(left, "id long, k int, t long")
    r_df = spark.createDataFrame(right, "id long, rk int, rt long")
    got = asof_join(l_df, r_df, ["k"], ["rk"], "t", "rt", {"rid": "id"}, width, ["id"], forward, equal, tolerance)
    assert got.columns == ["id", "k", "t", "rid"]
    assert sorted(map(tuple, got.collect()), key=key) == last_before(left, right, forward, equal, tolerance)


def test_asof_of_nothing(spark):
    left, right = sides(3)
    l_df = spark.createDataFrame(left, "id long, k int, t long")
    r_df = spark.createDataFrame(right, "id long, rk int, rt long")
    args = (["k"], ["rk"], "t", "rt", {"rid": "id"}, 10)
    assert asof_join(l_df.limit(0), r_df, *args).count() == 0
    assert [r["rid"] for r in asof_join(l_df, r_df.limit(0), *args).collect()] == [None] * len(left)


def test_asof_deals_a_hot_key_over_buckets(spark):
    rows = spark.range(4000).select(F.lit(1).alias("k"), F.col("id").alias("t"), "id")
    found = asof_join(rows, rows, ["k"], ["k"], "t", "t", {"rid": "id"}, 100, allow_equal=False)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "__b" in plan and "Join" not in plan
    assert found.where("rid = id - 1").count() == 3999


# --- Intervals ------------------------------------------------------------------------------


def spans(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a = rng.choice([None, *range(-500, 500)])
        size = rng.choice([0, 0, 1, 5, 40, 700, 100_000])
        b = rng.choice([None, a + size, a + size, a - 1]) if a is not None else rng.randint(-500, 500)
        out.append((i, rng.choice(["x", "x", "y", None]), a, b))
    return out


@pytest.mark.parametrize("by", [False, True])
@pytest.mark.parametrize("width", [1, 7, 5000])
def test_overlaps(spark, by, width):
    left, right = spans(width, 70), spans(width + 1, 60)
    frames = [spark.createDataFrame(rows, "id long, k string, a long, b long") for rows in (left, right)]
    low, high = -(10**9), 10**9
    bound = lambda r: (low if r[2] is None else r[2], high if r[3] is None else r[3])
    expected = []
    for x in left:
        for y in right:
            (a, b), (c, d) = bound(x), bound(y)
            if a <= b and c <= d and a <= d and c <= b and (not by or (x[1] == y[1] and x[1] is not None)):
                expected.append((x[0], y[0]))
    keys = (["k"], ["k"]) if by else ()
    pairs = intervals.overlap_join(*frames, ("a", "b"), ("a", "b"), width, *keys)
    assert sorted((r["l"]["id"], r["r"]["id"]) for r in pairs.collect()) == sorted(expected)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert intervals.overlap_join(frames[0].limit(0), frames[1], ("a", "b"), ("a", "b"), width, *keys).count() == 0


# --- Windows --------------------------------------------------------------------------------


def test_global_order(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, rng.choice([None, *range(40)]), rng.choice([None, *range(-9, 9)])) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, t int, v long").repartition(7)
    got = running.in_global_order(
        df, ["t", "id"], str(tmp_path / "order"), {"total": "v"}, "n", {"before": "v"}, {"after": "v"}, {"tile": 7, "many": 3000}
    )
    ordered = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    expected, total = [], None
    size, more = divmod(len(rows), 7)
    tiles = [t + 1 for t in range(7) for _ in range(size + (t < more))]
    for n, row in enumerate(ordered):
        if row[2] is not None:
            total = (total or 0) + row[2]
        near = [ordered[i][2] if 0 <= i < len(ordered) else None for i in (n - 1, n + 1)]
        expected.append((*row, total, n + 1, *near, tiles[n], n + 1))
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    assert running.in_global_order(df.limit(0), ["t", "id"], str(tmp_path / "none"), {"total": "v"}).count() == 0


@pytest.mark.parametrize("reach", [1, 10, 500])
def test_moving(spark, reach):
    rng = random.Random(reach)
    rows = [(i, rng.choice("ab"), rng.choice([None, *range(-100, 100)]), rng.randint(0, 5)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, k string, t long, v long")
    expected = []
    for i, k, t, _ in rows:
        near = [v for _, ok, ot, v in rows if ok == k and None not in (t, ot) and t - reach <= ot <= t]
        expected.append((i, sum(near) if near else None, len(near) if t is not None else None))
    got = running.moving(df, "t", reach, {"s": F.sum("v"), "n": F.count("*")}, ["k"])
    assert got.columns == [*df.columns, "s", "n"]
    assert sorted((r["id"], r["s"], r["n"]) for r in got.collect()) == sorted(expected)


# --- Cubes, sketches, changes ---------------------------------------------------------------


def test_grouping_sets(spark):
    rows = [("a", "x", 1, 5), ("a", "x", 1, 2), ("a", None, 2, 1), (None, "x", 1, None), ("b", "y", None, 4)]
    df = spark.createDataFrame(rows, "p string, q string, k int, v long")
    got = {(r["grouping_id"], r["p"], r["q"]): (r["n"], r["keys"], r["v"]) for r in
           cubes.grouping_sets(df, ["p", "q"], "k", "keys", {"v": "v"}, "n").collect()}
    assert got[3, None, None] == (5, 2, 12) and got[1, "a", None] == (3, 2, 8) and got[1, None, None] == (1, 1, None)
    assert got[2, None, "x"] == (3, 1, 7) and got[0, "b", "y"] == (1, 0, 4) and len(got) == 4 + 3 + 3 + 1
    some = cubes.grouping_sets(df, ["p", "q"], "k", "keys", sets=cubes.rollup_sets(["p", "q"]))
    assert {r["grouping_id"] for r in some.collect()} == {0, 1, 3}
    assert cubes.grouping_sets(df.limit(0), ["p", "q"], "k", "keys").count() == 0


def test_sketches_merge(spark):
    df = spark.range(20_000).select((F.col("id") % 10).alias("g"), (F.col("id") % 3).alias("h"), F.col("id").alias("k"), (F.col("id") * 7919 % 20011).alias("v"))
    df = df.unionByName(df.limit(0)).withColumn("k", F.when(F.col("g") != 9, F.col("k")))
    mart = sketches.merge(sketches.sketch(df, ["g", "h"], "k", "v"), ["g"])
    whole = sketches.merge(mart, []).select(sketches.distinct_estimate().alias("d"), sketches.quantile_estimate(0.9).alias("q")).first()
    direct = sketches.sketch(df, [], "k", "v").select(sketches.distinct_estimate().alias("d")).first()
    assert whole["d"] == direct["d"] and abs(whole["d"] - 18_000) <= 3 * sketches.distinct_error() * 18_000
    values = sorted(i * 7919 % 20011 for i in range(20_000))
    assert abs(bisect.bisect(values, whole["q"]) / 20_000 - 0.9) <= sketches.rank_error()
    empty = mart.where("g = 9").select(sketches.distinct_estimate().alias("d"), sketches.quantile_estimate(0.5).alias("q")).first()
    assert empty["d"] == 0 and empty["q"] is not None


def test_changes(spark):
    rng = random.Random(6)
    make = lambda: [(rng.choice([1, 2, 3, None]), rng.choice(["a", "b", None])) for _ in range(40)]
    old, new = make() + [(7, "x"), (7, "x")], make() + [(8, None), (7, "x")]
    frames = [spark.createDataFrame(rows, "k int, v string") for rows in (old, new)]
    a, b = Counter(old), Counter(new)
    rows = lambda c: sorted((r for r, n in c.items() for _ in range(n)), key=key)
    assert sorted(map(tuple, changes.except_all(*frames).collect()), key=key) == rows(a - b)
    assert sorted(map(tuple, changes.intersect_all(*frames).collect()), key=key) == rows(a & b)
    for r in changes.change_report(*frames, ["k"]).collect():
        of = lambda c, k=r["k"]: sum(n for (x, _), n in c.items() if x == k)
        assert (r["kept"], r["gone"], r["added"]) == (of(a & b), of(a - b), of(b - a))
        assert r["kind"] == {7: "changed", 8: "inserted"}.get(r["k"], r["kind"])


# --- Members --------------------------------------------------------------------------------


@pytest.mark.parametrize("bits", [64, 1 << 12, members.BITS])
def test_members(spark, bits):
    rng = random.Random(bits)
    rows = [(i, rng.choice([None, *range(200)]), rng.choice(["a", "b", None])) for i in range(400)]
    listed = [(rng.choice([None, *range(400)]), rng.choice(["a", "b", None])) for _ in range(60)] * 2
    df, keys = spark.createDataFrame(rows, "id long, k int, s string"), spark.createDataFrame(listed, "k int, s string")
    known = {x for x in listed if None not in x}
    semi = members.semi_join(df, keys, ["k", "s"], ["k", "s"], bits)
    anti = members.anti_join(df, keys, ["k", "s"], ["k", "s"], bits)
    assert semi.columns == anti.columns == df.columns
    assert sorted(r["id"] for r in semi.collect()) == [i for i, k, s in rows if (k, s) in known]
    assert sorted(r["id"] for r in anti.collect()) == [i for i, k, s in rows if (k, s) not in known]
    assert members.semi_join(df, keys.limit(0), ["k", "s"], ["k", "s"], bits).count() == 0
    assert members.anti_join(df, keys.limit(0), ["k", "s"], ["k", "s"], bits).count() == 400


def test_filter_keeps_most_rows_from_the_join(spark):
    df, keys = spark.range(50_000), spark.range(0, 50_000, 100)
    words = members.bloom_filter(keys, ["id"])
    passed = df.where(members.may_contain(words, [F.col("id")])).count()
    assert 500 <= passed < 600
