"""Jaccard join against all pairs, its signatures' guarantee, and edge cases."""

import random

import numpy as np
import pytest

from adstrata.llm import jaccard
from adstrata.llm.components import components


def shingles(text, k=5):
    words = (text or "").encode().lower().split()
    size = min(k, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if words else frozenset()


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(sets)
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least = {}
    for n, (i, s) in enumerate(sets):
        r = find(n)
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return sorted(
        ((i, len(s), least.get(find(n)) if s else i, links[n]) for n, (i, s) in enumerate(sets)), key=str
    )


def documents(seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    shared = [" ".join(rng.choices(words, k=30)) for _ in range(3)]
    rows = []
    for _ in range(25):
        base = rng.choices(words, k=rng.choice([3, 5, 6, 7, 8, 9, 40, 120]))
        for _ in range(rng.choice([1, 1, 2, 5])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(" ".join(copy) + (" " + rng.choice(shared) if rng.random() < 0.3 else ""))
    hub = rng.choices(words, k=100)
    for _ in range(60):  # one large group, in which every pair is near the threshold
        copy = list(hub)
        for _ in range(rng.choice([0, 1, 2, 3])):
            copy[rng.randrange(100)] = rng.choice(words)
        rows.append(" ".join(copy))
    rows += ["", None, "  ", "one", "ONE", "one two", "A b\tc\nd e f", "a b c d e f"]
    return [(i * 3 % 1001, t) for i, t in enumerate(rows)] + [(7777, rows[0]), (7777, rows[0]), (None, rows[0]), (None, "lone words of no id here")]


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"rare": 1, "block": 16, "bucket_shingles": 500},
        # shingles of two nodes of a block stay in it, and copies of a node are in several blocks
        {"rare": 4, "block": 8, "bucket_shingles": 700, "often": 2, "flush": 400},
        {"block": 4, "bucket_shingles": 300, "often": 3, "flush": 1},
    ],
)
def test_against_all_pairs(spark, options):
    rows = documents()
    if "often" in options:
        rows = [*rows, *((i + 5000, t) for i, t in reversed(rows) if i is not None)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, node string, n int")
    got = sorted((tuple(r) for r in jaccard.link(df, **options).collect()), key=str)
    assert got == brute(rows)


def test_components_with_a_hub(spark):
    rng = random.Random(4)
    edges = [(50, n) for n in range(51, 400)] + [(n, 399) for n in range(100, 200)]  # hubs as smaller and as larger end
    edges += [(n, n + 1) for n in range(1000, 1060)] + [(7, 7), (3, 1060)] + [(rng.randrange(2000, 2100),) * 2 for _ in range(5)]
    edges += [(rng.randrange(3000, 3200), rng.randrange(3000, 3200)) for _ in range(120)] + edges[:20]
    root = {n: n for e in edges for n in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    linked_nodes = {n for a, b in edges if a != b for n in (a, b)}
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(tuple(r) for r in got) == sorted((n, find(n)) for n in linked_nodes)


def test_blocks_of_large_clusters(spark):
    """Blocks hold nodes of one home; only blocks with a common signature meet, and every pair of nodes with one is asked."""
    rng = random.Random(8)
    signed, sizes = [], {}
    for home in range(6):
        for i in range(sizes.setdefault(home, rng.choice([3, 5, 40]))):
            node = home * 1000 + i
            signed += [(home * 10 + k, node) for k in range(3)]
    signed += [(900 + k, k * 1000) for k in range(6)] + [(900 + k, (k + 1) * 1000 + 1) for k in range(5)]  # a chain of homes
    s = spark.createDataFrame(signed, "sig long, node long")
    by_sig = {}
    for sig, node in signed:
        by_sig.setdefault(sig, set()).add(node)
    counts = {}
    for nodes in by_sig.values():
        if len(nodes) > 1:
            for node in nodes:
                counts[min(nodes), node] = counts.get((min(nodes), node), 0) + 1
    meets = spark.createDataFrame([(a, b, c) for (a, b), c in counts.items()], "a long, b long, shared long")
    many = spark.createDataFrame([(n, 0) for n in sorted({n for _, n in signed})], "node long, root long")
    placed = jaccard._placed(many, meets, 8)
    spot = {r["node"]: r["spot"] for r in placed.collect()}
    assert sorted(spot) == sorted({n for _, n in signed})
    for home, size in sizes.items():
        own = {spot[home * 1000 + i] for i in range(size)}
        assert len(own) == 1 if size <= 8 else 1 < len(own) <= 5
    got = [tuple(r) for r in jaccard._meeting(placed, s).collect()]
    expected = {tuple(sorted((spot[x], spot[y]))) for nodes in by_sig.values() for x in nodes for y in nodes if spot[x] != spot[y]}
    assert len(got) == len(set(got)) and set(got) == expected


def test_empty_table(spark):
    assert jaccard.link(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(5)
    universe = rng.integers(0, 2**63, 4000).astype(np.uint64)
    df_of = dict(zip(universe.tolist(), rng.choice([2, 3, 20, 33, 50, 900], len(universe)).tolist(), strict=True))
    tested = 0
    for _ in range(3000):
        n = int(rng.integers(3, 80))
        x = rng.choice(universe, n, replace=False)
        swap = int(rng.integers(0, max(1, n // 6) + 1))
        y = np.concatenate([x[swap:], np.setdiff1d(rng.choice(universe, int(rng.integers(0, swap + 1)), replace=False), x)])
        both = len(np.intersect1d(x, y))
        if 100 * both < 75 * (len(x) + len(y) - both) or len(y) < 3:
            continue
        tested += 1
        signed = [
            jaccard.signatures(len(s), s, np.array([df_of[t] for t in s.tolist()], np.uint32)) for s in (x, y)
        ]
        assert len(np.intersect1d(*signed)), (len(x), len(y), both)
    assert tested > 500
