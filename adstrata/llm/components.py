"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

PARTS = 64


def with_groups(rows: DataFrame, key: str, by: str, partial: dict[str, F.Column], total: dict[str, F.Column], of: DataFrame | None = None) -> DataFrame:
    """Rows of `of` (default: `rows`) with aggregates of `rows` over the same key.

    Each group is dealt by a hash of `by` to at most `PARTS` parts, so a key of most rows is not one task:
    `partial` is computed per part, `total` from these per key, and the totals go back to the parts.
    """
    part = F.pmod(F.xxhash64(by), F.lit(PARTS)).alias("_part")
    parts = rows.groupBy(key, part).agg(*(c.alias(n) for n, c in partial.items()))
    groups = parts.groupBy(key).agg(*(c.alias(n) for n, c in total.items()), F.collect_list("_part").alias("_parts"))
    groups = groups.select(key, *total, F.explode("_parts").alias("_part"))
    of = rows if of is None else of
    return of.select("*", part).join(groups, [key, "_part"]).drop("_part")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the edges (a, b), root being the smallest node it reaches.

    Each round links every node's larger neighbours, then its smaller ones, to the smallest of all;
    paths shrink to stars in a logarithmic number of rounds. Edge tables are written between rounds, and
    the edges of a hub are spread over many tasks.
    A node without edges is its own root in the caller's view; an empty table gives no row.
    """
    edges = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "star"
    )
    size = _shape(edges)
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = {"m": F.min("v")}, {"m": F.min("m")}
        large = with_groups(both, "u", "v", *least, of=both.where("v > u"))
        large = large.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        large = stored(large, "star-large")
        small = with_groups(large, "u", "v", *least)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        edges = stored(small.where("u <> v").distinct(), "star-small")
        now = _shape(edges)
        if now == size:
            break
        size = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _shape(edges: DataFrame) -> tuple:
    """Number of edges, order-free digest, and whether a node is both root and leaf; stable once all are stars."""
    row = edges.agg(F.count("*"), F.expr("sum(cast(xxhash64(u, v) as decimal(38,0)))")).first()
    return tuple(row)
