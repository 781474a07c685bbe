"""Mixing sources to target weights by hierarchical budgets.

The levels (for example domain, language, source) form a tree. A token budget flows from the root
down: siblings share their parent's budget by weight, and a child that cannot use its share (its
subtree holds no more, over `max_epochs` epochs) takes what it has and leaves the rest to its
siblings. Only when a whole subtree is exhausted does its shortage reach the parent's siblings. Each
leaf then takes whole epochs of its documents and a token prefix of one more epoch, in an order
seeded per epoch: the longest run of documents from the start that fits the rest of the budget.

A prefix sum over a leaf is taken in two steps, over `BUCKETS` hash buckets of the leaf and inside
the one bucket where the budget ends, so a leaf with a third of all rows is no single task. Texts do
not take part; documents are joined back by a digest of their row.

Nulls: a null level value is the node named by the empty string, a null text has no token and no copy
unless its leaf is taken whole, a null id is ordered as the empty text. Rows equal in id, text and
levels are taken or left together. Weights default to 1; a weight of 0 gives no budget. An empty
table gives no row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

SEED, MAX_EPOCHS, BUCKETS = 17, 2, 4096
WORD = r"[^\x20\x09-\x0D]+"


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _weight(level: str, weights: Mapping[str, int] | None) -> Column:
    if not weights:
        return F.lit(1).cast("long")
    pairs = [F.lit(x) for item in sorted(weights.items()) for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(level)), F.lit(1)).cast("long")


def _share(nodes: DataFrame, parents: Sequence[str], level: str) -> DataFrame:
    """Budgets of sibling nodes (cap, weight) from their parents' `budget`, by water filling."""
    whole = lambda c: c.cast("decimal(19,0)")  # noqa: E731  products of two need no more than 38 digits
    siblings = Window.partitionBy(*parents)
    order = siblings.orderBy((F.col("cap") / F.col("weight")).asc(), level)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    up_to = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    full = whole(F.col("cap")) * whole(F.sum("weight").over(rest)) <= whole(F.col("weight")) * whole(left)
    nodes = nodes.where("weight > 0").withColumn("_fits", full.cast("int"))
    nodes = nodes.withColumn("_full", F.min("_fits").over(up_to))
    free = F.col("budget") - F.sum(F.when(F.col("_full") == 1, F.col("cap")).otherwise(0)).over(siblings)
    open_weight = F.sum(F.when(F.col("_full") == 0, F.col("weight")).otherwise(0)).over(siblings)
    nodes = nodes.withColumns({"_free": free, "_open": open_weight})
    # whole numbers throughout, so that any engine gets the same budgets
    part = F.expr("cast((cast(weight as decimal(19,0)) * cast(_free as decimal(19,0))) div greatest(_open, 1) as bigint)")
    return nodes.withColumn("budget", F.when(F.col("_full") == 1, F.col("cap")).otherwise(part)).drop(
        "_fits", "_full", "_free", "_open"
    )


def leaf_budgets(
    leaves: DataFrame, levels: Sequence[str], budget: int, weights: Mapping[str, Mapping[str, int]], max_epochs: int,
) -> DataFrame:
    """levels, tokens, budget of every leaf (levels, tokens) that gets one."""
    at = leaves.select(*levels, "tokens", (F.col("tokens") * max_epochs).alias("cap"))
    parents: list[str] = []
    shared = at.agg(F.sum("cap").alias("cap")).select(F.least(F.lit(budget).cast("long"), F.col("cap")).alias("budget"))
    shared = shared.withColumn("_root", F.lit(0))
    for level in levels:
        nodes = at.groupBy(*parents, level).agg(F.sum("cap").alias("cap")).withColumn("_root", F.lit(0))
        nodes = nodes.withColumn("weight", _weight(level, weights.get(level)))
        given = shared.select(*parents, "_root", F.col("budget"))
        shared = _share(nodes.join(given, [*parents, "_root"]), [*parents, "_root"], level)
        parents.append(level)
    return at.join(shared.select(*levels, "budget"), list(levels)).select(*levels, "tokens", "budget")


def _digest(*parts) -> Column:
    return F.md5(F.concat_ws("|", *parts))


def select(
    docs: DataFrame, levels: Sequence[str], budget_share: float | None = None, budget: int | None = None,
    weights: Mapping[str, Mapping[str, int]] | None = None, doc_id: str = "doc_id", text: str = "text",
    max_epochs: int = MAX_EPOCHS, seed: int = SEED,
) -> DataFrame:
    """(row key, levels, epoch, n_tokens, copies) of what the mix takes; see `mix` for the documents."""
    rows = (
        keyed(docs, levels, doc_id, text)
        .select("_row", *levels, n_tokens(F.col(text)).alias("n_tokens"))
        .groupBy("_row", *levels, "n_tokens")
        .agg(F.count("*").alias("copies"))
        .withColumns({"n_all": F.col("n_tokens") * F.col("copies"), "bucket": F.substring("_row", 1, 3)})
    )
    rows = stored(rows, "mix-rows")
    buckets = stored(rows.groupBy(*levels, "bucket").agg(F.sum("n_all").alias("n")), "mix-buckets")
    leaves = buckets.groupBy(*levels).agg(F.sum("n").alias("tokens"))
    if budget is None:
        total = buckets.agg(F.sum("n")).first()[0] or 0
        budget = total * round(1000 * budget_share) // 1000
    leaves = leaf_budgets(leaves, levels, budget, weights or {}, max_epochs)
    leaves = leaves.select(
        *levels,
        F.expr("if(tokens = 0, 0, budget div greatest(tokens, 1))").cast("int").alias("full"),
        F.expr("if(tokens = 0, 0, budget % greatest(tokens, 1))").alias("rest"),
    )
    # buckets in the order of the leaf's last, partial epoch
    leaf = Window.partitionBy(*levels).orderBy("_at", "bucket")
    placed = (
        buckets.join(leaves, list(levels))
        .withColumn("_at", _digest(F.lit(str(seed)), F.col("full").cast("string"), "bucket"))
        .withColumn("upto", F.sum("n").over(leaf.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .select(*levels, "bucket", "full", "rest", (F.col("upto") - F.col("n")).alias("before"), "upto")
    )
    taken = rows.join(placed, [*levels, "bucket"])
    inside = Window.partitionBy(*levels, "bucket").orderBy("_at", "_row")
    cut = (
        taken.where("before < rest and upto > rest")
        .withColumn("_at", _digest(F.lit(str(seed)), F.col("full").cast("string"), "_row"))
        .withColumn("_end", F.col("before") + F.sum("n_all").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("last", F.col("_end") <= F.col("rest"))
    )
    whole = taken.where("not (before < rest and upto > rest)").withColumn("last", F.expr("rest > 0 and upto <= rest"))
    names = ["_row", *levels, "n_tokens", "copies", "full", "last"]
    chosen = whole.select(*names).unionByName(cut.select(*names)).where("full > 0 or last")
    epochs = F.sequence(F.lit(0), F.col("full") - 1 + F.col("last").cast("int"))
    return chosen.select("_row", *levels, F.explode(epochs).alias("epoch"), "n_tokens", "copies")


def keyed(docs: DataFrame, levels: Sequence[str], doc_id: str, text: str) -> DataFrame:
    """The rows with null levels named and a digest of id, levels and text as `_row`."""
    named = {level: F.coalesce(F.col(level).cast("string"), F.lit("")) for level in levels}
    docs = docs.withColumns(named)
    body = F.md5(F.coalesce(F.col(text), F.lit("")))
    return docs.withColumn("_row", _digest(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), body))


def mix(docs: DataFrame, levels: Sequence[str], doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents of the mix, once per epoch that takes them, with the column `epoch` (replaced if there)."""
    chosen = select(docs, levels, doc_id=doc_id, text=text, **options)
    epochs = chosen.groupBy("_row", *levels).agg(F.sort_array(F.collect_list("epoch")).alias("_epochs"))
    names = {level: f"_level_{i}" for i, level in enumerate(levels)}
    epochs = epochs.withColumnsRenamed(names)
    named = [F.coalesce(F.col(level).cast("string"), F.lit("")) for level in levels]
    body = F.md5(F.coalesce(F.col(text), F.lit("")))
    rows = docs.withColumn("__row", _digest(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), body))
    rows = rows.withColumns({f"__level_{i}": c for i, c in enumerate(named)})
    on = F.col("a.__row") == F.col("b._row")
    for i in range(len(levels)):
        on = on & (F.col(f"a.__level_{i}") == F.col(f"b._level_{i}"))
    return rows.alias("a").join(epochs.hint("shuffle_hash").alias("b"), on).select(
        *(F.col(f"a.{c}") for c in docs.columns if c != "epoch"), F.explode("_epochs").alias("epoch")
    )
