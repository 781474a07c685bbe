"""Exact top-k by inner product: dual-tree search over cover trees.

Candidates and queries are both indexed. Vectors go to the nearest of a bounded set of pivots; the
rows of a pivot are cut by hash into blocks of about `block_rows` rows, however many rows a pivot
draws, and each block becomes a cover tree: every node covers its points within a radius, its
children are a greedy net of half that radius. A query block and a candidate block are searched
together: a pair of nodes is pruned when centre product plus both covering radii cannot reach the
worst kth score of any query below the query node; pairs of small nodes are settled by one matrix
product, ties included.

Whole blocks are pruned the same way: a first round searches each query block against the candidate
blocks of its own pivot, which gives every query a kth score; the second round visits only blocks
whose bound reaches the worst of them. The pivots' balls (at most `pivots` rows) are what all tasks
know. Which blocks meet is decided by numbers alone; trees then travel to tiles of some query blocks
and some candidate blocks, once each, and only k rows per query and tile leave a task.

Scores are whole numbers and exact: sums are carried in float64 while they stay below 2**53, in
64-bit integers below 2**62, else in whole numbers of any size; a score that itself does not fit 64
bits raises an error. Vectors that are null or hold a null or non-finite component take no part;
vectors of different lengths are never compared. Rows of null id take no part either. Everything goes
by row: rows that repeat an id are queries of their own, with a list each, and candidates for each
other; a query leaves out its own row only. An empty table gives no row, and columns of other names
are not read.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

PIVOTS, BLOCK_ROWS, LEAF = 64, 2048, 48
#: Query and candidate blocks of a tile.
TILE = 16
HITS = "q_row long, query_id long, vec_id long, row long, score long"


class CoverTree:
    """Nodes in depth-first order; `order` lists the points so that a node's points are a slice."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = points
        self.leaf = leaf
        self.order = np.arange(len(points))
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.start: list[int] = []
        self.end: list[int] = []
        self.children: list[list[int]] = []
        if len(points):
            away = np.sqrt(((points - points[0]) ** 2).sum(1))
            self._build(0, len(points), 0, away)

    def _build(self, start: int, end: int, centre: int, away: np.ndarray) -> int:
        """A node of the points order[start:end], at distances `away` from point `centre`."""
        node = len(self.centre)
        radius = float(away.max())
        for values, value in ((self.centre, centre), (self.radius, radius), (self.start, start), (self.end, end), (self.children, [])):
            values.append(value)
        if end - start <= self.leaf or radius == 0.0:
            return node
        # Greedy net: each child covers what lies within half the radius of its centre.
        left, distance, own = self.order[start:end].copy(), away, centre
        groups = []
        while len(left):
            near = distance <= radius / 2
            groups.append((own, left[near], distance[near]))
            left = left[~near]
            if len(left):
                own = int(left[0])
                distance = np.sqrt(((self.points[left] - self.points[own]) ** 2).sum(1))
        if len(groups) > (end - start) // 4:
            # Children that cover next to nothing prune no better than one product of all.
            return node
        at, below = start, []
        for own, members, distance in groups:
            self.order[at : at + len(members)] = members
            below.append(self._build(at, at + len(members), own, distance))
            at += len(members)
        self.children[node] = below
        return node


def product(a: np.ndarray, b: np.ndarray, bound: float, own: np.ndarray) -> np.ndarray:
    """Exact inner products, of which none exceeds `bound` by much; those of a row with itself (`own`) may be anything."""
    if bound * 2 < 2.0**53:
        return (a @ b.T).astype(np.int64)
    if bound < 2.0**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    exact = lambda x: np.array([[int(c) for c in row] for row in x], dtype=object).reshape(x.shape)
    found = exact(a) @ exact(b).T
    found[own] = 0
    if found.size and (found.max() >= 2**63 or found.min() < -(2**63)):
        raise OverflowError("an inner product does not fit 64 bits")
    return found.astype(np.int64)


class Best:
    """The k best candidates per query, as (score, id, row); ties go to smaller ids, then rows."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.found = [np.empty((3, 0), np.int64)] * n
        self.worst = np.full(n, -np.inf)

    def offer(self, query: int, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        found = np.concatenate([self.found[query], np.stack([scores, ids, rows])], axis=1)
        if found.shape[1] > self.k:
            found = found[:, np.lexsort((found[2], found[1], -found[0]))[: self.k]]
        self.found[query] = found
        if found.shape[1] == self.k:
            self.worst[query] = max(self.worst[query], found[0].min())


class Points:
    """A block: cover tree, ids and rows of its points."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        self.tree, self.ids, self.rows = CoverTree(points), ids, rows


def dual_search(queries: Points, data: Points, best: Best) -> None:
    """Offers to `best` all candidates that may be among the k best of a query."""
    q, d = queries.tree, data.tree
    if not len(q.points) or not len(d.points):
        return
    q_norm, d_norm = np.sqrt((q.points**2).sum(1)), np.sqrt((d.points**2).sum(1))
    bound = float(q_norm.max() * d_norm.max())
    slack = 1.0 + bound * 1e-9
    work = [(0, 0)]
    while work:
        a, b = work.pop()
        ca, cb = q.centre[a], d.centre[b]
        rows = q.order[q.start[a] : q.end[a]]
        top = float(q.points[ca] @ d.points[cb]) + q.radius[a] * d_norm[cb] + d.radius[b] * q_norm[ca] + q.radius[a] * d.radius[b]
        # Ties matter (a smaller id wins), so only what is surely below goes.
        if top + slack < best.worst[rows].min():
            continue
        below_a, below_b = q.children[a], d.children[b]
        if below_b and (not below_a or d.radius[b] >= q.radius[a]):
            # nearest in product last, as it is taken first and raises the kth scores
            products = d.points[[d.centre[x] for x in below_b]] @ q.points[ca]
            work += [(a, below_b[i]) for i in np.argsort(products)]
        elif below_a:
            work += [(x, b) for x in below_a]
        else:
            columns = d.order[d.start[b] : d.end[b]]
            ids, places = data.ids[columns], data.rows[columns]
            scores = product(q.points[rows], d.points[columns], bound, queries.rows[rows][:, None] == places)
            for i, row in enumerate(rows):
                fits = (scores[i] >= best.worst[row]) & (places != queries.rows[row])
                if fits.any():
                    s, c, r = scores[i][fits], ids[fits], places[fits]
                    if len(s) > 4 * best.k:
                        keep = s >= np.partition(s, len(s) - best.k)[len(s) - best.k]
                        s, c, r = s[keep], c[keep], r[keep]
                    best.offer(row, s, c, r)


def integer_vectors(vectors: DataFrame, queries: Column, vec_id: str, embedding: str, scale: float = 64.0) -> DataFrame:
    """(vec_id, v, dim, is_query, row): components as floor(scale * x); only complete, finite vectors."""
    marked = vectors.withColumn("_is_query", F.coalesce(queries, F.lit(False)))
    v = F.col(embedding).cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return marked.where(F.col(vec_id).isNotNull() & v.isNotNull() & good).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.transform(v, lambda x: F.floor(x * scale).cast("double")).alias("v"),
        F.size(v).alias("dim"), F.col("_is_query").alias("is_query"), F.monotonically_increasing_id().alias("row"),
    )


def _matrix(values: pd.Series, dim: int) -> np.ndarray:
    return np.array(values.tolist(), dtype=np.float64).reshape(len(values), dim)


def _choose_pivots(vectors: DataFrame, pivots: int) -> dict[int, np.ndarray]:
    """A bounded sample by hash: at most `pivots` vectors per dimension (documented fit)."""
    by = Window.partitionBy("dim").orderBy(F.xxhash64("row"), "row")
    sizes = {r["dim"]: r["count"] for r in vectors.groupBy("dim").count().collect()}
    total = max(sum(sizes.values()), 1)
    # a few per wanted pivot, so that the window sorts little
    few = vectors.where(F.pmod(F.xxhash64("row"), F.lit(1 << 20)) <= math.ceil((1 << 20) * min(1.0, 8 * pivots * len(sizes) / total)))
    rows = few.withColumn("n", F.row_number().over(by)).where(F.col("n") <= pivots).orderBy("dim", "n").collect()
    found: dict[int, list] = {}
    for row in rows:
        found.setdefault(row["dim"], []).append(row["v"])
    chosen = {dim: found.get(dim, [[0.0] * dim]) for dim in sizes}
    return {dim: np.array(rows, np.float64).reshape(len(rows), dim) for dim, rows in chosen.items()}


def _assigner(pivots: dict[int, np.ndarray]):
    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            cell = np.zeros(len(frame), np.int32)
            away = np.zeros(len(frame))
            norm = np.zeros(len(frame))
            for dim, rows in frame.groupby("dim").indices.items():
                points, centres = _matrix(frame["v"].iloc[rows], dim), pivots[dim]
                squares = (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None]
                nearest = squares.argmin(1)
                cell[rows] = nearest
                away[rows] = np.sqrt(((points - centres[nearest]) ** 2).sum(1))
                norm[rows] = np.sqrt((points**2).sum(1))
            yield frame.assign(cell=cell, away=away, norm=norm)

    return assign


def _block(rows: int) -> Column:
    """Number of a row's block among those of its cell, which holds `n` rows."""
    return F.pmod(F.xxhash64("row", F.lit(7)), F.ceil(F.col("n") / F.lit(rows))).cast("int")


def _blocks(vectors: DataFrame, sizes: DataFrame, rows: int) -> DataFrame:
    """dim, cell, block, tree: cover trees over bounded blocks of a cell's rows."""
    # at most `pivots` rows per dimension, so the broadcast is bounded by the fit
    salted = vectors.join(F.broadcast(sizes), ["dim", "cell"]).withColumn("block", _block(rows))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("row", kind="stable")
        points = Points(
            _matrix(frame["v"], int(frame["dim"].iloc[0])), frame["vec_id"].to_numpy(np.int64), frame["row"].to_numpy(np.int64)
        )
        return frame[["dim", "cell", "block"]].iloc[:1].assign(tree=[pickle.dumps(points, protocol=5)])

    return salted.groupBy("dim", "cell", "block").applyInPandas(build, "dim int, cell int, block int, tree binary")


def _searcher(k: int):
    def search(asked: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        """All meetings of a tile: every tree is unpacked once."""
        blocks = {b: pickle.loads(t) for b, t in zip(data["to_block"], data["tree"], strict=True)}
        out = []
        for packed, rows, worst, met in zip(asked["q_tree"], asked["rows"], asked["worst"], asked["met"], strict=True):
            queries = pickle.loads(packed)
            best = Best(len(queries.rows), k)
            if rows is not None:
                best.worst = _floors(queries, rows, worst)
            for block in met:
                dual_search(queries, blocks[block], best)
            n = [f.shape[1] for f in best.found]
            scores, ids, places = np.concatenate(best.found, axis=1)
            out.append(pd.DataFrame({
                "q_row": np.repeat(queries.rows, n), "query_id": np.repeat(queries.ids, n), "vec_id": ids, "row": places, "score": scores,
            }))
        return pd.concat(out) if out else pd.DataFrame(columns=[c.split()[0] for c in HITS.split(", ")])

    return search


def _floors(queries: Points, rows, worst) -> np.ndarray:
    """The kth scores known of a block's queries."""
    known = dict(zip(rows, worst, strict=True))
    return np.array([known.get(r, -np.inf) for r in queries.rows.tolist()], np.float64)


def top_k(
    vectors: DataFrame, queries: Column, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding",
    pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS, query_rows: int = 512,
) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of every row that `queries` marks."""
    ready = stored(integer_vectors(vectors, queries, vec_id, embedding), "topk-vectors")
    centres = _choose_pivots(ready, pivots)
    if not centres:
        return ready.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).limit(0)
    schema = "vec_id long, v array<double>, dim int, is_query boolean, row long, cell int, away double, norm double"
    placed = stored(ready.mapInPandas(_assigner(centres), schema), "topk-cells")
    asked = placed.where("is_query")
    balls = stored(placed.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.max("away").alias("away")), "topk-balls")
    data = stored(_blocks(placed, balls.select("dim", "cell", "n"), block_rows), "topk-data")
    q_sizes = stored(asked.groupBy("dim", "cell").agg(F.count("*").alias("n")), "topk-sizes")
    q_blocks = _blocks(asked, q_sizes, query_rows).withColumnsRenamed({"cell": "q_cell", "block": "q_block", "tree": "q_tree"})
    q_blocks = stored(q_blocks, "topk-queries")
    tiles = -(-q_blocks.count() // TILE)

    # round 1: the query's own cell gives every query a kth score
    n_blocks = balls.select("dim", "cell", F.ceil(F.col("n") / F.lit(block_rows)).cast("int").alias("blocks"))
    own = q_blocks.join(F.broadcast(n_blocks), (q_blocks["dim"] == n_blocks["dim"]) & (F.col("q_cell") == F.col("cell"))).select(
        q_blocks["dim"], "q_cell", "q_block", F.col("cell").alias("to_cell"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("to_block"),
    )
    nothing = q_blocks.withColumns({"rows": F.lit(None).cast("array<long>"), "worst": F.lit(None).cast("array<long>")})
    first = stored(_best_of(_searched(own, nothing, data, k, tiles), k).drop("rank"), "topk-first")

    # round 2: the blocks of other cells whose ball can still reach a query block's worst kth score
    floors = first.groupBy("q_row").agg(F.count("*").alias("c"), F.min("score").alias("s")).where(F.col("c") >= k)
    members = asked.join(F.broadcast(q_sizes), ["dim", "cell"]).select(
        "dim", F.col("cell").alias("q_cell"), _block(query_rows).alias("q_block"), F.col("row").alias("q_row")
    )
    known = (
        members.join(floors, "q_row")
        .groupBy("dim", "q_cell", "q_block")
        .agg(F.collect_list(F.struct("q_row", "s")).alias("f"))
        .select("dim", "q_cell", "q_block", F.col("f.q_row").alias("rows"), F.col("f.s").alias("worst"))
    )
    ready = stored(q_blocks.join(known, ["dim", "q_cell", "q_block"], "left"), "topk-known")
    ball_of = {(r["dim"], r["cell"]): (r["n"], r["away"]) for r in balls.collect()}
    reach = ready.mapInPandas(
        _targets(centres, ball_of, block_rows), "dim int, q_cell int, q_block int, to_cell int, to_block int"
    )
    second = _searched(stored(reach, "topk-reach"), ready, data, k, tiles)
    return _best_of(first.unionByName(second), k).select("query_id", "rank", "vec_id", "score")


def _targets(centres: dict[int, np.ndarray], ball_of: dict[tuple[int, int], tuple[int, float]], block_rows: int):
    """Per query block, the candidate blocks that may still hold one of its k best."""

    def targets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                queries = pickle.loads(row.q_tree)
                tree = queries.tree
                worst = -np.inf if row.rows is None else _floors(queries, row.rows, row.worst).min()
                centre, around = tree.points[tree.centre[0]], tree.radius[0]
                length, rows = math.sqrt(centre @ centre), []
                for cell, pivot in enumerate(centres[row.dim]):
                    if cell == row.q_cell or (row.dim, cell) not in ball_of:
                        continue
                    n, away = ball_of[row.dim, cell]
                    top = float(centre @ pivot) + around * math.sqrt(pivot @ pivot) + away * length + around * away
                    if top + 1.0 + abs(top) * 1e-9 >= worst:
                        rows += [(row.dim, row.q_cell, row.q_block, cell, block) for block in range(-(-n // block_rows))]
                yield pd.DataFrame(rows, columns=["dim", "q_cell", "q_block", "to_cell", "to_block"])

    return targets


def _searched(meetings: DataFrame, queries: DataFrame, data: DataFrame, k: int, tiles: int) -> DataFrame:
    """Hits of query blocks in the candidate blocks they meet (pairs of block numbers)."""
    q_key, d_key = ["dim", "q_cell", "q_block"], ["dim", "to_cell", "to_block"]
    tile = ["dim", "q_tile", "to_cell", "d_tile"]
    tiled = meetings.withColumns({
        "q_tile": F.pmod(F.xxhash64("q_cell", "q_block"), F.lit(tiles)), "d_tile": F.floor(F.col("to_block") / TILE),
    })
    met = tiled.groupBy(*tile, "q_cell", "q_block").agg(F.sort_array(F.collect_list("to_block")).alias("met"))
    # Both sides come from one table, so one of them takes columns of its own.
    left = met.join(queries, q_key).select(*[F.col(c).alias(c) for c in tile], "q_tree", "rows", "worst", "met")
    blocks = data.withColumnsRenamed({"cell": "to_cell", "block": "to_block"})
    right = tiled.select(*tile, "to_block").distinct().join(blocks, d_key).select(*tile, "to_block", "tree")
    return left.groupBy(*tile).cogroup(right.groupBy(*tile)).applyInPandas(_searcher(k), HITS)


def _best_of(hits: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id", "row")
    return hits.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
