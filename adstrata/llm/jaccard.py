"""N-gram Jaccard join with token-combination prefixes.

A document is the set of its distinct word shingles, as 64-bit hashes; documents of equal sets are
one node from the start. Two nodes link when 100 * |intersection| >= threshold * |union|.

1. Document frequencies. Shingle hashes travel in blocks of nodes, packed by hash buckets of bounded
   size, and only those in two nodes or more come back to their block. A shingle that many nodes of one
   block hold stays there and its bucket gets their number only, so a footer of a third of all documents
   is one entry per block and not one per document. A node links with nothing unless three quarters of its
   shingles did (it must share that many), which leaves few nodes.
2. Prefixes. Shingles are ordered by (frequency, hash). At most tau = n - ceil(0.75 n) shingles of a
   node are missing from a partner, so a prefix is extended until removing any tau of its shingles
   leaves a signature: rare shingles are signatures by themselves, frequent ones only in pairs of one
   of `S` hash classes, and a class of c frequent shingles yields c - 1 towards the count. Signatures
   live in size bands a factor 4/3 apart; a node writes into its own and the next band, where every
   partner of a possible size meets it and S is the same for both.
3. Verification. Nodes that share signatures form candidate clusters. A small cluster is checked as it
   is. A large one is cut into blocks of bounded size, each of nodes that share most signatures with the
   same node, and only blocks with a common signature meet: chance candidates may chain clusters into one
   without making their blocks meet. Blocks are checked exactly by products of 0/1 matrices and return
   link counts and a spanning forest, never their pairs. Components of the forests are the components
   of all links.

Nulls: a null text has no words, hence no shingles and no link; a null id is kept, a component's id is
its smallest id that is not null (null if there is none). Repeated rows are members of one node. Other
columns do not matter; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .components import components, with_groups

SHINGLE, THRESHOLD = 5, 75
RARE = 32
BUCKET_SHINGLES = 2_000_000
BLOCK = 512
OFTEN = 8
MOST_PARTS = 20_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _SHIFT)) * _MIX
    return h ^ (h >> np.uint64(32))


class Shingler:
    """Distinct shingle hashes of texts; word hashes are kept while they fit."""

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > 250_000:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        k = min(self.size, len(words))
        out = h[: len(h) - k + 1] + np.uint64(k)
        for i in range(1, k):
            out = _mixed(out) + h[i : len(h) - k + 1 + i]
        return np.unique(_mixed(out))


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _node(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _memberships(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in batches:
            n, node, digest = [], [], []
            for text in batch.column(1):
                s = shingler(text.as_py())
                d = _digest(s)
                n.append(len(s))
                node.append(_node(d))
                digest.append(d)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(digest, pa.binary())],
                ["doc_id", "n", "node", "digest"],
            )

    return run


_PACKED = pa.schema(
    [
        ("bucket", pa.int32()), ("block", pa.int64()), ("hashes", pa.binary()), ("at", pa.binary()), ("nodes", pa.binary()),
        ("ns", pa.binary()), ("uses", pa.binary()), ("head", pa.bool_()),
    ]
)
_SPREAD = "bucket int, block long, hashes binary, at binary, nodes binary, ns binary, uses binary, head boolean"
_RETURNED = "block long, hashes binary, dfs binary, at binary, nodes binary, ns binary"


def _runs(values: np.ndarray) -> np.ndarray:
    """Where the runs of a sorted array begin."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.empty(0, np.int64)


def _spread(size: int, buckets: int, often: int, flush: int, block_nodes: int = 60_000):
    """Shingle hashes in blocks of nodes, packed by bucket; each node once per task.

    A block has one more row, its head: all its nodes, their sizes, and the shingles that `often` of them
    or more hold. Of these the buckets get the number of nodes only.
    """

    def pack(sets: list[np.ndarray], nodes: list[int]) -> pa.RecordBatch:
        h = np.concatenate(sets)
        ns = np.array([len(s) for s in sets], np.uint32)
        owner = np.repeat(np.arange(len(sets), dtype=np.uint16), ns)
        names = np.array(nodes, np.int64)
        # Blocks of equal nodes are one block, number them alike.
        block = xxhash.xxh64_intdigest(names.tobytes()) - (1 << 63)
        order = np.argsort(h)
        h, owner = h[order], owner[order]
        starts = _runs(h)
        uses = np.diff(np.append(starts, len(h)))
        many = uses >= often
        hot, held = h[starts[many]], uses[many].astype(np.uint32)
        stays = np.repeat(many, uses)
        rows: dict[str, list] = {n: [] for n in _PACKED.names}

        def add(*values) -> None:
            for name, value in zip(_PACKED.names, values, strict=True):
                rows[name].append(value)

        def buckets_of(hashes: np.ndarray) -> Iterator[tuple[int, int, int]]:
            # ranges of hashes, so sorted hashes are in order of their buckets
            bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            begin = _runs(bucket)
            yield from zip(bucket[begin].tolist(), begin.tolist(), [*begin[1:].tolist(), len(bucket)], strict=False)

        add(block % buckets, block, h[stays].tobytes(), owner[stays].tobytes(), names.tobytes(), ns.tobytes(), None, True)
        for bucket, i, j in buckets_of(hot):
            add(bucket, block, hot[i:j].tobytes(), None, None, None, held[i:j].tobytes(), False)
        h, owner = h[~stays], owner[~stays]
        for bucket, i, j in buckets_of(h):
            used, at = np.unique(owner[i:j], return_inverse=True)
            # `ns` of these rows: the nodes' places in the block
            add(bucket, block, h[i:j].tobytes(), at.astype(np.uint16).tobytes(), names[used].tobytes(), used.tobytes(), None, False)
        return pa.RecordBatch.from_pydict(rows, schema=_PACKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(size), set()
        sets, nodes, total = [], [], 0
        for batch in batches:
            for text in batch.column(0):
                s = shingler(text.as_py())
                if len(s) < 3:
                    continue  # smaller sets link with equal ones only
                node = _node(_digest(s))
                if node in seen:
                    continue
                seen.add(node)
                sets.append(s)
                nodes.append(node)
                total += len(s)
                if total >= flush or len(sets) >= block_nodes:
                    yield pack(sets, nodes)
                    sets, nodes, total = [], [], 0
        if sets:
            yield pack(sets, nodes)

    return run


def _shared(frame: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: the shingles that stand in two nodes or more, back to the nodes' blocks.

    Frequencies count a node again in every further block that holds the shingle often; they only order
    shingles, and a shingle has one frequency everywhere.
    """
    head = frame["head"].astype(bool)
    out = [(int(r.block), r.hashes, None, r.at, r.nodes, r.ns) for r in frame[head].itertuples(index=False)]
    rows = frame[~head].sort_values("block", kind="stable")
    names = sorted(set(rows["block"].tolist()))
    number = {b: i for i, b in enumerate(names)}
    empty = lambda *types: [[np.empty(0, t)] for t in types]
    hashes, owners, places, blocks = empty(np.uint64, np.int64, np.uint16, np.uint32)
    hot, held, hot_blocks = empty(np.uint64, np.uint32, np.uint32)
    for row in rows.itertuples(index=False):
        h = np.frombuffer(row.hashes, np.uint64)
        block = np.full(len(h), number[row.block], np.uint32)
        if row.at is None:
            hot.append(h)
            held.append(np.frombuffer(row.uses, np.uint32))
            hot_blocks.append(block)
            continue
        at = np.frombuffer(row.at, np.uint16)
        hashes.append(h)
        owners.append(np.frombuffer(row.nodes, np.int64)[at])
        places.append(np.frombuffer(row.ns, np.uint16)[at])
        blocks.append(block)
    h, node, place, block = (np.concatenate(x) for x in (hashes, owners, places, blocks))
    # A node of several blocks answers to the smallest: the same one in every bucket.
    order = np.lexsort((block, node, h))
    h, node, place, block = h[order], node[order], place[order], block[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (node[1:] != node[:-1])
    h, place, block = h[fresh], place[fresh], block[fresh]
    # Blocks of equal nodes are one block and say the same.
    hot, held, hot_block = (np.concatenate(x) for x in (hot, held, hot_blocks))
    order = np.lexsort((hot_block, hot))
    hot, held, hot_block = hot[order], held[order], hot_block[order]
    fresh = np.ones(len(hot), bool)
    fresh[1:] = (hot[1:] != hot[:-1]) | (hot_block[1:] != hot_block[:-1])
    hot, held, hot_block = hot[fresh], held[fresh], hot_block[fresh]

    known, at = np.unique(np.concatenate([h, hot]), return_inverse=True)
    df = np.bincount(at, weights=np.concatenate([np.ones(len(h)), held]), minlength=len(known)).astype(np.uint32)[at]
    df, hot_df = df[: len(h)], df[len(h) :]
    h, place, block, df = h[df > 1], place[df > 1], block[df > 1], df[df > 1]

    def back(block: np.ndarray, h: np.ndarray, df: np.ndarray, place: np.ndarray | None) -> None:
        order = np.argsort(block, kind="stable")
        block, h, df = block[order], h[order], df[order]
        begin = _runs(block).tolist()
        for a, b in zip(begin, [*begin[1:], len(h)], strict=False):
            at = None if place is None else place[order[a:b]].tobytes()
            out.append((names[block[a]], h[a:b].tobytes(), df[a:b].tobytes(), at, None, None))

    back(block, h, df, place)
    back(hot_block, hot, hot_df, None)
    return pd.DataFrame(out, columns=["block", "hashes", "dfs", "at", "nodes", "ns"])


def _sets(threshold: int):
    """Of one block: the nodes that share enough shingles, with these and their frequencies."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        head = next(r for r in rows if r["nodes"] is not None)
        names, ns = np.frombuffer(head["nodes"], np.int64), np.frombuffer(head["ns"], np.uint32)
        joined = lambda part, c, t: np.concatenate([np.empty(0, t), *(np.frombuffer(r[c], t) for r in part)])
        parts = [r for r in rows if r["nodes"] is None and r["at"] is not None]
        hot = [r for r in rows if r["nodes"] is None and r["at"] is None]
        h, df, at = (joined(parts, c, t) for c, t in (("hashes", np.uint64), ("dfs", np.uint32), ("at", np.uint16)))
        # the shingles that stayed, with the frequencies their buckets found
        stayed = np.frombuffer(head["hashes"], np.uint64)
        if len(stayed):
            hot_h, hot_df = joined(hot, "hashes", np.uint64), joined(hot, "dfs", np.uint32)
            order = np.argsort(hot_h)
            found = hot_df[order][np.searchsorted(hot_h[order], stayed)]
            h, df, at = np.append(h, stayed), np.append(df, found), np.append(at, np.frombuffer(head["at"], np.uint16))
        order = np.argsort(at, kind="stable")
        h, df, at = h[order], df[order], at[order]
        kept: dict[str, list] = {"block": [], "node": [], "n": [], "tokens": [], "dfs": []}
        begin = _runs(at).tolist()
        for a, b in zip(begin, [*begin[1:], len(h)], strict=False):
            n = int(ns[at[a]])
            if (b - a) * 100 >= n * threshold:
                values = (head["block"], int(names[at[a]]), n, h[a:b].tobytes(), df[a:b].tobytes())
                for name, value in zip(kept, values, strict=True):
                    kept[name].append(value)
        return pa.Table.from_pydict(kept, schema=pa.schema([
            ("block", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("tokens", pa.binary()), ("dfs", pa.binary()),
        ]))

    return run


def needed(n: int, threshold: int) -> int:
    """Shingles that a set of n shares with any partner, at least."""
    return -(-n * threshold // 100)


def signatures(n: int, tokens: np.ndarray, dfs: np.ndarray, threshold: int = THRESHOLD, rare: int = RARE) -> np.ndarray:
    """Signature hashes of a set of n shingles, of which `tokens` occur elsewhere too."""
    order = np.lexsort((tokens, dfs))
    tokens, dfs = tokens[order], dfs[order]
    tau = n - needed(n, threshold)
    alone = n - len(tokens)  # shingles of no other node: first in the order, without partner
    band = int(math.floor(math.log(n) / math.log(100 / threshold) + 1e-9))
    found = []
    for space in (band, band + 1):
        classes = max(1, int((100 / threshold) ** space) // 8)
        is_rare = dfs <= rare
        n_rare = int(is_rare.sum())
        singles = tokens[: min(n_rare, max(0, tau + 1 - alone))]
        count = alone + len(singles)
        salt = np.uint64(space * 2)
        found.append(_mixed(singles + salt))
        if count > tau:
            continue
        frequent = tokens[n_rare:]
        group = (_mixed(frequent) % np.uint64(classes)).astype(np.int64)
        # a class counts from its second shingle on
        by = np.argsort(group, kind="stable")
        first = np.concatenate([[True], group[by][1:] != group[by][:-1]]) if len(by) else np.empty(0, bool)
        adds = np.ones(len(frequent), np.int64)
        adds[by[first]] = 0
        reached = np.flatnonzero(count + np.cumsum(adds) > tau)
        end = int(reached[0]) + 1 if len(reached) else len(frequent)
        frequent, group = frequent[:end], group[:end]
        by = np.lexsort((frequent, group))
        frequent, group = frequent[by], group[by]
        step = 1
        while step < len(frequent):
            same = group[step:] == group[:-step]
            if not same.any():
                break
            found.append(_mixed(_mixed(frequent[:-step][same] + salt) + frequent[step:][same] + np.uint64(1)))
            step += 1
    return np.unique(np.concatenate(found))


def _signed(threshold: int, rare: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, n, tokens, dfs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                s = signatures(n, np.frombuffer(tokens, np.uint64), np.frombuffer(dfs, np.uint32), threshold, rare)
                yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64)), pa.array(np.full(len(s), node, np.int64))], ["sig", "node"])

    return run


def _overlaps(a: list[np.ndarray], b: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Intersection sizes of all sets of a with all of b, by products of 0/1 matrices."""
    both = np.concatenate([*a, *b])
    names, at = np.unique(both, return_inverse=True)
    row = np.repeat(np.arange(len(a) + len(b)), [len(s) for s in (*a, *b)])
    total = np.zeros((len(a), len(b)), np.float32)
    order = np.argsort(at, kind="stable")
    at, row = at[order], row[order]
    edges = np.searchsorted(at, np.arange(0, len(names) + width, width))
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        if lo == hi:
            continue
        matrix = np.zeros((len(a) + len(b), min(width, len(names) - i * width)), np.float32)
        matrix[row[lo:hi], at[lo:hi] - i * width] = 1
        total += matrix[: len(a)] @ matrix[len(a) :].T
    return total.astype(np.int64)


def linked(a: list[np.ndarray], na: np.ndarray, b: list[np.ndarray], nb: np.ndarray, threshold: int) -> np.ndarray:
    both = _overlaps(a, b)
    return 100 * both >= threshold * (na[:, None] + nb[None, :] - both)


def _forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of a symmetric link matrix."""
    left, edges = np.ones(len(links), bool), []
    for start in range(len(links)):
        if not left[start]:
            continue
        left[start] = False
        work = [start]
        while work:
            x = work.pop()
            for y in np.flatnonzero(links[x] & left).tolist():
                left[y] = False
                edges.append((x, y))
                work.append(y)
    return edges


FOUND = "a long, b long, links long"


def _verify(left: pd.DataFrame, right: pd.DataFrame | None, threshold: int) -> list[tuple]:
    """(node, other, 0) for forest edges and (node, null, links) for link counts, of one block or pair."""
    tokens = lambda f: [np.frombuffer(t, np.uint64) for t in f["tokens"]]
    na, ca, ia = (left[c].to_numpy(np.int64) for c in ("n", "copies", "node"))
    if right is None:
        links = linked(tokens(left), na, tokens(left), na, threshold)
        np.fill_diagonal(links, False)
        counts = [(ia, links @ ca)]
        edges = [(ia[x], ia[y]) for x, y in _forest(links)]
    else:
        nb, cb, ib = (right[c].to_numpy(np.int64) for c in ("n", "copies", "node"))
        links = linked(tokens(left), na, tokens(right), nb, threshold)
        counts = [(ia, links @ cb), (ib, links.T @ ca)]
        square = np.zeros((len(ia) + len(ib),) * 2, bool)
        square[: len(ia), len(ia) :] = links
        square[len(ia) :, : len(ia)] = links.T
        names = np.concatenate([ia, ib])
        edges = [(names[x], names[y]) for x, y in _forest(square)]
    rows = [(int(x), int(y), 0) for x, y in edges]
    for names, degree in counts:
        rows += [(int(x), None, int(d)) for x, d in zip(names, degree, strict=True) if d]
    return rows


def _result(rows: list[tuple]) -> pd.DataFrame:
    a, b, links = zip(*rows, strict=True) if rows else ((), (), ())
    # built as integers: node numbers need all 64 bits, which a float column would round
    return pd.DataFrame({"a": np.array(a, np.int64), "b": pd.array(b, dtype="Int64"), "links": np.array(links, np.int64)})


def _placed(many: DataFrame, meets: DataFrame, block: int) -> DataFrame:
    """The nodes of large clusters with `spot`, the number of their block.

    A node's home is the node it shares most signatures with, among the smallest ones of signatures. Large
    homes are cut into blocks by node, small ones of a cluster share blocks.
    """
    homes = meets.groupBy(F.col("b").alias("node")).agg(F.max_by("a", F.struct("shared", -F.col("a"))).alias("home"))
    spots = many.select("node", "root").join(homes, "node")
    sizes = spots.groupBy("root", "home").agg(F.count("*").alias("held"))
    small = F.when(F.col("held") <= block, F.col("held"))
    bins = sizes.groupBy("root").agg(F.ceil(F.coalesce(F.sum(small), F.lit(0)) / F.lit(block)).alias("bins"))
    pieces = F.ceil(F.col("held") / F.lit(block))
    spot = F.when(
        F.col("held") > block, F.xxhash64(F.lit(0), "root", "home", F.pmod(F.xxhash64("node"), pieces))
    ).otherwise(F.xxhash64(F.lit(1), "root", F.lit(0).cast("long"), F.pmod(F.xxhash64("home"), F.greatest("bins", F.lit(1)))))
    return spots.join(sizes, ["root", "home"]).join(bins, "root").select("node", spot.alias("spot"))


def _meeting(placed: DataFrame, signed: DataFrame) -> DataFrame:
    """Pairs (i, j) of different blocks that have a signature in common, each once."""
    spots = signed.join(placed, "node").groupBy("sig").agg(F.array_sort(F.collect_set("spot")).alias("spots"))
    spots = spots.where(F.size("spots") > 1).select("spots").distinct()
    first = spots.select("spots", F.posexplode("spots").alias("at", "i")).where(F.col("at") < F.size("spots") - 1)
    return first.select("i", F.explode(F.slice("spots", F.col("at") + 2, F.size("spots"))).alias("j")).distinct()


def _checked(clusters: DataFrame, total: int, signed: DataFrame, meets: DataFrame, threshold: int, block: int) -> DataFrame:
    """Exact links inside the clusters (node, root, size, n, copies, tokens), as `_verify` returns them."""
    cut = clusters.withColumn("blocks", F.ceil(F.col("size") / F.lit(block)).cast("int"))
    # small clusters share tasks; large ones are cut into blocks
    few = cut.where("blocks = 1").withColumn("task", F.pmod(F.xxhash64("root"), F.lit(-(-total // block) or 1)))

    def alone(frame: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for _, part in frame.groupby("root", sort=False):
            rows += _verify(part, None, threshold)
        return _result(rows)

    inside = few.groupBy("task").applyInPandas(alone, FOUND)
    many = cut.where("blocks > 1")
    placed = stored(_placed(many, meets, block), "jaccard-placed")
    packed = stored(
        many.join(placed, "node").groupBy("spot").agg(F.collect_list(F.struct("node", "n", "copies", "tokens")).alias("members")),
        "jaccard-blocks",
    )
    pairs = _meeting(placed, signed).unionByName(packed.select(F.col("spot").alias("i"), F.col("spot").alias("j")))
    pairs = pairs.join(packed.select(F.col("spot").alias("i"), F.col("members").alias("left")), "i").join(
        packed.select(F.col("spot").alias("j"), F.col("members").alias("right")), "j"
    )

    def frame_of(members) -> pd.DataFrame:
        return pd.DataFrame([(m["node"], m["n"], m["copies"], m["tokens"]) for m in members], columns=["node", "n", "copies", "tokens"])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, left, right in zip(*batch.columns, strict=True):
                a = frame_of(left.as_py())
                b = None if i.as_py() == j.as_py() else frame_of(right.as_py())
                yield pa.RecordBatch.from_pandas(_result(_verify(a, b, threshold)), schema=pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())]), preserve_index=False)

    return inside.unionByName(pairs.select("i", "j", "left", "right").mapInArrow(across, FOUND))


def link(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, shingle: int = SHINGLE,
    rare: int = RARE, bucket_shingles: int = BUCKET_SHINGLES, block: int = BLOCK, often: int = OFTEN, flush: int = 1_000_000,
) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links (documents it links with) of every document.

    `flush` is the number of shingles in a block of nodes; shingles of `often` nodes of a block stay with it.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    members = stored(
        docs.select(F.col(doc_id).alias("doc_id"), text).mapInArrow(
            _memberships(shingle), f"doc_id {kind}, n long, node long, digest binary"
        ),
        "jaccard-members",
    )
    nodes = members.where("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.min("n").alias("n"),
        F.min("digest").alias("d1"), F.max("digest").alias("d2"),
    )
    nodes = stored(nodes, "jaccard-nodes")
    total, clash = nodes.agg(F.sum("n"), F.sum((F.col("d1") != F.col("d2")).cast("int"))).first()
    if clash:
        raise ValueError("two different sets have the same 64-bit node number")
    buckets = max(1, -(-(total or 0) // bucket_shingles))
    spread = docs.select(text).mapInArrow(_spread(shingle, buckets, often, flush), _SPREAD)
    # one task per bucket; a shuffle of more parts than that would be slow to plan, so tasks take several then
    shared = spread.repartitionById(min(buckets, MOST_PARTS), "bucket").groupBy("bucket").applyInPandas(_shared, _RETURNED)
    held = shared.groupBy("block").applyInArrow(_sets(threshold), "block long, node long, n long, tokens binary, dfs binary")
    held = stored(held, "jaccard-held")
    # a node of several blocks is whole in the smallest
    sets = held.join(held.groupBy("node").agg(F.min("block").alias("block")), ["node", "block"]).drop("block")
    sets = stored(sets, "jaccard-sets")
    signed = stored(sets.mapInArrow(_signed(threshold, rare), "sig long, node long"), "jaccard-signatures")
    leaders = signed.groupBy("sig").agg(F.min("node").alias("leader"), F.count("*").alias("c")).where("c > 1").select("sig", "leader")
    meets = signed.join(leaders, "sig").groupBy(F.col("leader").alias("a"), F.col("node").alias("b")).agg(F.count("*").alias("shared"))
    meets = stored(meets, "jaccard-meets")
    clusters = components(meets.select("a", "b"))
    clusters = stored(with_groups(clusters, "root", "node", {"size": F.count("*")}, {"size": F.sum("size")}), "jaccard-clusters")
    n_clustered = clusters.count()
    ready = clusters.join(sets.select("node", "n", "tokens"), "node").join(nodes.select("node", "copies"), "node")
    found = stored(_checked(ready, n_clustered, signed, meets, threshold, block), "jaccard-links")
    roots = components(found.where("b is not null").select("a", "b"))
    degree = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    joined = nodes.join(roots, "node", "left").join(degree, "node", "left").select(
        "node", "first_id", "copies", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links")
    )
    joined = stored(joined, "jaccard-joined")
    least = {"component_id": F.min("first_id")}, {"component_id": F.min("component_id")}
    named = stored(with_groups(joined, "root", "node", *least).select("node", "component_id", (F.col("links") + F.col("copies") - 1).alias("n_links")), "jaccard-named")
    full = members.where("n > 0").join(named, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links")
    empty = members.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return full.unionByName(empty)
