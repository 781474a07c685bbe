"""Class-based n-gram scores (Brown et al.): words in classes found by exchange clustering.

Probability of a token after another: P(class | class before) * P(word | class).

1. Unigram counts of all training tokens. Words that make up at least 1 / `frequent` of them, and beyond
   them every word used `bucket_uses` times, are exchanged one by one; all others, the rare words, start in
   the class of their ending, and their class as context stays that one, which needs no lookup. So the
   exchanged vocabulary grows with the input, and no rare word is a large group.
2. Exchange of the frequent words: from the table of bigram counts every word's neighbour counts are
   gathered once; a sweep computes, for all words in parallel, the move that gains most average mutual
   information against the class bigram matrix (at most `classes` + `shapes` squared, the only shared
   state). All these moves are tried together; as long as they do not raise the objective, only the half of
   them with the larger gains is tried again. The next sweep begins with twice the share that did. A single
   move always gains, so exchange ends when no word gains by moving, or after `sweeps` sweeps.
3. Exchange of the rare words: their uses travel in blocks of documents, packed by hash bucket, so
   that a bucket holds every use of its words; it counts them, moves each to the rare class that gains
   most, and sends back to the blocks what scoring needs.
4. Scores: transitions are smoothed with the class shares, emissions of rare classes with half a count
   and one unknown word per class. Sums per document are added up by key.

All counts cover all training documents; the unigram, bigram and rare-use tables grow with them.

Nulls: a null text is empty (its end is its only token); a null id is training. Rows equal in id and
text share their sums and each keeps its row. Other columns are ignored; an empty table gives no row.
Without training tokens every probability is that of an unknown word.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

FREQUENT, CLASSES, SHAPES, SWEEPS = 50_000, 64, 64, 4
BUCKET_USES = 1_500_000
END = b"\n"
PRIOR = 50.0


def tokens_of(text: str | None) -> list[bytes]:
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), END]


def shape(word: bytes, shapes: int) -> int:
    return zlib.crc32(word[-2:]) % shapes


def _digest(text: str | None) -> int:
    return xxhash.xxh64_intdigest((text or "").encode("utf-8", "surrogatepass")) - (1 << 63)


_COUNTS = pa.schema([("word", pa.binary()), ("n", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": list(counts), "n": list(counts.values())}, schema=_COUNTS)

    for batch in batches:
        for text in batch.column(0):
            counts.update(tokens_of(text.as_py()))
            if len(counts) > 400_000:
                yield flush()
                counts.clear()
    if counts:
        yield flush()


class Encoder:
    """Numbers of frequent words, and rare words as `F + shape`."""

    def __init__(self, words: list[bytes], shapes: int):
        self.ids = {w: i for i, w in enumerate(words)}
        self.first_rare, self.shapes = len(words), shapes
        self.rare: dict[bytes, int] = {}

    def __call__(self, tokens: list[bytes]) -> np.ndarray:
        ids, rare = self.ids, self.rare
        if len(rare) > 500_000:
            rare.clear()
        out = []
        for t in tokens:
            i = ids.get(t)
            if i is None:
                i = rare.get(t)
                if i is None:
                    i = rare[t] = self.first_rare + shape(t, self.shapes)
            out.append(i)
        return np.array(out, np.int64)


def _pairs(words: list[bytes], shapes: int, flush: int = 2_000_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, size = Encoder(words, shapes), len(words) + shapes
        end = encode.ids[END]
        codes, total = [], 0

        def packed() -> pa.RecordBatch:
            code, n = np.unique(np.concatenate(codes), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array((code // size).astype(np.int32)), pa.array((code % size).astype(np.int32)), pa.array(n.astype(np.int64))],
                ["prev", "cur", "n"],
            )

        for batch in batches:
            for text in batch.column(0):
                cur = encode(tokens_of(text.as_py()))
                codes.append(np.concatenate([[end], cur[:-1]]) * size + cur)
                total += len(cur)
                if total >= flush:
                    yield packed()
                    codes, total = [], 0
        if codes:
            yield packed()

    return run


def _cells(total: np.ndarray) -> pa.RecordBatch:
    cell = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(total[cell])], ["cell", "n"])


def _summed(cells: DataFrame, size: int) -> np.ndarray:
    """Sum of the tasks' arrays; at most `size` rows reach the driver, however many tasks there are."""
    total = np.zeros(size)
    for row in cells.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        total[row["cell"]] = row["n"]
    return total


def _class_matrix(pairs: DataFrame, cls: np.ndarray, g: int) -> np.ndarray:
    """Counts of class bigrams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(g * g)
        for batch in batches:
            prev, cur, n = (c.to_numpy() for c in batch.columns)
            total += np.bincount(cls[prev] * g + cls[cur], weights=n, minlength=g * g)
        yield _cells(total)

    return _summed(pairs.mapInArrow(run, "cell int, n double"), g * g).reshape(g, g)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-12))


def objective(m: np.ndarray) -> float:
    return float(_xlogx(m).sum() - _xlogx(m.sum(0)).sum() - _xlogx(m.sum(1)).sum())


def best_class(left: np.ndarray, right: np.ndarray, own: float, at: int, m: np.ndarray, classes: int) -> tuple[int, float]:
    """The class a word moves to, and the gain over staying, given its neighbours' class counts.

    `own` is how often the word follows itself, `at` its class; all other words stay.
    """
    m = m.copy()
    m[at, :] -= right
    m[:, at] -= left
    m[at, at] += own
    left, right = left.copy(), right.copy()
    left[at] -= own
    right[at] -= own
    rows, columns = m[:classes], m[:, :classes].T
    gain = (_xlogx(rows + right) - _xlogx(rows)).sum(1) + (_xlogx(columns + left) - _xlogx(columns)).sum(1)
    k = np.arange(classes)
    diagonal, l, r = m[k, k], left[k], right[k]
    gain -= _xlogx(diagonal + r) + _xlogx(diagonal + l) - 2 * _xlogx(diagonal)
    gain += _xlogx(diagonal + l + r + own) - _xlogx(diagonal)
    n_right, n_left = right.sum() + own, left.sum() + own
    # the words before and after it keep their transitions, whichever class it has
    out, into = m.sum(1)[:classes] + l, m.sum(0)[:classes] + r
    gain -= _xlogx(out + n_right) - _xlogx(out) + _xlogx(into + n_left) - _xlogx(into)
    to = int(gain.argmax())
    return to, float(gain[to] - gain[at])


def exchange(pairs: DataFrame, n_words: int, classes: int, shapes: int, sweeps: int) -> tuple[np.ndarray, np.ndarray]:
    """Class of every word number (frequent ones, then shapes) and the class bigram matrix."""
    g, size = classes + shapes, n_words + shapes
    cls = np.concatenate([np.arange(n_words) % classes, classes + np.arange(shapes)]).astype(np.int64)
    both = pairs.select(F.col("cur").alias("w"), F.col("prev").alias("code"), "n").unionByName(
        pairs.select(F.col("prev").alias("w"), (F.col("cur") + size).alias("code"), "n")
    )
    contexts = stored(
        both.where(F.col("w") < n_words).groupBy("w").agg(F.collect_list("code").alias("codes"), F.collect_list("n").alias("ns")),
        "brown-contexts",
    )
    m, share = _class_matrix(pairs, cls, g), 1.0
    for _ in range(sweeps):

        def move(batches: Iterator[pa.RecordBatch], cls=cls, m=m) -> Iterator[pa.RecordBatch]:
            doubled = np.concatenate([cls, cls + g])
            for batch in batches:
                words, to, gains = [], [], []
                for w, codes, ns in zip(*batch.columns, strict=True):
                    w = w.as_py()
                    codes, ns = codes.values.to_numpy(), ns.values.to_numpy()
                    counts = np.bincount(doubled[codes], weights=ns, minlength=2 * g)
                    own = float(ns[codes == w].sum())
                    best, gain = best_class(counts[:g], counts[g:], own, int(cls[w]), m, classes)
                    if gain > 1e-6 and best != cls[w]:
                        words.append(w)
                        to.append(best)
                        gains.append(gain)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words, pa.int32()), pa.array(to, pa.int32()), pa.array(gains, pa.float64())], ["w", "to", "gain"]
                )

        # at most one row per frequent word
        moves = sorted(contexts.mapInArrow(move, "w int, to int, gain double").collect(), key=lambda r: (-r["gain"], r["w"]))
        moves = moves[: math.ceil(len(moves) * share)]
        while moves:
            tried = cls.copy()
            for row in moves:
                tried[row["w"]] = row["to"]
            after = _class_matrix(pairs, tried, g)
            if objective(after) > objective(m):
                cls, m, share = tried, after, min(1.0, 2 * share)
                break
            moves, share = moves[: len(moves) // 2], share / 2
        if not moves:
            break
    return cls, m


def transitions(m: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """Smoothed P(class | class before)."""
    total = max(m.sum(), 1.0)
    share = (m.sum(0) + 0.5) / (total + 0.5 * m.shape[1])
    return (m + prior * share) / (m.sum(1, keepdims=True) + prior)


_SPREAD = (
    "bucket int, block long, hashes binary, at binary, before binary, shapes binary, docs binary, ids binary,"
    " has_id binary, digests binary, train binary"
)
_NAMES = [x.split()[0] for x in _SPREAD.split(", ")]


def _uses(words: list[bytes], shapes: int, cls: np.ndarray, buckets: int, flush: int = 1_000_000):
    """Uses of rare words, packed by bucket: word hash, document, class before, shape."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(words, shapes)
        end, first = encode.ids[END], encode.first_rare
        hashes, owners, before, kinds, docs, total = [], [], [], [], [], 0
        known: dict[bytes, int] = {}

        def packed() -> pa.RecordBatch:
            h, owner = np.concatenate(hashes), np.concatenate(owners)
            g, kind = np.concatenate(before), np.concatenate(kinds)
            ids = np.array([0 if d[0] is None else d[0] for d in docs], np.int64)
            has = np.array([d[0] is not None for d in docs], np.uint8)
            digest, train = np.array([d[1] for d in docs], np.int64), np.array([d[2] for d in docs], np.uint8)
            bucket = (h % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            h, owner, g, kind, bucket = h[order], owner[order], g[order], kind[order], bucket[order]
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            # Blocks of equal documents may share a number: their sums per document then add up as well.
            block = xxhash.xxh64_intdigest(ids.tobytes() + has.tobytes() + digest.tobytes()) - (1 << 63)
            rows: dict[str, list] = {n: [] for n in _NAMES}
            for a, b in zip([0, *cuts], [*cuts, len(h)], strict=True):
                used, at = np.unique(owner[a:b], return_inverse=True)
                parts = (
                    h[a:b], at.astype(np.uint32), g[a:b].astype(np.uint8), kind[a:b].astype(np.uint8), used.astype(np.uint32),
                    ids[used], has[used], digest[used], train[used],
                )
                values = (int(bucket[a]), block, *(x.tobytes() for x in parts))
                for name, value in zip(_NAMES, values, strict=True):
                    rows[name].append(value)
            return pa.RecordBatch.from_pydict(rows, pa.schema([("bucket", pa.int32()), ("block", pa.int64()), *((n, pa.binary()) for n in _NAMES[2:])]))

        for batch in batches:
            for doc_id, text, held_out in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens = tokens_of(text)
                ids = encode(tokens)
                at = np.flatnonzero(ids >= first)
                if not len(at):
                    continue
                if len(known) > 500_000:
                    known.clear()
                h = np.empty(len(at), np.uint64)
                for i, j in enumerate(at.tolist()):
                    word = tokens[j]
                    x = known.get(word)
                    if x is None:
                        x = known[word] = xxhash.xxh64_intdigest(word)
                    h[i] = x
                previous = np.concatenate([[end], ids[:-1]])[at]
                hashes.append(h)
                owners.append(np.full(len(at), len(docs), np.uint32))
                before.append(cls[previous])
                kinds.append(ids[at] - first)
                docs.append((doc_id, _digest(text), not held_out))
                total += len(at)
                if total >= flush:
                    yield packed()
                    hashes, owners, before, kinds, docs, total = [], [], [], [], [], 0
        if docs:
            yield packed()

    return run


_RARE = (
    "block long, docs binary, ids binary, has_id binary, digests binary, starts binary, codes binary, logs binary,"
    " known binary, bases binary, n binary, types binary"
)


def _rare_words(m: np.ndarray, classes: int, shapes: int, n_tokens: int, n_types: int, slice_rows: int = 50_000):
    """Of one bucket: counts and classes of its words, and per block what its documents need of them."""
    g = classes + shapes
    start = m[:, classes:]
    log_to = np.log((start + PRIOR * (start.sum(0) + 0.5) / (start.sum() + 0.5 * shapes)) / (start.sum(1, keepdims=True) + PRIOR))
    log_size = np.log(start.sum(0) + 1.0)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        h = np.concatenate([np.frombuffer(x, np.uint64) for x in frame["hashes"]])
        before = np.concatenate([np.frombuffer(x, np.uint8) for x in frame["before"]])
        kind = np.concatenate([np.frombuffer(x, np.uint8) for x in frame["shapes"]])
        docs, ids, has, digests, train = (
            np.concatenate([np.frombuffer(x, t) for x in frame[c]])
            for c, t in (("docs", np.uint32), ("ids", np.int64), ("has_id", np.uint8), ("digests", np.int64), ("train", np.uint8))
        )
        sizes = [len(x) for x in frame["train"]]
        offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        doc = np.concatenate([np.frombuffer(x, np.uint32).astype(np.int64) + o for x, o in zip(frame["at"], offsets, strict=True)])
        order = np.argsort(h, kind="stable")
        h, before, kind, doc = h[order], before[order], kind[order], doc[order]
        begin = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        word = np.repeat(np.arange(len(begin)), np.diff(np.concatenate([begin, [len(h)]])))
        is_train = train[doc].astype(bool)
        count = np.bincount(word[is_train], minlength=len(begin))
        cls = kind[begin].astype(np.int64)
        # exchange: the class whose place in the contexts gains most. A word has at most g different contexts,
        # so slices between words bound the memory however often one word is used.
        context, uses = np.unique(word[is_train] * g + before[is_train], return_counts=True)
        w, b = context // g, context % g
        edges = np.searchsorted(w, np.append(w[::slice_rows], len(begin)))
        for a, e in zip(edges[:-1], edges[1:], strict=True):
            if a < e:
                first = a + np.flatnonzero(np.diff(w[a:e], prepend=-1))
                gains = np.add.reduceat(log_to[b[a:e]] * uses[a:e, None], first - a, axis=0) - count[w[first]][:, None] * log_size
                own = cls[w[first]]
                best = gains.argmax(1)
                better = gains[np.arange(len(first)), best] > gains[np.arange(len(first)), own] + 1e-9
                cls[w[first]] = np.where(better, best, own)
        counts = np.zeros((g, shapes))
        np.add.at(counts, (before[is_train], cls[word[is_train]]), 1)
        types = np.bincount(cls[count > 0], minlength=shapes).astype(np.float64)
        by = np.argsort(doc, kind="stable")
        doc, word, before = doc[by], word[by], before[by]
        codes = before.astype(np.uint16) * np.uint16(shapes) + cls[word].astype(np.uint16)
        c = count[word]
        logs, base = np.log10(c + 0.5), np.log10((c + 0.5) / (n_tokens + 0.5 * (n_types + 1)))
        # every document of a row has uses in it, so rows are runs of the sorted documents
        ends = np.cumsum(sizes)
        edges = np.searchsorted(doc, np.concatenate([[0], ends]))
        rows = []
        for i, block in enumerate(frame["block"]):
            a, b = edges[i], edges[i + 1]
            d = doc[a:b]
            begin = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
            used = d[begin]
            rows.append((
                int(block), docs[used].tobytes(), ids[used].tobytes(), has[used].tobytes(), digests[used].tobytes(),
                np.concatenate([begin, [b - a]]).astype(np.int64).tobytes(), codes[a:b].tobytes(),
                np.add.reduceat(logs[a:b], begin).tobytes(),
                np.add.reduceat((c[a:b] > 0).astype(np.int64), begin).tobytes(), np.add.reduceat(base[a:b], begin).tobytes(),
                # the bucket's class counts go with its first row
                counts.tobytes() if not i else None, types.tobytes() if not i else None,
            ))
        return pd.DataFrame(rows, columns=[x.split()[0] for x in _RARE.split(", ")])

    return run


SUMS = "doc_id long, digest long, held_out boolean, n_rows long, n_tokens long, n_known long, base_score double, score double"
_SUMS = pa.schema([
    ("doc_id", pa.int64()), ("digest", pa.int64()), ("held_out", pa.bool_()), ("n_rows", pa.int64()), ("n_tokens", pa.int64()),
    ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
])


def _rare_sums(log_to: np.ndarray, log_size: np.ndarray, shapes: int):
    """Of one block: sums over its documents' rare words, one row per document."""
    cost = (log_to - log_size).ravel()

    def run(table: pa.Table) -> pa.Table:
        doc, score, base, known, ids, has, digests = [], [], [], [], [], [], []
        for row in table.to_pylist():
            starts = np.frombuffer(row["starts"], np.int64)
            codes = np.frombuffer(row["codes"], np.uint16)
            score.append(np.frombuffer(row["logs"]) + np.add.reduceat(cost[codes], starts[:-1]))
            for values, name, kind in (
                (doc, "docs", np.uint32), (base, "bases", np.float64), (known, "known", np.int64), (ids, "ids", np.int64),
                (has, "has_id", np.uint8), (digests, "digests", np.int64),
            ):
                values.append(np.frombuffer(row[name], kind))
        _, first, at = np.unique(np.concatenate(doc), return_index=True, return_inverse=True)
        add = lambda parts: np.bincount(at, weights=np.concatenate(parts), minlength=len(first))
        n = len(first)
        return pa.Table.from_arrays([
            pa.array(np.concatenate(ids)[first], mask=~np.concatenate(has)[first].astype(bool)),
            pa.array(np.concatenate(digests)[first]), pa.nulls(n, pa.bool_()), pa.array(np.zeros(n, np.int64)),
            pa.array(np.zeros(n, np.int64)), pa.array(add(known).astype(np.int64)), pa.array(add(base)), pa.array(add(score)),
        ], schema=_SUMS)

    return run


def _frequent_sums(words: list[bytes], counts: np.ndarray, shapes: int, cls: np.ndarray, log_to: np.ndarray, log_word: np.ndarray, base: np.ndarray):
    """Per row: the sums over its frequent tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(words, shapes)
        end, first = encode.ids[END], encode.first_rare
        known = counts > 0
        for batch in batches:
            out: dict[str, list] = {n: [] for n in _SUMS.names}
            for doc_id, text, held_out in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = encode(tokens_of(text))
                previous = np.concatenate([[end], ids[:-1]])
                at = ids < first
                cur, before = ids[at], cls[previous[at]]
                values = (doc_id, _digest(text), held_out, 1, len(ids), int(known[cur].sum()), float(base[cur].sum()), float((log_to[before, cls[cur]] + log_word[cur]).sum()))
                for name, value in zip(_SUMS.names, values, strict=True):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=_SUMS)

    return run


def score(
    docs: DataFrame, held_out: F.Column, doc_id: str = "doc_id", text: str = "text", frequent: int = FREQUENT,
    classes: int = CLASSES, shapes: int = SHAPES, sweeps: int = SWEEPS, bucket_uses: int = BUCKET_USES,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out")
    )
    train = rows.where("not held_out")
    counts = stored(
        train.select("text").mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "brown-counts"
    )
    n_tokens, n_types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # at most `frequent` words can make up 1 / frequent of all tokens, and tokens / bucket_uses be used so often
    often = (F.col("n") * frequent >= n_tokens) | (F.col("n") >= bucket_uses) | (F.col("word") == F.lit(bytearray(END)))
    common = counts.where(often).orderBy(F.desc("n"), "word").collect()
    words, word_counts = [bytes(r["word"]) for r in common], np.array([r["n"] for r in common], np.int64)
    if END not in words:  # no training rows
        words, word_counts = [*words, END], np.append(word_counts, 0).astype(np.int64)
    pairs = stored(
        train.select("text").mapInArrow(_pairs(words, shapes), "prev int, cur int, n long").groupBy("prev", "cur").agg(F.sum("n").alias("n")),
        "brown-pairs",
    )
    cls, m = exchange(pairs, len(words), classes, shapes, sweeps)
    n_rare = max(0, int(m[:, classes:].sum()) + n_tokens // 5)
    buckets = max(1, -(-n_rare // bucket_uses))
    uses = rows.select("doc_id", "text", "held_out").mapInArrow(_uses(words, shapes, cls, buckets), _SPREAD)
    rare = stored(uses.groupBy("bucket").applyInPandas(_rare_words(m, classes, shapes, n_tokens, n_types), _RARE), "brown-rare")

    g = classes + shapes
    m = m.copy()

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(g * shapes + shapes)
        for batch in batches:
            for n, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total += np.concatenate([np.frombuffer(n), np.frombuffer(t)])
        yield _cells(total)

    total = _summed(rare.where("n is not null").select("n", "types").mapInArrow(matrices, "cell int, n double"), g * shapes + shapes)
    m[:, classes:] = total[: g * shapes].reshape(g, shapes)
    types = total[g * shapes :]
    log_to = np.log10(transitions(m))
    sizes = m.sum(0)
    log_word = np.log10(np.maximum(word_counts, 0.5) / np.maximum(sizes[cls[: len(words)]], 1.0))
    base = np.log10((word_counts + 0.5) / (n_tokens + 0.5 * (n_types + 1)))
    log_size = np.log10(sizes[classes:] + 0.5 * (types + 1))
    parts = rows.mapInArrow(_frequent_sums(words, word_counts, shapes, cls, log_to, log_word, base), SUMS).unionByName(
        rare.drop("n", "types").groupBy("block").applyInArrow(_rare_sums(log_to[:, classes:], log_size, shapes), SUMS)
    )
    summed = parts.groupBy("doc_id", "digest").agg(
        F.max("held_out").alias("held_out"), F.sum("n_rows").alias("copies"),
        *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")),
    )
    per_row = lambda c: (F.col(c) / F.col("copies")).alias(c)
    whole = lambda c: F.expr(f"{c} div copies").alias(c)
    return summed.select(
        "doc_id", "held_out", whole("n_tokens"), whole("n_known"), F.lit(int(n_tokens)).cast("long").alias("train_tokens"),
        per_row("base_score"), per_row("score"), F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("_c"),
    ).drop("_c")
