"""Alignment of two tokenizers' tokens by the bytes they cover, and how many documents link two ids.

Tokens of both sides are intervals of the same bytes. Every token points to its farthest-right
overlapping token: the one of the other side that covers its last byte, if that one ends later (of
two that end together, side A points to side B). Doubling the successors of all tokens of a block of
documents at once converges to the terminal token of each connected run; the terminal labels the
group, whose bounds are the offsets at which tokens of both sides end. All tokens of a group are
linked across the sides.

At scale: documents are cut into blocks of about `BLOCK_BYTES` of text, and a block is one row of
arrays: its documents' numbers and the distinct id pairs of each. Pairs are counted first per block,
so a pair that every document holds is one row per block; counts and each A id's highest count meet
the blocks' distinct pairs by key and go back as one array per block. Nothing is broadcast, and what a
task holds is bounded by the block, or by the one document that is longer: the links of a block are packed
into bytes, and its file has a row group every `GROUP_BLOCKS` blocks, as a reader holds a whole one.

Long texts are encoded in pieces of about `PIECE_BYTES`, cut only before a space between two ASCII
letters: neither tokenizer has a token across that place (of B this is checked in its vocabulary).
Only a text without such a place is encoded in one piece.

Nulls: null and empty texts have no tokens, as have texts whose tokens do not spell the text; such
documents give zeros and an empty hash. Rows with a null or repeated id are documents of their own.
An empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

BLOCK_BYTES = 3 << 19
BLOCK_ROWS = 8_192
PIECE_BYTES = 64 << 10
#: Blocks of a row group: readers take up to 4096 rows of one at once, whatever their size.
GROUP_BLOCKS = 8
#: Links are listed in slices of at most about this many.
SLICE = 1 << 20
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
FOLDER = "/opt/tokenizers"
#: How byte-level encoding splits words, and characters outside of which the libraries' classes may differ.
_WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_UNUSUAL = re.compile("[^\x00-\u024f\u2010-\u2027\u20ac]")
_CUT = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")


class Side:
    """One tokenizer: ids of texts, and the bytes of every id."""

    def __init__(self, spelled: list[bytes], encode, begins_with_space: bool):
        self.spelled, self.encode = spelled, encode
        self.size = np.array([len(s) for s in spelled], np.int64)
        # One text per id and separator: within a side, between sides, between groups, at the end.
        self.names = [f"{i}{mark}" for i in range(len(spelled)) for mark in (",", "|", ";", "")]
        self.begins_with_space = begins_with_space

    def spells(self, ids: list[int], data: bytes) -> bool:
        return b"".join(map(self.spelled.__getitem__, ids)) == data


@lru_cache(maxsize=1)
def sides(folder: str) -> tuple[Side, Side]:
    """Both tokenizers, loaded once per worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(f"{folder}/{A_FILE}")
    a.encode_special_tokens = True
    # Printable bytes stand for themselves, the others for the characters from 256 on.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    spelled_a: list[bytes] = [b""] * a.get_vocab_size()
    for token, i in a.get_vocab().items():
        spelled_a[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{B_FILE}")
    pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    spelled_b = [
        bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
    ]
    splits = not any(re.search("[A-Za-z]▁", p) for p in pieces)
    quick = _ranked(json.loads(a.to_str()), spelled_a)

    def encode_a(texts: list[str]) -> list:
        if quick is None or any(_UNUSUAL.search(t) for t in texts):
            return [e.ids for e in a.encode_batch_fast(texts, add_special_tokens=False)]
        return [quick.encode_ordinary(t) for t in texts]

    return Side(spelled_a, encode_a, True), Side(spelled_b, lambda texts: b.encode(texts, num_threads=1), splits)


def _ranked(file: dict, spelled: list[bytes]):
    """A faster encoder of the same file, where its merges stand in order of their ids; else None."""
    import tiktoken

    merges, vocabulary = file["model"]["merges"], file["model"]["vocab"]
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
    if file["pre_tokenizer"].get("type") != "ByteLevel" or [vocabulary[x + y] for x, y in pairs] != list(range(256, 256 + len(pairs))):
        return None
    ranks = {spelled[i]: i for i in vocabulary.values() if i < 256 + len(pairs)}
    return tiktoken.Encoding("a", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})


def pieces_of(text: str, size: int = PIECE_BYTES) -> list[str]:
    """The text cut before spaces that no token crosses; the space at a cut is left out."""
    out, start = [], 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if cut is None:
            break
        out.append(text[start : cut.start()])
        start = cut.end()
    out.append(text[start:])
    return out


def encoded(texts: list[str], folder: str) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Ids of space+text on both sides; both empty where they do not spell the text."""
    a, b = sides(folder)
    parts, owner = [], []
    for i, text in enumerate(texts):
        cut = pieces_of(text) if b.begins_with_space else [text]
        parts += cut
        owner += [i] * len(cut)
    ids: list[tuple[list, list]] = [([], []) for _ in texts]
    fits = [bool(text) for text in texts]
    start = 0
    while start < len(parts):
        end, size = start, 0
        while end < len(parts) and (end == start or size + len(parts[end]) <= 4 * PIECE_BYTES):
            size += len(parts[end])
            end += 1
        some = [" " + p for p in parts[start:end]]
        for i, part, x, y in zip(owner[start:end], some, a.encode(some), b.encode(parts[start:end]), strict=True):
            data = part.encode("utf-8", "surrogatepass")
            fits[i] = fits[i] and a.spells(x, data) and b.spells(y, data)
            ids[i][0].append(np.array(x, np.int32))
            ids[i][1].append(np.array(y, np.int32))
        start = end
    none = np.empty(0, np.int32)
    return tuple([np.concatenate(x[side]) if ok else none for x, ok in zip(ids, fits, strict=True)] for side in (0, 1))


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """Label of every token (side A, then side B): the last token of its connected run, by pointer jumping.

    Both sides cover the same bytes from 0 on; ends are ascending.
    """
    n = len(ends_a)
    over_a = np.searchsorted(ends_b, ends_a, "left")  # the token of B that covers A's last byte
    over_b = np.searchsorted(ends_a, ends_b, "left")
    to = np.empty(n + len(ends_b), np.int64)
    to[:n] = over_a + n
    own = np.arange(n, n + len(ends_b))
    to[n:] = np.where(ends_a[over_b] > ends_b, over_b, own) if n else own
    while True:
        further = to[to]
        if np.array_equal(further, to):
            return to
        to = further


class Block:
    """Groups and links of a run of documents, all at once."""

    def __init__(self, ids_a: list[np.ndarray], ids_b: list[np.ndarray], folder: str):
        a, b = sides(folder)
        self.n_a, self.n_b = np.array([len(x) for x in ids_a], np.int64), np.array([len(x) for x in ids_b], np.int64)
        n_docs = len(ids_a)
        self.a, self.b = (np.concatenate(x).astype(np.int64) for x in (ids_a, ids_b))
        doc_a, doc_b = np.repeat(np.arange(n_docs), self.n_a), np.repeat(np.arange(n_docs), self.n_b)
        # Documents follow each other in the bytes; both sides end where a document ends.
        label = terminals(np.cumsum(a.size[self.a]), np.cumsum(b.size[self.b]))
        # A group's terminal is its last token of side B, so counting terminals numbers the groups in order.
        n = len(self.a)
        last = label[n:] == np.arange(n, n + len(self.b))
        number = np.cumsum(last) - 1
        self.group_a, self.group_b = number[label[:n] - n], number[label[n:] - n]
        self.doc_of_group = doc_b[last]
        self.n_groups = np.bincount(self.doc_of_group, minlength=n_docs)
        self.in_a = np.bincount(self.group_a, minlength=len(self.doc_of_group))
        self.in_b = np.bincount(self.group_b, minlength=len(self.doc_of_group))
        before = np.concatenate([[0], np.cumsum(self.in_a * self.in_b)])
        self.n_links = np.diff(before[np.concatenate([[0], np.cumsum(self.n_groups)])])
        self._links()
        self.hashes = self._hashes(a, b, doc_a, doc_b)

    @staticmethod
    def _distinct(groups: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """group, id and number of uses of the distinct ids of groups, by group."""
        keys, uses = np.unique(groups << 16 | ids, return_counts=True)
        return keys >> 16, keys & 0xFFFF, uses

    def _links(self) -> None:
        """Distinct pairs (document << 32 | A id << 16 | B id) and how often each is linked."""
        single = (self.in_a == 1) & (self.in_b == 1)
        of_a, of_b = single[self.group_a], single[self.group_b]
        keys = [self.doc_of_group[single] << 32 | self.a[of_a] << 16 | self.b[of_b]]
        uses = [np.ones(len(keys[0]), np.int64)]
        group_a, id_a, use_a = self._distinct(self.group_a[~of_a], self.a[~of_a])
        group_b, id_b, use_b = self._distinct(self.group_b[~of_b], self.b[~of_b])
        first = np.searchsorted(group_b, group_a, "left")
        width = np.searchsorted(group_b, group_a, "right") - first
        upto, start = np.cumsum(width), 0
        while start < len(group_a):
            end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + SLICE, "right")))
            w = width[start:end]
            left = np.repeat(np.arange(start, end), w)
            right = np.repeat(first[start:end] - np.cumsum(w) + w, w) + np.arange(w.sum())
            key, use = self._summed(
                self.doc_of_group[group_a[left]] << 32 | id_a[left] << 16 | id_b[right], use_a[left] * use_b[right]
            )
            keys.append(key)
            uses.append(use)
            start = end
        self.links, self.uses = self._summed(np.concatenate(keys), np.concatenate(uses))

    @staticmethod
    def _summed(keys: np.ndarray, uses: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys in order and the sums of their uses."""
        order = np.argsort(keys)
        keys = keys[order]
        begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
        return keys[begins], np.add.reduceat(uses[order], begins) if len(keys) else np.empty(0, np.int64)

    def _hashes(self, a: Side, b: Side, doc_a: np.ndarray, doc_b: np.ndarray) -> list[str]:
        # Places of the tokens when each group's A tokens stand before its B tokens.
        upto_a, upto_b = np.cumsum(self.in_a), np.cumsum(self.in_b)
        place_a = np.arange(len(self.a)) + (upto_b - self.in_b)[self.group_a]
        place_b = np.arange(len(self.b)) + upto_a[self.group_b]

        def merged(of_a: np.ndarray, of_b: np.ndarray) -> np.ndarray:
            out = np.empty(len(of_a) + len(of_b), np.int64)
            out[place_a], out[place_b] = of_a, of_b
            return out

        side = merged(np.zeros(len(self.a), np.int64), np.ones(len(self.b), np.int64))
        group, ids, doc = merged(self.group_a, self.group_b), merged(self.a, self.b), merged(doc_a, doc_b)
        ends = np.append(doc[1:] != doc[:-1], True) if len(doc) else np.empty(0, bool)
        mark = np.zeros(len(ids), np.int64)
        mark[:-1] = np.where(group[1:] != group[:-1], 2, np.where(side[1:] != side[:-1], 1, 0))
        mark[ends] = 3
        at = (ids * 4 + mark).tolist()
        side = side.tolist()
        out, names, start = [], (a.names, b.names), 0
        for n in (self.n_a + self.n_b).tolist():
            if n:
                text = "".join([names[s][i] for s, i in zip(side[start : start + n], at[start : start + n], strict=True)])
                out.append(hashlib.sha256(text.encode()).hexdigest())
            else:
                out.append("")
            start += n
        return out


NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def packed(values: np.ndarray) -> bytes:
    """Numbers from 0 on as little-endian unsigned integers of the fewest bytes that hold all of them."""
    most = int(values.max()) if len(values) else 0
    return values.astype(f"<u{next(n for n in (1, 2, 4, 8) if most >> 8 * n == 0)}").tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    """The n numbers of `packed`."""
    return np.frombuffer(data, f"<u{len(data) // n}").astype(np.int64) if n else np.empty(0, np.int64)


def _blocks(docs: DataFrame, doc_id: str, text: str, folder: str) -> DataFrame:
    """One row per block: its documents' numbers, hashes and pairs, and the distinct pairs with their documents."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0

        def finish(ids: list[pa.Array], ids_a: list, ids_b: list):
            block = Block(ids_a, ids_b, folder)
            pairs, at = np.unique(block.links & 0xFFFFFFFF, return_inverse=True)
            per_doc = np.bincount(block.links >> 32, minlength=len(ids_a))
            one = lambda values, t: pa.array([values], pa.list_(t))
            known = pa.concat_arrays(ids)
            columns = {
                "block": pa.array([task << 33 | made], pa.int64()),
                "ids": pa.ListArray.from_arrays(pa.array([0, len(known)], pa.int32()), known),
                **{n: one(getattr(block, n), pa.int64()) for n in NUMBERS},
                "hashes": one(block.hashes, pa.string()),
                "per_doc": one(per_doc, pa.int32()),
                "at": pa.array([packed(at)], pa.binary()), "uses": pa.array([packed(block.uses)], pa.binary()),
                "pairs": one(pairs, pa.int64()), "docs": one(np.bincount(at, minlength=len(pairs)), pa.int64()),
            }
            return pa.RecordBatch.from_pydict(columns)

        ids, ids_a, ids_b, size = [], [], [], 0
        for batch in batches:
            texts, start = batch.column(1), 0
            while start < batch.num_rows:
                end = start
                while end < batch.num_rows and size < BLOCK_BYTES and len(ids_a) + end - start < BLOCK_ROWS:
                    size += len(texts[end].as_py() or "") + 64
                    end += 1
                a, b = encoded([t or "" for t in texts.slice(start, end - start).to_pylist()], folder)
                ids.append(batch.column(0).slice(start, end - start))
                ids_a += a
                ids_b += b
                start = end
                if size >= BLOCK_BYTES or len(ids_a) >= BLOCK_ROWS:
                    yield finish(ids, ids_a, ids_b)
                    made += 1
                    ids, ids_a, ids_b, size = [], [], [], 0
        if ids_a:
            yield finish(ids, ids_a, ids_b)

    numbers = ", ".join(f"{n} array<long>" for n in NUMBERS)
    schema = f"block long, ids array<{kind}>, {numbers}, hashes array<string>, per_doc array<int>, at binary, uses binary"
    made = docs.select(doc_id, text).mapInArrow(run, f"{schema}, pairs array<long>, docs array<long>")
    # Pages are else looked at every hundred rows, and row groups are closed by size only.
    limits = {"parquet.block.row.count.limit": GROUP_BLOCKS, "parquet.page.size.row.check.min": 1}
    return stored(made, "alignment", limits)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """pair, count, is_best from rows of pair and documents: is_best marks the highest counts of the pair's A id."""
    counts = pairs.groupBy("pair").agg(F.sum("docs").alias("count"))
    side_a = F.shiftright("pair", 16)
    best = counts.groupBy(side_a.alias("a")).agg(F.max("count").alias("most"))
    return counts.join(best, side_a == F.col("a")).select("pair", "count", (F.col("count") == F.col("most")).alias("is_best"))


def align(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folder: str = FOLDER) -> DataFrame:
    """Groups, links and their corpus-wide counts of every document."""
    blocks = _blocks(docs, doc_id, text, folder)
    listed = F.posexplode(F.arrays_zip("pairs", "docs")).alias("n", "p")
    pairs = blocks.select("block", listed).select("block", "n", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs"))
    counts = stored(pair_counts(pairs), "alignment-counts")
    back = (
        pairs.select("block", "n", "pair").join(counts, "pair")
        .groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("n", "count", "is_best"))).alias("known"))
    )
    joined = blocks.drop("pairs", "docs").join(back, "block", "left").select(
        "ids", *NUMBERS, "hashes", "per_doc", "at", "uses", "known"
    )
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                cell = lambda name: batch.column(name)[row].values  # noqa: E731, B023
                ids, per_doc = cell("ids"), cell("per_doc").to_numpy()
                links = int(per_doc.sum())
                at, uses = (unpacked(batch.column(name)[row].as_buffer(), links) for name in ("at", "uses"))  # noqa: B023
                n_best = count_sum = np.zeros(len(ids), np.int64)
                if links:
                    known = cell("known")
                    count = known.field("count").to_numpy()
                    best = known.field("is_best").to_numpy(zero_copy_only=False)
                    totals = lambda values: np.diff(np.concatenate([[0], np.cumsum(values)])[np.concatenate([[0], np.cumsum(per_doc)])])  # noqa: E731, B023
                    n_best, count_sum = totals(uses * best[at]), totals(uses * count[at])
                yield pa.RecordBatch.from_arrays(
                    [ids, *(cell(n) for n in NUMBERS), pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), cell("hashes")],
                    [doc_id, *NUMBERS, "n_best", "count_sum", "groups_sha256"],
                )

    numbers = ", ".join(f"{n} long" for n in NUMBERS)
    return joined.mapInArrow(run, f"`{doc_id}` {kind}, {numbers}, n_best long, count_sum long, groups_sha256 string")
