"""Benchmark decontamination with an Aho-Corasick automaton over all test items.

Items are normalised to words, and every word of an item enters the automaton once: items are cut
into blocks of half a window, and since each window of `window` consecutive words holds a whole block,
a text that has a window meets a block of it in the one scan. A met block is extended word by word
along its item in both directions; a match of `window` words or more is the union of the windows in
it. Items with fewer words are patterns as a whole. Word numbers of the matches map back to code
points of the original text. Words are spelled as three letters of three small alphabets, which keeps
the automaton's nodes few and its matches aligned.

Every task builds the automaton for itself. A benchmark above `shard_bytes` of text is cut into ranges by a hash of
the item id, each with an automaton of its own; the table then passes through them one after the other,
written to the shared folder in between, and each pass adds to what a row has found so far. Rows are
never grouped, so repeated and null ids need no care, and results are the same for any `shard_bytes`.
About 30 bytes of memory a task go with each byte of the benchmark, and the driver holds one range at a time.

Nulls: a null text has no words; an item without words has no window; a null item id is written as
the empty string. Repeated items count once per id. Documents keep their row each, also repeated ones
and those of null id. An empty benchmark marks nothing; an empty table gives no row. Columns of other
names pass through `find_items` and `clean`.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RAW_WORD, stored, words_of

WINDOW = 10
SHARD_BYTES = 16 << 20
#: Letters that spell the numbers of words, three a word, from alphabets that share none.
_BASE = 96
_UNKNOWN = "\x00\x00\x00"
FOUND = (
    "n_words long, words array<struct<first:int,end:int>>, items array<string>,"
    " spans array<struct<start:int,end:int>>"
)
_TYPE = pa.struct([
    ("n_words", pa.int64()),
    ("words", pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))),
    ("items", pa.list_(pa.string())),
    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
])


def _spelled(number: int) -> str:
    if number >= _BASE**3:
        raise ValueError("too many different words for one automaton; lower shard_bytes")
    return chr(0x100 + number % _BASE) + chr(0x200 + number // _BASE % _BASE) + chr(0x300 + number // _BASE**2)


class Index:
    """The automaton over blocks of items, and the items to extend them along."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        self.window, self.block = window, (window + 1) // 2
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item_id, text in items:
            words = tuple(self.numbers.setdefault(w, len(self.numbers)) for w in words_of(text))
            if words:
                owners.setdefault(words, set()).add("" if item_id is None else str(item_id))
        self.spelling = {w: _spelled(n) for w, n in self.numbers.items()}
        letters = list(self.spelling.values())
        self.items = [array("I", words) for words in owners]
        self.owners = [sorted(ids) for ids in owners.values()]
        places: dict[str, list[tuple[int, int]]] = {}
        for i, words in enumerate(self.items):
            size = self.block if len(words) >= window else len(words)
            for at in range(0, len(words) - size + 1, size):
                places.setdefault("".join(letters[n] for n in words[at : at + size]), []).append((i, at))
        self.machine = ahocorasick.Automaton()
        for pattern, found in places.items():
            self.machine.add_word(pattern, (len(pattern) // 3, found))
        if places:
            self.machine.make_automaton()
        self.empty = not places

    def matches(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(item, first word, end) of the maximal matches that hold a window."""
        if self.empty or not words:
            return
        spelled = self.spelling
        known = [spelled.get(w, _UNKNOWN) for w in words]
        numbers, reached = None, {}
        for last, (size, places) in self.machine.iter("".join(known)):
            at = last // 3 + 1 - size
            if numbers is None:
                numbers = [self.numbers.get(w, -1) for w in words]
            for item, place in places:
                body = self.items[item]
                if len(body) < self.window:
                    yield item, at, at + size
                    continue
                # One extension serves all blocks of a match, which lie on one diagonal.
                if reached.get((item, at - place), -1) > at:
                    continue
                first, end = at, at + size
                while first > 0 and first - at + place > 0 and numbers[first - 1] == body[first - 1 - at + place]:
                    first -= 1
                while end < len(numbers) and end - at + place < len(body) and numbers[end] == body[end - at + place]:
                    end += 1
                reached[item, at - place] = end
                if end - first >= self.window:
                    yield item, first, end


def scan_text(index: Index, text: str | None, with_spans: bool = False, before: dict | None = None) -> dict:
    """Words, runs of hit words (end exclusive), items, and the runs' code points in the text; with what
    another index found in it before."""
    words = words_of(text)
    hits = {(r["first"], r["end"]) for r in before["words"]} if before else set()
    items = set(before["items"]) if before else set()
    for item, first, end in index.matches(words):
        hits.add((first, end))
        items.update(index.owners[item])
    runs: list[list[int]] = []
    for first, end in sorted(hits):
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([first, end])
    found = {"n_words": len(words), "words": [{"first": a, "end": b} for a, b in runs], "items": sorted(items), "spans": []}
    if with_spans and runs:
        places = [m.span() for m in RAW_WORD.finditer(text)]
        found["spans"] = [{"start": places[a][0], "end": places[b - 1][1]} for a, b in runs]
    return found


def _scanner(items: list, window: int, text: str, again: bool, drop: list[str], with_spans: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(items, window)
        for batch in batches:
            earlier = batch.column("__found").to_pylist() if again else [None] * batch.num_rows
            found = [scan_text(index, t.as_py(), with_spans, f) for t, f in zip(batch.column(text), earlier, strict=True)]
            kept = [n for n in batch.schema.names if n != "__found" and n not in drop]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(found, _TYPE)], [*kept, "__found"])

    return scan


def _shards(benchmark: DataFrame, item_id: str, text: str, shard_bytes: int) -> Iterator[tuple[list, bool]]:
    """The items in lists of bounded size, and whether it is the last; a hash of the id decides who goes where."""
    items = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t")).where("t is not null")
    size = items.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    n = -(-size // shard_bytes) or 1
    for shard in range(n):
        part = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == shard) if n > 1 else items
        yield [(r["i"], r["t"]) for r in part.collect()], shard == n - 1


def find_items(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, with_spans: bool = True, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """The given rows (without the text unless spans are asked for) and a struct `__found`."""
    for items, is_last in _shards(benchmark, item_id, item_text, shard_bytes):
        again = "__found" in docs.columns
        drop = [text] if is_last and not with_spans else []
        schema = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "__found" and f.name not in drop
        )
        docs = docs.mapInArrow(
            _scanner(items, window, text, again, drop, with_spans and is_last),
            f"{schema + ', ' if schema else ''}__found struct<{_struct(FOUND)}>",
        )
        if not is_last:
            docs = stored(docs, "decontam")
    return docs


def _struct(fields: str) -> str:
    return re.sub(r"(\w+) (\w)", r"\1:\2", fields)


def n_hit(words: F.Column) -> F.Column:
    """Words in the runs, which do not overlap."""
    return F.aggregate(words, F.lit(0).cast("long"), lambda a, r: a + (r["end"] - r["first"]))


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document: words, hit words, items and whether any window occurs."""
    found = find_items(docs.select("doc_id", "text"), benchmark, with_spans=False, **options)
    f = F.col("__found")
    return found.select(
        "doc_id", f["n_words"].alias("n_words"), n_hit(f["words"]).alias("n_hit"),
        F.size(f["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(f["items"], ",").cast("binary"), 256).alias("items_sha256"),
        (F.size(f["words"]) > 0).alias("contaminated"),
    )


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows in which no window of the benchmark occurs, columns unchanged."""
    found = find_items(docs, benchmark, text, with_spans=True, **options)
    return found.where(F.size(F.col("__found")["words"]) == 0).select(*docs.columns)
