"""Repair of conversation structure at least cost, by the auction algorithm for shortest paths.

A conversation is a lattice: its layers are the places between rows, the four states of a layer say
what the repaired roles so far allow next (nothing yet, after the system's row, after a user's, after
an assistant's). Keeping, rerolling or deleting a row leads to the next layer, an inserted empty row
to another state of the same layer; costs are whole numbers. The auction gives every node a price
and keeps one path: at its last node the cheapest way on (arc plus the price behind it) either
exceeds the node's price, which then rises to it while the path contracts by the node, or extends the
path. Origins are taken layer by layer from the end, a path that meets a node settled before ends
there, and a layer starts from the least price behind it, which no price may fall short of; so the
work is linear in the rows. In the end all prices are the exact costs still ahead. Arcs that bridge
the difference of two prices are tight: each path of tight arcs is a cheapest one, and taking the
least letter at every node spells the least audit, as no state has two arcs of one letter.

At scale: rows without their texts are sorted by range, so one long conversation spreads over many
tasks, and are cut into blocks of `block_rows`. A row is a duplicate if it is not the first of its
conversation with its role and text; firsts come from one aggregate and meet the rows by place. A
block's auction gives the costs between its end states; conversations of several blocks settle the
lattice of blocks the same way and then trace their blocks in parallel. What one task holds of a
conversation is its code of one byte a row, which is the size of its audit. Texts are shuffled once;
their hash is taken in a stream over sorted rows, since SHA-256 is sequential.

Nulls: a null role or text is one blank, as are null ids and turns in the damage's key; null turns
come first and count for no gap; rows of a null id are one conversation with a null id. Rows of one
turn are in the order of a digest of role and text, so rows that repeat are adjacent and all but the
first are duplicates. A role that begins with another letter, or is empty, fits nowhere and is rerolled or
deleted. A conversation without rows has zeros, an empty audit and the hash of the empty string.
An empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

BLOCK_ROWS = 4096
BLANKS = r"\x20\x09-\x0D"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
NONE = 1 << 60
INITIALS = "sua"
FAULTS = ("", "blank", "duplicate", "truncated")
#: State after a kept row by its initial; no entry where the row does not fit.
KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: State after an inserted or rerolled row, whose role the state before it decides.
FORCED = (2, 2, 3, 2)
ROLES = {2: "user", 3: "assistant"}
#: Prices behind the last row: states that need a user's, an assistant's or both rows inserted.
ENDS = (0, 2 * INSERT, INSERT, 0)
LEGAL = {"su", "ua", "au"}


# --- The auction ----------------------------------------------------------------------------


@lru_cache(maxsize=None)
def arcs_of(code: str) -> tuple:
    """Arcs over one row by state, as (letter, cost, next state) in order of the letters."""
    initial, fault = decode(code)
    arcs = []
    for state in range(4):
        ways = [("D", DELETE, state)]
        if fault in (0, 3):
            more = TRUNCATED if fault == 3 else 0
            if initial in KEPT[state]:
                ways.append(("K", KEEP + more, KEPT[state][initial]))
            ways.append(("R", REROLE + more, FORCED[state]))
        arcs.append(tuple(ways))
    return tuple(arcs)


def decode(code: str) -> tuple[str, int]:
    """Initial and fault of a row's letter."""
    number = ord(code) - 97
    return (INITIALS + "o")[number % 4], number // 4


def settle(layers: list[tuple], ends: tuple, inserts: bool = True) -> list[list[int]]:
    """Prices of the states of all layers: exact costs to the end, `NONE` where no way leads there."""
    prices: list[list[int]] = [[]] * len(layers) + [list(ends)]
    for at in range(len(layers) - 1, -1, -1):
        arcs, behind = layers[at], prices[at + 1]
        # States only move towards the last two, so these prices are lower bounds the auction may start from.
        last = min(behind[2], behind[3])
        price = [min(behind), min(behind[1:]), last, last]
        settled = [False] * 4
        for origin in range(4):
            path = [origin]
            while path and not settled[path[-1]]:
                state = path[-1]
                best, to = NONE, None
                for _, cost, after in arcs[state]:
                    if cost + behind[after] < best:
                        best = cost + behind[after]
                if inserts and INSERT + price[FORCED[state]] < best:
                    best, to = INSERT + price[FORCED[state]], FORCED[state]
                if best >= NONE:
                    price[state], settled[state] = NONE, True
                    path.pop()
                elif price[state] < best:
                    price[state] = best
                    if len(path) > 1:
                        path.pop()
                elif to is None:
                    break
                else:
                    path.append(to)
            for state in path:
                settled[state] = True
        prices[at] = price
    return prices


def trace(codes: str, prices: list[list[int]], state: int) -> tuple[str, int]:
    """Letters of the least path of tight arcs from a state of the first layer, and the state it ends in."""
    out = []
    for at, code in enumerate(codes):
        price, behind = prices[at], prices[at + 1]
        while True:
            tight = [(letter, to, 1) for letter, cost, to in arcs_of(code)[state] if price[state] == cost + behind[to]]
            if price[state] == INSERT + price[FORCED[state]]:
                tight.append(("I", FORCED[state], 0))
            letter, state, moved = min(tight)
            out.append(letter)
            if moved:
                break
    return "".join(out), state


@lru_cache(maxsize=50_000)
def costs_between(codes: str) -> tuple:
    """Costs from each state before a block's rows to each state behind them, as four rows."""
    layers = [arcs_of(c) for c in codes]
    columns = [settle(layers, tuple(0 if s == end else NONE for s in range(4)))[0] for end in range(4)]
    return tuple(tuple(columns[end][state] for end in range(4)) for state in range(4))


@lru_cache(maxsize=50_000)
def traces(codes: str, ends: tuple) -> tuple:
    """For each state before a block: cost to the end, letters, state behind it."""
    prices = settle([arcs_of(c) for c in codes], ends)
    return tuple(
        (prices[0][s], *trace(codes, prices, s)) if prices[0][s] < NONE else (NONE, "", s) for s in range(4)
    )


def least_edits(codes: str) -> tuple[int, str]:
    """Cost and audit of one conversation, from its rows' letters."""
    cost, letters, state = traces(codes, ENDS)[0]
    return cost, letters + "I" * (ENDS[state] // INSERT)


# --- Rows -----------------------------------------------------------------------------------


def damaged(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """c, t, role, text, dropped of every row after the damage; dropped rows stay, marked and empty."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(blank(conv_id), F.lit(":"), blank(turn)).cast("binary")), F.lit(20))
    marked = rows.select(
        F.col(conv_id).alias("c"), F.col(turn).cast("long").alias("t"), blank(role).alias("role"), blank(text).alias("text"),
        kind.alias("kind"),
    )
    k = F.col("kind")
    return marked.select(
        "c", "t",
        F.when(k == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(k < 2, "").when(k == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (k == 0).alias("dropped"),
        F.explode(F.when(k == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def digest(role: str = "role", text: str = "text") -> Column:
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), F.col(role), F.col(text))))


def _numbered(rows: DataFrame) -> DataFrame:
    """c, t, digest, mark, at: rows without texts, `at` growing in the order of the conversations' rows."""
    initial = F.substring("role", 1, 1)
    letter = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    blank, whole = ~F.col("text").rlike(f"[^{BLANKS}]"), F.col("text").rlike(rf"[.!?][{BLANKS}]*\z")
    mark = F.when(F.col("dropped"), -1).otherwise(letter + F.when(blank, 4).when(~whole, 12).otherwise(0))
    # Equal rows may be split anywhere, so their number in the input keeps a hot one from being one range.
    light = rows.select("c", "t", digest().alias("digest"), mark.cast("int").alias("mark"), F.monotonically_increasing_id().alias("n"))
    keys = ("c", "t", "digest", "n")
    placed = light.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stored(placed.select("c", "t", "digest", "mark", F.monotonically_increasing_id().alias("at")), "repair-rows")


BLOCK = "codes string, first long, last long, turns long, blank long, duplicate long, truncated long, illegal long, costs array<long>"


def _blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """One row per conversation and block: its rows' letters, counts, and costs between states."""
    firsts = rows.where("mark >= 0").groupBy("c", "digest").agg(F.min("at").alias("at"))
    none = F.lit(None)
    items = rows.select("c", "at", F.lit(0).alias("is_first"), "t", "mark").unionByName(
        firsts.select("c", "at", F.lit(1).alias("is_first"), none.cast("long").alias("t"), none.cast("int").alias("mark"))
    )
    grouped = items.groupBy("c", F.floor(F.col("at") / block_rows).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("at", "is_first", "t", "mark"))).alias("items")
    )
    kind = rows.schema["c"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            offsets, flat = lists.offsets.to_pylist(), lists.values
            is_first, turns, marks = (flat.field(n).to_pylist() for n in ("is_first", "t", "mark"))
            out = [_block(is_first, turns, marks, a, b) for a, b in zip(offsets, offsets[1:], strict=False)]
            columns = [batch.column(0), batch.column(1)]
            columns += [pa.array([o[i] for o in out], t) for i, t in enumerate(
                [pa.string()] + [pa.int64()] * 7 + [pa.list_(pa.int64())]
            )]
            yield pa.RecordBatch.from_arrays(columns, ["c", "block", *(f.split()[0] for f in BLOCK.split(", "))])

    return grouped.mapInArrow(run, f"c {kind}, block long, {BLOCK}")


def _block(is_first: list, turns: list, marks: list, start: int, end: int) -> tuple:
    codes, counts, illegal, before = [], [0, 0, 0, 0], 0, None
    first = last = None
    n_turns = 0
    for i in range(start, end):
        if is_first[i] or marks[i] < 0:
            continue
        mark = marks[i]
        if mark // 4 != 1 and not (i + 1 < end and is_first[i + 1]):
            mark = mark % 4 + 8
        counts[mark // 4] += 1
        code = chr(97 + mark)
        codes.append(code)
        initial = decode(code)[0]
        if before is not None and before + initial not in LEGAL:
            illegal += 1
        before = initial
        if turns[i] is not None and turns[i] != last:
            n_turns, last = n_turns + 1, turns[i]
            first = last if first is None else first
    word = "".join(codes)
    return word, first, last, n_turns, *counts[1:], illegal, [c for row in costs_between(word) for c in row]


SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def _summed(blocks: list[dict]) -> list[int]:
    """gaps, blank, duplicate, truncated, illegal of a conversation, from its blocks in order."""
    turns, illegal, first, last, before = 0, 0, None, None, None
    for b in blocks:
        turns += b["turns"]
        if b["first"] is not None:
            turns -= last == b["first"]
            first, last = (b["first"] if first is None else first), b["last"]
        illegal += b["illegal"]
        if b["codes"]:
            if before is not None:
                illegal += before + decode(b["codes"][0])[0] not in LEGAL
            before = decode(b["codes"][-1])[0]
    gaps = last - first + 1 - turns if first is not None else 0
    return [gaps, *(sum(b[f] for b in blocks) for f in FAULTS[1:]), illegal]


def _answers(blocks: DataFrame) -> DataFrame:
    """c, the summary's columns and audit of every conversation."""
    kind = blocks.schema["c"].dataType.simpleString()
    names = [f.split()[0] for f in BLOCK.split(", ")]
    whole = blocks.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("block", *names))).alias("blocks"))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, audits, parts = [], [], []
            for listed in batch.column(1).to_pylist():
                listed = [b for b in listed if b["codes"]]
                if len(listed) <= 1:
                    cost, audit = least_edits(listed[0]["codes"] if listed else "")
                    part = []
                else:
                    layers = []
                    for b in listed:
                        costs = b["costs"]
                        layers.append(tuple(
                            tuple(("", costs[4 * s + e], e) for e in range(4) if costs[4 * s + e] < NONE) for s in range(4)
                        ))
                    prices = settle(layers, ENDS, inserts=False)
                    cost, audit = prices[0][0], None
                    part = [{"at": i, "codes": b["codes"], "ends": prices[i + 1]} for i, b in enumerate(listed)]
                rows.append([*_summed(listed), cost])
                audits.append(audit)
                parts.append(part)
            columns = [batch.column(0), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(6)), pa.array(audits, pa.string())]
            columns.append(pa.array(parts, pa.list_(pa.struct(
                [("at", pa.int64()), ("codes", pa.string()), ("ends", pa.list_(pa.int64()))]
            ))))
            yield pa.RecordBatch.from_arrays(columns, ["c", *(f.split()[0] for f in SUMMARY.split(", ")), "audit", "parts"])

    solved = stored(whole.mapInArrow(
        solve, f"c {kind}, {SUMMARY}, audit string, parts array<struct<at:bigint,codes:string,ends:array<bigint>>>"
    ), "repair-solved")
    short = solved.where("audit is not null").drop("parts")
    long = solved.where("audit is null")
    if long.isEmpty():
        return short

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [traces(codes, tuple(ends)) for codes, ends in zip(*(batch.column(i).to_pylist() for i in (2, 3)), strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1),
                pa.array([[t[1] for t in f] for f in found], pa.list_(pa.string())),
                pa.array([[t[2] for t in f] for f in found], pa.list_(pa.int32())),
            ], ["c", "at", "letters", "to"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            audits = []
            for listed in batch.column(1):
                state, out = 0, []
                for part in listed:
                    out.append(part["letters"][state].as_py())
                    state = part["to"][state].as_py()
                audits.append("".join(out) + "I" * (ENDS[state] // INSERT))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(audits, pa.string())], ["c", "audit"])

    pieces = long.select("c", F.inline("parts")).repartition("c", "at").mapInArrow(
        follow, f"c {kind}, at long, letters array<string>, to array<int>"
    )
    audits = pieces.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("at", "letters", "to"))).alias("parts")).mapInArrow(
        join, f"c {kind}, audit string"
    )
    joined = long.drop("audit", "parts").alias("l").join(audits.alias("r"), F.col("l.c").eqNullSafe(F.col("r.c")))
    return short.unionByName(joined.select("l.*", "r.audit"))


def repair(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    block_rows: int = BLOCK_ROWS, with_rows: bool = False,
) -> DataFrame:
    """Damage, faults and cheapest edits of every conversation: the id, gaps, blank, duplicate, truncated, illegal,
    cost, audit and repaired_sha256; with_rows adds the repaired rows as an array."""
    rows = damaged(rows, conv_id, turn, role, text)
    answers = _answers(_blocks(_numbered(rows), block_rows))
    names = [f.split()[0] for f in SUMMARY.split(", ")]
    none = F.lit(None)
    heads = answers.select("c", F.lit(0).alias("kind"), none.cast("long").alias("t"), none.cast("binary").alias("digest"),
                           none.cast("string").alias("role"), none.cast("string").alias("text"), *names, "audit")
    bodies = rows.where("not dropped").select(
        "c", F.lit(1).alias("kind"), "t", digest().alias("digest"), "role", "text", *(none.cast("long").alias(n) for n in names),
        none.cast("string").alias("audit"),
    )
    keys = ("c", "kind", "t", "digest")
    stream = heads.unionByName(bodies).repartition("c").sortWithinPartitions(*keys).drop("t", "digest")
    kind = rows.schema["c"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Edits applied row by row; of a conversation only the hash so far is held."""
        done, heads, held = [], [], None

        def finish():
            if held is not None:
                held.close()
                done.append((*held.head, held.sha.hexdigest(), held.kept))

        def emit():
            names_out = [conv_id, *names, "audit", "repaired_sha256"] + ["repaired"] * with_rows
            types = [None, *[pa.int64()] * 6, pa.string(), pa.string()]
            columns = [pa.concat_arrays(heads)] if len(heads) else []
            columns += [pa.array([d[i] for d in done], types[i + 1]) for i in range(8)]
            if with_rows:
                columns.append(pa.array([d[8] for d in done], pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))))
            return pa.RecordBatch.from_arrays(columns, names_out)

        waiting = None
        for batch in batches:
            lists = [batch.column(i).to_pylist() for i in range(1, batch.num_columns)]
            for at, row in enumerate(zip(*lists, strict=True)):
                if row[0] == 0:
                    finish()
                    if waiting is not None:
                        heads.append(waiting)
                    held, waiting = _Edits(row[3:], with_rows), batch.column(0).slice(at, 1)
                else:
                    held.add(row[1], row[2])
            if done:
                yield emit()
                done, heads = [], []
        finish()
        if waiting is not None:
            heads.append(waiting)
            yield emit()

    extra = ", repaired array<struct<role:string,text:string>>" if with_rows else ""
    return stream.mapInArrow(run, f"`{conv_id}` {kind}, {SUMMARY}, audit string, repaired_sha256 string{extra}")


class _Edits:
    """One conversation's audit, applied as its rows come by."""

    def __init__(self, head: tuple, with_rows: bool):
        self.head, self.audit, self.at, self.state = head, head[-1], 0, 0
        self.sha, self.any, self.kept = hashlib.sha256(), False, [] if with_rows else None

    def _put(self, role: str, text: str) -> None:
        if self.any:
            self.sha.update(b"\n")
        self.any = True
        self.sha.update(role.encode())
        self.sha.update(b":")
        self.sha.update(text.encode())
        if self.kept is not None:
            self.kept.append({"role": role, "text": text})

    def _inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.state = FORCED[self.state]
            self._put(ROLES[self.state], "")
            self.at += 1

    def add(self, role: str, text: str) -> None:
        self._inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = KEPT[self.state][role[0]]
            self._put(role, text)
        elif letter == "R":
            self.state = FORCED[self.state]
            self._put(ROLES[self.state], text)

    def close(self) -> None:
        self._inserts()
