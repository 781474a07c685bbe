"""Conversation repair against enumeration, in one block and in many."""

import hashlib
import random
import re
import zlib
from itertools import product

import duckdb
import pytest

from adstrata.llm import oracle, repair

FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SHAPE = re.compile(r"(s?(ua)+)?")


def damage(rows):
    out = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(c, t, role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    """Initials and faults of rows in order."""
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role[:1], fault))
    return out


def cheapest(marks):
    """The cheapest, then least audit by a search over whole strings of edits (no prices)."""
    best = {("", ""): 0}  # (audit, initials) of every prefix worth keeping
    for step in range(len(marks) + 1):
        for _ in range(2):
            for (audit, roles), cost in list(best.items()):
                for r in "ua":
                    best.setdefault((audit + "I", roles + r), cost + 3)
        best = {k: c for k, c in best.items() if re.fullmatch(r"(s?(ua)*u?)", k[1])}
        if step == len(marks):
            break
        initial, fault = marks[step]
        after = {}
        for (audit, roles), cost in best.items():
            ways = [("D", roles, 4)]
            if fault in ("", "truncated"):
                more = 3 if fault else 0
                ways += [("K", roles + (initial or "?"), more)] + [("R", roles + r, 3 + more) for r in "ua"]
            for letter, now, add in ways:
                if re.fullmatch(r"(s?(ua)*u?)", now):
                    key = (audit + letter, now)
                    after[key] = min(after.get(key, 10**9), cost + add)
        # Of prefixes that leave the same choice only the cheapest and least can win.
        kept = {}
        for (audit, roles), cost in after.items():
            state = (bool(roles), roles[-1:] if roles else "")
            kept[state] = min(kept.get(state, (10**9, "", "")), (cost, audit, roles))
        best = {(audit, roles): cost for cost, audit, roles in kept.values()}
    ends = [(c, a) for (a, r), c in best.items() if SHAPE.fullmatch(r)]
    return min(ends)


def repaired(audit, rows):
    out, at, state = [], 0, ""
    for letter in audit:
        forced = "assistant" if state == "u" else "user"
        if letter == "I":
            out.append(f"{forced}:")
            state = forced[0]
            continue
        _, _, role, text = rows[at]
        at += 1
        if letter == "D":
            continue
        role = forced if letter == "R" else role
        out.append(f"{role}:{text}")
        state = role[0]
    assert at == len(rows)
    return "\n".join(out)


def order(row):
    key = hashlib.md5(f"{len(row[2])}:{row[2]}{row[3]}".encode()).digest()
    return (row[1] is not None, row[1] or 0, key)


def brute(rows):
    out = []
    for c in {r[0] for r in rows}:
        mine = sorted((r for r in damage(rows) if r[0] == c), key=order)
        marks = faults(mine)
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts = [sum(f == name for _, f in marks) for name in ("blank", "duplicate", "truncated")]
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(marks, marks[1:], strict=False))
        cost, audit = cheapest(marks)
        out.append((c, gaps, *counts, illegal, cost, audit, hashlib.sha256(repaired(audit, mine).encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(n, longest, seed):
    rng = random.Random(seed)
    texts = ["Hello there.", "What is it?", "no end", " \t", "", "Yes!  ", "one more.\n", None, "two. three"]
    rows = []
    for c in range(n):
        turn = rng.randint(-2, 3)
        for _ in range(rng.randint(1, longest)):
            turn += rng.choice([1, 1, 1, 2, 0])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "usr", None, ""])
            text = rng.choice(texts) if rng.random() < 0.5 else f"text {rng.randrange(10**6)}{rng.choice('.?!x')}"
            rows.append((c, None if rng.random() < 0.05 else turn, role, text))
    rows += [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (None, None, None, None)]
    return rows + rows[:20]  # repeated rows


@pytest.mark.parametrize("options", [{}, {"block_rows": 1}, {"block_rows": 3}])
def test_repair(spark, options):
    rows = conversations(60, 12, 5)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, audit string, c int")
    done = repair.repair(df, **options)
    assert done.columns == ["conv_id", *FIELDS]
    assert sorted((tuple(r) for r in done.collect()), key=str) == brute(rows)
    assert repair.repair(df.limit(0), **options).count() == 0


def test_repair_of_one_long_conversation(spark):
    rows = [(7, *r[1:]) for r in conversations(30, 12, 9) if r[0] is not None]
    rows = [(c, i if t is not None else None, role, text) for i, (c, t, role, text) in enumerate(rows)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    done = repair.repair(df, block_rows=8, with_rows=True).collect()
    assert [tuple(r)[:-1] for r in done] == brute(rows)
    text = "\n".join(f"{r['role']}:{r['text']}" for r in done[0]["repaired"])
    assert hashlib.sha256(text.encode()).hexdigest() == done[0]["repaired_sha256"]
    assert SHAPE.fullmatch("".join(r["role"][0] for r in done[0]["repaired"]))


def test_prices_are_exact():
    """Every short conversation: the auction's prices and audits equal the search."""
    codes = [chr(97 + i + 4 * f) for i in range(4) for f in (0, 1, 3)]
    for n in range(4):
        for word in product(codes, repeat=n):
            marks = [(i if i != "o" else "t", repair.FAULTS[f]) for i, f in map(repair.decode, word)]
            assert repair.least_edits("".join(word)) == cheapest(marks)


def test_twin_on_odd_rows(spark):
    rows = [r for r in conversations(40, 9, 11) if r[2] != ""]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    expected = con.execute(oracle.oracle_sql()["op12_repair"]).fetchall()
    assert sorted((tuple(r) for r in repair.repair(df).collect()), key=str) == sorted(expected, key=str)
