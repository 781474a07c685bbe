"""Semi and anti joins with a large list of keys, behind a Bloom filter.

The list's keys set bits of a filter of fixed size, built by an aggregate of at most one row per 64
bits and carried in the plan as a literal (a proven bound: `bits` / 8 bytes). Rows whose bits are not
all set cannot be members, so they never reach the shuffle: a semi join drops them in the scan's
stage, an anti join keeps them there. What is left is decided by an exact join, so wrong hits of the
filter cost work but change nothing.

Null keys match nothing: a semi join drops such rows, an anti join keeps them. An empty list has no
members. Rows keep their number and columns; repeated keys in the list do not repeat rows.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 20
HASHES = 4


def _positions(keys: Sequence[Column], bits: int) -> list[Column]:
    # Two hashes give all positions (Kirsch and Mitzenmacher).
    first, second = (F.pmod(h, F.lit(bits)) for h in (F.xxhash64(*keys), F.xxhash64(F.lit(1), *keys)))
    return [(first + second * i) % bits for i in range(HASHES)]


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))


def bloom_filter(members: DataFrame, key: Sequence[str], bits: int = BITS) -> Column:
    """The filter of the list's keys as a literal array of 64-bit words."""
    at = F.explode(F.array(*_positions([F.col(k) for k in key], bits))).alias("at")
    words = (
        members.dropna(subset=list(key)).select(at)
        .groupBy(F.floor(F.col("at") / 64).alias("word"))
        .agg(F.bit_or(_bit(F.col("at"))).alias("set"))
    )
    dense = [0] * (bits // 64)
    for row in words.collect():  # at most bits / 64 rows
        dense[row["word"]] = row["set"]
    return F.from_json(F.lit(json.dumps(dense)), "array<long>")


def may_contain(words: Column, keys: Sequence[Column], bits: int = BITS) -> Column:
    """Whether all bits of a key are set; false for nulls."""
    known = [k.isNotNull() for k in keys]
    for at in _positions(keys, bits):
        word = F.get(words, F.floor(at / 64).cast("int"))
        known.append(word.bitwiseAND(_bit(at)) != 0)
    result = known[0]
    for one in known[1:]:
        result = result & one
    return F.coalesce(result, F.lit(False))


def semi_join(rows: DataFrame, members: DataFrame, key: Sequence[str], member_key: Sequence[str], bits: int = BITS) -> DataFrame:
    """The rows whose key is in the list."""
    possible = rows.where(may_contain(bloom_filter(members, member_key, bits), [F.col(k) for k in key], bits))
    return possible.join(_keys(members, member_key), _same(key), "left_semi")


def anti_join(rows: DataFrame, members: DataFrame, key: Sequence[str], member_key: Sequence[str], bits: int = BITS) -> DataFrame:
    """The rows whose key is not in the list."""
    maybe = may_contain(bloom_filter(members, member_key, bits), [F.col(k) for k in key], bits)
    left = rows.where(maybe).join(_keys(members, member_key), _same(key), "left_anti")
    return rows.where(~maybe).unionByName(left)


def _keys(members: DataFrame, key: Sequence[str]) -> DataFrame:
    return members.select(*[F.col(k).alias(f"__m{i}") for i, k in enumerate(key)])


def _same(key: Sequence[str]) -> list[Column]:
    return [F.col(k) == F.col(f"__m{i}") for i, k in enumerate(key)]
