"""Term dictionary: family -> term -> aliases, flattened with match patterns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adstrata.functions.text import fold
from adstrata.schemas import TERM_DICTIONARY

WORD = r"\p{L}\p{N}_"
ALNUM = "a-zA-Z0-9"


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Flattened dictionary from a ``{"familles": {family: {term: [alias]}}}`` JSON file."""
    return flatten_dictionary(
        spark.read.schema(TERM_DICTIONARY).option("multiLine", True).json(path)
    )


def dictionary_from_mapping(
    spark: SparkSession, families: Mapping[str, Mapping[str, list[str]]]
) -> DataFrame:
    """The same from a Python mapping."""
    rows = [({f: {t: list(a) for t, a in terms.items()} for f, terms in families.items()},)]
    return flatten_dictionary(spark.createDataFrame(rows, TERM_DICTIONARY))


def flatten_dictionary(nested: DataFrame) -> DataFrame:
    """(famille, skill, alias, prio, loose, pattern, anchor), one row per alias.

    ``prio`` orders aliases by length, longest first, ties in file order: the smallest is tried
    first. It is a struct of these, so no row has to be numbered.
    """
    exploded = (
        nested.select(F.posexplode(F.map_entries("familles")).alias("f_ord", "f"))
        .select("f_ord", F.col("f.key").alias("famille"),
                F.posexplode(F.map_entries("f.value")).alias("s_ord", "s"))
        .select("f_ord", "s_ord", "famille", F.col("s.key").alias("skill"),
                F.posexplode("s.value").alias("a_ord", "alias_raw"))
        .withColumn("alias", fold(F.col("alias_raw")))
        .where(F.col("alias") != "")
    )
    return exploded.select(
        "famille",
        "skill",
        "alias",
        F.struct(
            (-F.length("alias")).alias("len"), F.col("f_ord").alias("f"),
            F.col("s_ord").alias("s"), F.col("a_ord").alias("a"),
        ).alias("prio"),
        is_loose(F.col("alias")).alias("loose"),
        boundary_pattern(F.col("alias")).alias("pattern"),
        anchor_token(F.col("alias")).alias("anchor"),
    )


def is_loose(alias: Column) -> Column:
    """Starts or ends with punctuation, so a word boundary cannot delimit it."""
    return alias.rlike(rf"^[^{WORD}\s]|[^{WORD}\s]$")


def boundary_pattern(alias: Column) -> Column:
    """Regex for the alias (text already lower-cased).

    Word-edged aliases must not touch a letter, digit or underscore; the others must not touch
    an ASCII letter or digit. Character classes are spelled out because the meaning of ``\\b``
    depends on the Java version.
    """
    literal = F.regexp_replace(alias, rf"([^{WORD}\s])", r"\\$1")
    edge = F.when(is_loose(alias), F.lit(ALNUM)).otherwise(F.lit(WORD))
    return F.concat(F.lit("(?<!["), edge, F.lit("])"), literal, F.lit("(?!["), edge, F.lit("])"))


def anchor_token(alias: Column) -> Column:
    """A token that every text containing the alias must have; null when there is none.

    Word-edged aliases: their longest word. Others: their longest run of ASCII letters and
    digits. Such a token is always a whole token of the text too.
    """
    pieces = F.when(is_loose(alias), F.split(alias, f"[^{ALNUM}]+")).otherwise(
        F.split(alias, f"[^{WORD}]+")
    )
    longest = F.array_max(
        F.transform(pieces, lambda w: F.struct(F.length(w).alias("n"), w.alias("w")))
    )["w"]
    return F.when(longest != "", longest)
