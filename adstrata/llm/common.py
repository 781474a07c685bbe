"""What the operators share: tables, the shared scratch folder, and words as bytes."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII letters fold to lower case and every other ASCII character but digits becomes a blank;
#: bytes of longer UTF-8 sequences stay, so splitting at blanks yields the words of the contracts.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isdigit() or 97 <= b <= 122 else 32
    for b in range(256)
)
#: The same words in a text whose case is not folded yet, and as a separator pattern of the JVM (and of DuckDB).
RAW_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see: spark.checkpoint.dir, or else the session's warehouse.

    Intermediate tables of a session go into one folder below it, named by the application, so that they can
    be removed together when the application is done; later readers of a result need them until then.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{folder.rstrip('/')}/adstrata-llm-{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, options: dict | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back, which cuts the lineage; ``options`` of the Parquet writer."""
    path = new_folder(df.sparkSession, label)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def once(column) -> F.Column:
    """The column as its own generated attribute, so later uses read it instead of repeating it."""
    return F.explode(F.array(column))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words (letters, digits, non-ASCII) as UTF-8 bytes."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def sha256_text(column) -> F.Column:
    return F.sha2(F.encode(F.coalesce(column, F.lit("")), "UTF-8"), 256)
