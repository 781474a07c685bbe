"""Parquet tables at rest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from adstrata.sources.bronze import write_partitioned


def write_table(
    df: DataFrame, path: str, partition: list[str] | None = None, mode: str = "overwrite",
    replaces: str = "dynamic", deal: bool = True,
) -> None:
    """Snappy Parquet, replaced as a whole, or when partitioned as ``replaces`` says: only the keys
    written (``dynamic``) or everything (``static``). ``deal=False`` spares the shuffle of rows that come
    by key already.

    Row order is not part of a table; sort when reading.
    """
    if partition:
        write_partitioned(df, path, partition, mode, replaces, deal)
    else:
        df.write.mode(mode).option("compression", "snappy").parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan; with a schema the column order is the schema's, partitioned or not."""
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def register_views(spark: SparkSession, tables: dict[str, str]) -> None:
    """Temporary views over Parquet paths, for SQL text."""
    for name, path in tables.items():
        spark.read.parquet(path).createOrReplaceTempView(name)
