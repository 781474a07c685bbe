"""Bronze as a stream: a folder of JSON Lines is landed file by file, each record once.

The file source keeps the files it has seen in the checkpoint, and the file sink keeps the files that
each batch has committed, so a rerun lands nothing twice. A run that fails before its batch is
committed leaves files that no reader sees, and the next run does that batch again; one that fails
between the sink's and the checkpoint's commit finds the batch done and skips it. Nothing is held in
state; every batch is the narrow stage of `bronze.ingest`.

Blank lines are no records. Records that are not one JSON object land too, filed under the unknown
source and month, where `bronze.integrity_report` counts them. An empty folder lands nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adstrata.schemas import BRONZE
from adstrata.sources.bronze import PARTITION, bronze_rows


def arriving(spark: SparkSession, inbox: str, max_files: int = 1000) -> DataFrame:
    """(raw, file) rows of the files that arrive in a folder, at most `max_files` a batch."""
    return (
        spark.readStream.option("maxFilesPerTrigger", max_files)
        .text(inbox)
        .where(F.trim("value") != "")
        .select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("file"))
    )


def land(spark: SparkSession, inbox: str, zone: str, checkpoint: str, max_files: int = 1000) -> None:
    """Land what has arrived since the last run and stop."""
    query = (
        bronze_rows(arriving(spark, inbox, max_files))
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .partitionBy(*PARTITION)
        .trigger(availableNow=True)
        .start(zone)
    )
    query.awaitTermination()


def read_landed(spark: SparkSession, zone: str) -> DataFrame:
    """Bronze rows of the committed batches. Read the zone by its root: the list of committed files lies there."""
    return spark.read.schema(BRONZE).parquet(zone)
