"""Bronze zone: untouched records, partitioned by source and publication month."""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from adstrata import dictionaries as D
from adstrata.functions.dates import month_key
from adstrata.functions.numeric import share_pct
from adstrata.schemas import BRONZE
from adstrata.sources.envelope import is_record

SCHEMA_VERSION = "1.0"
PARTITION = ["source_part", "mois_part"]
FEED = "flux_part"
DEFAULT_FEED = "principal"


def source_key(source: Column, unknown: str = D.UNKNOWN_SOURCE) -> Column:
    """Lower case, spaces to underscores; missing or empty gives ``unknown``."""
    key = F.replace(F.lower(source), F.lit(" "), F.lit("_"))
    return F.when(key != "", key).otherwise(F.lit(unknown))


def with_partition_keys(df: DataFrame, source: Column, published: Column) -> DataFrame:
    """Add the two partition columns derived from a source name and a date text."""
    return df.withColumns(
        {"source_part": source_key(source), "mois_part": month_key(published)}
    )


def write_partitioned(
    df: DataFrame, path: str, partition: list[str], mode: str = "overwrite",
    replaces: str = "dynamic", deal: bool = True,
) -> None:
    """Snappy Parquet, one directory per key.

    ``overwrite`` replaces only the keys written (``dynamic``) or the whole table (``static``).

    REBALANCE groups rows of a key into few files, and lets adaptive execution split a key that
    holds a large share of the rows over several tasks. Rows that come by key already (read from files
    of one key each) need no such shuffle: ``deal=False`` writes them where they are.
    """
    rows = df.hint("rebalance", *partition) if deal else df
    (
        rows
        .write.mode(mode)
        .option("partitionOverwriteMode", replaces)
        .option("compression", "snappy")
        .partitionBy(*partition)
        .parquet(path)
    )


def feed_path(path: str, feed: str) -> str:
    """Folder of one feed in a zone."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", feed):
        raise ValueError(f"a feed id is made of letters, digits, '_', '.' and '-': {feed!r}")
    return f"{path}/{FEED}={feed}"


def ingest(
    records: DataFrame, path: str, mode: str = "overwrite", feed: str = DEFAULT_FEED,
    rejects: str | None = None,
) -> None:
    """Write (raw, file) records to Bronze with their metadata, the record text untouched.

    Each feed has its own folder: landing it again replaces it as a whole, so a record whose month
    changed leaves no older copy, and no other feed is touched. With ``rejects``, records that are
    not one JSON object go to that zone instead, once the others are landed.
    """
    if rejects is None:
        write_partitioned(bronze_rows(records), feed_path(path, feed), PARTITION, mode, "static")
        return
    # The write counts the rejects on its way; only a feed that has some is read once more for them.
    seen = Observation()
    checked = records.withColumn("_fits", is_record()).observe(
        seen, F.coalesce(F.sum(F.when(~F.col("_fits"), 1)), F.lit(0)).alias("rejects")
    )
    fitting = checked.where("_fits").drop("_fits")
    write_partitioned(bronze_rows(fitting), feed_path(path, feed), PARTITION, mode, "static")
    bad = records.where(~is_record()) if _any_rejects(seen) else records.limit(0)
    bad.select(
        "raw", F.col("file").alias("source_fichier"), F.current_timestamp().alias("date_ingestion")
    ).write.mode(mode).parquet(feed_path(rejects, feed))


def _any_rejects(seen: Observation) -> bool:
    """Whether the observed write met rejects; true where its plan went, and the count with it, as no record fitted."""
    try:
        return seen.get["rejects"] > 0
    except Py4JJavaError:
        return True


def bronze_rows(records: DataFrame) -> DataFrame:
    """Bronze columns of (raw, file) records, batch or stream."""
    # One parse per record for both keys; the record itself is written as it came.
    keys = F.from_json("raw", "source string, date_publication string")
    keyed = with_partition_keys(
        records.withColumn("_keys", keys),
        F.col("_keys.source"),
        F.col("_keys.date_publication"),
    )
    return keyed.select(
        "raw",
        F.col("file").alias("source_fichier"),
        F.current_timestamp().alias("date_ingestion"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        *PARTITION,
    )


def read_bronze(
    spark: SparkSession,
    path: str,
    sources: list[str] | None = None,
    months: tuple[str, str] | None = None,
) -> DataFrame:
    """Bronze rows of all feeds; ``sources`` and an inclusive ``months`` range prune partitions."""
    rows = spark.read.schema(BRONZE).parquet(path)
    return selected(rows, sources, months)


def selected(
    rows: DataFrame, sources: list[str] | None = None, months: tuple[str, str] | None = None
) -> DataFrame:
    """The rows of some partitions."""
    if sources is not None:
        rows = rows.where(F.col("source_part").isin(list(sources)))
    if months is not None:
        rows = rows.where(F.col("mois_part").between(*months))
    return rows


def manifest(bronze: DataFrame) -> DataFrame:
    """One row per partition: rows, last ingestion time, schema version."""
    return bronze.groupBy(*PARTITION).agg(
        F.concat_ws("/", *PARTITION).alias("partition"),
        F.count(F.lit(1)).alias("nb_offres"),
        F.max("date_ingestion").alias("date_ingestion"),
        F.max("schema_version").alias("schema_version"),
    )


def ingestion_stats(keyed: DataFrame) -> DataFrame:
    """Rows per (source, month) with their share of the whole and the date-anomaly count."""
    total = keyed.agg(F.count(F.lit(1))).scalar()
    return (
        keyed.groupBy(*PARTITION)
        .agg(F.count(F.lit(1)).alias("nb_offres"))
        .withColumn("pct_total", share_pct(F.col("nb_offres"), total))
        .withColumn(
            "nb_dates_inconnues",
            F.when(F.col("mois_part") == D.UNKNOWN_MONTH, F.col("nb_offres")).otherwise(F.lit(0)),
        )
    )


def source_stats(keyed: DataFrame) -> DataFrame:
    """Rows, share and date anomalies per source."""
    total = keyed.agg(F.count(F.lit(1))).scalar()
    return (
        keyed.groupBy("source_part")
        .agg(
            F.count(F.lit(1)).alias("nb_offres"),
            F.count_if(F.col("mois_part") == D.UNKNOWN_MONTH).alias("nb_dates_inconnues"),
        )
        .withColumn("pct_total", share_pct(F.col("nb_offres"), total))
    )


def largest_partitions(keyed: DataFrame, k: int = 10) -> DataFrame:
    """The k largest partitions, ties broken by key."""
    return (
        keyed.groupBy(*PARTITION)
        .agg(F.count(F.lit(1)).alias("nb_offres"))
        .orderBy(F.desc("nb_offres"), *PARTITION)
        .limit(k)
    )


def integrity_report(bronze: DataFrame) -> DataFrame:
    """One row: partitions, rows, sources, months, and records that are not a JSON object.

    Counting per partition first keeps the single final row's input as small as the number of
    partitions.
    """
    per_partition = bronze.groupBy(*PARTITION).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~is_record()).alias("corrupt"),
    )
    return per_partition.agg(
        F.count(F.lit(1)).alias("partitions_found"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_offres"),
        F.array_sort(F.collect_set("source_part")).alias("sources_found"),
        F.array_sort(F.collect_set("mois_part")).alias("mois_couverts"),
        F.coalesce(F.sum("corrupt"), F.lit(0)).alias("enregistrements_corrompus"),
    )


def envelope_integrity_report(envelopes: DataFrame) -> DataFrame:
    """The same report over envelope files (``sources.envelope.read_envelopes``)."""
    good = ~F.col("corrupt")
    key = F.when(good & F.contains(F.col("metadata.partition"), F.lit("/")),
                 F.col("metadata.partition"))
    per_key = envelopes.groupBy(key.alias("key")).agg(
        F.count_if(good).alias("files"),
        F.sum(F.when(good, F.size("offres")).otherwise(0)).alias("rows"),
        F.count_if(~good).alias("corrupt"),
    )
    return per_key.agg(
        F.coalesce(F.sum("files"), F.lit(0)).alias("partitions_found"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_offres"),
        F.array_sort(F.collect_set(F.substring_index("key", "/", 1))).alias("sources_found"),
        F.array_sort(
            F.collect_set(F.regexp_replace("key", "^[^/]*/", ""))
        ).alias("mois_couverts"),
        F.coalesce(F.sum("corrupt"), F.lit(0)).alias("fichiers_corrompus"),
    )


def corrupt_files(envelopes: DataFrame) -> DataFrame:
    """Paths of the envelope files that could not be parsed."""
    # Spark refuses a JSON scan that needs the corrupt-record column alone, hence the size test.
    return envelopes.where(F.col("corrupt") & (F.size("offres") >= 0)).select("file")
