"""The whole run, Bronze to Gold. Each step reads what the previous one wrote.

Writing between steps cuts the lineage, so a lost executor costs a task, not the run, and each
mart scans compact Parquet instead of parsing text again.
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from adstrata.operators.extraction import extract_terms
from adstrata.operators.spread import spread
from adstrata.plans import gold, silver
from adstrata.schemas import CLEAN_ADS, QUALITY, SKILLS
from adstrata.sources import bronze, tables
from adstrata.sources.envelope import read_raw, typed_ads
from adstrata.sources.terms import read_dictionary


@dataclass(frozen=True)
class Lake:
    """Paths of the zones under one root."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def rejects(self) -> str:
        return f"{self.root}/bronze_rejets"

    @property
    def manifest(self) -> str:
        return f"{self.root}/bronze_manifest"

    @property
    def ads(self) -> str:
        return f"{self.root}/silver/offres_clean"

    @property
    def quality(self) -> str:
        return f"{self.root}/silver/metadonnees_qualite"

    @property
    def skills(self) -> str:
        return f"{self.root}/silver/competences_extraites"

    def mart(self, name: str) -> str:
        return f"{self.root}/gold/{name}"


@dataclass(frozen=True)
class Step:
    name: str
    rows: int
    seconds: float
    rejected: int = 0


def _require_rows(df: DataFrame, what: str) -> None:
    if df.isEmpty():
        raise ValueError(f"no rows in {what}")


def run_bronze(
    spark: SparkSession, lake: Lake, source: str, layout: str = "envelope",
    feed: str = bronze.DEFAULT_FEED, corrupt: str = "raise", pattern: str = "*.json",
) -> int:
    """Land the raw records of one feed and write the manifest; returns the rows in Bronze.

    Records that are not one JSON object go to ``lake.rejects``.
    """
    records = read_raw(spark, source, layout, corrupt, pattern)
    bronze.ingest(records, lake.bronze, feed=feed, rejects=lake.rejects)
    landed = bronze.read_bronze(spark, lake.bronze)
    tables.write_table(bronze.manifest(landed), lake.manifest)
    return landed.count()


def count_rejects(spark: SparkSession, lake: Lake) -> int:
    """Records of all feeds that Bronze turned away."""
    return spark.read.parquet(lake.rejects).count()


def run_silver(
    spark: SparkSession,
    lake: Lake,
    rules: silver.SilverRules | None = None,
    sources: list[str] | None = None,
    months: tuple[str, str] | None = None,
    partitions: int | None = None,
) -> int:
    """Clean the ads of Bronze (all of it, or some partitions).

    Silver has the partitions of Bronze, so a partial run replaces exactly what it read again. A
    partial run that finds a Silver partition which Bronze no longer has becomes a whole run, as
    such a partition cannot be replaced by rows.
    """
    part = sources is not None or months is not None
    if part and _has_stale(spark, lake, sources, months):
        sources = months = None
        part = False
    landed = bronze.read_bronze(spark, lake.bronze, sources, months)
    _require_rows(landed, lake.bronze)
    keep = tuple(bronze.PARTITION)
    raw = typed_ads(spread(landed, partitions, "raw"), keep=keep)
    clean = silver.clean_ads(raw, rules, keep)
    # Bronze's files hold one partition each, so the ads are written where they were read.
    tables.write_table(
        clean, lake.ads, bronze.PARTITION, replaces="dynamic" if part else "static", deal=partitions is not None
    )
    ads = tables.read_table(spark, lake.ads, CLEAN_ADS)
    tables.write_table(silver.quality_rows(ads), lake.quality)
    return ads.count()


def _has_stale(
    spark: SparkSession, lake: Lake, sources: list[str] | None, months: tuple[str, str] | None
) -> bool:
    """Whether Silver holds a selected partition without a row in Bronze."""
    keys = bronze.PARTITION
    try:
        written = spark.read.parquet(lake.ads)
    except AnalysisException:  # no Silver yet
        return False
    have = bronze.selected(written, sources, months).select(*keys).distinct()
    want = bronze.read_bronze(spark, lake.bronze, sources, months).select(*keys).distinct()
    return not have.join(want, keys, "left_anti").isEmpty()


def run_terms(
    spark: SparkSession, lake: Lake, dictionary: str, partitions: int | None = None
) -> int:
    """Extract dictionary terms from the clean ads."""
    ads = tables.read_table(spark, lake.ads, CLEAN_ADS)
    dealt = spread(ads, partitions, "id_offre", "description")
    found = extract_terms(dealt, read_dictionary(spark, dictionary))
    tables.write_table(found.select(*SKILLS.fieldNames()), lake.skills)
    written = tables.read_table(spark, lake.skills, SKILLS)
    _require_rows(written, lake.skills)
    return written.count()


def run_gold(spark: SparkSession, lake: Lake) -> int:
    """Build and write the marts; returns how many."""
    ads = tables.read_table(spark, lake.ads, CLEAN_ADS)
    found = tables.read_table(spark, lake.skills, SKILLS)
    marts = gold.build_marts(ads, found)
    for name, mart in marts.items():
        tables.write_table(mart, lake.mart(name))
    return len(marts)


def read_marts(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """The written marts by name."""
    return {name: tables.read_table(spark, lake.mart(name)) for name in gold.MARTS}


def run(
    spark: SparkSession, source: str, root: str, dictionary: str, layout: str = "envelope",
    feed: str = bronze.DEFAULT_FEED, corrupt: str = "raise", partitions: int | None = None, pattern: str = "*.json",
) -> list[Step]:
    """All steps in order; the first failure stops the run by raising.

    ``layout``: an envelope file is one task by nature, so land large feeds as ``lines``.
    ``partitions``: tasks over which Silver and extraction deal the rows; None leaves the scan's.
    ``pattern``: names of the envelope files.
    """
    lake = Lake(root)
    steps: list[tuple[str, Callable[[], int]]] = [
        ("bronze", lambda: run_bronze(spark, lake, source, layout, feed, corrupt, pattern)),
        ("silver", lambda: run_silver(spark, lake, partitions=partitions)),
        ("terms", lambda: run_terms(spark, lake, dictionary, partitions)),
        ("gold", lambda: run_gold(spark, lake)),
    ]
    done = []
    for name, action in steps:
        started = time.monotonic()
        rows = action()
        rejected = count_rejects(spark, lake) if name == "bronze" else 0
        done.append(Step(name, rows, time.monotonic() - started, rejected))
    return done


def main(argv: list[str] | None = None) -> None:
    """``spark-submit`` entry: paths come from the command line."""
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--source", required=True)
    parser.add_argument("--lake", required=True)
    parser.add_argument("--dictionary", required=True)
    parser.add_argument("--layout", choices=["envelope", "lines"], default="envelope")
    parser.add_argument("--feed", default=bronze.DEFAULT_FEED)
    parser.add_argument("--corrupt", choices=["raise", "skip"], default="raise")
    parser.add_argument("--partitions", type=int)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("adstrata").getOrCreate()
    steps = run(
        spark, args.source, args.lake, args.dictionary, args.layout, args.feed, args.corrupt,
        args.partitions,
    )
    for step in steps:
        print(f"{step.name:<8} {step.rows:>12} rows  {step.seconds:8.1f} s  {step.rejected} rejected")


if __name__ == "__main__":
    main()
