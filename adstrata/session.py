"""Session defaults. A session that already exists (a cluster's) is used as it is."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app: str = "adstrata", **conf: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # HotSpot does not compile methods beyond 8000 bytes of bytecode; the wide Silver
        # projection runs faster outside whole-stage code generation than interpreted inside it.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
