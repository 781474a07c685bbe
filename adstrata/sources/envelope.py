"""Raw ads: JSON envelopes, JSON Lines, and JSON text to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adstrata.schemas import RAW_AD, RAW_AD_DEFAULTS

# Reading each record as STRING keeps its JSON text, unknown fields included.
_ENVELOPE = T.StructType(
    [
        T.StructField(
            "metadata",
            T.StructType(
                [
                    T.StructField("source_fichier", T.StringType()),
                    T.StructField("date_ingestion", T.StringType()),
                    T.StructField("partition", T.StringType()),
                    T.StructField("nb_offres", T.IntegerType()),
                    T.StructField("schema_version", T.StringType()),
                ]
            ),
        ),
        T.StructField("offres", T.ArrayType(T.StringType())),
        T.StructField("_corrupt", T.StringType()),
    ]
)

# Control characters that no JSON text holds, so a file is one line.
_END_OF_FILE = "\u0000\u0001\u0000"


def read_envelopes(spark: SparkSession, path: str | list[str], pattern: str = "*.json") -> DataFrame:
    """One row per envelope file: metadata, offres (ARRAY of JSON text), file, corrupt flag.

    An envelope is one JSON document, so a file is the unit of parallelism; land large feeds as
    JSON Lines instead (``read_lines``), which splits. The document is read as one line: with
    ``multiLine`` the text of each record would be fetched by a read of its own at its place in the file.
    """
    files = (
        spark.read.schema(_ENVELOPE)
        .option("lineSep", _END_OF_FILE)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .option("columnNameOfCorruptRecord", "_corrupt")
        .json(path)
    )
    return files.select(
        "metadata",
        F.coalesce("offres", F.array().cast("array<string>")).alias("offres"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_corrupt").isNotNull().alias("corrupt"),
    )


def read_envelope_records(
    spark: SparkSession, path: str | list[str], corrupt: str = "raise", pattern: str = "*.json"
) -> DataFrame:
    """(raw, file) rows from envelope files; a missing record list gives no rows.

    A file that is no JSON document stops the job (``raise``) or is left out (``skip``; list such
    files with ``bronze.corrupt_files``).
    """
    if corrupt not in ("raise", "skip"):
        raise ValueError(f"corrupt must be raise or skip, not {corrupt!r}")
    files = read_envelopes(spark, path, pattern)
    if corrupt == "skip":
        offres = F.when(F.col("corrupt"), F.array().cast("array<string>")).otherwise(F.col("offres"))
    else:
        stop = F.raise_error(F.concat(F.lit("corrupt envelope: "), F.col("file")))
        offres = F.when(F.col("corrupt"), stop.cast("array<string>")).otherwise(F.col("offres"))
    return files.select(F.explode(offres).alias("raw"), "file")


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(raw, file) rows from JSON Lines, each line untouched."""
    return (
        spark.read.text(path)
        .where(F.trim("value") != "")
        .select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("file"))
    )


def read_raw(
    spark: SparkSession, path: str | list[str], layout: str = "envelope", corrupt: str = "raise",
    pattern: str = "*.json",
) -> DataFrame:
    """(raw, file) rows in either layout: ``envelope`` (files named like ``pattern``) or ``lines``."""
    if layout == "lines":
        return read_lines(spark, path)
    if layout != "envelope":
        raise ValueError(f"layout must be envelope or lines, not {layout!r}")
    return read_envelope_records(spark, path, corrupt, pattern)


def is_record(raw: str = "raw") -> Column:
    """Whether the text is one JSON object and nothing else."""
    # As an array of one, anything behind the object is a syntax error or a second element.
    alone = F.from_json(F.concat(F.lit("["), F.col(raw), F.lit("]")), "array<string>")
    return F.coalesce((F.size(alone) == 1) & F.json_object_keys(raw).isNotNull(), F.lit(False))


def _field_default(field: T.StructField) -> Column:
    value = RAW_AD_DEFAULTS[field.name]
    literal = F.array() if value == [] else F.lit(value)
    return literal.cast(field.dataType)


def typed_ads(records: DataFrame, raw: str = "raw", keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse JSON text into the raw-ad columns; ``keep`` names columns to carry along.

    A key the record lacks takes its default; a key present with null stays null. Text that is no
    JSON object gives no ad: Bronze files it under its rejects.
    """
    # A generated column is not pulled into the filter, so the keys are read once.
    keys = F.explode(F.array(F.json_object_keys(raw)))
    listed = records.select(*keep, F.col(raw).alias("_raw"), keys.alias("keys")).where(F.col("keys").isNotNull())
    parsed = listed.select(*keep, F.from_json("_raw", RAW_AD).alias("ad"), "keys")
    return parsed.select(
        *keep,
        *[
            F.coalesce(
                F.col("ad")[f.name],
                F.when(
                    ~F.coalesce(F.array_contains("keys", f.name), F.lit(False)),
                    _field_default(f),
                ),
            ).alias(f.name)
            for f in RAW_AD.fields
        ]
    )


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    """Company reference CSV (header, all text)."""
    from adstrata.schemas import COMPANIES

    return spark.read.schema(COMPANIES).option("header", True).csv(path)
