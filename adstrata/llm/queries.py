"""The registered queries of the operators, over the given tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, brown, decontam, jaccard, licenses, linededup, mixing, quality, repair, secrets, topk, toxicity, warc
from .common import sha256_text, table


def op3_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1
    return brown.score(table(spark, sf_dir, "documents"), held_out)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(manifest, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_documents(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: The tree of the mix: form of the text, language, source. Children without a weight have weight 1.
MIX_LEVELS = ("domain", "lang", "source")
MIX_WEIGHTS = {"domain": {"brief": 1, "article": 3, "long": 2}, "lang": {"en": 5, "de": 2, "fr": 2, "es": 1}}
MIX_SHARE = 0.6


def with_domain(docs: DataFrame) -> DataFrame:
    n = F.length(F.coalesce("text", F.lit("")))
    return docs.withColumn("domain", F.when(n < 1000, "brief").when(n < 8000, "article").otherwise("long"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_domain(table(spark, sf_dir, "documents")).withColumn("id", F.col("doc_id"))
    mixed = mixing.mix(docs, MIX_LEVELS, budget_share=MIX_SHARE, weights=MIX_WEIGHTS)
    return mixed.select("doc_id", "domain", "lang", "source", "epoch", mixing.n_tokens(F.col("text")).alias("n_tokens"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_removed", sha256_text(F.col("text")).alias("text_sha256"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(table(spark, sf_dir, "conversations"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_top_k, op2_secrets, op3_class_lm, op4_jaccard_join, op5_warc, op6_decontamination,
        op7_toxicity, op8_mixing, op9_licenses, op10_line_dedup, op11_alignment, op12_repair, op13_quality,
    )}
