"""A training corpus from `documents`, in five stages of which each works on what the last one kept.

Every stage takes whatever the one before kept, an empty table too, and hands on the rows it keeps with all
their columns. Null texts count as empty: they are not toxic, have no line, no words and no window,
and take no tokens of a budget. Rows of one id are one document where a stage decides by document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adstrata.llm import decontam, jaccard, linededup, mixing, toxicity
from adstrata.llm.common import stored, table
from adstrata.llm.queries import MIX_LEVELS, MIX_SHARE, MIX_WEIGHTS, with_domain


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores below 0.5; rows that repeat stay or go alike."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that stand elsewhere before; documents of which nothing is left go.

    Rows that repeat id and text lose the same lines, so they stay equal; null texts stay. `n_chars`, where the
    table has it, is that of the text as it is now.
    """
    n_lines, n_removed = (linededup.free_name(docs, n) for n in ("n_lines", "n_removed"))
    done = linededup.dedup_lines(docs)
    kept = done.where((F.col(n_removed) == 0) | (F.col(n_removed) < F.col(n_lines)))
    if "n_chars" in docs.columns:
        shorter = F.when(F.col(n_removed) > 0, F.length("text")).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", shorter.cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates, and all those without words.

    Rows of one id are one document: they stay or go together. Rows of null id stay.
    """
    found = jaccard.link(docs.select("doc_id", "text"))
    gone = found.where("doc_id > component_id").select("doc_id").distinct()
    kept = docs.join(stored(gone, "near-gone").hint("shuffle_hash"), "doc_id", "left_anti")
    return kept.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of the benchmark occurs, row by row."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, once per epoch that takes them, with their `domain` (a column of that name is
    replaced, as the budget is split by it) and `epoch`."""
    return mixing.mix(with_domain(docs), MIX_LEVELS, budget_share=MIX_SHARE, weights=MIX_WEIGHTS)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_duplicates", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: A learned score, a similarity join and its components are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
