"""Headline timings at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The steps are the ones of the whole run (every order becomes one ad), timed as a job runs them:
each reads what the previous one wrote.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from adstrata.operators.extraction import extract_terms  # noqa: E402
from adstrata.operators.spread import spread  # noqa: E402
from adstrata.plans import analytics, gold, job, silver  # noqa: E402
from adstrata.session import local_session  # noqa: E402
from adstrata.sources import bronze, tables  # noqa: E402
from adstrata.sources.envelope import read_lines, typed_ads  # noqa: E402
from adstrata.sources.terms import WORD, dictionary_from_mapping  # noqa: E402
from workload import cases as K  # noqa: E402
from workload import queries as W  # noqa: E402
from workload.ads import messy_ads, scratch, table  # noqa: E402

ALIASES = 281  # the size of the dictionary the published run used
PUBLISHED_ADS = 5_000


def frequent_terms(texts) -> dict:
    """A dictionary of 281 aliases in 97 terms and 10 families from the texts' own words (column t)."""
    words = (
        texts.select(F.explode(F.split(F.lower("t"), f"[^{WORD}]+")).alias("w"))
        .where("w <> ''")
        .groupBy("w")
        .count()
        .orderBy(F.desc("count"), "w")
        .limit(ALIASES)
    )
    families: dict = {}
    for i, row in enumerate(words.collect()):
        term = families.setdefault(f"f{i % 97 % 10}", {}).setdefault(f"t{i % 97}", [])
        # Every tenth alias is a phrase, which takes the confirmation path.
        term.append(f"{row['w']} of the" if i % 10 == 9 else row["w"])
    return families


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "adstrata-bench")
    root = scratch(spark, "bench")
    keep = tuple(bronze.PARTITION)
    lake = job.Lake(f"{root}/lake")
    timings: dict[str, float] = {}

    def timed(name, action):
        started = time.monotonic()
        result = action()
        timings[name] = round(time.monotonic() - started, 3)
        return result

    def drain(df):
        df.write.format("noop").mode("overwrite").save()

    messy_ads(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value")).repartition(
        int(cpus), "value"
    ).write.text(f"{root}/inbox")
    n_ads = spark.read.text(f"{root}/inbox").count()
    big = dictionary_from_mapping(spark, frequent_terms(table(spark, sf_dir, "documents").select(F.col("text").alias("t"))))
    terms = dictionary_from_mapping(spark, K.AD_TERMS)

    timed("bronze_ingest", lambda: bronze.ingest(read_lines(spark, f"{root}/inbox"), lake.bronze))
    landed = bronze.read_bronze(spark, lake.bronze)
    timed(
        "silver_transform",
        lambda: tables.write_table(
            silver.clean_ads(typed_ads(landed, keep=keep), keep=keep), lake.ads, bronze.PARTITION,
            replaces="static", deal=False
        ),
    )
    ads = tables.read_table(spark, lake.ads, job.CLEAN_ADS)
    timed(
        "ad_terms",
        lambda: tables.write_table(
            extract_terms(spread(ads, int(cpus), "id_offre", "description"), terms), lake.skills
        ),
    )
    found = tables.read_table(spark, lake.skills, job.SKILLS)
    for name, mart in gold.build_marts(ads, found).items():
        timed(f"gold_{name}", lambda m=mart, n=name: tables.write_table(m, lake.mart(n)))
    timed(
        "document_terms_281",
        lambda: drain(
            extract_terms(spread(W._documents(spark, sf_dir), int(cpus), "doc_id"), big, "doc_id", "first",
                          "text", {"lang": "lang"})
        ),
    )
    # The size of the published run: 5 000 ads, 281 aliases, two fields. The documents are the ads' texts.
    few = W._documents(spark, sf_dir).orderBy("doc_id").limit(PUBLISHED_ADS)
    few.write.parquet(f"{root}/published")
    published = spark.read.parquet(f"{root}/published")
    timed(
        "terms_5000_ads_281",
        lambda: drain(extract_terms(spread(published, int(cpus), "doc_id"), big, "doc_id", "first", "text", {"lang": "lang"})),
    )
    marts = job.read_marts(spark, lake)
    questions = {
        "top_terms_overall": analytics.top_terms_overall(marts["top_competences"]),
        "city_rank": analytics.city_rank(marts["offres_par_ville"]),
        "salary_rollup": analytics.salary_rollup(marts["salaires_par_profil"]),
        "salary_by_experience": analytics.salary_by_experience(ads),
        "experience_correlation": analytics.experience_correlation(ads),
        "top_recruiters": analytics.top_recruiters(marts["entreprises_recruteurs"]),
    }
    for name, df in questions.items():
        timed(name, lambda d=df: drain(d))
    for name in ("price_quartiles", "supplier_flags", "order_trend", "quantity_correlation"):
        timed(name, lambda n=name: drain(W.queries()[n](spark, sf_dir)))

    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "ads": n_ads,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
