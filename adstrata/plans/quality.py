"""Quality report over the Silver tables, one small table per question."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstrata.functions.numeric import share_pct
from adstrata.operators.distribution import member_counts, value_counts
from adstrata.plans.silver import SEPARATOR


def anomaly_summary(clean: DataFrame) -> DataFrame:
    """One row: ads, ads with a salary and their share, ads with 0, 1 and 2+ anomalies."""
    c = F.col
    return clean.agg(
        F.count(F.lit(1)).alias("total"),
        F.count("salaire_min_mad").alias("nb_salaire_connu"),
        F.count_if(c("nb_anomalies") == 0).alias("nb_sans_anomalie"),
        F.count_if(c("nb_anomalies") == 1).alias("nb_une_anomalie"),
        F.count_if(c("nb_anomalies") >= 2).alias("nb_plusieurs_anomalies"),
    ).withColumns(
        {
            "pct_salaire_connu": share_pct(c("nb_salaire_connu"), c("total")),
            "pct_sans_anomalie": share_pct(c("nb_sans_anomalie"), c("total")),
        }
    )


def anomaly_types(clean: DataFrame, k: int = 5) -> DataFrame:
    """The k most frequent anomaly types."""
    return member_counts(clean, F.split("anomalies", SEPARATOR), "anomalie", k)


def quality_report(clean: DataFrame) -> dict[str, DataFrame]:
    """All the tables of the report, by name."""
    return {
        "profils": value_counts(clean, "profil_normalise"),
        "villes": value_counts(clean, "ville", k=5),
        "contrats": value_counts(clean, "type_contrat"),
        "synthese": anomaly_summary(clean),
        "anomalies": anomaly_types(clean),
    }
