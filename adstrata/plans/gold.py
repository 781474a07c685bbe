"""Gold marts. Column names are parameters; the defaults are the Silver columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstrata import dictionaries as D
from adstrata.functions.numeric import round_to, share_pct
from adstrata.operators.percentiles import exact_percentiles
from adstrata.operators.ranking import rank_within, top_k


def top_terms(
    matches: DataFrame,
    ads: DataFrame,
    ad_id: str = "id_offre",
    profile: str = "profil_normalise",
    family: str = "famille",
    term: str = "skill_normalise",
    unclassified: str = D.UNCLASSIFIED,
) -> DataFrame:
    """Distinct ads per (profile, family, term), share of all ads and dense rank in profile.

    Profile ``tous`` counts every ad, unclassified ones included. Both levels come from one
    pass: each match is emitted under its own profile (when classified) and under ``tous``.
    """
    total = ads.agg(F.count_distinct(ad_id)).scalar()
    classified = (F.col(profile) != unclassified) & F.col(profile).isNotNull()
    groups = F.when(classified, F.array(F.col(profile), F.lit(D.ALL_PROFILES))).otherwise(
        F.array(F.lit(D.ALL_PROFILES))
    )
    counted = (
        matches.select(
            F.explode(groups).alias("profil"),
            F.col(family).alias("famille"),
            F.col(term).alias("competence"),
            F.col(ad_id).alias("_id"),
        )
        .groupBy("profil", "famille", "competence")
        .agg(F.count_distinct("_id").alias("nb_offres_mentionnent"))
        .withColumn("pct_offres_total", share_pct(F.col("nb_offres_mentionnent"), total, 2))
    )
    return rank_within(counted, "profil", "nb_offres_mentionnent", "rang_dans_profil", dense=True)


def _located(ads: DataFrame, profile: str, city: str) -> DataFrame:
    """Ads with a recognised city and profile; nulls drop out of the inequalities."""
    return ads.where(
        ~F.col(city).isin(D.OTHER, D.UNKNOWN_CITY)
        & (F.col(profile) != D.UNCLASSIFIED)
        & F.col(profile).isNotNull()
    )


def volume_by_city(
    ads: DataFrame,
    profile: str = "profil_normalise",
    city: str = "ville",
    remote: Column | None = None,
) -> DataFrame:
    """Ads and remote ads per (city, profile)."""
    if remote is None:
        remote = F.col("teletravail").isin(D.REMOTE_VALUES)
    return (
        _located(ads, profile, city)
        .groupBy(F.col(city).alias("ville"), F.col(profile).alias("profil"))
        .agg(
            F.count(F.lit(1)).alias("nb_offres"),
            F.count_if(remote).alias("nb_offres_remote"),
        )
        .withColumn("pct_remote", share_pct(F.col("nb_offres_remote"), F.col("nb_offres"), 1))
    )


def salary_by_profile(
    ads: DataFrame,
    profile: str = "profil_normalise",
    city: str = "ville",
    low: str = "salaire_min_mad",
    high: str = "salaire_max_mad",
    mid: str = "salaire_median_mad",
    known: str = "salaire_connu",
    at_least: int = 3,
) -> DataFrame:
    """Salary median, quartiles and extremes per (profile, city) with enough ads."""
    c = F.col
    rows = _located(ads, profile, city).select(
        c(profile).alias("profil"),
        c(city).alias("ville"),
        c(known).alias("_known"),
        F.when(c(known), c(low)).alias("_low"),
        F.when(c(known), c(high)).alias("_high"),
        F.when(c(known), c(mid)).alias("_mid"),
    )
    marts = exact_percentiles(
        rows, ["profil", "ville"], "_mid", {"_q2": 0.5, "_q1": 0.25, "_q3": 0.75},
        also={
            "nb_offres": F.count(F.lit(1)),
            "nb_offres_avec_salaire": F.count_if("_known"),
            "_min": F.min("_low"),
            "_max": F.max("_high"),
        },
    )
    return marts.where(c("nb_offres") >= at_least).select(
        "profil",
        "ville",
        "nb_offres",
        "nb_offres_avec_salaire",
        share_pct(c("nb_offres_avec_salaire"), c("nb_offres"), 1).alias(
            "pct_salaire_communique"
        ),
        round_to(c("_q2"), 0).alias("salaire_median_mad"),
        round_to(c("_q1"), 0).alias("salaire_q1_mad"),
        round_to(c("_q3"), 0).alias("salaire_q3_mad"),
        round_to(c("_min"), 0).alias("salaire_min_observe"),
        round_to(c("_max"), 0).alias("salaire_max_observe"),
    )


def recruiters(
    ads: DataFrame,
    company: str = "entreprise",
    city: str = "ville",
    profile: str = "profil_normalise",
    mid: str = "salaire_median_mad",
    known: str = "salaire_connu",
) -> DataFrame:
    """Ads, distinct profiles, mean salary and the profile list per (company, city).

    Aggregating per profile first is plain hash aggregation that shrinks the data before the
    list is collected, and a company's list is never longer than the number of profiles. It
    also replaces the self-join of a count table with a list table.
    """
    c = F.col
    per_profile = (
        ads.where(c(company).isNotNull() & (c(company) != "") & (c(city) != D.OTHER))
        .groupBy(
            c(company).alias("entreprise"), c(city).alias("ville"), c(profile).alias("_profile")
        )
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum(F.when(c(known), c(mid))).alias("_sum"),
            F.count(F.when(c(known), c(mid))).alias("_known"),
        )
    )
    named = F.when(c("_profile") != D.UNCLASSIFIED, c("_profile"))
    return (
        per_profile.groupBy("entreprise", "ville")
        .agg(
            F.sum("_n").alias("nb_offres_publiees"),
            F.count(named).alias("nb_profils_differents"),
            round_to(F.try_divide(F.sum("_sum").cast("double"), F.sum("_known")), 0).alias(
                "salaire_moyen_propose"
            ),
            F.array_sort(F.collect_list(named)).alias("profils_recrutes"),
        )
    )


def monthly_trends(
    ads: DataFrame,
    year: str = "annee_publication",
    month: str = "mois_publication",
    profile: str = "profil_normalise",
    mid: str = "salaire_median_mad",
    known: str = "salaire_connu",
) -> DataFrame:
    """Ads, ads with a salary and mean salary per (year, month, profile)."""
    c = F.col
    return (
        ads.where(
            c(year).isNotNull()
            & c(month).isNotNull()
            & (c(profile) != D.UNCLASSIFIED)
            & c(profile).isNotNull()
        )
        .groupBy(c(year).alias("annee"), c(month).alias("mois"), c(profile).alias("profil"))
        .agg(
            F.count(F.lit(1)).alias("nb_offres"),
            F.count_if(known).alias("nb_avec_salaire"),
            round_to(F.avg(F.when(c(known), c(mid))), 0).alias("salaire_moyen_mois"),
        )
    )


MARTS = {
    "top_competences": None,
    "offres_par_ville": volume_by_city,
    "salaires_par_profil": salary_by_profile,
    "entreprises_recruteurs": recruiters,
    "tendances_mensuelles": monthly_trends,
}


def build_marts(ads: DataFrame, matches: DataFrame) -> dict[str, DataFrame]:
    """All five marts from the two Silver tables."""
    return {
        name: top_terms(matches, ads) if build is None else build(ads)
        for name, build in MARTS.items()
    }


# Verification table -> the mart it reads.
SUMMARY_MARTS = {
    "competences": "top_competences",
    "salaires": "salaires_par_profil",
    "villes": "offres_par_ville",
    "recruteurs": "entreprises_recruteurs",
}


def summary(
    marts: dict[str, DataFrame],
    city: str = D.FOCUS_CITY,
    profile: str = D.DATA_PROFILES[0],
    ks: Sequence[int] = (10, 8, 5, 10),
) -> dict[str, DataFrame]:
    """Four verification tables over the marts, ties broken by the row's keys; those whose mart is given."""
    c = F.col
    tables = {
        "competences": lambda: top_k(
            marts["top_competences"].where(c("profil") == D.ALL_PROFILES),
            "nb_offres_mentionnent", ks[0], ["famille", "competence"],
        ).select("competence", "famille", "nb_offres_mentionnent", "pct_offres_total"),
        "salaires": lambda: top_k(
            marts["salaires_par_profil"].where(c("ville") == city),
            "salaire_median_mad", ks[1], ["profil"],
        ).select(
            "profil", "nb_offres", "nb_offres_avec_salaire",
            "salaire_median_mad", "salaire_q1_mad", "salaire_q3_mad",
        ),
        "villes": lambda: top_k(
            marts["offres_par_ville"].where(c("profil") == profile),
            "nb_offres", ks[2], ["ville"],
        ).select("ville", "nb_offres", "nb_offres_remote", "pct_remote"),
        "recruteurs": lambda: top_k(
            marts["entreprises_recruteurs"],
            "nb_offres_publiees", ks[3], ["entreprise", "ville"],
        ).select("entreprise", "ville", "nb_offres_publiees", "salaire_moyen_propose"),
    }
    return {name: tables[name]() for name, mart in SUMMARY_MARTS.items() if mart in marts}
