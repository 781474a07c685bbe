"""Questions over the Gold marts (and, for experience, the clean ads).

Every limit has a tie-break, so the selected rows are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adstrata import dictionaries as D
from adstrata.functions.numeric import band, level, pearson, round_to, share_pct
from adstrata.operators.joins import literal_dimension, ratio_to_base
from adstrata.operators.percentiles import exact_percentiles
from adstrata.operators.pivots import pivot
from adstrata.operators.ranking import rank_within, top_k, top_k_ranked


# --- Demand for terms ---------------------------------------------------------------------


def top_terms_overall(terms: DataFrame, k: int = 20) -> DataFrame:
    """The k terms most in demand over all profiles."""
    overall = terms.where(F.col("profil") == D.ALL_PROFILES)
    return top_k(overall, "nb_offres_mentionnent", k, ["famille", "competence"]).select(
        "famille", "competence", "nb_offres_mentionnent", "pct_offres_total", "rang_dans_profil"
    )


def leading_terms(
    terms: DataFrame, profiles: Sequence[str] = tuple(D.DATA_PROFILES), rank: int = 5
) -> DataFrame:
    """Terms up to a dense rank in some profiles; ties can give more than ``rank`` rows."""
    return (
        terms.where(F.col("profil").isin(list(profiles)) & (F.col("rang_dans_profil") <= rank))
        .select("profil", "famille", "competence", "nb_offres_mentionnent", "rang_dans_profil")
        .orderBy("profil", "rang_dans_profil", "famille", "competence")
    )


def leading_terms_pivot(
    terms: DataFrame, profiles: Sequence[str] = tuple(D.DATA_PROFILES), rank: int = 5
) -> DataFrame:
    """Mean ads per rank (rows) and profile (columns)."""
    return pivot(
        leading_terms(terms, profiles, rank),
        "rang_dans_profil",
        "profil",
        {p: p for p in profiles},
        "nb_offres_mentionnent",
        "avg",
    )


# --- Cities -------------------------------------------------------------------------------


def city_rank(volume: DataFrame, cities: Sequence[str] = tuple(D.COMPARED_CITIES)) -> DataFrame:
    """Rank of some cities within each profile."""
    compared = volume.where(F.col("ville").isin(list(cities)))
    return (
        rank_within(compared, "profil", "nb_offres", "rang_ville")
        .select("ville", "profil", "nb_offres", "nb_offres_remote", "pct_remote", "rang_ville")
        .orderBy("profil", "rang_ville", "ville")
    )


def city_against_base(
    volume: DataFrame, city: str = D.FOCUS_CITY, base: str = D.BASE_CITY
) -> DataFrame:
    """Ads of a city per profile as a percentage of the base city's."""
    return ratio_to_base(
        volume, "profil", "ville", "nb_offres", city, base, ["pct_remote"], "pct_vs_casa"
    ).orderBy(F.desc("nb_offres"), "profil")


def volume_pivot(
    ranked: DataFrame,
    profiles: Sequence[str] = tuple(D.DATA_PROFILES),
    cities: Sequence[str] = tuple(D.COMPARED_CITIES),
) -> DataFrame:
    """Ads per profile (rows) and city (columns), zero where absent."""
    rows = ranked.where(F.col("profil").isin(list(profiles)))
    return pivot(rows, "profil", "ville", {c: c for c in cities}, "nb_offres", "sum", 0)


def remote_pivot(
    ranked: DataFrame, cities: Sequence[str] = tuple(D.COMPARED_CITIES[:3])
) -> DataFrame:
    """Remote share per profile (rows) and city (columns), zero where absent."""
    return pivot(ranked, "profil", "ville", {c: c for c in cities}, "pct_remote", "avg", 0.0)


def city_map(
    volume: DataFrame, spark: SparkSession, coordinates: dict | None = None
) -> DataFrame:
    """Ads per city with coordinates; cities without coordinates drop out."""
    coordinates = D.CITY_COORDINATES if coordinates is None else coordinates
    places = literal_dimension(
        spark,
        [(city, float(lat), float(lon)) for city, (lat, lon) in coordinates.items()],
        "ville string, lat double, lon double",
    )
    totals = volume.groupBy("ville").agg(F.sum("nb_offres").alias("total_offres"))
    return totals.join(places, "ville").orderBy(F.desc("total_offres"), "ville")


# --- Salaries -----------------------------------------------------------------------------


def salary_rollup(salaries: DataFrame) -> DataFrame:
    """Per profile: ads, salary coverage, median of the city medians, extremes."""
    c = F.col
    return (
        salaries.groupBy("profil")
        .agg(
            F.sum("nb_offres").alias("nb_offres_total"),
            F.sum("nb_offres_avec_salaire").alias("nb_avec_salaire"),
            # One value per city of the profile: the mart bounds the group.
            round_to(F.median("salaire_median_mad"), 0).alias("salaire_median_mad"),
            F.min("salaire_min_observe").alias("salaire_plancher"),
            F.max("salaire_max_observe").alias("salaire_plafond"),
        )
        .withColumn(
            "pct_salaire_communique", share_pct(c("nb_avec_salaire"), c("nb_offres_total"), 1)
        )
        .orderBy(F.desc_nulls_last("salaire_median_mad"), "profil")
    )


def salary_gap(
    salaries: DataFrame, city: str = D.FOCUS_CITY, at_least: int = 5
) -> DataFrame:
    """Salaries of one city against the median of city medians of the same profile."""
    national = salaries.groupBy("profil").agg(
        round_to(F.median("salaire_median_mad"), 0).alias("_national")
    )
    return (
        salaries.where((F.col("ville") == city) & (F.col("nb_offres") >= at_least))
        .join(national, "profil")
        .select(
            "profil",
            "nb_offres",
            "salaire_median_mad",
            "salaire_q1_mad",
            "salaire_q3_mad",
            round_to(F.col("salaire_median_mad") - F.col("_national"), 0).alias(
                "ecart_mediane_nationale"
            ),
        )
        .orderBy(F.desc_nulls_last("salaire_median_mad"), "profil")
    )


# --- Experience against salary ------------------------------------------------------------


def salary_by_experience(
    ads: DataFrame,
    profiles: Sequence[str] | None = tuple(D.CORRELATION_PROFILES),
    profile: str = "profil_normalise",
    years: str = "experience_min_ans",
    mid: str = "salaire_median_mad",
    known: str = "salaire_connu",
    bands: Sequence[tuple] = tuple(D.EXPERIENCE_BANDS),
) -> DataFrame:
    """Ads and exact median salary per profile and experience band, in band order."""
    label, ordinal = band(F.col(years), bands, D.NO_BAND)
    rows = ads if profiles is None else ads.where(F.col(profile).isin(list(profiles)))
    rows = rows.select(
        F.col(profile).alias("profil"),
        label.alias("tranche_experience"),
        ordinal.alias("ordre"),
        F.when(F.col(known), F.col(mid)).alias("_mid"),
    )
    keys = ["profil", "tranche_experience", "ordre"]
    medians = exact_percentiles(
        rows, keys, "_mid", {"_median": 0.5}, also={"nb_offres": F.count(F.lit(1))}
    )
    return medians.select(
        *keys, "nb_offres", round_to(F.col("_median"), 0).alias("salaire_median")
    ).orderBy("profil", "ordre")


def experience_correlation(
    ads: DataFrame,
    profiles: Sequence[str] | None = tuple(D.CORRELATION_PROFILES),
    profile: str = "profil_normalise",
    x: str = "experience_min_ans",
    y: str = "salaire_median_mad",
    known: str | None = "salaire_connu",
) -> DataFrame:
    """Pearson r of two columns per profile, three decimals, with a strength label."""
    rows = ads if profiles is None else ads.where(F.col(profile).isin(list(profiles)))
    measured = F.col(y) if known is None else F.when(F.col(known), F.col(y))
    r = F.col("correlation_pearson")
    return (
        rows.groupBy(F.col(profile).alias("profil"))
        .agg(round_to(pearson(F.col(x), measured), 3).alias("correlation_pearson"))
        .withColumn(
            "force",
            F.when(
                r.isNotNull(), level(F.abs(r), D.CORRELATION_STRENGTH, D.CORRELATION_WEAKEST)
            ),
        )
        .orderBy(F.desc_nulls_last("correlation_pearson"), "profil")
    )


# --- Recruiters ---------------------------------------------------------------------------


def top_recruiters(companies: DataFrame, k: int = 20) -> DataFrame:
    """The k largest recruiters with their global rank."""
    return top_k_ranked(
        companies, "nb_offres_publiees", k, ["entreprise", "ville"], "rang_recruteur"
    ).select(
        "entreprise",
        "ville",
        "nb_offres_publiees",
        "nb_profils_differents",
        "salaire_moyen_propose",
        "rang_recruteur",
    )


def competitors(companies: DataFrame, city: str = D.FOCUS_CITY, k: int = 15) -> DataFrame:
    """The k largest recruiters of a city with a level; no known salary is the weakest level."""
    local = companies.where(F.col("ville") == city)
    return top_k(local, "nb_offres_publiees", k, ["entreprise"]).select(
        "entreprise",
        "nb_offres_publiees",
        "profils_recrutes",
        "salaire_moyen_propose",
        level(
            F.col("salaire_moyen_propose"), D.COMPETITOR_LEVELS, D.COMPETITOR_WEAKEST
        ).alias("niveau_competition"),
    )


# --- Trend --------------------------------------------------------------------------------


def monthly_series(
    trends: DataFrame, profiles: Sequence[str] = tuple(D.TREND_PROFILES)
) -> DataFrame:
    """Ads per month of some profiles with the month as a date."""
    return (
        trends.where(F.col("profil").isin(list(profiles)))
        .select(
            "annee",
            "mois",
            F.make_date(
                F.col("annee").cast("int"), F.col("mois").cast("int"), F.lit(1)
            ).alias("date_mois"),
            "profil",
            "nb_offres",
        )
        .orderBy("annee", "mois", "profil")
    )
