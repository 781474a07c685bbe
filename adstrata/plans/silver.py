"""Silver: raw ads to typed, normalised ads with a quality flag per repair. One narrow stage."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstrata import dictionaries as D
from adstrata.functions.dates import date_pair, parse_date
from adstrata.functions.experience import parse_experience
from adstrata.functions.lookup import (
    classify,
    map_lookup,
    normalise_exact,
    normalise_with_fallback,
)
from adstrata.functions.salary import is_implausible, is_inverted, midpoint, parse_salary
from adstrata.functions.text import digits_text, fold, in_small_methods, is_empty
from adstrata.schemas import CLEAN_ADS, QUALITY

SEPARATOR = ", "


@dataclass(frozen=True)
class SilverRules:
    """Dictionaries and switches of the transform."""

    titles: dict = field(default_factory=lambda: D.TITLE_KEYWORDS)
    cities: dict = field(default_factory=lambda: D.CITY_SPELLINGS)
    regions: dict = field(default_factory=lambda: D.CITY_REGION)
    contracts: dict = field(default_factory=lambda: D.CONTRACT_SPELLINGS)
    confidential: tuple = tuple(D.CONFIDENTIAL_WORDS)
    beginner: tuple = tuple(D.BEGINNER_WORDS)
    strict_experience: bool = False


def clean_ads(
    raw: DataFrame, rules: SilverRules | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """The 33 clean columns, one row per raw ad; ``keep`` names columns to carry along.

    Written as successive projections: texts are prepared once, each parser runs once on them,
    and the repairs read the parsed values. Each is too long for one method.
    """
    rules = rules or SilverRules()
    c = F.col
    small = {"id_offre": in_small_methods(c("id_offre"))}

    prepared = raw.withColumns(
        {
            **small,
            "_title_text": fold(c("titre_poste")),
            "_city_text": fold(c("ville")),
            "_contract_text": fold(c("type_contrat")),
            "_pay_text": digits_text(c("salaire_brut")),
            "_years_text": F.lower(digits_text(c("experience_requise"))),
            "_published_text": digits_text(c("date_publication")),
            "_expires_text": digits_text(c("date_expiration")),
        }
    ).withColumn("_pay_lowered", F.lower("_pay_text"))
    parsed = prepared.withColumns(
        {
            **small,
            "_profile": classify(
                c("titre_poste"), rules.titles, D.UNCLASSIFIED, c("_title_text")
            ),
            "_city": normalise_with_fallback(
                c("ville"), rules.cities, D.UNKNOWN_CITY, D.OTHER, c("_city_text")
            ),
            "_contract": normalise_exact(
                c("type_contrat"),
                rules.contracts,
                D.UNSPECIFIED_CONTRACT,
                D.OTHER,
                c("_contract_text"),
            ),
            "_salary": parse_salary(
                c("salaire_brut"),
                rules.confidential,
                text=c("_pay_text"),
                lowered=c("_pay_lowered"),
            ),
            "_experience": parse_experience(
                c("experience_requise"),
                rules.beginner,
                rules.strict_experience,
                c("_years_text"),
            ),
            "_published": parse_date(c("date_publication"), text=c("_published_text")),
            "_expires": parse_date(c("date_expiration"), text=c("_expires_text")),
        }
    )
    low, high = c("_salary.min"), c("_salary.max")
    swapped = is_inverted(low, high)
    repaired = parsed.withColumns(
        {
            **small,
            "_region": F.when(c("_city") == D.UNKNOWN_CITY, c("_city")).otherwise(
                map_lookup(c("_city"), rules.regions, D.OTHER)
            ),
            "_inverted": swapped,
            "_low": F.when(swapped, high).otherwise(low),
            "_high": F.when(swapped, low).otherwise(high),
            "_dates": date_pair(c("_published"), c("_expires")),
        }
    )
    flags = {
        "titre_non_classifie": c("_profile") == D.UNCLASSIFIED,
        "ville_non_reconnue": c("_city").isin(D.OTHER, D.UNKNOWN_CITY),
        "contrat_non_reconnu": c("_contract").isin(D.UNSPECIFIED_CONTRACT, D.OTHER),
        "salaire_inverti": c("_inverted"),
        "salaire_hors_plage": is_implausible(c("_low")),
        "salaire_non_parseable": c("_salary.currency") == D.SALARY_UNPARSEABLE,
        "experience_non_parseable": c("_experience.min").isNull(),
        "dates_incoherentes": ~c("_dates.valid"),
    }
    count = F.lit(0)
    for flag in flags.values():
        count = count + flag.cast("int")
    names = F.concat_ws(SEPARATOR, *[F.when(flag, F.lit(name)) for name, flag in flags.items()])

    return repaired.select(
        *keep,
        "id_offre",
        "source",
        c("titre_poste").alias("titre_poste_original"),
        c("_profile").alias("profil_normalise"),
        c("ville").alias("ville_originale"),
        c("_city").alias("ville"),
        c("_region").alias("region"),
        c("type_contrat").alias("contrat_original"),
        c("_contract").alias("type_contrat"),
        F.when(~is_empty(c("salaire_brut")), c("salaire_brut")).alias("salaire_brut_original"),
        c("_low").alias("salaire_min_mad"),
        c("_high").alias("salaire_max_mad"),
        c("_salary.currency").alias("salaire_devise"),
        midpoint(c("_low"), c("_high")).alias("salaire_median_mad"),
        c("_low").isNotNull().alias("salaire_connu"),
        c("experience_requise").alias("experience_originale"),
        c("_experience.min").alias("experience_min_ans"),
        c("_experience.max").alias("experience_max_ans"),
        c("_dates.published").alias("date_publication"),
        c("_dates.expires").alias("date_expiration"),
        c("_dates.valid").alias("dates_valides"),
        F.month(c("_dates.published")).alias("mois_publication"),
        F.year(c("_dates.published")).alias("annee_publication"),
        "description",
        "competences_brut",
        "entreprise",
        "secteur",
        "niveau_etudes",
        "nb_postes",
        "teletravail",
        "langue_requise",
        count.alias("nb_anomalies"),
        names.alias("anomalies"),
    ).select(*CLEAN_ADS.fieldNames(), *keep)


def quality_rows(clean: DataFrame) -> DataFrame:
    """One quality row per clean ad."""
    c = F.col
    return clean.select(
        "id_offre",
        c("profil_normalise").alias("profil"),
        "ville",
        "nb_anomalies",
        "anomalies",
        (c("profil_normalise") != D.UNCLASSIFIED).alias("titre_mapped"),
        "dates_valides",
        (
            ~c("salaire_devise").isin(
                D.SALARY_CONFIDENTIAL, D.SALARY_UNPARSEABLE, D.SALARY_MISSING
            )
        ).alias("salaire_parseable"),
    ).select(*QUALITY.fieldNames())


def languages_as_json(clean: DataFrame) -> DataFrame:
    """Edge form of the language list: JSON text with a blank after each comma."""
    items = F.transform(
        "langue_requise",
        lambda x: F.regexp_replace(F.to_json(F.array(x)), r"^\[|\]$", ""),
    )
    text = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    return clean.withColumn("langue_requise", F.coalesce(text, F.lit("[]")))
