"""Parsers and normalizers against case tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adstrata import dictionaries as D
from adstrata.functions.dates import date_pair, month_key, parse_date
from adstrata.functions.experience import parse_experience
from adstrata.functions.lookup import classify, map_lookup, normalise_exact, normalise_with_fallback
from adstrata.functions.numeric import level, pearson, round_to, share_pct
from adstrata.functions.salary import is_implausible, is_inverted, midpoint, parse_salary
from adstrata.functions.text import fold, strip


def evaluate(spark, values, expression, schema="x string"):
    rows = [(i, v) if not isinstance(v, tuple) else (i, *v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, " + schema)
    # A round trip through an exchange keeps the optimizer from folding the literals away.
    out = df.repartition(2).select("i", expression.alias("r")).orderBy("i").collect()
    return [r["r"] for r in out]


# Spellings are fixed values of the dictionaries; the forms around them are our own.
CITIES = [
    ("cAsA", "Casablanca", "Casablanca-Settat"),
    ("dar el beida ", "Casablanca", "Casablanca-Settat"),
    ("Tanja", "Tanger", "Tanger-Tétouan-Al Hoceïma"),
    ("rabat\t", "Rabat", "Rabat-Salé-Kénitra"),
    (" fès ", "Fès", "Fès-Meknès"),
    ("marrakesh", "Marrakech", "Marrakech-Safi"),
    ("gare de Tanger, quai 2", "Tanger", "Tanger-Tétouan-Al Hoceïma"),
    ("Settat près de Casa", "Casablanca", "Casablanca-Settat"),
    ("Lyon", "Autre", "Autre"),
    ("   ", "Autre", "Autre"),
    ("", "Inconnu", "Inconnu"),
    (None, "Inconnu", "Inconnu"),
]


def test_city(spark):
    city = normalise_with_fallback(F.col("x"), D.CITY_SPELLINGS, D.UNKNOWN_CITY, D.OTHER)
    assert evaluate(spark, [c[0] for c in CITIES], city) == [c[1] for c in CITIES]
    region = F.when(city == D.UNKNOWN_CITY, city).otherwise(
        map_lookup(city, D.CITY_REGION, D.OTHER)
    )
    assert evaluate(spark, [c[0] for c in CITIES], region) == [c[2] for c in CITIES]


CONTRACTS = [
    ("Cdi ", "CDI"),
    ("Contrat à durée indéterminée", "CDI"),
    ("freeLance", "Freelance"),
    (" Mission freelance", "Freelance"),
    ("stage PFE", "Stage"),
    ("cdd de trois mois", "Autre"),
    ("", "Non précisé"),
    (None, "Non précisé"),
    (" ", "Autre"),
]


def test_contract(spark):
    contract = normalise_exact(
        F.col("x"), D.CONTRACT_SPELLINGS, D.UNSPECIFIED_CONTRACT, D.OTHER
    )
    assert evaluate(spark, [c[0] for c in CONTRACTS], contract) == [c[1] for c in CONTRACTS]


TITLES = [
    ("Lead Data Engineer", "Data Engineer"),
    ("Data Eng.", "Non classifié"),
    ("Développeur React Native", "Développeur Frontend"),
    ("ML ENGINEER / DevOps", "Data Scientist"),
    ("SRE", "DevOps / SRE"),
    ("", "Non classifié"),
    (None, "Non classifié"),
]


def test_title_class_order_decides(spark):
    title = classify(F.col("x"), D.TITLE_KEYWORDS, D.UNCLASSIFIED)
    assert evaluate(spark, [t[0] for t in TITLES], title) == [t[1] for t in TITLES]


SALARIES = [
    ("15000-20000 MAD", 15000, 20000, "MAD"),
    ("15000 - 20000 DH", 15000, 20000, "MAD"),
    ("15 000 – 20 000 dhs", 15000, 20000, "MAD"),
    ("15 000-20 000", 15000, 20000, "MAD"),
    ("15K-20K MAD", 15000, 20000, "MAD"),
    ("15k-20k dh", 15000, 20000, "MAD"),
    ("15000 MAD", 15000, 15000, "MAD"),
    ("15k", 15000, 15000, "MAD"),
    ("1500-1800 EUR", 16000, 19500, "EUR→MAD"),
    ("1500 eur", 16000, 16000, "EUR→MAD"),
    ("Selon profil", None, None, "Confidentiel"),
    ("   ", None, None, "Confidentiel"),
    ("CONFIDENTIEL", None, None, "Confidentiel"),
    ("A négocier", None, None, "Non parseable"),
    (None, None, None, "Non renseigné"),
    ("", None, None, "Non renseigné"),
    ("15-20K", 20000, 20000, "MAD"),
    ("15K EUR", None, None, "Non parseable"),
    ("15 000-20 000 EUR", 0, 0, "EUR→MAD"),
    ("99999999999 MAD", None, None, "MAD"),
    ("٥٠٠٠-٦٠٠٠ MAD", 5000, 6000, "MAD"),
    ("à définir", None, None, "Non parseable"),
]


def test_salary(spark):
    got = evaluate(spark, [s[0] for s in SALARIES], parse_salary(F.col("x")))
    assert [(g["min"], g["max"], g["currency"]) for g in got] == [s[1:] for s in SALARIES]


def test_salary_repair(spark):
    cases = [(5, 3), (0, 3), (3, 0), (3, 5), (None, 3), (1499, 9), (100001, 9), (1500, 1501)]
    a, b = F.col("a"), F.col("b")
    schema = "a int, b int"
    assert evaluate(spark, cases, is_inverted(a, b), schema) == [
        True, False, False, False, False, True, True, False,
    ]
    assert evaluate(spark, cases, is_implausible(a), schema) == [
        True, False, True, True, False, True, True, False,
    ]
    assert evaluate(spark, cases + [(2, None), (2, 5)], midpoint(a, b), schema) == [
        4, 2, 2, 4, 3, 754, 50005, 1500, 2, 4,
    ]


EXPERIENCE = [
    ("3-5 ans", 3, 5),
    ("2 à 4 ans", 2, 4),
    ("min 2 ans", 2, None),
    ("au moins 4 ans", 4, None),
    ("Senior (7+ ans)", 7, None),
    ("Débutant accepté", 0, 1),
    ("0 à 1 an", 0, 1),
    ("10 ans", 0, 1),
    ("10-15 ans", 0, 1),
    ("Expert confirmé", None, None),
    ("", None, None),
    (None, None, None),
]


def test_experience(spark):
    got = evaluate(spark, [e[0] for e in EXPERIENCE], parse_experience(F.col("x")))
    assert [(g["min"], g["max"]) for g in got] == [e[1:] for e in EXPERIENCE]


def test_experience_strict(spark):
    got = evaluate(
        spark, ["10 ans", "10-15 ans", "0 à 1 an", "0-1 an"],
        parse_experience(F.col("x"), strict=True),
    )
    assert [(g["min"], g["max"]) for g in got] == [(10, None), (10, 15), (0, 1), (0, 1)]


DATES = [
    ("2024-08-15", dt.date(2024, 8, 15)),
    ("15/08/2024", dt.date(2024, 8, 15)),
    ("15-08-2024", dt.date(2024, 8, 15)),
    ("2024/08/15", dt.date(2024, 8, 15)),
    (" 2024-8-5\t", dt.date(2024, 8, 5)),
    ("5/8/2024", dt.date(2024, 8, 5)),
    ("2024-08/15", None),
    ("2024-02-30", None),
    ("2024-02-29", dt.date(2024, 2, 29)),
    ("31/04/2024", None),
    ("2024-08-15T10:00:00", None),
    ("24-08-15", None),
    ("0000-01-01", None),
    ("2024", None),
    ("not-a-date", None),
    ("", None),
    (None, None),
]


def test_parse_date(spark):
    assert evaluate(spark, [d[0] for d in DATES], parse_date(F.col("x"))) == [d[1] for d in DATES]


def test_month_key_cuts_timestamps(spark):
    got = evaluate(
        spark, ["2024-08-15T10:00:00", "15/08/2024", "bad", None], month_key(F.col("x"))
    )
    assert got == ["2024_08", "2024_08", "date_inconnue", "date_inconnue"]


def test_date_pair(spark):
    cases = [
        ("2023-02-28", "2023-03-01"),
        ("1/2/2022", "28/02/2022"),
        ("2021-12-31", "2021-12-30"),
        ("demain", "2020-01-01"),
        ("2020-02-29", "plus tard"),
        ("2019-07-07", "2019-07-07"),
    ]
    pair = date_pair(parse_date(F.col("p")), parse_date(F.col("e")))
    got = evaluate(spark, cases, pair, "p string, e string")
    d = dt.date
    assert [tuple(g) for g in got] == [
        (d(2023, 2, 28), d(2023, 3, 1), True),
        (d(2022, 2, 1), d(2022, 2, 28), True),
        (d(2021, 12, 31), d(2021, 12, 30), False),
        (None, None, False),
        (d(2020, 2, 29), None, True),
        (d(2019, 7, 7), d(2019, 7, 7), True),
    ]


def test_rounding(spark):
    cases = [1.005, 2.5, -2.5, 12.345, 0.125]
    assert evaluate(spark, cases, round_to(F.col("x"), 0), "x double") == [1, 3, -3, 12, 0]
    assert evaluate(spark, cases, round_to(F.col("x"), 2), "x double") == [
        1.0, 2.5, -2.5, 12.35, 0.13,
    ]


def test_share_guards_zero(spark):
    got = evaluate(spark, [(1, 4), (1, 0), (1, None)], share_pct(F.col("a"), F.col("b"), 1),
                   "a int, b int")
    assert got == [25.0, None, None]


def test_pearson_zero_variance_is_null(spark):
    df = spark.createDataFrame(
        [("a", 1, 5.0), ("a", 1, 7.0), ("b", 1, 2.0), ("b", 2, 4.0), ("b", None, 9.0)],
        "k string, x int, y double",
    )
    got = {r.k: r.r for r in df.groupBy("k").agg(pearson(F.col("x"), F.col("y")).alias("r"))
           .collect()}
    assert got["a"] is None and got["b"] == pytest.approx(1.0)


def test_level_null_is_weakest(spark):
    got = evaluate(spark, [25000.0, 20000.0, 12000.0, None],
                   level(F.col("x"), D.COMPETITOR_LEVELS, D.COMPETITOR_WEAKEST), "x double")
    assert got == ["Compétiteur fort", "Compétiteur moyen", "Compétiteur faible",
                   "Compétiteur faible"]


def test_strip_matches_python(spark):
    values = ["  a b  ", "\t\nX\r", "　", "\x1cé\x1f"]
    assert evaluate(spark, values, strip(F.col("x"))) == [v.strip() for v in values]
    assert evaluate(spark, values, fold(F.col("x"))) == [v.lower().strip() for v in values]
