"""Messy ads made of the given tables: one ad per order, every field a function of the row."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adstrata.functions.text import in_small_methods
from workload import cases as K


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in a folder that all executors share.

    That is spark.checkpoint.dir, or else the session's warehouse; both are settings of the cluster.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _pick(values: list, index: Column) -> Column:
    """values[index mod length] as a literal array lookup."""
    options = F.array(*[F.lit(v).cast("string") for v in values])
    return F.get(options, F.pmod(index, F.lit(len(values))).cast("int"))


def messy_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-ad columns built from orders joined with customer.

    The rows are dealt anew, as a file of few row groups would leave all later text work to as few tasks.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice", "o_orderdate"
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).repartition(*orders.columns)
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    text = lambda x: x.cast("string")

    low = (F.floor(F.col("o_totalprice") / 10000) + 4) * 500
    high = low + F.pmod(c, F.lit(12)) * 500
    eur = lambda x: text(F.floor(x * 10 / 108))
    kilo = lambda x: text(F.floor(x / 1000))
    years = F.pmod(c, F.lit(9))
    fmt = F.pmod(k, F.lit(12))
    salary = (
        F.when(fmt == 0, F.concat(text(low), F.lit("-"), text(high), F.lit(" MAD")))
        .when(fmt == 1, F.concat(text(low), F.lit(" - "), text(high), F.lit(" DH")))
        .when(fmt == 2, F.concat(kilo(low), F.lit("K-"), kilo(high), F.lit("K MAD")))
        .when(fmt == 3, F.concat(kilo(low), F.lit("k-"), kilo(high), F.lit("k dh")))
        .when(fmt == 4, F.concat(eur(low), F.lit("-"), eur(high), F.lit(" EUR")))
        .when(fmt == 5, F.concat(text(low), F.lit(" MAD")))
        .when(fmt == 6, F.concat(text(high), F.lit("-"), text(low), F.lit(" MAD")))
        .when(fmt == 7, F.lit("Selon profil"))
        .when(fmt == 8, F.lit("A négocier"))
        .when(fmt == 9, F.lit(None))
        .when(
            fmt == 10,
            F.concat(kilo(low), F.lit("\u00a0"), F.lpad(text(low % 1000), 3, "0"), F.lit(" dhs")),
        )
        .otherwise(F.concat(text(low * 10), F.lit(" MAD")))
    )
    exp = F.pmod(k, F.lit(8))
    experience = (
        F.when(exp == 0, F.lit("Débutant accepté"))
        .when(exp == 1, F.concat(text(years), F.lit("-"), text(years + 2), F.lit(" ans")))
        .when(exp == 2, F.concat(text(years), F.lit(" à "), text(years + 2), F.lit(" ans")))
        .when(exp == 3, F.concat(F.lit("min "), text(years), F.lit(" ans")))
        .when(exp == 4, F.concat(F.lit("Senior ("), text(years), F.lit("+ ans)")))
        .when(exp == 5, F.lit("Expert confirmé"))
        .when(exp == 6, F.lit(None))
        .otherwise(F.concat(text(years + 10), F.lit(" ans")))
    )
    day = F.col("o_orderdate").cast("date")
    end = F.date_add(day, (F.pmod(c, F.lit(60)) - 5).cast("int"))
    pub = F.pmod(k, F.lit(6))
    published = (
        F.when(F.pmod(k, F.lit(103)) == 0, F.lit("bientôt"))
        .when(pub == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(pub == 1, F.date_format(day, "dd/MM/yyyy"))
        .when(pub == 2, F.date_format(day, "dd-MM-yyyy"))
        .when(pub == 3, F.date_format(day, "yyyy/MM/dd"))
        .when(pub == 4, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T08:00:00")))
        .otherwise(F.concat(F.lit("  "), F.date_format(day, "d/M/yyyy")))
    )
    expires = (
        F.when(F.pmod(c, F.lit(3)) == 0, F.date_format(end, "yyyy-MM-dd"))
        .when(F.pmod(c, F.lit(3)) == 1, F.date_format(end, "dd/MM/yyyy"))
        .otherwise(F.lit("n/a"))
    )
    n = len(K.SKILLS_WRITTEN)
    skill = lambda i: _pick(K.SKILLS_WRITTEN, i)
    sep = _pick(K.SEPARATORS, k + c)
    listed = F.concat(skill(k), sep, skill(k * 3 + c), sep, skill(c))
    first, second = skill(k + 2 * c), skill(k * 5 + n - 1)
    head, middle, rest = K.SENTENCE.replace("{1}", "{0}").split("{0}", 2)
    before_second, tail = rest.split("{0}")
    description = F.concat(
        F.lit(head), first, F.lit(middle), first, F.lit(before_second), second, F.lit(tail)
    )
    return rows.select(
        # All of it in one method would be too long to be compiled.
        in_small_methods(F.concat(F.lit("AD-"), text(k))).alias("id_offre"),
        F.when(F.pmod(k, F.lit(101)) != 0, F.col("o_orderpriority")).alias("source"),
        _pick([t[0] for t in K.TITLES], k * 7 + c).alias("titre_poste"),
        description.alias("description"),
        listed.alias("competences_brut"),
        F.when(F.pmod(c, F.lit(13)) != 0, F.col("c_name")).otherwise("").alias("entreprise"),
        _pick([v[0] for v in K.CITIES], k + c * 5).alias("ville"),
        _pick([t[0] for t in K.CONTRACTS], k + c).alias("type_contrat"),
        experience.alias("experience_requise"),
        salary.alias("salaire_brut"),
        F.when(F.pmod(k, F.lit(7)) != 0, F.lit("Bac+5")).alias("niveau_etudes"),
        F.col("c_mktsegment").alias("secteur"),
        published.alias("date_publication"),
        expires.alias("date_expiration"),
        (F.pmod(k, F.lit(3)) + 1).cast("int").alias("nb_postes"),
        _pick(K.REMOTE, k + c).alias("teletravail"),
        F.array(F.lit("Français"), F.lit("Anglais")).alias("langue_requise"),
    )


_stored: dict[tuple[str, str, str], str] = {}


def stored(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[SparkSession, str], DataFrame]
) -> DataFrame:
    """A derived table written once per application and read back, as between job steps."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path = scratch(spark, name)
        build(spark, sf_dir).write.parquet(path)
        _stored[key] = path
    return spark.read.parquet(_stored[key])
