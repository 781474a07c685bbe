"""SQL twins of the queries, written from the tables' own numbers.

The ads' expected values come from the keys and amounts the messy text was made of, never from
parsing that text, so the SQL shares no logic with the operators it checks.
"""

from __future__ import annotations

import re

from workload import cases as K
from workload import relations


def q(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def sql_list(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def pick(values, index: str) -> str:
    values = list(values)
    return f"({sql_list(values)})[1 + ({index}) % {len(values)}]"


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts)


# --- Messy ads and their expected clean form ----------------------------------------------

_head, _middle, _rest = K.SENTENCE.replace("{1}", "{0}").split("{0}", 2)
_before, _tail = _rest.split("{0}")
_n = len(K.SKILLS_WRITTEN)


def _skill(index: str) -> str:
    return pick(K.SKILLS_WRITTEN, index)


BASE = f"""
base AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderpriority, c_name, c_mktsegment,
         CAST(o_orderdate AS DATE) AS d,
         (CAST(floor(o_totalprice / 10000) AS BIGINT) + 4) * 500 AS lo,
         (CAST(floor(o_totalprice / 10000) AS BIGINT) + 4) * 500 + (o_custkey % 12) * 500 AS hi,
         o_custkey % 9 AS y
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

RAW = f"""
raw AS (
  SELECT *,
    'AD-' || k AS id_offre,
    CASE WHEN k % 101 <> 0 THEN o_orderpriority END AS source,
    {pick([t[0] for t in K.TITLES], 'k * 7 + c')} AS titre_poste_original,
    {pick([t[1] for t in K.TITLES], 'k * 7 + c')} AS profil_normalise,
    {pick([v[0] for v in K.CITIES], 'k + c * 5')} AS ville_originale,
    {pick([v[1] for v in K.CITIES], 'k + c * 5')} AS ville,
    {pick([v[2] for v in K.CITIES], 'k + c * 5')} AS region,
    {pick([t[0] for t in K.CONTRACTS], 'k + c')} AS contrat_original,
    {pick([t[1] for t in K.CONTRACTS], 'k + c')} AS type_contrat,
    CASE k % 12
      WHEN 0 THEN lo || '-' || hi || ' MAD'
      WHEN 1 THEN lo || ' - ' || hi || ' DH'
      WHEN 2 THEN (lo // 1000) || 'K-' || (hi // 1000) || 'K MAD'
      WHEN 3 THEN (lo // 1000) || 'k-' || (hi // 1000) || 'k dh'
      WHEN 4 THEN (lo * 10 // 108) || '-' || (hi * 10 // 108) || ' EUR'
      WHEN 5 THEN lo || ' MAD'
      WHEN 6 THEN hi || '-' || lo || ' MAD'
      WHEN 7 THEN 'Selon profil'
      WHEN 8 THEN 'A négocier'
      WHEN 9 THEN NULL
      WHEN 10 THEN (lo // 1000) || chr(160) || lpad(CAST(lo % 1000 AS VARCHAR), 3, '0') || ' dhs'
      ELSE (lo * 10) || ' MAD'
    END AS salaire_brut_original,
    CASE k % 12
      WHEN 2 THEN lo // 1000 * 1000 WHEN 3 THEN lo // 1000 * 1000
      WHEN 4 THEN CAST(round_even(CAST(lo * 10 // 108 AS DOUBLE)
                                  * CAST(10.8 AS DOUBLE) / 500, 0) AS BIGINT) * 500
      WHEN 7 THEN NULL WHEN 8 THEN NULL WHEN 9 THEN NULL
      WHEN 11 THEN lo * 10
      ELSE lo
    END AS smin,
    CASE k % 12
      WHEN 2 THEN hi // 1000 * 1000 WHEN 3 THEN hi // 1000 * 1000
      WHEN 4 THEN CAST(round_even(CAST(hi * 10 // 108 AS DOUBLE)
                                  * CAST(10.8 AS DOUBLE) / 500, 0) AS BIGINT) * 500
      WHEN 7 THEN NULL WHEN 8 THEN NULL WHEN 9 THEN NULL
      WHEN 5 THEN lo WHEN 10 THEN lo WHEN 11 THEN lo * 10
      ELSE hi
    END AS smax,
    CASE k % 12
      WHEN 4 THEN 'EUR→MAD' WHEN 7 THEN 'Confidentiel' WHEN 8 THEN 'Non parseable'
      WHEN 9 THEN 'Non renseigné' ELSE 'MAD'
    END AS salaire_devise,
    (k % 12 = 6 AND hi > lo) AS inverti,
    CASE k % 8
      WHEN 0 THEN 'Débutant accepté'
      WHEN 1 THEN y || '-' || (y + 2) || ' ans'
      WHEN 2 THEN y || ' à ' || (y + 2) || ' ans'
      WHEN 3 THEN 'min ' || y || ' ans'
      WHEN 4 THEN 'Senior (' || y || '+ ans)'
      WHEN 5 THEN 'Expert confirmé'
      WHEN 6 THEN NULL
      ELSE (y + 10) || ' ans'
    END AS experience_originale,
    CASE
      WHEN k % 8 IN (5, 6) THEN NULL
      WHEN k % 8 = 0 THEN 0
      WHEN k % 8 IN (1, 2) AND y + 2 = 10 THEN 0
      WHEN k % 8 = 7 AND y = 0 THEN 0
      WHEN k % 8 = 7 THEN y + 10
      ELSE y
    END AS emin,
    CASE
      WHEN k % 8 IN (4, 5, 6) THEN NULL
      WHEN k % 8 = 0 THEN 1
      WHEN k % 8 IN (1, 2) THEN CASE WHEN y + 2 = 10 THEN 1 ELSE y + 2 END
      WHEN k % 8 = 3 THEN CASE WHEN y = 0 THEN 1 END
      ELSE CASE WHEN y = 0 THEN 1 END
    END AS emax,
    CASE WHEN k % 103 <> 0 AND k % 6 <> 4 THEN d END AS pub,
    CASE WHEN k % 103 <> 0 AND k % 6 <> 4 AND c % 3 <> 2
         THEN d + CAST(c % 60 - 5 AS INTEGER) END AS fin,
    CASE WHEN k % 103 = 0 THEN 'date_inconnue' ELSE strftime(d, '%Y_%m') END AS mois_part,
    lower(replace(coalesce(CASE WHEN k % 101 <> 0 THEN o_orderpriority END, 'inconnu'), ' ', '_'))
      AS source_part,
    CASE WHEN c % 13 <> 0 THEN c_name ELSE '' END AS entreprise,
    {pick(K.REMOTE, 'k + c')} AS teletravail,
    {q(_head)} || {_skill('k + 2 * c')} || {q(_middle)} || {_skill('k + 2 * c')}
      || {q(_before)} || {_skill(f'k * 5 + {_n - 1}')} || {q(_tail)} AS description,
    {_skill('k')} || {pick(K.SEPARATORS, 'k + c')} || {_skill('k * 3 + c')}
      || {pick(K.SEPARATORS, 'k + c')} || {_skill('c')} AS competences_brut
  FROM base
)"""

CLEAN = """
clean AS MATERIALIZED (
  SELECT *,
    CAST(smin AS INTEGER) AS salaire_min_mad,
    CAST(smax AS INTEGER) AS salaire_max_mad,
    CAST(round_even((smin + smax) / 2, 0) AS INTEGER) AS salaire_median_mad,
    smin IS NOT NULL AS salaire_connu,
    CAST(emin AS INTEGER) AS experience_min_ans,
    CAST(emax AS INTEGER) AS experience_max_ans,
    (pub IS NOT NULL AND coalesce(pub <= fin, TRUE)) AS dates_valides,
    CAST(month(pub) AS INTEGER) AS mois_publication,
    CAST(year(pub) AS INTEGER) AS annee_publication,
    [x FOR x IN [
      CASE WHEN profil_normalise = 'Non classifié' THEN 'titre_non_classifie' END,
      CASE WHEN ville IN ('Autre', 'Inconnu') THEN 'ville_non_reconnue' END,
      CASE WHEN type_contrat IN ('Autre', 'Non précisé') THEN 'contrat_non_reconnu' END,
      CASE WHEN inverti THEN 'salaire_inverti' END,
      CASE WHEN smin < 1500 OR smin > 100000 THEN 'salaire_hors_plage' END,
      CASE WHEN salaire_devise = 'Non parseable' THEN 'salaire_non_parseable' END,
      CASE WHEN emin IS NULL THEN 'experience_non_parseable' END,
      CASE WHEN NOT (pub IS NOT NULL AND coalesce(pub <= fin, TRUE)) THEN 'dates_incoherentes' END
    ] IF x IS NOT NULL] AS liste
  FROM raw
)"""

ADS = (BASE, RAW, CLEAN)


# --- Term extraction ----------------------------------------------------------------------

_WORD = r"\p{L}\p{N}_"
_ASCII = "a-zA-Z0-9"


def _entries(families) -> list[tuple[int, str, str, str]]:
    """(prio, skill, family, alias) in search order."""
    entries = [
        (skill, family, alias.strip().lower())
        for family, skills in families.items()
        for skill, aliases in skills.items()
        for alias in aliases
        if alias.strip()
    ]
    entries.sort(key=lambda e: -len(e[2]))
    return [(prio, *entry) for prio, entry in enumerate(entries)]


def terms(source: str, row: str, listed: str, text: str, carry: str, families) -> tuple[str, ...]:
    """CTEs ending in ``terms``: one row per (row, skill) with its winning alias.

    Every word of the text is put between two marks, so an alias with word edges occurs exactly
    where its bracketed form is a substring and plain replacement counts it. The few aliases
    with punctuation at an edge are counted by one constant pattern each, over text in which the
    characters that may delimit them are doubled (so that two hits never share one).
    """
    entries = _entries(families)
    loose = [e for e in entries if re.search(r"^[^\w\s]|[^\w\s]$", e[3])]
    plain = [e for e in entries if e not in loose]

    def bracketed(alias: str) -> str:
        return re.sub(r"\w+", lambda m: "\x01" + m.group() + "\x02", alias)

    values = ", ".join(
        f"({prio}, {q(skill)}, {q(family)}, {q(alias)}, {q(bracketed(alias))})"
        for prio, skill, family, alias in plain
    )

    def count(field: str) -> str:
        return f"(length({field}) - length(replace({field}, form, ''))) // length(form)"

    branches = [
        f"""SELECT texts.* EXCLUDE (a, b, aw, bw), prio, skill, famille, alias,
    {count('aw')} AS na, {count('bw')} AS nb
  FROM texts JOIN (VALUES {values}) AS t(prio, skill, famille, alias, form)
    ON contains(aw, form) OR contains(bw, form)"""
    ]
    for prio, skill, family, alias in loose:
        literal = "".join(
            re.escape(ch) if re.match("[a-z0-9]", ch) else re.escape(ch) * 2 for ch in alias
        )
        pattern = q(f"(?:^|[^{_ASCII}]){literal}(?:$|[^{_ASCII}])")

        def hits(field: str, pattern: str = pattern) -> str:
            double = f"regexp_replace({field}, '([^{_ASCII}])', '\\1\\1', 'g')"
            return f"len(regexp_extract_all({double}, {pattern}))"

        branches.append(
            f"""SELECT texts.* EXCLUDE (a, b, aw, bw), {prio}, {q(skill)}, {q(family)}, {q(alias)},
    {hits('a')}, {hits('b')}
  FROM texts WHERE contains(a, {q(alias)}) OR contains(b, {q(alias)})"""
        )
    wrap = f"'([{_WORD}]+)', chr(1) || '\\1' || chr(2), 'g'"
    return (
        f"""
lowered AS (
  SELECT {row} AS row_id, {carry}, lower(coalesce({listed}, '')) AS a,
         lower(coalesce({text}, '')) AS b
  FROM {source}
)""",
        f"""
texts AS MATERIALIZED (
  SELECT *, regexp_replace(a, {wrap}) AS aw, regexp_replace(b, {wrap}) AS bw FROM lowered
)""",
        "hits AS (\n  " + "\n  UNION ALL\n  ".join(branches) + "\n)",
        """
terms AS MATERIALIZED (
  SELECT * EXCLUDE (skill, alias, na, nb, prio),
    skill AS skill_normalise, alias AS alias_trouve,
    CASE WHEN na > 0 AND nb > 0 THEN 'both' WHEN na > 0 THEN 'competences_brut'
         ELSE 'description' END AS source,
    CAST(nb AS INTEGER) AS nb_mentions_desc
  FROM hits WHERE na > 0 OR nb > 0
  QUALIFY row_number() OVER (PARTITION BY row_id, skill ORDER BY prio) = 1
)""",
    )


AD_TERMS = terms(
    "clean",
    "k",
    "competences_brut",
    "description",
    "id_offre, profil_normalise, ville, type_contrat, annee_publication, mois_publication, "
    "source AS source_offre",
    K.AD_TERMS,
)
DOC_TERMS = terms(
    "documents", "doc_id", "split_part(text, chr(10), 1)", "text", "lang, documents.source AS src",
    K.TEXT_TERMS,
)
CONV_TERMS = terms(
    "conversations", "conv_id || '/' || turn", "role", "text", "role", K.TEXT_TERMS
)


# --- Gold marts ---------------------------------------------------------------------------


def top_terms(profile: str = "profil_normalise", ads: str = "clean", ad_id: str = "id_offre") -> str:
    return f"""
per_group AS (
  SELECT {profile} AS profil, famille, skill_normalise AS competence,
         count(DISTINCT {ad_id}) AS nb_offres_mentionnent
  FROM terms WHERE {profile} <> 'Non classifié' AND {profile} IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT 'tous', famille, skill_normalise, count(DISTINCT {ad_id}) FROM terms GROUP BY ALL
),
top_competences AS (
  SELECT *,
    round(nb_offres_mentionnent * 100.0
          / (SELECT count(DISTINCT {ad_id}) FROM {ads}), 2) AS pct_offres_total,
    CAST(dense_rank() OVER (PARTITION BY profil ORDER BY nb_offres_mentionnent DESC) AS INTEGER)
      AS rang_dans_profil
  FROM per_group
)"""


VOLUME = """
offres_par_ville AS (
  SELECT ville, profil_normalise AS profil, count(*) AS nb_offres,
    count(*) FILTER (WHERE teletravail IN ('Hybride', 'Télétravail complet')) AS nb_offres_remote,
    round(count(*) FILTER (WHERE teletravail IN ('Hybride', 'Télétravail complet')) * 100.0
          / nullif(count(*), 0), 1) AS pct_remote
  FROM clean
  WHERE ville NOT IN ('Autre', 'Inconnu') AND profil_normalise <> 'Non classifié'
  GROUP BY ALL
)"""

SALARIES = """
salaires_par_profil AS (
  SELECT profil_normalise AS profil, ville, count(*) AS nb_offres,
    count(*) FILTER (WHERE salaire_connu) AS nb_offres_avec_salaire,
    round(count(*) FILTER (WHERE salaire_connu) * 100.0 / nullif(count(*), 0), 1)
      AS pct_salaire_communique,
    round(median(salaire_median_mad) FILTER (WHERE salaire_connu), 0) AS salaire_median_mad,
    round(quantile_cont(salaire_median_mad, 0.25) FILTER (WHERE salaire_connu), 0)
      AS salaire_q1_mad,
    round(quantile_cont(salaire_median_mad, 0.75) FILTER (WHERE salaire_connu), 0)
      AS salaire_q3_mad,
    CAST(min(salaire_min_mad) FILTER (WHERE salaire_connu) AS DOUBLE) AS salaire_min_observe,
    CAST(max(salaire_max_mad) FILTER (WHERE salaire_connu) AS DOUBLE) AS salaire_max_observe
  FROM clean
  WHERE ville NOT IN ('Autre', 'Inconnu') AND profil_normalise <> 'Non classifié'
  GROUP BY ALL HAVING count(*) >= 3
)"""

RECRUITERS = """
entreprises_recruteurs AS (
  SELECT entreprise, ville, count(*) AS nb_offres_publiees,
    count(DISTINCT profil_normalise) FILTER (WHERE profil_normalise <> 'Non classifié')
      AS nb_profils_differents,
    round(avg(salaire_median_mad) FILTER (WHERE salaire_connu), 0) AS salaire_moyen_propose,
    coalesce(list(DISTINCT profil_normalise ORDER BY profil_normalise)
             FILTER (WHERE profil_normalise <> 'Non classifié'), []) AS profils_recrutes
  FROM clean
  WHERE entreprise IS NOT NULL AND entreprise <> '' AND ville <> 'Autre'
  GROUP BY ALL
)"""

TRENDS = """
tendances_mensuelles AS (
  SELECT annee_publication AS annee, mois_publication AS mois, profil_normalise AS profil,
    count(*) AS nb_offres, count(*) FILTER (WHERE salaire_connu) AS nb_avec_salaire,
    round(avg(salaire_median_mad) FILTER (WHERE salaire_connu), 0) AS salaire_moyen_mois
  FROM clean
  WHERE annee_publication IS NOT NULL AND profil_normalise <> 'Non classifié'
  GROUP BY ALL
)"""


def with_ads(*parts: str, select: str) -> str:
    return ctes(*ADS, *parts) + "\n" + select


def with_ad_terms(*parts: str, select: str) -> str:
    return ctes(*ADS, *AD_TERMS, *parts) + "\n" + select


_CLEAN_COLUMNS = """
  id_offre, source, titre_poste_original, profil_normalise, ville_originale, ville, region,
  contrat_original, type_contrat, salaire_brut_original, salaire_min_mad, salaire_max_mad,
  salaire_devise, salaire_median_mad, salaire_connu, experience_originale, experience_min_ans,
  experience_max_ans, strftime(pub, '%Y-%m-%d') AS date_publication,
  strftime(fin, '%Y-%m-%d') AS date_expiration, dates_valides, mois_publication,
  annee_publication, description, competences_brut, entreprise, c_mktsegment AS secteur,
  CASE WHEN k % 7 <> 0 THEN 'Bac+5' END AS niveau_etudes,
  CAST(k % 3 + 1 AS INTEGER) AS nb_postes, teletravail,
  '["Français", "Anglais"]' AS langue_requise, CAST(len(liste) AS INTEGER) AS nb_anomalies,
  array_to_string(liste, ', ') AS anomalies"""

_DATA = "('Data Engineer', 'Data Analyst', 'Data Scientist')"
_CORR = "('Data Engineer', 'Data Analyst', 'Data Scientist', 'DevOps / SRE')"
_BANDS = [
    ("0 — Débutant", "experience_min_ans = 0"),
    ("1-2 ans", "experience_min_ans BETWEEN 1 AND 2"),
    ("3-4 ans", "experience_min_ans BETWEEN 3 AND 4"),
    ("5-7 ans", "experience_min_ans BETWEEN 5 AND 7"),
    ("8+ ans Senior", "experience_min_ans >= 8"),
]


def _case(branches, rest: str) -> str:
    return "CASE " + " ".join(f"WHEN {w} THEN {t}" for w, t in branches) + f" ELSE {rest} END"


def _counts(key: str, limit: str = "") -> str:
    return f"""SELECT {key}, count(*) AS nb,
  count(*) * 100.0 / (SELECT count(*) FROM clean) AS pct
  FROM clean GROUP BY {key} {limit}"""


def _city_pivot(cities, value: str, agg: str, rows: str) -> str:
    cells = ", ".join(
        f"coalesce({agg}({value}) FILTER (WHERE ville = {q(c)}), 0) AS {q_ident(c)}"
        for c in cities
    )
    return f"SELECT profil, {cells} FROM offres_par_ville WHERE {rows} GROUP BY profil"


def q_ident(name: str) -> str:
    return '"' + name + '"'


def _safe_r(x: str, y: str, keep: str = "TRUE") -> str:
    r = f"corr({x}, {y}) FILTER (WHERE {keep} AND {x} IS NOT NULL AND {y} IS NOT NULL)"
    return f"round(CASE WHEN isnan({r}) THEN NULL ELSE {r} END, 3)"


def _strength(r: str) -> str:
    return (
        f"CASE WHEN {r} IS NULL THEN NULL WHEN abs({r}) > 0.6 THEN 'forte' "
        f"WHEN abs({r}) > 0.3 THEN 'modérée' ELSE 'faible' END"
    )


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}

    # Bronze
    o["bronze_partitions"] = with_ads(
        select="""SELECT source_part, mois_part, count(*) AS nb_offres,
  count(*) * 100.0 / (SELECT count(*) FROM raw) AS pct_total,
  count(*) FILTER (WHERE mois_part = 'date_inconnue') AS nb_dates_inconnues
FROM raw GROUP BY ALL"""
    )
    o["bronze_sources"] = with_ads(
        select="""SELECT source_part, count(*) AS nb_offres,
  count(*) FILTER (WHERE mois_part = 'date_inconnue') AS nb_dates_inconnues,
  count(*) * 100.0 / (SELECT count(*) FROM raw) AS pct_total
FROM raw GROUP BY ALL"""
    )
    o["bronze_largest"] = with_ads(
        select="""SELECT source_part, mois_part, count(*) AS nb_offres
FROM raw GROUP BY ALL ORDER BY nb_offres DESC, source_part, mois_part LIMIT 10"""
    )
    o["bronze_integrity"] = with_ads(
        select="""SELECT count(DISTINCT (source_part, mois_part)) AS partitions_found,
  count(*) AS total_offres,
  list(DISTINCT source_part ORDER BY source_part) AS sources_found,
  list(DISTINCT mois_part ORDER BY mois_part) AS mois_couverts,
  CAST(0 AS BIGINT) AS enregistrements_corrompus FROM raw"""
    )
    o["envelope_integrity"] = with_ads(
        select="""SELECT count(DISTINCT (source_part, mois_part)) FILTER (good) AS partitions_found,
  count(*) FILTER (good) AS total_offres,
  list(DISTINCT source_part ORDER BY source_part) FILTER (good) AS sources_found,
  list(DISTINCT mois_part ORDER BY mois_part) FILTER (good) AS mois_couverts,
  count(DISTINCT (source_part, mois_part)) FILTER (NOT good) AS fichiers_corrompus
FROM (SELECT *, NOT ends_with(mois_part, '_06') AS good FROM raw)"""
    )
    o["bronze_manifest"] = with_ads(
        select="""SELECT source_part, mois_part, source_part || '/' || mois_part AS partition,
  count(*) AS nb_offres, '1.0' AS schema_version FROM raw GROUP BY ALL"""
    )
    o["streamed_manifest"] = o["bronze_manifest"]
    o["bronze_pruned"] = with_ads(
        select="""SELECT id_offre, source_part, mois_part FROM raw
WHERE source_part IN ('1-urgent', '4-not_specified') AND mois_part BETWEEN '1996_01' AND '1996_12'"""
    )

    # Silver
    o["silver_ads"] = with_ads(select=f"SELECT {_CLEAN_COLUMNS} FROM clean")
    o["silver_from_bronze"] = o["silver_ads"]
    o["silver_quality"] = with_ads(
        select="""SELECT id_offre, profil_normalise AS profil, ville,
  CAST(len(liste) AS INTEGER) AS nb_anomalies, array_to_string(liste, ', ') AS anomalies,
  profil_normalise <> 'Non classifié' AS titre_mapped, dates_valides,
  salaire_devise IN ('MAD', 'EUR→MAD') AS salaire_parseable FROM clean"""
    )
    o["title_classes"] = with_ads(
        select="SELECT id_offre, titre_poste_original AS titre, profil_normalise AS profil,"
        " profil_normalise <> 'Non classifié' AS reconnu FROM raw"
    )
    o["city_names"] = with_ads(
        select="SELECT id_offre, ville_originale AS brut, ville, region FROM raw"
    )
    o["contract_types"] = with_ads(
        select="SELECT id_offre, contrat_original AS brut, type_contrat AS contrat FROM raw"
    )
    o["salary_texts"] = with_ads(
        select="""SELECT id_offre, salaire_min_mad AS smin, salaire_max_mad AS smax,
  salaire_devise AS devise, inverti, coalesce(smin < 1500 OR smin > 100000, FALSE) AS hors_plage,
  salaire_median_mad AS milieu FROM clean"""
    )
    o["experience_texts"] = with_ads(
        select="SELECT id_offre, experience_min_ans AS emin, experience_max_ans AS emax FROM clean"
    )
    o["experience_texts_strict"] = with_ads(
        select="""SELECT id_offre,
  CAST(CASE WHEN k % 8 IN (1, 2, 3, 4) THEN y WHEN k % 8 = 7 THEN y + 10
            WHEN k % 8 = 0 THEN 0 END AS INTEGER) AS emin,
  CAST(CASE WHEN k % 8 IN (1, 2) THEN y + 2 WHEN k % 8 = 0 THEN 1
            WHEN k % 8 = 3 AND y = 0 THEN 1 END AS INTEGER) AS emax FROM clean"""
    )
    o["date_pairs"] = with_ads(
        select="""SELECT id_offre, strftime(pub, '%Y-%m-%d') AS publication,
  strftime(fin, '%Y-%m-%d') AS expiration, dates_valides AS valide,
  CAST(month(pub) AS INTEGER) AS mois, CAST(year(pub) AS INTEGER) AS annee FROM clean"""
    )
    o["shipping_dates"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  strftime(l_shipdate, '%Y-%m-%d') AS expedition, l_shipdate >= o_orderdate AS valide
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
    o["quality_profiles"] = with_ads(select=_counts("profil_normalise"))
    o["quality_cities"] = with_ads(select=_counts("ville", "ORDER BY nb DESC, ville LIMIT 5"))
    o["quality_contracts"] = with_ads(select=_counts("type_contrat"))
    o["quality_summary"] = with_ads(
        select="""SELECT count(*) AS total, count(smin) AS nb_salaire_connu,
  count(*) FILTER (WHERE len(liste) = 0) AS nb_sans_anomalie,
  count(*) FILTER (WHERE len(liste) = 1) AS nb_une_anomalie,
  count(*) FILTER (WHERE len(liste) >= 2) AS nb_plusieurs_anomalies,
  count(smin) * 100.0 / count(*) AS pct_salaire_connu,
  count(*) FILTER (WHERE len(liste) = 0) * 100.0 / count(*) AS pct_sans_anomalie FROM clean"""
    )
    o["quality_anomalies"] = with_ads(
        select="""SELECT anomalie, count(*) AS nb FROM (SELECT unnest(liste) AS anomalie FROM clean)
GROUP BY anomalie ORDER BY nb DESC, anomalie LIMIT 5"""
    )

    # Terms
    o["ad_terms"] = with_ad_terms(
        select="""SELECT id_offre, skill_normalise, famille, alias_trouve, source,
  nb_mentions_desc, profil_normalise, ville, type_contrat, annee_publication, mois_publication,
  source_offre FROM terms"""
    )
    o["document_terms"] = ctes(*DOC_TERMS) + """
SELECT row_id AS id_offre, skill_normalise, famille, alias_trouve, source, nb_mentions_desc, lang
FROM terms"""
    o["document_terms_large"] = o["document_terms_from_file"] = o["document_terms"]
    o["conversation_terms"] = ctes(*CONV_TERMS) + """
SELECT row_id AS id_offre, skill_normalise, famille, alias_trouve, source, nb_mentions_desc, role
FROM terms"""
    o["term_coverage"] = with_ad_terms(
        select="""SELECT *, nb_offres - nb_offres_avec AS nb_offres_sans,
  nb_correspondances / nb_offres AS moyenne_par_offre,
  nb_correspondances / nb_offres_avec AS moyenne_par_offre_avec
FROM (SELECT count(*) AS nb_correspondances,
        count(DISTINCT skill_normalise) AS nb_competences,
        (SELECT count(*) FROM clean) AS nb_offres,
        count(DISTINCT id_offre) AS nb_offres_avec FROM terms)"""
    )
    whole = "(SELECT count(DISTINCT id_offre) FROM terms)"
    o["term_top"] = with_ad_terms(
        select=f"""SELECT skill_normalise, count(DISTINCT id_offre) AS nb_offres,
  count(DISTINCT id_offre) * 100.0 / {whole} AS pct_offres FROM terms GROUP BY ALL
ORDER BY nb_offres DESC, skill_normalise LIMIT 15"""
    )
    o["term_families"] = with_ad_terms(
        select=f"""SELECT famille, count(DISTINCT id_offre) AS nb_offres,
  count(DISTINCT id_offre) * 100.0 / {whole} AS pct_offres FROM terms GROUP BY ALL"""
    )
    o["term_sources"] = with_ad_terms(
        select="""SELECT source, count(*) AS nb,
  count(*) * 100.0 / (SELECT count(*) FROM terms) AS pct FROM terms GROUP BY source"""
    )
    o["term_top_profile"] = with_ad_terms(
        select="""SELECT skill_normalise, count(DISTINCT id_offre) AS nb_offres FROM terms
WHERE profil_normalise = 'Data Engineer' GROUP BY ALL
ORDER BY nb_offres DESC, skill_normalise LIMIT 8"""
    )

    # Gold
    top = top_terms()
    o["gold_top_terms"] = with_ad_terms(top, select="SELECT * FROM top_competences")
    o["gold_volume_by_city"] = with_ads(VOLUME, select="SELECT * FROM offres_par_ville")
    o["job_run"], o["job_run_terms"], o["job_ads"] = (
        o["gold_volume_by_city"], o["gold_top_terms"], o["silver_ads"]
    )
    o["missing_keys"] = with_ads(select="""
SELECT id_offre,
  CASE WHEN k % 2 = 0 THEN titre_poste_original ELSE '' END AS titre_poste,
  CASE WHEN k % 2 = 0 THEN 1 ELSE CAST(k % 3 + 1 AS INTEGER) END AS nb_postes,
  CASE WHEN k % 2 <> 0 THEN '' WHEN k % 7 <> 0 THEN 'Bac+5' END AS niveau_etudes,
  CAST([] AS VARCHAR[]) AS langue_requise
FROM clean""")
    o["language_lists"] = """
SELECT c_custkey, '[' || coalesce(array_to_string(list_transform(l,
    lambda x: coalesce(CAST(to_json(x) AS VARCHAR), 'null')), ', '), '') || ']' AS langue_requise
FROM (
  SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN CAST([] AS VARCHAR[]) WHEN c_custkey % 11 = 0 THEN NULL
    ELSE ['l"' || lower(c_mktsegment), CASE WHEN c_custkey % 3 <> 0 THEN c_name END, 'a, b\\'] END AS l
  FROM customer)"""
    o["labelled_languages"] = """
SELECT lang, count(*) AS n_labelled, CAST(sum(quality) AS BIGINT) AS n_good
FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND toxic IS NOT NULL GROUP BY lang"""
    o["job_rejects"] = """
SELECT 'broken' AS raw, true AS rejected, count(*) AS n_taken
FROM orders JOIN customer ON o_custkey = c_custkey"""
    o["sql_over_views"] = with_ad_terms(select="""
SELECT a.ville, count(*) AS n_terms FROM clean a JOIN terms t ON a.id_offre = t.id_offre
GROUP BY a.ville""")
    o["gold_salary_by_profile"] = with_ads(SALARIES, select="SELECT * FROM salaires_par_profil")
    o["gold_recruiters"] = with_ads(RECRUITERS, select="SELECT * FROM entreprises_recruteurs")
    o["gold_monthly_trends"] = with_ads(TRENDS, select="SELECT * FROM tendances_mensuelles")
    o["summary_terms"] = with_ad_terms(
        top,
        select="""SELECT competence, famille, nb_offres_mentionnent, pct_offres_total
FROM top_competences WHERE profil = 'tous'
ORDER BY nb_offres_mentionnent DESC, famille, competence LIMIT 10""",
    )
    o["summary_salaries"] = with_ads(
        SALARIES,
        select="""SELECT profil, nb_offres, nb_offres_avec_salaire, salaire_median_mad,
  salaire_q1_mad, salaire_q3_mad FROM salaires_par_profil WHERE ville = 'Tanger'
ORDER BY salaire_median_mad DESC NULLS LAST, profil LIMIT 8""",
    )
    o["summary_cities"] = with_ads(
        VOLUME,
        select="""SELECT ville, nb_offres, nb_offres_remote, pct_remote FROM offres_par_ville
WHERE profil = 'Data Engineer' ORDER BY nb_offres DESC, ville LIMIT 5""",
    )
    o["summary_recruiters"] = with_ads(
        RECRUITERS,
        select="""SELECT entreprise, ville, nb_offres_publiees, salaire_moyen_propose
FROM entreprises_recruteurs ORDER BY nb_offres_publiees DESC, entreprise, ville LIMIT 10""",
    )

    # Questions
    o["top_terms_overall"] = with_ad_terms(
        top,
        select="""SELECT famille, competence, nb_offres_mentionnent, pct_offres_total,
  rang_dans_profil FROM top_competences WHERE profil = 'tous'
ORDER BY nb_offres_mentionnent DESC, famille, competence LIMIT 20""",
    )
    o["leading_terms"] = with_ad_terms(
        top,
        select=f"""SELECT profil, famille, competence, nb_offres_mentionnent, rang_dans_profil
FROM top_competences WHERE profil IN {_DATA} AND rang_dans_profil <= 5""",
    )
    o["leading_terms_pivot"] = with_ad_terms(
        top,
        select="SELECT rang_dans_profil, "
        + ", ".join(
            f"avg(nb_offres_mentionnent) FILTER (WHERE profil = {q(p)}) AS {q_ident(p)}"
            for p in ("Data Engineer", "Data Analyst", "Data Scientist")
        )
        + f" FROM top_competences WHERE profil IN {_DATA} AND rang_dans_profil <= 5 GROUP BY ALL",
    )
    compared = ["Casablanca", "Rabat", "Tanger", "Marrakech", "Fès"]
    in_compared = "(" + ", ".join(q(c) for c in compared) + ")"
    o["city_rank"] = with_ads(
        VOLUME,
        select=f"""SELECT ville, profil, nb_offres, nb_offres_remote, pct_remote,
  CAST(rank() OVER (PARTITION BY profil ORDER BY nb_offres DESC) AS INTEGER) AS rang_ville
FROM offres_par_ville WHERE ville IN {in_compared}""",
    )
    o["city_against_base"] = with_ads(
        VOLUME,
        select="""SELECT t.profil, t.nb_offres, t.pct_remote,
  round(t.nb_offres * 100.0 / nullif(c.nb_offres, 0), 1) AS pct_vs_casa
FROM offres_par_ville t
LEFT JOIN offres_par_ville c ON t.profil = c.profil AND c.ville = 'Casablanca'
WHERE t.ville = 'Tanger'""",
    )
    o["city_volume_pivot"] = with_ads(
        VOLUME,
        select=_city_pivot(compared, "nb_offres", "sum", f"profil IN {_DATA} AND ville IN {in_compared}")
        .replace("coalesce(sum", "CAST(coalesce(sum").replace(", 0) AS", ", 0) AS BIGINT) AS"),
    )
    o["city_remote_pivot"] = with_ads(
        VOLUME,
        select=_city_pivot(
            compared[:3], "pct_remote", "avg", "ville IN ('Casablanca', 'Rabat', 'Tanger')"
        ),
    )
    coordinates = ", ".join(
        f"({q(city)}, CAST({lat} AS DOUBLE), CAST({lon} AS DOUBLE))"
        for city, (lat, lon) in _COORDINATES.items()
    )
    o["city_map"] = with_ads(
        VOLUME,
        select=f"""SELECT ville, CAST(sum(nb_offres) AS BIGINT) AS total_offres, lat, lon
FROM offres_par_ville JOIN (VALUES {coordinates}) AS p(ville, lat, lon) USING (ville)
GROUP BY ville, lat, lon""",
    )
    o["salary_rollup"] = with_ads(
        SALARIES,
        select="""SELECT profil, CAST(sum(nb_offres) AS BIGINT) AS nb_offres_total,
  CAST(sum(nb_offres_avec_salaire) AS BIGINT) AS nb_avec_salaire,
  round(sum(nb_offres_avec_salaire) * 100.0 / nullif(sum(nb_offres), 0), 1)
    AS pct_salaire_communique,
  round(median(salaire_median_mad), 0) AS salaire_median_mad,
  min(salaire_min_observe) AS salaire_plancher, max(salaire_max_observe) AS salaire_plafond
FROM salaires_par_profil GROUP BY profil""",
    )
    o["salary_gap"] = with_ads(
        SALARIES,
        select="""SELECT t.profil, t.nb_offres, t.salaire_median_mad, t.salaire_q1_mad,
  t.salaire_q3_mad, round(t.salaire_median_mad - n.m, 0) AS ecart_mediane_nationale
FROM salaires_par_profil t
JOIN (SELECT profil, round(median(salaire_median_mad), 0) AS m
      FROM salaires_par_profil GROUP BY profil) n ON t.profil = n.profil
WHERE t.ville = 'Tanger' AND t.nb_offres >= 5""",
    )
    band = _case([(w, q(label)) for label, w in _BANDS], q("Non précisé"))
    order = _case([(w, str(i)) for i, (_, w) in enumerate(_BANDS)], "5")
    o["salary_by_experience"] = with_ads(
        select=f"""SELECT profil_normalise AS profil, {band} AS tranche_experience,
  CAST({order} AS INTEGER) AS ordre, count(*) AS nb_offres,
  round(median(salaire_median_mad) FILTER (WHERE salaire_connu), 0) AS salaire_median
FROM clean WHERE profil_normalise IN {_CORR} GROUP BY ALL"""
    )
    r = _safe_r("experience_min_ans", "salaire_median_mad", "salaire_connu")
    o["experience_correlation"] = with_ads(
        select=f"""SELECT profil, correlation_pearson, {_strength('correlation_pearson')} AS force
FROM (SELECT profil_normalise AS profil, {r} AS correlation_pearson
      FROM clean WHERE profil_normalise IN {_CORR} GROUP BY ALL)"""
    )
    o["top_recruiters"] = with_ads(
        RECRUITERS,
        select="""SELECT entreprise, ville, nb_offres_publiees, nb_profils_differents,
  salaire_moyen_propose,
  CAST(rank() OVER (ORDER BY nb_offres_publiees DESC) AS INTEGER) AS rang_recruteur
FROM entreprises_recruteurs ORDER BY nb_offres_publiees DESC, entreprise, ville LIMIT 20""",
    )
    o["competitors"] = with_ads(
        RECRUITERS,
        select="""SELECT entreprise, nb_offres_publiees, profils_recrutes, salaire_moyen_propose,
  CASE WHEN salaire_moyen_propose > 20000 THEN 'Compétiteur fort'
       WHEN salaire_moyen_propose > 12000 THEN 'Compétiteur moyen'
       ELSE 'Compétiteur faible' END AS niveau_competition
FROM entreprises_recruteurs WHERE ville = 'Tanger'
ORDER BY nb_offres_publiees DESC, entreprise LIMIT 15""",
    )
    o["monthly_series"] = with_ads(
        TRENDS,
        select="""SELECT annee, mois, strftime(make_date(annee, mois, 1), '%Y-%m-%d') AS date_mois,
  profil, nb_offres FROM tendances_mensuelles
WHERE profil IN ('Data Engineer', 'Data Analyst', 'Développeur Full Stack', 'DevOps / SRE')""",
    )

    # The same operators on the tables as they are
    o["nation_regions"] = """
SELECT c_custkey, n_name AS nation, coalesce(r_name, 'Autre') AS region
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey"""
    o["segment_classes"] = """
SELECT p_partkey, CASE WHEN contains(lower(p_name), 'bolt') OR contains(lower(p_name), 'nut')
       THEN 'fixation' WHEN contains(lower(p_name), 'ring') OR contains(lower(p_name), 'red')
       THEN 'forme' ELSE 'Non classifié' END AS classe FROM part"""
    o["nation_volume"] = """
SELECT n_name AS ville, c_mktsegment AS profil, count(*) AS nb_offres,
  count(*) FILTER (WHERE c_acctbal > 0) AS nb_offres_remote,
  round(count(*) FILTER (WHERE c_acctbal > 0) * 100.0 / count(*), 1) AS pct_remote
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL"""
    o["price_quartiles"] = """
SELECT o_orderpriority AS profil, n_name AS ville, count(*) AS nb_offres,
  count(*) FILTER (WHERE o_orderstatus <> 'P') AS nb_offres_avec_salaire,
  round(count(*) FILTER (WHERE o_orderstatus <> 'P') * 100.0 / count(*), 1)
    AS pct_salaire_communique,
  round(median(o_totalprice) FILTER (WHERE o_orderstatus <> 'P'), 0) AS salaire_median_mad,
  round(quantile_cont(o_totalprice, 0.25) FILTER (WHERE o_orderstatus <> 'P'), 0)
    AS salaire_q1_mad,
  round(quantile_cont(o_totalprice, 0.75) FILTER (WHERE o_orderstatus <> 'P'), 0)
    AS salaire_q3_mad,
  round(min(o_totalprice) FILTER (WHERE o_orderstatus <> 'P'), 0) AS salaire_min_observe,
  round(max(o_totalprice) FILTER (WHERE o_orderstatus <> 'P'), 0) AS salaire_max_observe
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY ALL HAVING count(*) >= 3"""
    o["supplier_flags"] = """
SELECT CAST(l_suppkey AS VARCHAR) AS entreprise, l_returnflag AS ville,
  count(*) AS nb_offres_publiees, count(DISTINCT p_brand) AS nb_profils_differents,
  round(avg(CAST(l_quantity AS INTEGER)) FILTER (WHERE l_linestatus = 'F'), 0)
    AS salaire_moyen_propose,
  list(DISTINCT p_brand ORDER BY p_brand) AS profils_recrutes
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL"""
    o["order_trend"] = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS annee, CAST(month(o_orderdate) AS INTEGER) AS mois,
  o_orderstatus AS profil, count(*) AS nb_offres,
  count(*) FILTER (WHERE o_totalprice > 100000) AS nb_avec_salaire,
  round(avg(o_totalprice) FILTER (WHERE o_totalprice > 100000), 0) AS salaire_moyen_mois
FROM orders GROUP BY ALL"""
    o["price_bands"] = """
SELECT l_returnflag AS profil,
  CASE WHEN l_quantity <= 10 THEN 'petit' WHEN l_quantity <= 30 THEN 'moyen'
       ELSE 'grand' END AS tranche_experience,
  CAST(CASE WHEN l_quantity <= 10 THEN 0 WHEN l_quantity <= 30 THEN 1 ELSE 2 END AS INTEGER)
    AS ordre, count(*) AS nb_offres, round(median(l_extendedprice), 0) AS salaire_median
FROM lineitem GROUP BY ALL"""
    r = _safe_r("l_quantity", "l_extendedprice")
    o["quantity_correlation"] = f"""
SELECT profil, correlation_pearson, {_strength('correlation_pearson')} AS force
FROM (SELECT l_returnflag AS profil, {r} AS correlation_pearson FROM lineitem GROUP BY ALL)"""
    o["document_term_demand"] = (
        ctes(*DOC_TERMS, top_terms("lang", "documents", "row_id").replace(
            "(SELECT count(DISTINCT row_id) FROM documents)",
            "(SELECT count(DISTINCT doc_id) FROM documents)"))
        + "\nSELECT * FROM top_competences"
    )
    o["event_counts"] = """
SELECT event_type, count(*) AS nb, count(*) * 100.0 / (SELECT count(*) FROM events) AS pct
FROM events GROUP BY event_type"""
    return o | relations.oracle_sql()


_COORDINATES = {
    "Casablanca": (33.5731, -7.5898),
    "Rabat": (34.0209, -6.8416),
    "Tanger": (35.7595, -5.8340),
    "Marrakech": (31.6295, -7.9811),
    "Fès": (34.0181, -5.0078),
    "Agadir": (30.4278, -9.5981),
    "Meknès": (33.8935, -5.5473),
    "Oujda": (34.6867, -1.9114),
    "Kenitra": (34.2610, -6.5802),
    "Tétouan": (35.5785, -5.3684),
    "El Jadida": (33.2316, -8.5007),
    "Mohammedia": (33.6866, -7.3830),
    "Settat": (33.0016, -7.6194),
}
