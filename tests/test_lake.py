"""Bronze, Silver, Gold and the whole run on envelope files."""

import json

import pytest

from adstrata import schemas
from adstrata.plans import gold, job, quality, silver
from adstrata.sources import bronze, tables
from adstrata.sources.envelope import (
    read_companies,
    read_envelope_records,
    read_envelopes,
    read_lines,
    typed_ads,
)
from adstrata.sources.terms import read_dictionary

ADS = [
    {
        "id_offre": "A1", "source": "Site Un", "titre_poste": "Data Engineer",
        "description": "Python et apache spark.\nC++", "competences_brut": "SPARK / R",
        "entreprise": "Acme", "ville": "Tanja", "type_contrat": "cdi",
        "experience_requise": "3-5 ans", "salaire_brut": "20000-15000 MAD",
        "niveau_etudes": None, "secteur": "IT", "date_publication": "15/08/2024",
        "date_expiration": "2024-09-15", "nb_postes": 2, "teletravail": "Hybride",
        "langue_requise": ["Français", 'l"anglais'], "extra": {"kept": [1, 2]},
    },
    {"id_offre": "A2", "source": "linkedin", "titre_poste": "Astronaute", "ville": "Paris",
     "date_publication": "2024-08-15T10:00:00", "salaire_brut": None},
    {"titre_poste": "SRE", "salaire_brut": "A négocier", "experience_requise": "10 ans",
     "date_publication": "2024-01-02", "date_expiration": "2024-01-01", "ville": "Fes",
     "type_contrat": "CDD 6 mois"},
]
DICTIONARY = {
    "familles": {
        "langages": {"python": ["Python "], "r": ["r"], "cpp": ["c++"]},
        "data": {"spark": ["spark", "apache spark"], "none": [""]},
    }
}


@pytest.fixture()
def files(tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "ads.json").write_text(
        json.dumps({"offres": ADS}, ensure_ascii=False, indent=2), encoding="utf-8"
    )
    (tmp_path / "dict.json").write_text(json.dumps(DICTIONARY, indent=1), encoding="utf-8")
    return tmp_path


def test_records_are_untouched(spark, files):
    rows = read_envelope_records(spark, str(files / "in")).collect()
    assert [json.loads(r["raw"]) for r in rows] == ADS


def test_envelope_without_records_and_corrupt_file(spark, files):
    tree = files / "tree"
    for part, body in {
        "un/2024_08": {"metadata": {"partition": "un/2024_08"}, "offres": ADS[:2]},
        "un/2024_09": {"metadata": {"partition": "un/2024_09"}, "offres": ADS[2:]},
        "deux/2024_09": {"metadata": {"partition": "deux/2024_09"}},
    }.items():
        (tree / part).mkdir(parents=True)
        (tree / part / "offres_raw.json").write_text(json.dumps(body), encoding="utf-8")
    (tree / "bad").mkdir()
    (tree / "bad" / "offres_raw.json").write_text('{"offres": [', encoding="utf-8")
    files_df = read_envelopes(spark, str(tree))
    row = bronze.envelope_integrity_report(files_df).first()
    assert tuple(row) == (3, 3, ["deux", "un"], ["2024_08", "2024_09"], 1)
    assert [r.file.endswith("bad/offres_raw.json") for r in bronze.corrupt_files(files_df)
            .collect()] == [True]


def test_missing_keys_take_defaults_and_nulls_stay(spark, files):
    ads = typed_ads(read_envelope_records(spark, str(files / "in"))).collect()
    assert (ads[0]["niveau_etudes"], ads[0]["nb_postes"]) == (None, 2)
    assert (ads[1]["salaire_brut"], ads[1]["niveau_etudes"], ads[1]["nb_postes"]) == (None, "", 1)
    assert (ads[2]["id_offre"], ads[2]["langue_requise"]) == ("UNKNOWN", [])


def test_silver_rows(spark, files):
    raw = typed_ads(read_envelope_records(spark, str(files / "in")))
    clean = silver.clean_ads(raw)
    assert clean.columns == schemas.CLEAN_ADS.fieldNames()
    assert [f.dataType for f in clean.schema] == [f.dataType for f in schemas.CLEAN_ADS]
    a, b, c = clean.collect()
    assert (a["profil_normalise"], a["ville"], a["region"], a["type_contrat"]) == (
        "Data Engineer", "Tanger", "Tanger-Tétouan-Al Hoceïma", "CDI",
    )
    assert (a["salaire_min_mad"], a["salaire_max_mad"], a["salaire_median_mad"]) == (
        15000, 20000, 17500,
    )
    assert (a["anomalies"], a["nb_anomalies"]) == ("salaire_inverti", 1)
    assert b["anomalies"] == (
        "titre_non_classifie, ville_non_reconnue, contrat_non_reconnu, "
        "experience_non_parseable, dates_incoherentes"
    )
    assert (b["salaire_devise"], b["region"]) == ("Non renseigné", "Autre")
    assert c["anomalies"] == "contrat_non_reconnu, salaire_non_parseable, dates_incoherentes"
    assert (c["experience_min_ans"], c["experience_max_ans"]) == (0, 1)
    text = silver.languages_as_json(clean).first()["langue_requise"]
    assert text == json.dumps(ADS[0]["langue_requise"], ensure_ascii=False)
    quality_row = silver.quality_rows(clean).collect()[2]
    assert tuple(quality_row)[5:] == (True, False, False)
    report = {k: v.collect() for k, v in quality.quality_report(clean).items()}
    assert tuple(report["synthese"][0])[:5] == (3, 1, 0, 1, 2)
    assert report["anomalies"][0]["nb"] == 2
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_dictionary_order(spark, files):
    rows = read_dictionary(spark, str(files / "dict.json")).orderBy("prio").collect()
    assert [r["alias"] for r in rows] == ["apache spark", "python", "spark", "c++", "r"]
    assert [r["loose"] for r in rows] == [False, False, False, True, False]


def test_run(spark, files):
    root = str(files / "lake")
    args = (spark, str(files / "in"), root, str(files / "dict.json"))
    first = [(s.name, s.rows) for s in job.run(*args)]
    assert first == [("bronze", 3), ("silver", 3), ("terms", 4), ("gold", 5)]
    # A second run replaces the same partitions instead of adding to them.
    assert [(s.name, s.rows) for s in job.run(*args)] == first
    lake = job.Lake(root)
    marts = job.read_marts(spark, lake)
    top = {(r["profil"], r["competence"]): tuple(r)[3:] for r in
           marts["top_competences"].collect()}
    assert top[("tous", "spark")] == (1, 33.33, 1)
    assert ("Data Engineer", "cpp") in top
    found = tables.read_table(spark, lake.skills, schemas.SKILLS)
    spark_row = found.where("skill_normalise = 'spark'").first()
    assert (spark_row["alias_trouve"], spark_row["source"], spark_row["nb_mentions_desc"]) == (
        "apache spark", "description", 1,
    )
    summary = gold.summary(marts)
    assert [r["ville"] for r in summary["villes"].collect()] == ["Tanger"]
    manifest = tables.read_table(spark, lake.manifest).collect()
    assert sorted((r["partition"], r["nb_offres"]) for r in manifest) == [
        ("inconnu/2024_01", 1), ("linkedin/2024_08", 1), ("site_un/2024_08", 1),
    ]
    pruned = bronze.read_bronze(spark, lake.bronze, ["linkedin"], ("2024_01", "2024_12"))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "source_part" in filters and "mois_part" in filters
    assert pruned.count() == 1
    report = bronze.integrity_report(bronze.read_bronze(spark, lake.bronze)).first()
    assert (report["partitions_found"], report["total_offres"]) == (3, 3)


def test_run_stops_on_missing_input(spark, files):
    empty = files / "empty"
    empty.mkdir()
    (empty / "ads.json").write_text('{"offres": []}', encoding="utf-8")
    with pytest.raises(Exception):
        job.run(spark, str(empty), str(files / "lake2"), str(files / "dict.json"))
    with pytest.raises(Exception):
        job.run(spark, str(files / "nowhere"), str(files / "lake3"), str(files / "dict.json"))


def test_lines_append_and_companies(spark, files):
    lines = files / "lines.jsonl"
    lines.write_text("\n".join(json.dumps(a) for a in ADS) + "\n\n", encoding="utf-8")
    zone = str(files / "zone")
    bronze.ingest(read_lines(spark, str(lines)), zone)
    bronze.ingest(read_lines(spark, str(lines)), zone, mode="append")
    assert bronze.read_bronze(spark, zone).count() == 6
    (files / "c.csv").write_text(
        "nom_entreprise,secteur,taille,ville_siege,site_web,type\nAcme,IT,10,Fès,x.ma,PME\n",
        encoding="utf-8",
    )
    assert read_companies(spark, str(files / "c.csv")).first()["ville_siege"] == "Fès"


def test_gold_edge_rules(spark):
    rows = [
        ("Acme", "Inconnu", "SRE", 100, True), ("Acme", "Inconnu", "SRE", 200, True),
        ("Acme", "Inconnu", "Non classifié", 900, False), ("Acme", "Autre", "SRE", 1, True),
        ("", "Fès", "SRE", 1, True), (None, "Fès", "SRE", 1, True),
        ("Solo", "Fès", "Non classifié", None, False),
    ]
    ads = spark.createDataFrame(
        rows, "entreprise string, ville string, profil_normalise string, "
        "salaire_median_mad int, salaire_connu boolean"
    )
    got = {r["entreprise"]: tuple(r)[1:] for r in gold.recruiters(ads).collect()}
    assert got == {
        "Acme": ("Inconnu", 3, 1, 150.0, ["SRE"]),
        "Solo": ("Fès", 1, 0, None, []),
    }


def test_top_terms_counts_unclassified_only_overall(spark):
    matches = spark.createDataFrame(
        [("1", "P", "f", "t"), ("2", "Non classifié", "f", "t"), ("3", None, "f", "t"),
         ("1", "P", "f", "u"), ("1", "P", "f", "t")],
        "id_offre string, profil_normalise string, famille string, skill_normalise string",
    )
    ads = spark.createDataFrame([(str(i),) for i in range(4)], "id_offre string")
    got = {(r[0], r[2]): tuple(r)[3:] for r in gold.top_terms(matches, ads).collect()}
    assert got == {
        ("P", "t"): (1, 25.0, 1), ("P", "u"): (1, 25.0, 1),
        ("tous", "t"): (3, 75.0, 1), ("tous", "u"): (1, 25.0, 2),
    }


def _ad(number, source, published):
    return {"id_offre": number, "source": source, "titre_poste": "SRE", "date_publication": published}


def _feed(folder, *ads, name="f.json"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps({"offres": list(ads)}), encoding="utf-8")
    return str(folder)


def _ids(spark, lake):
    return sorted(r["id_offre"] for r in tables.read_table(spark, lake.ads, schemas.CLEAN_ADS).collect())


def test_partial_runs_leave_other_ads(spark, tmp_path):
    lake = job.Lake(str(tmp_path / "lake"))
    ads = [_ad("A", "x", "2024-07-01"), _ad("B", "x", "2024-08-01"), _ad("C", "y", "2024-07-01"),
           _ad("D", "y", "bientôt")]
    job.run_bronze(spark, lake, _feed(tmp_path / "in", *ads))
    job.run_silver(spark, lake)
    job.run_silver(spark, lake, sources=["x"])
    assert _ids(spark, lake) == ["A", "B", "C", "D"]
    job.run_silver(spark, lake, months=("2024_08", "2024_08"))
    assert _ids(spark, lake) == ["A", "B", "C", "D"]
    # B moves to September: landing again leaves no ghost, in whole or partial runs
    ads[1] = _ad("B", "x", "2024-09-01")
    job.run_bronze(spark, lake, _feed(tmp_path / "in", *ads))
    assert bronze.read_bronze(spark, lake.bronze).count() == 4
    job.run_silver(spark, lake, months=("2024_08", "2024_09"))
    assert _ids(spark, lake) == ["A", "B", "C", "D"]
    ads.pop()
    job.run_bronze(spark, lake, _feed(tmp_path / "in", *ads))
    job.run_silver(spark, lake)
    assert _ids(spark, lake) == ["A", "B", "C"]


def test_feeds_do_not_replace_each_other(spark, tmp_path):
    lake = job.Lake(str(tmp_path / "lake"))
    one = _feed(tmp_path / "one", _ad("A", "x", "2024-07-01"))
    two = _feed(tmp_path / "two", _ad("B", "x", "2024-07-02"))
    job.run_bronze(spark, lake, one, feed="one")
    job.run_bronze(spark, lake, two, feed="two")
    assert job.run_bronze(spark, lake, two, feed="two") == 2
    with pytest.raises(ValueError):
        job.run_bronze(spark, lake, two, feed="../two")


def test_broken_files_and_records(spark, tmp_path):
    lake = job.Lake(str(tmp_path / "lake"))
    folder = _feed(tmp_path / "in", _ad("A", "x", "2024-07-01"))
    (tmp_path / "in" / "cut.json").write_text('{"offres": [{"id_offre": "B"', encoding="utf-8")
    with pytest.raises(Exception, match="corrupt envelope"):
        job.run_bronze(spark, lake, folder)
    assert job.run_bronze(spark, lake, folder, corrupt="skip") == 1
    lines = tmp_path / "ads.jsonl"
    lines.write_text('{"id_offre": "L"}\n{"id_offre": \n{"a": 1} x\n[1]\n', encoding="utf-8")
    assert job.run_bronze(spark, lake, str(lines), "lines", feed="lines") == 2
    assert job.count_rejects(spark, lake) == 3
    job.run_silver(spark, lake)
    assert _ids(spark, lake) == ["A", "L"]
    # landing a feed again replaces its rejects too, also by none, and a feed may be empty
    good = tmp_path / "good.jsonl"
    good.write_text('{"id_offre": "L"}\n', encoding="utf-8")
    assert job.run_bronze(spark, lake, str(good), "lines", feed="lines") == 2
    assert job.count_rejects(spark, lake) == 0
    zone = str(tmp_path / "empty")
    bronze.ingest(read_lines(spark, str(good)).where("raw is null"), zone, rejects=zone + "-rejects")
    assert spark.read.parquet(zone + "-rejects").count() == 0
    # of a feed of rejects alone none is lost
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"id_offre": \n[1]\n', encoding="utf-8")
    zone = str(tmp_path / "bad-zone")
    bronze.ingest(read_lines(spark, str(bad)), zone, rejects=zone + "-rejects")
    assert spark.read.parquet(zone + "-rejects").count() == 2
    # without a rejects zone the report finds them
    zone = str(tmp_path / "zone")
    bronze.ingest(read_lines(spark, str(lines)), zone)
    assert bronze.integrity_report(bronze.read_bronze(spark, zone)).first()["enregistrements_corrompus"] == 3
