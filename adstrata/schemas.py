"""Fixed schemas. Nothing is inferred from data."""

from pyspark.sql import types as T

_S, _I, _L, _B, _D = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.BooleanType(),
    T.DateType(),
)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


RAW_AD = _struct(
    ("id_offre", _S),
    ("source", _S),
    ("titre_poste", _S),
    ("description", _S),
    ("competences_brut", _S),
    ("entreprise", _S),
    ("ville", _S),
    ("type_contrat", _S),
    ("experience_requise", _S),
    ("salaire_brut", _S),
    ("niveau_etudes", _S),
    ("secteur", _S),
    ("date_publication", _S),
    ("date_expiration", _S),
    ("nb_postes", _I),
    ("teletravail", _S),
    ("langue_requise", T.ArrayType(_S)),
)

# Value of a raw field that the record does not have at all (an explicit null stays null).
RAW_AD_DEFAULTS = {
    "id_offre": "UNKNOWN",
    "source": "",
    "titre_poste": "",
    "description": "",
    "competences_brut": "",
    "entreprise": "",
    "ville": "",
    "type_contrat": "",
    "experience_requise": "",
    "salaire_brut": "",
    "niveau_etudes": "",
    "secteur": "",
    "date_publication": "",
    "date_expiration": "",
    "nb_postes": 1,
    "teletravail": "",
    "langue_requise": [],
}

BRONZE = _struct(
    ("raw", _S),
    ("source_fichier", _S),
    ("date_ingestion", T.TimestampType()),
    ("schema_version", _S),
    ("flux_part", _S),
    ("source_part", _S),
    ("mois_part", _S),
)

CLEAN_ADS = _struct(
    ("id_offre", _S),
    ("source", _S),
    ("titre_poste_original", _S),
    ("profil_normalise", _S),
    ("ville_originale", _S),
    ("ville", _S),
    ("region", _S),
    ("contrat_original", _S),
    ("type_contrat", _S),
    ("salaire_brut_original", _S),
    ("salaire_min_mad", _I),
    ("salaire_max_mad", _I),
    ("salaire_devise", _S),
    ("salaire_median_mad", _I),
    ("salaire_connu", _B),
    ("experience_originale", _S),
    ("experience_min_ans", _I),
    ("experience_max_ans", _I),
    ("date_publication", _D),
    ("date_expiration", _D),
    ("dates_valides", _B),
    ("mois_publication", _I),
    ("annee_publication", _I),
    ("description", _S),
    ("competences_brut", _S),
    ("entreprise", _S),
    ("secteur", _S),
    ("niveau_etudes", _S),
    ("nb_postes", _I),
    ("teletravail", _S),
    ("langue_requise", T.ArrayType(_S)),
    ("nb_anomalies", _I),
    ("anomalies", _S),
)

QUALITY = _struct(
    ("id_offre", _S),
    ("profil", _S),
    ("ville", _S),
    ("nb_anomalies", _I),
    ("anomalies", _S),
    ("titre_mapped", _B),
    ("dates_valides", _B),
    ("salaire_parseable", _B),
)

SKILLS = _struct(
    ("id_offre", _S),
    ("skill_normalise", _S),
    ("famille", _S),
    ("alias_trouve", _S),
    ("source", _S),
    ("nb_mentions_desc", _I),
    ("profil_normalise", _S),
    ("ville", _S),
    ("type_contrat", _S),
    ("annee_publication", _I),
    ("mois_publication", _I),
    ("source_offre", _S),
)

COMPANIES = _struct(
    ("nom_entreprise", _S),
    ("secteur", _S),
    ("taille", _S),
    ("ville_siege", _S),
    ("site_web", _S),
    ("type", _S),
)

TERM_DICTIONARY = _struct(("familles", T.MapType(_S, T.MapType(_S, T.ArrayType(_S)))))
