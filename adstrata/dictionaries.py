"""Lookup dictionaries. All of them are fixed values and all are parameters of the operators.

The skill dictionary is not here: it is an input file (see ``sources.terms``).
"""

# --- Fixed values: city spellings, in match order -----------------------------------------
CITY_SPELLINGS = {
    "Casablanca": ["casablanca", "casa", "dar el beida", "casablanque"],
    "Rabat": ["rabat", "rabat-salé", "rabat salé"],
    "Tanger": ["tanger", "tangier", "tanja", "tanger-assilah", "tanger med", "tanger assilah"],
    "Marrakech": ["marrakech", "marrakesh"],
    "Fès": ["fès", "fes"],
    "Agadir": ["agadir"],
    "Oujda": ["oujda"],
    "Meknès": ["meknès", "meknes"],
    "Tétouan": ["tétouan", "tetouan"],
    "El Jadida": ["el jadida", "el-jadida"],
    "Kenitra": ["kenitra", "kénitra"],
    "Mohammedia": ["mohammedia"],
    "Settat": ["settat"],
}

# --- Fixed values: administrative region of each city -------------------------------------
CITY_REGION = {
    "Casablanca": "Casablanca-Settat",
    "Mohammedia": "Casablanca-Settat",
    "El Jadida": "Casablanca-Settat",
    "Settat": "Casablanca-Settat",
    "Rabat": "Rabat-Salé-Kénitra",
    "Kenitra": "Rabat-Salé-Kénitra",
    "Tanger": "Tanger-Tétouan-Al Hoceïma",
    "Tétouan": "Tanger-Tétouan-Al Hoceïma",
    "Marrakech": "Marrakech-Safi",
    "Agadir": "Souss-Massa",
    "Fès": "Fès-Meknès",
    "Meknès": "Fès-Meknès",
    "Oujda": "Oriental",
}

# --- Fixed values: city coordinates (latitude, longitude) ---------------------------------
CITY_COORDINATES = {
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

# --- Fixed values: contract spellings (whole-value match) ---------------------------------
CONTRACT_SPELLINGS = {
    "CDI": ["cdi", "contrat à durée indéterminée", "permanent", "cdi - temps plein", "contrat cdi"],
    "CDD": ["cdd", "contrat à durée déterminée", "temporaire", "mission"],
    "Freelance": [
        "freelance",
        "consultant",
        "auto-entrepreneur",
        "indépendant",
        "mission freelance",
    ],
    "Stage": [
        "stage",
        "internship",
        "stage pfe",
        "stage de fin d'études",
        "stage conventionné",
        "stage 6 mois",
    ],
    "Alternance": ["alternance", "apprentissage", "contrat pro", "contrat d'apprentissage"],
}

# --- Fixed values: title keywords, classes in priority order ------------------------------
TITLE_KEYWORDS = {
    "Data Scientist": [
        "data scientist",
        "machine learning engineer",
        "ml engineer",
        "ingénieur machine learning",
        "ai engineer",
        "ingénieur ia",
        "deep learning",
    ],
    "Data Engineer": [
        "data engineer",
        "ingénieur data",
        "ingénieur big data",
        "big data engineer",
        "ingénieur etl",
        "etl developer",
        "pipeline developer",
        "dev data",
    ],
    "Data Analyst": [
        "data analyst",
        "analyste data",
        "analyste bi",
        "business analyst data",
        "bi analyst",
        "analyste reporting",
        "chargé de reporting",
        "bi developer",
        "développeur bi",
        "ingénieur bi",
        "analyste de données",
        "reporting analyst",
    ],
    "Développeur Full Stack": ["full stack", "fullstack", "full-stack"],
    "Développeur Backend": [
        "backend",
        "back-end",
        "développeur api",
        "ingénieur logiciel backend",
        "développeur serveur",
    ],
    "Développeur Frontend": [
        "frontend",
        "front-end",
        "développeur react",
        "développeur angular",
        "ui developer",
    ],
    "Développeur Mobile": [
        "mobile",
        "react native",
        "flutter developer",
        "développeur ios",
        "développeur android",
    ],
    "DevOps / SRE": ["devops", "sre", "site reliability", "devsecops", "ingénieur infra"],
    "Cloud Engineer": [
        "cloud engineer",
        "ingénieur cloud",
        "architecte cloud",
        "cloud architect",
        "aws engineer",
        "azure engineer",
        "gcp engineer",
    ],
    "Cybersécurité": [
        "cybersécurité",
        "cybersecurity",
        "sécurité",
        "pentest",
        "analyste soc",
        "soc analyst",
        "rssi",
    ],
    "Chef de Projet IT": [
        "chef de projet",
        "project manager",
        "scrum master",
        "product owner",
        "pmo",
        "responsable projet",
    ],
}

# --- Fixed values: words that mark a withheld salary --------------------------------------
CONFIDENTIAL_WORDS = [
    "confidentiel",
    "selon profil",
    "à négocier",
    "negocier",
    "profil",
    "a negocier",
]

# --- Fixed values: salary conversion ------------------------------------------------------
EUR_TO_MAD = 10.8
EUR_ROUNDING_STEP = 500

# --- Fixed values: plausible monthly salary bounds ----------------------------------------
SALARY_PLAUSIBLE = (1500, 100000)

# --- Fixed values: words of an entry-level experience text --------------------------------
BEGINNER_WORDS = ["débutant", "debutant", "0 à 1", "0-1", "0 an"]

# --- Fixed values: accepted date layouts (field order, separator) -------------------------
DATE_LAYOUTS = [("ymd", "-"), ("dmy", "/"), ("dmy", "-"), ("ymd", "/")]

# --- Fixed values: output labels ----------------------------------------------------------
UNCLASSIFIED = "Non classifié"
OTHER = "Autre"
UNKNOWN_CITY = "Inconnu"
UNSPECIFIED_CONTRACT = "Non précisé"
SALARY_MISSING = "Non renseigné"
SALARY_CONFIDENTIAL = "Confidentiel"
SALARY_UNPARSEABLE = "Non parseable"
CURRENCY_MAD = "MAD"
CURRENCY_FROM_EUR = "EUR→MAD"
ALL_PROFILES = "tous"
UNKNOWN_SOURCE = "inconnu"
UNKNOWN_MONTH = "date_inconnue"
REMOTE_VALUES = ["Hybride", "Télétravail complet"]

# --- Fixed values: the questions asked of the Gold tables ---------------------------------
DATA_PROFILES = ["Data Engineer", "Data Analyst", "Data Scientist"]
CORRELATION_PROFILES = ["Data Engineer", "Data Analyst", "Data Scientist", "DevOps / SRE"]
TREND_PROFILES = ["Data Engineer", "Data Analyst", "Développeur Full Stack", "DevOps / SRE"]
COMPARED_CITIES = ["Casablanca", "Rabat", "Tanger", "Marrakech", "Fès"]
FOCUS_CITY = "Tanger"
BASE_CITY = "Casablanca"

# Experience bands: (label, lowest year, highest year), in display order.
EXPERIENCE_BANDS = [
    ("0 — Débutant", 0, 0),
    ("1-2 ans", 1, 2),
    ("3-4 ans", 3, 4),
    ("5-7 ans", 5, 7),
    ("8+ ans Senior", 8, None),
]
NO_BAND = "Non précisé"

# Competitor levels: (label, salary strictly above), strongest first; the last is the rest.
COMPETITOR_LEVELS = [("Compétiteur fort", 20000), ("Compétiteur moyen", 12000)]
COMPETITOR_WEAKEST = "Compétiteur faible"

# Correlation strength: (label, |r| strictly above), strongest first; the last is the rest.
CORRELATION_STRENGTH = [("forte", 0.6), ("modérée", 0.3)]
CORRELATION_WEAKEST = "faible"
