"""Schemas and business values shared by all modules."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
MONEY_SUM = T.DecimalType(28, 2)

# ---------------------------------------------------------------------------
# Row images inside the change envelope. Times come as numbers (micros or days
# since the epoch) or as ISO text, so they are read as text.
# ---------------------------------------------------------------------------
ACTIVITY_IMAGE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("id_salarie", T.StringType()),
        T.StructField("start_date", T.StringType()),
        T.StructField("activity_type", T.StringType()),
        T.StructField("distance_m", T.FloatType()),
        T.StructField("duration_sec", T.IntegerType()),
        T.StructField("comment", T.StringType()),
    ]
)

EMPLOYEE_IMAGE = T.StructType(
    [
        T.StructField("id_salarie", T.StringType()),
        T.StructField("salaire_brut", T.StringType()),
        T.StructField("moyen_deplacement", T.StringType()),
        T.StructField("nom", T.StringType()),
        T.StructField("prenom", T.StringType()),
        T.StructField("date_embauche", T.StringType()),
        T.StructField("type_contrat", T.StringType()),
        T.StructField("bu", T.StringType()),
    ]
)

# Alerts print numbers as they came, so they keep them as text.
ALERT_IMAGE = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("id_salarie", "activity_type", "distance_m", "duration_sec", "comment")
    ]
)

# Headers of the HR file.
HR_HEADERS = (
    "ID salarié",
    "Nom",
    "Prénom",
    "Date de naissance",
    "BU",
    "Date d'embauche",
    "Salaire brut",
    "Type de contrat",
    "Nombre de jours de CP",
    "Adresse du domicile",
    "Moyen de déplacement",
)

# ---------------------------------------------------------------------------
# Fixed values.
# ---------------------------------------------------------------------------
# Column of the declared practice.
DECLARED = "pratique_declaree"

BONUS_RATE = Decimal("0.05")
DEFAULT_SALARY = Decimal("30000.00")
ACTIVE_THRESHOLD = 15
WELLBEING_DAYS = 5

# Travel modes that earn the bonus, after `mode_key`.
ECO_MODE_KEYS = ("marche_running", "velo_trottinette_autres")

# Defaults for missing employee fields.
EMPLOYEE_DEFAULTS = {
    "salaire_brut": "30000",
    "moyen_deplacement": "Non spécifié",
    "nom": "Inconnu",
    "prenom": "Inconnu",
    "type_contrat": "CDI",
    "bu": "Non spécifié",
}

# Header spellings and the column names they stand for.
HEADER_ALIASES = {
    "id": "id_salarie",
    "salarie": "id_salarie",
    "pratique": DECLARED,
    "date_de_naissance": "date_naissance",
    "date_dembauche": "date_embauche",
    "salaire": "salaire_brut",
    "type_de_contrat": "type_contrat",
    "nombre_de_jours_de_cp": "jours_cp",
    "adresse_du_domicile": "adresse",
    "moyen_de_deplacement": "moyen_deplacement",
    "deplacement": "moyen_deplacement",
    "transport": "moyen_deplacement",
    "moyen_transport": "moyen_deplacement",
}

# Beginnings of header names and the columns they stand for.
HEADER_BEGINNINGS = {"pratique_d": DECLARED}

# Accented letters that headers lose, and characters they drop.
ACCENTED = "éèêàâîôûç"
UNACCENTED = "eeeaaiouc"
HEADER_DROPPED = "°()'\""

# Distance bands in km by city, first match wins.
CITY_BANDS = (
    ("montpellier", 3, 8),
    ("lattes", 1, 5),
    ("frontignan", 25, 30),
    ("saint-clément-de-rivière", 8, 12),
    ("nîmes", 45, 50),
    ("pérols", 5, 8),
    ("mèze", 30, 35),
    ("prades-le-lez", 10, 15),
    ("mauguio", 8, 12),
    ("vendargues", 12, 18),
    ("clermont-l-hérault", 40, 45),
    ("grabels", 15, 20),
)

# Distance bands in km by postal code, tried when no city matches.
POSTCODE_BANDS = (
    ("34000", 3, 10),
    ("34090", 3, 10),
    ("34970", 1, 5),
    ("34110", 25, 30),
    ("30900", 45, 50),
    ("34470", 5, 8),
    ("34140", 30, 35),
    ("34730", 10, 15),
    ("34130", 8, 12),
    ("34740", 12, 18),
    ("34800", 40, 45),
    ("34790", 15, 20),
)

# Band when the address tells nothing.
DEFAULT_BAND = (5, 40)

# Words that decide the commute rule.
EXCLUDED_WORDS = ("voiture", "thermique", "electrique", "transport", "commun")
WALK_WORDS = ("marche", "running")
RIDE_WORDS = ("vélo", "velo", "trottinette")
WALK_LIMIT_KM = 15
RIDE_LIMIT_KM = 25

# Newest version of an employee: event time first, so that a stream that starts over from a new
# checkpoint does not bring old versions back; then the place in the message log; then the load.
VERSION_ORDER = ("cdc_ts_ms", "cdc_offset", "processing_timestamp", "batch_id")

# Columns of the verdict table.
VALIDATION_COLUMNS = (
    "id_salarie",
    "nom",
    "prenom",
    "adresse",
    "moyen_deplacement",
    "distance_km",
    "validation_deplacement",
    "adresse_entreprise",
)

# Verdict texts of the commute rule.
VALID = "Valide"
EXCLUDED = "Mode exclu: Véhicule motorisé ou transport"
UNKNOWN_MODE = "Mode non spécifié"
MISSING_DATA = "Erreur: Données manquantes"
ERROR_PREFIX = "Erreur:"

# Alert texts for missing fields.
ALERT_DEFAULTS = {
    "id_salarie": "Inconnu",
    "activity_type": "Activité inconnue",
    "distance_m": "0",
    "duration_sec": "0",
}
