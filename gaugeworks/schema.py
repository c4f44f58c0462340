"""Fixed schemas, names and lookup values of the published datasets."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: published hourly schema, in published order -------------
READINGS = T.StructType(
    [
        T.StructField("station_code", T.StringType()),
        T.StructField("station_name", T.StringType()),
        T.StructField("basin_name", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("water_level", T.DoubleType()),
        T.StructField("flood_status", T.StringType()),
        T.StructField("warning_level", T.DoubleType()),
        T.StructField("danger_level", T.DoubleType()),
        T.StructField("high_flood_level", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("dedup_key", T.StringType()),
    ]
)
READING_COLUMNS = READINGS.fieldNames()

# --- Fixed values: accepted provider spellings per standard column ---------
FIELD_ALIASES = {
    "station_code": [
        "station_code",
        "code_station",
        "stationcode",
        "station code",
        "stationid",
        "station id",
        "sitecode",
        "site code",
    ],
    "station_name": ["station", "station_name", "station name", "name"],
    "timestamp": [
        "timestamp",
        "datetime",
        "obs_time",
        "observed at",
        "observedat",
        "date_time",
        "time",
        "date",
        "data acquisition time",
        "dataacquisitiontime",
    ],
    "water_level": [
        "water_level",
        "waterlevel",
        "water level",
        "wl",
        "level",
        "resultat_obs_elab",
        "gauge reading",
        "gaugereading",
        "river water level telemetry hourly (meter)",
        "river water level manual hourly (meter)",
    ],
    "latitude": ["latitude", "lat"],
    "longitude": ["longitude", "lon", "long"],
}

# --- Fixed values: alert categories and their display colours --------------
NORMAL = "NORMAL"
WARNING = "WARNING"
DANGER = "DANGER"
EXCEEDED = "HIGH_FLOOD_EXCEEDED"
STATUS_COLOURS = {
    "HIGH_FLOOD_EXCEEDED": "#d62728",
    "DANGER": "#ff7f0e",
    "WARNING": "#f7c33d",
    "NORMAL": "#2ca02c",
}
UNKNOWN_COLOUR = "#7f7f7f"

# --- Fixed values: map buffers, at no risk and by risk (radius: per unit, opacity: per 100)
BUFFER_RADIUS = (5000.0, 55000.0)
BUFFER_OPACITY = (0.12, 0.25)

# --- Fixed values: keys under which a landed payload may hold its records --
PAYLOAD_KEYS = ["records", "data", "results", "observations"]

# --- Fixed values: daily family -------------------------------------------
DAILY_COLUMNS = [
    "station_code",
    "record_date",
    "water_level_mm",
    "flood_alert",
    "hubeau_elab_code",
    "data_production_date",
    "validation_status_code",
    "validation_status",
    "production_method_code",
    "production_method",
    "quality_code",
    "quality_assessment",
    "location_code",
    "longitude",
    "latitude",
]
PROVIDER_TO_ENGLISH = {
    "code_site": "location_code",
    "code_station": "station_code",
    "date_obs_elab": "record_date",
    "resultat_obs_elab": "water_level_mm",
    "date_prod": "data_production_date",
    "code_statut": "validation_status_code",
    "libelle_statut": "validation_status",
    "code_methode": "production_method_code",
    "libelle_methode": "production_method",
    "code_qualification": "quality_code",
    "libelle_qualification": "quality_assessment",
    "longitude": "longitude",
    "latitude": "latitude",
    "grandeur_hydro_elab": "hubeau_elab_code",
}
FRENCH_CATEGORIES = {
    "validation_status": {
        "Donnée validée": "validated",
        "Donnée brute": "raw",
        "Donnée pré-validée": "pre-validated",
    },
    "quality_assessment": {
        "Bonne": "good",
        "Non qualifiée": "unqualified",
        "Douteuse": "dubious",
    },
    "production_method": {
        "Calculée": "calculated",
        "Mesurée": "measured",
        "Expertisée": "expert-reviewed",
    },
}
HINDI_CATEGORIES = {
    "validation_status": {
        "मान्य": "validated",
        "अमान्य": "unvalidated",
        "प्रारंभिक": "pre-validated",
    },
    "quality_assessment": {
        "अच्छी": "good",
        "खराब": "poor",
        "संतोषजनक": "satisfactory",
    },
    "flood_severity": {
        "अत्यधिक": "severe",
        "मध्यम": "moderate",
        "कम": "low",
    },
}
FLOOD_ALERT_MM = 6000
EARLIEST_DATE = {"france": "1900-01-01", "india": "1950-01-01"}
# ---------------------------------------------------------------------------
