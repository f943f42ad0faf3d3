"""Table layouts, packed-field layouts and cleansing rules, kept as data."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: column names of the raw observation table -----------------
RAW_COLUMNS = [
    "STATION", "DATE", "LATITUDE", "LONGITUDE", "ELEVATION",
    "WND", "CIG", "VIS", "TMP", "DEW", "SLP",
]

# --- fixed values: tokens inside each packed field, in file order ------------
PACKED_LAYOUTS = {
    "WND": ["WND_DIR_DEG", "WND_DIR_QUAL", "WND_TYPE", "WND_SPD_RAW", "WND_SPD_QUAL"],
    "CIG": ["CIG_HEIGHT_M", "CIG_QUAL", "CIG_DET_CODE", "CIG_CAVOK"],
    "VIS": ["VIS_DIST_M", "VIS_QUAL", "VIS_VAR_CODE", "VIS_VAR_QUAL"],
    "TMP": ["TMP_RAW", "TMP_QUAL"],
    "DEW": ["DEW_RAW", "DEW_QUAL"],
    "SLP": ["SLP_RAW", "SLP_QUAL"],
}

# --- fixed values: codes that stand for a missing reading --------------------
MISSING_CODES = {
    "WND_SPD_RAW": ["9999"],
    "CIG_HEIGHT_M": ["99999"],
    "VIS_DIST_M": ["999999"],
    "TMP_RAW": ["+9999", "9999"],
    "DEW_RAW": ["+9999", "9999"],
    "SLP_RAW": ["99999"],
}
WIND_DIRECTION_MISSING = "999"
WIND_TYPE_VARIABLE = "V"
WIND_TYPE_MISSING = "9"
WIND_SPEED_CALM = "0000"

# --- fixed values: accepted quality codes ------------------------------------
_QC_BASE = ["0", "1", "4", "5", "9"]
_QC_TEMPERATURE = _QC_BASE + ["A", "C", "I", "M", "P", "R", "U"]
ACCEPTED_QC = {
    "WND_DIR_QUAL": _QC_BASE,
    "WND_SPD_QUAL": _QC_BASE,
    "CIG_QUAL": _QC_BASE,
    "VIS_QUAL": _QC_BASE,
    "VIS_VAR_QUAL": _QC_BASE,
    "SLP_QUAL": _QC_BASE,
    "TMP_QUAL": _QC_TEMPERATURE,
    "DEW_QUAL": _QC_TEMPERATURE,
}

# --- fixed values: columns that only serve the quality checks ----------------
QC_COLUMNS = [
    "WND_DIR_QUAL", "WND_SPD_QUAL",
    "CIG_QUAL", "CIG_DET_CODE", "CIG_CAVOK",
    "VIS_QUAL", "VIS_VAR_CODE", "VIS_VAR_QUAL",
    "TMP_QUAL", "DEW_QUAL", "SLP_QUAL",
]

# --- fixed values: divisor that turns a raw token into its unit --------------
UNIT_DIVISORS = {
    "WND_DIR_DEG": 1.0,
    "WND_SPD_RAW": 10.0,
    "CIG_HEIGHT_M": 1.0,
    "VIS_DIST_M": 1.0,
    "TMP_RAW": 10.0,
    "DEW_RAW": 10.0,
    "SLP_RAW": 10.0,
}
UNIT_NAMES = {
    "WND_SPD_RAW": "WND_SPD_MS",
    "TMP_RAW": "TMP_C",
    "DEW_RAW": "DEW_C",
    "SLP_RAW": "SLP_hPa",
}
GEO_COLUMNS = ["LATITUDE", "LONGITUDE", "ELEVATION"]

# --- fixed values: sentinels of the typed, humidity-bearing variant ----------
# "codes" are the documented missing codes; "compat" are the negative numbers the
# variant has always compared against, which let 999.9 and 9999.9 through.
TYPED_SENTINELS = {
    "codes": {"TMP": [9999], "DEW": [9999], "SLP": [99999], "VIS": [999999]},
    "compat": {"TMP": [-9999], "DEW": [-9999], "SLP": [-9999], "VIS": [-999999]},
}

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

CLEAN_SCHEMA = T.StructType([
    T.StructField("STATION", T.StringType()),
    T.StructField("DATE", T.TimestampType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("LATITUDE", T.DoubleType()),
    T.StructField("LONGITUDE", T.DoubleType()),
    T.StructField("ELEVATION", T.DoubleType()),
    T.StructField("WND_DIR_DEG", T.DoubleType()),
    T.StructField("WND_TYPE", T.StringType()),
    T.StructField("WND_SPD_MS", T.DoubleType()),
    T.StructField("CIG_HEIGHT_M", T.DoubleType()),
    T.StructField("VIS_DIST_M", T.DoubleType()),
    T.StructField("TMP_C", T.DoubleType()),
    T.StructField("DEW_C", T.DoubleType()),
    T.StructField("SLP_hPa", T.DoubleType()),
])

# --- fixed values: label and feature lists of the regression models ----------
LABEL = "TMP_C"
LINEAR_FEATURES = [
    "DEW_C", "SLP_hPa", "WND_SPD_MS", "VIS_DIST_M", "CIG_HEIGHT_M",
    "LATITUDE", "LONGITUDE", "ELEVATION",
]
FOREST_FEATURES = [
    "LATITUDE", "LONGITUDE", "ELEVATION",
    "WND_DIR_DEG", "WND_SPD_MS", "CIG_HEIGHT_M", "VIS_DIST_M",
    "DEW_C", "SLP_hPa",
    "year", "month", "day", "hour",
]
PROFILE_COLUMNS = [
    "WND_DIR_DEG", "WND_SPD_MS", "CIG_HEIGHT_M", "VIS_DIST_M", "TMP_C", "DEW_C", "SLP_hPa",
]
CORRELATION_COLUMNS = [
    "TMP_C", "DEW_C", "SLP_hPa", "WND_SPD_MS", "VIS_DIST_M", "CIG_HEIGHT_M",
]
