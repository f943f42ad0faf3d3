"""Raw strings to the typed variant with relative humidity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skyledger import schema as S
from skyledger.functions.calendar import cast_timestamp
from skyledger.functions.humidity import relative_humidity
from skyledger.functions.text import decode_tenths, decode_visibility, try_number

# fixed values: what the typed scan takes from the raw files
TYPED_SOURCE_COLUMNS = [
    "STATION", "DATE", "LATITUDE", "LONGITUDE", "ELEVATION", "TMP", "DEW", "SLP", "VIS", "RH",
]


def typed_humidity(df: DataFrame, missing_tokens: str = "codes") -> DataFrame:
    """Typed readings, humidity, and the year and month partition columns.

    A raw column the table lacks gives a typed NULL. ``missing_tokens="compat"``
    tests the negative sentinels instead of the documented codes.
    """
    sentinels = S.TYPED_SENTINELS[missing_tokens]
    have = set(df.columns)

    def raw(name: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast("string")

    decoded = df.select(
        raw("STATION").cast("string").alias("STATION"),
        cast_timestamp(raw("DATE")).alias("DATE"),
        *[try_number(raw(c)).alias(c) for c in S.GEO_COLUMNS],
        decode_tenths(raw("TMP"), sentinels["TMP"]).alias("TMP_C"),
        decode_tenths(raw("DEW"), sentinels["DEW"]).alias("DEW_C"),
        decode_tenths(raw("SLP"), sentinels["SLP"]).alias("SLP_hPa"),
        decode_visibility(raw("VIS"), sentinels["VIS"]).alias("VIS_m"),
        try_number(raw("RH")).alias("RH_given"),
    )
    return decoded.select(
        "STATION", "DATE", *S.GEO_COLUMNS, "TMP_C", "DEW_C", "SLP_hPa", "VIS_m",
        relative_humidity("TMP_C", "DEW_C", "RH_given").alias("RH_pct"),
        F.year("DATE").alias("year"),
        F.month("DATE").alias("month"),
    )
