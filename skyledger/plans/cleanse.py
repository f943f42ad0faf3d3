"""Raw strings to typed, cleansed observations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from skyledger import schema as S
from skyledger.operators import columns as C, filters as L


def cleanse(
    df: DataFrame, station_as_int: bool = False, variable_wind_dir: str = "keep",
    stored: bool = False,
) -> DataFrame:
    """Decode, drop missing and suspect rows, scale to units: the cleansed table.

    A variable wind carries the direction code 999, which passes as 999.0;
    ``variable_wind_dir="null"`` turns it into NULL. One lazy table, narrow all
    through: no shuffle, and nothing runs until the caller acts. Timestamps are
    parsed after the filters, on the rows that stay.

    A row without one of the packed fields never stays. For a ``stored`` table this is said
    before the split as well, so it reaches the scan; computed columns would be
    computed twice for it.
    """
    if variable_wind_dir not in ("keep", "null"):
        raise ValueError("variable_wind_dir is 'keep' or 'null'")
    if stored:
        there = [F.col(c).isNotNull() for c in C.present(df, list(S.PACKED_LAYOUTS))]
        df = df.filter(reduce(Column.__and__, there)) if there else df
    kept = L.keep_accepted(L.drop_missing(C.split_packed(df, once=True)))
    scaled = C.rename_units(C.scale_units(C.add_calendar(C.drop_columns(kept))))
    if variable_wind_dir == "null":
        code = F.lit(float(S.WIND_DIRECTION_MISSING))
        scaled = C.replace_in_place(
            scaled, {"WND_DIR_DEG": F.nullif(F.col("WND_DIR_DEG"), code)}
        )
    return C.cast_geo(scaled, station_as_int)
