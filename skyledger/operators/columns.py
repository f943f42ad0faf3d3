"""Column surgery: split, reorder, drop, rename, cast and scale.

Every function builds one ``select``, so the analysed plan stays flat however many
columns are touched. Columns a table does not have are left out quietly, because
observation files differ in what they carry.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from skyledger import schema as S
from skyledger.functions.calendar import calendar_parts, parse_timestamp
from skyledger.functions.text import try_number


def split_packed(
    df: DataFrame, layouts: Mapping[str, Sequence[str]] | None = None, once: bool = False
) -> DataFrame:
    """Replace each packed column by its token columns, at the same position.

    A filter on tokens is pushed below the ``select`` that makes them, and would then
    split the same text again for each condition. ``once`` routes the token arrays
    through ``inline``, which filters do not cross, so each field is split a single
    time per row. Leave it off where only some of the token columns will be read.
    """
    layouts = S.PACKED_LAYOUTS if layouts is None else layouts
    names = df.columns
    packed = [c for c in names if c in layouts]
    split = {c: f"split(cast(`{c}` AS string), ',')" for c in packed}
    if once and packed:
        others = [c for c in names if c not in split]
        arrays = ", ".join(f"{split[c]} AS `{c}`" for c in packed)
        df = df.select(*others, F.expr(f"inline(array(struct({arrays})))"))
        split = {c: f"`{c}`" for c in packed}
    out: list[Column | str] = []
    for name in names:
        if name in split:
            out += [
                F.expr(f"get({split[name]}, {i}) AS `{t}`") for i, t in enumerate(layouts[name])
            ]
        else:
            out.append(name)
    return df.select(*out)


def place_after(df: DataFrame, anchor: str, new: Mapping[str, Column]) -> DataFrame:
    """Add columns right after ``anchor``; same-named old columns are replaced."""
    out: list[Column | str] = []
    for name in df.columns:
        if name not in new:
            out.append(name)
        if name == anchor:
            out += [c.alias(n) for n, c in new.items()]
    return df.select(*out)


def replace_in_place(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    """Swap expressions into existing columns without moving them."""
    have = set(df.columns)
    return df.withColumns({c: e for c, e in new.items() if c in have})


def add_calendar(df: DataFrame, column: str = "DATE") -> DataFrame:
    """Parse the timestamp and put year, month, day and hour right after it."""
    parsed = replace_in_place(df, {column: parse_timestamp(column)})
    return place_after(parsed, column, calendar_parts(column))


def drop_columns(df: DataFrame, columns: Sequence[str] = tuple(S.QC_COLUMNS)) -> DataFrame:
    return df.drop(*columns)


def rename_units(df: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    return df.withColumnsRenamed(dict(S.UNIT_NAMES if names is None else names))


def scale_units(df: DataFrame, divisors: Mapping[str, float] | None = None) -> DataFrame:
    """Cast raw tokens to DOUBLE and divide them into their unit."""
    divisors = S.UNIT_DIVISORS if divisors is None else divisors
    new = {
        c: F.expr(f"try_cast(`{c}` AS double)" + ("" if d == 1.0 else f" / {float(d)}D"))
        for c, d in divisors.items()
    }
    return replace_in_place(df, new)


def cast_geo(df: DataFrame, station_as_int: bool = False) -> DataFrame:
    """Coordinates to DOUBLE; the station id to INT only on request.

    Eleven-digit and alphanumeric ids do not fit an INT and would become NULL.
    """
    types = dict.fromkeys(S.GEO_COLUMNS, "double")
    if station_as_int:
        types["STATION"] = "int"
    return replace_in_place(df, {c: try_number(c, t) for c, t in types.items()})


def present(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """The wanted columns this table has, in the wanted order."""
    have = set(df.columns)
    return [c for c in wanted if c in have]


def select_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    return df.select(*present(df, wanted))


def column_kinds(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Names of numeric and of all other columns."""
    fields = [f for f in df.schema.fields if f.name not in set(exclude)]
    numeric = [f.name for f in fields if isinstance(f.dataType, NumericType)]
    return numeric, [f.name for f in fields if f.name not in set(numeric)]


def model_columns(
    df: DataFrame, label: str, features: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Label, features and whatever else is to be kept; nothing more is scanned."""
    return df.select(*dict.fromkeys([*keep, label, *features]))
