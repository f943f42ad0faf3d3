"""Text, token and parsing expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(c: Column | str, sep: str = ",") -> Column:
    """Packed text as an array of tokens."""
    return F.split(as_column(c).cast("string"), sep)


def token(c: Column | str, index: int, sep: str = ",") -> Column:
    """Token at a 0-based index; NULL past the end."""
    return F.get(tokens(c, sep), F.lit(index))


def first_token(c: Column | str) -> Column:
    """Text before the first comma (all of it where there is none)."""
    return F.substring_index(as_column(c), ",", 1)


def strip_plus(c: Column | str) -> Column:
    """Drop one leading plus sign."""
    c = as_column(c)
    return F.when(c.startswith("+"), F.substr(c, F.lit(2))).otherwise(c)


def try_number(c: Column | str, to: str | DataType = "double") -> Column:
    """Cast that gives NULL for text that is not a number."""
    return as_column(c).try_cast(to)


def empty_to_null(c: Column | str) -> Column:
    return F.nullif(as_column(c), F.lit(""))


def _leading_int(c: Column | str, missing: list[int]) -> Column:
    value = try_number(strip_plus(first_token(c)), "int")
    return F.when(~value.isin(missing), value) if missing else value


def decode_tenths(c: Column | str, missing: list[int]) -> Column:
    """Leading token in tenths of a unit as DOUBLE; missing codes become NULL."""
    return _leading_int(c, missing) / F.lit(10.0)


def decode_visibility(c: Column | str, missing: list[int]) -> Column:
    """Leading token as INT metres; missing codes become NULL."""
    return _leading_int(c, missing)


def alpha_label(alpha: Column | str) -> Column:
    """Short name of a mixing weight: 0.25 -> a0p25, 1.0 -> a1."""
    fixed = F.format_number(as_column(alpha), 2)
    trimmed = F.regexp_replace(fixed, r"\.?0+$", "")
    return F.concat(F.lit("a"), F.regexp_replace(trimmed, r"\.", "p"))
