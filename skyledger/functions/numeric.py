"""Arithmetic, binning, hashing and error expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from skyledger.functions.text import as_column

NULL_KEY = "<null>"  # stands for a NULL in the text that is hashed


def residual(label: Column | str, prediction: Column | str) -> Column:
    return as_column(label) - as_column(prediction)


def rmse(label: Column | str, prediction: Column | str) -> Column:
    """Aggregate: root of the mean squared error."""
    return F.sqrt(F.avg(F.pow(residual(label, prediction), F.lit(2))))


def unit_bin(c: Column | str, width: float = 1.0) -> Column:
    """Number of the bin of the given width that holds the value (BIGINT)."""
    return F.floor(as_column(c) / F.lit(float(width)))


def key_hash(*keys: Column | str, salt: str = "", digits: int = 8) -> Column:
    """Non-negative BIGINT from the leading hex digits of the MD5 of the key.

    It depends on the row alone, so the same rows are picked however the table is
    partitioned, in whatever engine. Up to 15 digits fit a BIGINT. A NULL key part is a
    value of its own, in its own place, so no row is without a hash.
    """
    parts = [F.coalesce(as_column(k).cast("string"), F.lit(NULL_KEY)) for k in keys]
    text = parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)
    if salt:
        text = F.concat(F.lit(salt), text)
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def key_bucket(*keys: Column | str, buckets: int = 100, salt: str = "") -> Column:
    """Bucket in [0, buckets) of the key (INT)."""
    return (key_hash(*keys, salt=salt) % buckets).cast("int")
