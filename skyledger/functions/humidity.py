"""Relative humidity."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from skyledger.functions.text import as_column

# fixed values: Magnus coefficients over water
MAGNUS_A = 17.625
MAGNUS_B = 243.04


def _magnus_exponent(t: Column) -> Column:
    return MAGNUS_A * t / (MAGNUS_B + t)


def magnus_humidity(temperature: Column | str, dew_point: Column | str) -> Column:
    """Percent humidity from temperature and dew point in degrees Celsius."""
    t, d = as_column(temperature), as_column(dew_point)
    return 100.0 * F.exp(_magnus_exponent(d) - _magnus_exponent(t))


def relative_humidity(
    temperature: Column | str, dew_point: Column | str, given: Column | str | None = None
) -> Column:
    """The reported value if there is one, else the Magnus value held in [0, 100].

    ``greatest``/``least`` skip NULLs, so the both-present test must stay: without
    it a missing temperature would read as 100 percent.
    """
    t, d = as_column(temperature), as_column(dew_point)
    held = F.greatest(F.lit(0.0), F.least(F.lit(100.0), magnus_humidity(t, d)))
    computed = F.when(t.isNotNull() & d.isNotNull(), held)
    if given is None:
        return computed
    return F.coalesce(as_column(given).try_cast("double"), computed)
