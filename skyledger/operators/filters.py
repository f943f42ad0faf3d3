"""Missing-value and quality-code filters, with their counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skyledger import schema as S


def _one_of(column: str, values: Sequence[str]) -> str:
    quoted = [v.replace("\\", "\\\\").replace("'", "\\'") for v in values]
    return f"`{column}` IN (" + ", ".join(f"'{v}'" for v in quoted) + ")"


def _missing_rules(codes: Mapping[str, Sequence[str]] | None) -> dict[str, str]:
    codes = S.MISSING_CODES if codes is None else codes
    rules = {
        "wind_direction": f"WND_DIR_DEG = '{S.WIND_DIRECTION_MISSING}'"
        f" AND WND_TYPE <> '{S.WIND_TYPE_VARIABLE}'",
        "wind_type": f"WND_TYPE = '{S.WIND_TYPE_MISSING}'"
        f" AND WND_SPD_RAW <> '{S.WIND_SPEED_CALM}'",
    }
    return rules | {c: _one_of(c, v) for c, v in codes.items()}


def missing_rules(codes: Mapping[str, Sequence[str]] | None = None) -> dict[str, Column]:
    """One boolean per rule over the split, still textual tokens."""
    return {n: F.expr(r) for n, r in _missing_rules(codes).items()}


def is_missing(codes: Mapping[str, Sequence[str]] | None = None) -> Column:
    """TRUE if any rule hits; NULL if none hits and a token is absent."""
    return F.expr(" OR ".join(f"({r})" for r in _missing_rules(codes).values()))


def is_accepted(accepted: Mapping[str, Sequence[str]] | None = None) -> Column:
    """TRUE if every quality code is an accepted one; NULL codes never are."""
    accepted = S.ACCEPTED_QC if accepted is None else accepted
    return F.expr(" AND ".join(_one_of(c, v) for c, v in accepted.items()))


def drop_missing(df: DataFrame, codes: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Keep rows on which no rule hits and no tested token is absent."""
    return df.filter(~is_missing(codes))


def keep_accepted(df: DataFrame, accepted: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    return df.filter(is_accepted(accepted))


def missing_rule_counts(
    df: DataFrame, codes: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Rows hit by each rule, and rows dropped only for an absent token: (rule, n)."""
    rules = missing_rules(codes)
    counts = [F.count_if(c).alias(n) for n, c in rules.items()]
    counts.append(F.count_if(is_missing(codes).isNull()).alias("absent_token"))
    return df.agg(*counts).unpivot([], [*rules, "absent_token"], "rule", "n")


def cleanse_funnel(df: DataFrame) -> DataFrame:
    """Rows before cleansing, after the missing filter and after the quality filter.

    All three come from one pass: (stage, n).
    """
    kept = ~is_missing()
    stages = {
        "raw": F.count(F.lit(1)),
        "not_missing": F.count_if(kept),
        "accepted": F.count_if(kept & is_accepted()),
    }
    one_row = df.agg(*[c.alias(n) for n, c in stages.items()])
    return one_row.unpivot([], list(stages), "stage", "n")


def drop_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns)) if columns else df
