"""DuckDB SQL for the registered queries, written from their definitions.

Linear models are solved in SQL as well: the normal equations of standardised
features are eliminated step by step in a chain of one-row tables.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np

from skyledger.plans.feed import FEED_SQL

# fixed values: column lists of the profiles and of the linear models
PROFILE_COLUMNS = [
    "WND_DIR_DEG", "WND_SPD_MS", "CIG_HEIGHT_M", "VIS_DIST_M", "TMP_C", "DEW_C", "SLP_hPa",
]
CORRELATION_COLUMNS = [
    "TMP_C", "DEW_C", "SLP_hPa", "WND_SPD_MS", "VIS_DIST_M", "CIG_HEIGHT_M",
]
LINEAR_FEATURES = [
    "DEW_C", "SLP_hPa", "WND_SPD_MS", "VIS_DIST_M", "CIG_HEIGHT_M",
    "LATITUDE", "LONGITUDE", "ELEVATION",
]

ORACLES: dict[str, str] = {}

# ------------------------------------------------------------ shared tables ---
FEED = f"feed AS ({FEED_SQL})"

# fixed values: tokens of the packed fields, missing rules, accepted codes
_TOKENS = {
    "WND": ["WND_DIR_DEG", "WND_DIR_QUAL", "WND_TYPE", "WND_SPD_RAW", "WND_SPD_QUAL"],
    "CIG": ["CIG_HEIGHT_M", "CIG_QUAL", "CIG_DET_CODE", "CIG_CAVOK"],
    "VIS": ["VIS_DIST_M", "VIS_QUAL", "VIS_VAR_CODE", "VIS_VAR_QUAL"],
    "TMP": ["TMP_RAW", "TMP_QUAL"],
    "DEW": ["DEW_RAW", "DEW_QUAL"],
    "SLP": ["SLP_RAW", "SLP_QUAL"],
}


def _token_list(*fields: str) -> str:
    return ", ".join(
        f"string_split({f}, ',')[{i + 1}] AS {t}"
        for f in fields
        for i, t in enumerate(_TOKENS[f])
    )


_PLAIN = "event_id, STATION, DATE, LATITUDE, LONGITUDE, ELEVATION"
TOKENS = f"{FEED}, tok AS (SELECT {_PLAIN}, {_token_list(*_TOKENS)} FROM feed)"

_RULES = {
    "wind_direction": "WND_DIR_DEG = '999' AND WND_TYPE <> 'V'",
    "wind_type": "WND_TYPE = '9' AND WND_SPD_RAW <> '0000'",
    "WND_SPD_RAW": "WND_SPD_RAW = '9999'",
    "CIG_HEIGHT_M": "CIG_HEIGHT_M = '99999'",
    "VIS_DIST_M": "VIS_DIST_M = '999999'",
    "TMP_RAW": "TMP_RAW IN ('+9999', '9999')",
    "DEW_RAW": "DEW_RAW IN ('+9999', '9999')",
    "SLP_RAW": "SLP_RAW = '99999'",
}
_MISSING = " OR ".join(f"({r})" for r in _RULES.values())
_OK = "('0', '1', '4', '5', '9')"
_OK_T = "('0', '1', '4', '5', '9', 'A', 'C', 'I', 'M', 'P', 'R', 'U')"
_ACCEPTED = (
    f"WND_DIR_QUAL IN {_OK} AND WND_SPD_QUAL IN {_OK} AND CIG_QUAL IN {_OK} "
    f"AND VIS_QUAL IN {_OK} AND VIS_VAR_QUAL IN {_OK} AND SLP_QUAL IN {_OK} "
    f"AND TMP_QUAL IN {_OK_T} AND DEW_QUAL IN {_OK_T}"
)
_DATE = "try_strptime(DATE, '%Y-%m-%dT%H:%M:%S')"
CLEAN = f"""{TOKENS}, clean AS (
  SELECT event_id, STATION, {_DATE} AS "DATE",
    cast(year({_DATE}) AS INTEGER) AS "year", cast(month({_DATE}) AS INTEGER) AS "month",
    cast(day({_DATE}) AS INTEGER) AS "day", cast(hour({_DATE}) AS INTEGER) AS "hour",
    try_cast(LATITUDE AS DOUBLE) AS LATITUDE, try_cast(LONGITUDE AS DOUBLE) AS LONGITUDE,
    try_cast(ELEVATION AS DOUBLE) AS ELEVATION,
    try_cast(WND_DIR_DEG AS DOUBLE) AS WND_DIR_DEG, WND_TYPE,
    try_cast(WND_SPD_RAW AS DOUBLE) / 10.0 AS WND_SPD_MS,
    try_cast(CIG_HEIGHT_M AS DOUBLE) AS CIG_HEIGHT_M,
    try_cast(VIS_DIST_M AS DOUBLE) AS VIS_DIST_M,
    try_cast(TMP_RAW AS DOUBLE) / 10.0 AS TMP_C,
    try_cast(DEW_RAW AS DOUBLE) / 10.0 AS DEW_C,
    try_cast(SLP_RAW AS DOUBLE) / 10.0 AS "SLP_hPa"
  FROM tok WHERE NOT ({_MISSING}) AND {_ACCEPTED})"""


def _first_int(c: str) -> str:
    return f"try_cast(regexp_replace(regexp_extract({c}, '^([^,]*)', 1), '^\\+', '') AS INTEGER)"


def _tenths(c: str, missing: int) -> str:
    return f"CASE WHEN {_first_int(c)} <> {missing} THEN {_first_int(c)} / 10.0 END"


_MAGNUS = "100.0 * exp(17.625 * td / (243.04 + td) - 17.625 * t / (243.04 + t))"
_HUMIDITY = f"""CASE WHEN RH IS NOT NULL THEN cast(RH AS DOUBLE)
  WHEN t IS NOT NULL AND td IS NOT NULL THEN greatest(0.0, least(100.0, {_MAGNUS})) END"""


def _typed(tmp: int, slp: int, vis: int) -> str:
    return f"""{FEED}, dec AS (
  SELECT *, cast(DATE AS TIMESTAMP) AS ts, {_tenths('TMP', tmp)} AS t, {_tenths('DEW', tmp)} AS td,
    {_tenths('SLP', slp)} AS p, {_first_int('VIS')} AS v FROM feed),
typed AS (
  SELECT STATION, ts AS "DATE", cast(LATITUDE AS DOUBLE) AS LATITUDE,
    cast(LONGITUDE AS DOUBLE) AS LONGITUDE, cast(ELEVATION AS DOUBLE) AS ELEVATION,
    t AS TMP_C, td AS DEW_C, p AS "SLP_hPa", CASE WHEN v <> {vis} THEN v END AS VIS_m,
    {_HUMIDITY} AS RH_pct,
    cast(year(ts) AS INTEGER) AS "year", cast(month(ts) AS INTEGER) AS "month" FROM dec)"""


TYPED = _typed(9999, 99999, 999999)
_TYPED_OUT = """SELECT STATION, "DATE", LATITUDE, LONGITUDE, ELEVATION, round(TMP_C, 6) AS TMP_C,
  round(DEW_C, 6) AS DEW_C, round("SLP_hPa", 6) AS "SLP_hPa", VIS_m, round(RH_pct, 6) AS RH_pct,
  "year", "month" FROM typed"""


def _hash(text: str, digits: int = 8) -> str:
    return f"cast('0x' || substr(md5({text}), 1, {digits}) AS BIGINT)"


_ID = "cast(event_id AS VARCHAR)"
PARTS = f"""{CLEAN},
parts AS (SELECT *, CASE WHEN {_hash(_ID)} % 100 < 70 THEN 'train' ELSE 'test' END AS part FROM clean),
train AS (SELECT * FROM parts WHERE part = 'train'),
test AS (SELECT * FROM parts WHERE part = 'test')"""


# ------------------------------------------------------- sources and sinks ---
_RAW_LIST = "STATION, DATE, LATITUDE, LONGITUDE, ELEVATION, WND, CIG, VIS, TMP, DEW, SLP"
ORACLES["raw_projection"] = f"WITH {FEED} SELECT {_RAW_LIST} FROM feed"
_CSV_ELEVATION = "CASE WHEN RH IS NULL THEN ELEVATION END"
ORACLES["read_raw_csv"] = (
    f"WITH {FEED} SELECT STATION, DATE, LATITUDE, LONGITUDE, {_CSV_ELEVATION} AS ELEVATION, "
    "WND, CIG, VIS, TMP, DEW, SLP FROM feed"
)
ORACLES["read_raw_layouts"] = f"""WITH {FEED} SELECT STATION, DATE, LATITUDE, LONGITUDE,
  CASE WHEN event_id % 3 <> 1 THEN ELEVATION END AS ELEVATION, WND, CIG, VIS, TMP,
  CASE WHEN event_id % 3 <> 2 THEN DEW END AS DEW, SLP FROM feed"""
ORACLES["typed_scan"] = f"""WITH {FEED}
SELECT STATION, cast(DATE AS TIMESTAMP) AS "DATE", cast(LATITUDE AS DOUBLE) AS LATITUDE,
  cast(LONGITUDE AS DOUBLE) AS LONGITUDE, cast({_CSV_ELEVATION} AS DOUBLE) AS ELEVATION,
  cast(RH AS DOUBLE) AS RH, cast(year(cast(DATE AS TIMESTAMP)) AS INTEGER) AS "year",
  cast(month(cast(DATE AS TIMESTAMP)) AS INTEGER) AS "month" FROM feed"""
ORACLES["row_count"] = f"WITH {FEED} SELECT count(*) AS n FROM feed"
ORACLES["cleanse"] = f"WITH {CLEAN} SELECT * FROM clean"
ORACLES["parquet_roundtrip"] = ORACLES["cleanse"]
ORACLES["csv_roundtrip"] = ORACLES["cleanse"]
ORACLES["spread_rows"] = ORACLES["cleanse"]
ORACLES["head_rows"] = f"{ORACLES['cleanse']} ORDER BY event_id LIMIT 20"
ORACLES["alpha_labels"] = """SELECT DISTINCT cast(l_discount AS DOUBLE) AS weight,
  'a' || replace(CASE WHEN l_discount = floor(l_discount) THEN cast(cast(l_discount AS BIGINT) AS VARCHAR)
    ELSE rtrim(cast(cast(l_discount AS DOUBLE) AS VARCHAR), '0') END, '.', 'p') AS label FROM lineitem"""
ORACLES["typed_humidity"] = f"WITH {TYPED} {_TYPED_OUT}"
ORACLES["typed_humidity_compat"] = f"WITH {_typed(-9999, -9999, -999999)} {_TYPED_OUT}"
ORACLES["partitioned_roundtrip"] = ORACLES["typed_humidity"]
ORACLES["compact"] = ORACLES["typed_humidity"]
ORACLES["compact_incremental"] = f"""SELECT "year", "month", "month" > 3 AS kept, true AS few, count(*) AS n
FROM ({ORACLES['typed_humidity']}) GROUP BY "year", "month\""""
ORACLES["one_hot_dictionary"] = """SELECT value, row_number() OVER (ORDER BY value) - 1 AS slot, n FROM (
  SELECT cast(l_orderkey AS VARCHAR) AS value, count(*) AS n FROM lineitem GROUP BY 1)"""
ORACLES["partition_pruned"] = ORACLES["typed_humidity"] + ' WHERE "month" IN (2, 7)'
ORACLES["ingest_counts"] = "SELECT count(*) AS rows_written, count(*) AS rows_stored FROM events"

# ------------------------------------------------- columns and expressions ---
for _name, _fields in {
    "split_wnd": ["WND"], "split_cig": ["CIG"], "split_vis": ["VIS"],
    "split_tmp_dew_slp": ["TMP", "DEW", "SLP"],
}.items():
    ORACLES[_name] = f"WITH {FEED} SELECT event_id, {_token_list(*_fields)} FROM feed"
ORACLES["cast_geo"] = f"""WITH {FEED}
SELECT event_id, try_cast(STATION AS INTEGER) AS STATION, cast(LATITUDE AS DOUBLE) AS LATITUDE,
  cast(LONGITUDE AS DOUBLE) AS LONGITUDE, cast(ELEVATION AS DOUBLE) AS ELEVATION FROM feed"""
ORACLES["scale_units"] = f"""WITH {TOKENS}
SELECT event_id, cast(WND_DIR_DEG AS DOUBLE) AS WND_DIR_DEG,
  cast(WND_SPD_RAW AS DOUBLE) / 10.0 AS WND_SPD_MS, cast(CIG_HEIGHT_M AS DOUBLE) AS CIG_HEIGHT_M,
  cast(VIS_DIST_M AS DOUBLE) AS VIS_DIST_M, cast(TMP_RAW AS DOUBLE) / 10.0 AS TMP_C,
  cast(DEW_RAW AS DOUBLE) / 10.0 AS DEW_C, cast(SLP_RAW AS DOUBLE) / 10.0 AS "SLP_hPa" FROM tok"""
ORACLES["calendar_parts"] = f"""WITH {FEED}, ts AS (SELECT event_id, {_DATE} AS d FROM feed)
SELECT event_id, d AS "DATE", cast(year(d) AS INTEGER) AS "year",
  cast(month(d) AS INTEGER) AS "month", cast(day(d) AS INTEGER) AS "day",
  cast(hour(d) AS INTEGER) AS "hour" FROM ts"""
ORACLES["tenths_decode"] = f"""WITH {FEED} SELECT event_id, {_tenths('TMP', 9999)} AS TMP,
  {_tenths('DEW', 9999)} AS DEW, {_tenths('SLP', 99999)} AS SLP,
  {_tenths('TMP', -9999)} AS "TMP_compat", {_tenths('DEW', -9999)} AS "DEW_compat",
  {_tenths('SLP', -9999)} AS "SLP_compat" FROM feed"""
ORACLES["vis_decode"] = f"""WITH {FEED}, v AS (SELECT event_id, {_first_int('VIS')} AS v FROM feed)
SELECT event_id, CASE WHEN v <> 999999 THEN v END AS VIS_m,
  CASE WHEN v <> -999999 THEN v END AS "VIS_compat" FROM v"""
ORACLES["relative_humidity"] = f"""WITH {FEED}, dec AS (
  SELECT event_id, RH, {_tenths('TMP', 9999)} AS t, {_tenths('DEW', 9999)} AS td FROM feed)
SELECT event_id, round({_MAGNUS}, 6) AS magnus, round({_HUMIDITY}, 6) AS RH_pct FROM dec"""

# -------------------------------------------------------- filters, cleanse ---
ORACLES["missing_rule_counts"] = f"WITH {TOKENS} " + " UNION ALL ".join(
    [f"SELECT '{n}' AS rule, count(*) FILTER ({r}) AS n FROM tok" for n, r in _RULES.items()]
    + [f"SELECT 'absent_token' AS rule, count(*) FILTER (({_MISSING}) IS NULL) AS n FROM tok"]
)
ORACLES["drop_missing"] = f"WITH {TOKENS} SELECT * FROM tok WHERE NOT ({_MISSING})"
ORACLES["qc_filter"] = f"WITH {TOKENS} SELECT * FROM tok WHERE {_ACCEPTED}"
ORACLES["cleanse_funnel"] = f"""WITH {TOKENS}
SELECT 'raw' AS stage, count(*) AS n FROM tok
UNION ALL SELECT 'not_missing', count(*) FROM tok WHERE NOT ({_MISSING})
UNION ALL SELECT 'accepted', count(*) FROM tok WHERE NOT ({_MISSING}) AND {_ACCEPTED}"""
ORACLES["cleanse_variable_wind"] = f"""WITH {CLEAN}
SELECT event_id, try_cast(STATION AS INTEGER) AS STATION,
  nullif(WND_DIR_DEG, 999.0) AS WND_DIR_DEG, WND_TYPE FROM clean"""


# --------------------------------------------------------------- profiling ---
def _q(name: str) -> str:
    return f'"{name}"'


def _null_counts(table: str, columns: Sequence[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({_q(c)} IS NULL) AS null_count FROM {table}"
        for c in columns
    )


def _describe(table: str, columns: Sequence[str], digits: int) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({_q(c)}) AS "count",
  round(avg({_q(c)}), {digits}) AS "mean", round(stddev_samp({_q(c)}), {digits}) AS "stddev",
  round(min({_q(c)}), {digits}) AS "min", round(max({_q(c)}), {digits}) AS "max" FROM {table}"""
        for c in columns
    )


def _correlations(table: str, columns: Sequence[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, round(corr({_q(a)}, {_q(b)}), 6) AS corr FROM {table}"
        for a in columns
        for b in columns
    )


def _histogram(table: str, columns: Sequence[str], bins: int) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", cast(b AS INTEGER) AS "bin",
  round(lo + b * (hi - lo) / {bins}, 6) AS lo, round(lo + (b + 1) * (hi - lo) / {bins}, 6) AS hi,
  (SELECT count(*) FROM {table} WHERE least(cast(floor(({_q(c)} - lo) / ((hi - lo) / {bins})) AS INTEGER), {bins - 1}) = b) AS n
FROM (SELECT min({_q(c)}) AS lo, max({_q(c)}) AS hi FROM {table}), (SELECT unnest(range({bins})) AS b)"""
        for c in columns
    )


_LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_FEED_COLUMNS = ["event_id", *_RAW_LIST.split(", "), "RH"]
_TYPED_COLUMNS = [
    "STATION", "DATE", "LATITUDE", "LONGITUDE", "ELEVATION", "TMP_C", "DEW_C", "SLP_hPa",
    "VIS_m", "RH_pct", "year", "month",
]
ORACLES["null_counts"] = f"WITH {FEED} {_null_counts('feed', _FEED_COLUMNS)}"
ORACLES["describe_numeric"] = f"WITH {CLEAN} {_describe('clean', PROFILE_COLUMNS, 6)}"
ORACLES["describe_lineitem"] = _describe("lineitem", _LINE, 4)
for _part in ("hour", "month"):
    ORACLES[f"avg_by_{_part}"] = (
        f'WITH {CLEAN} SELECT "{_part}", round(avg(TMP_C), 6) AS avg_tmp FROM clean GROUP BY "{_part}"'
    )
ORACLES["distinct_months"] = f'WITH {TYPED} SELECT DISTINCT "year", "month" FROM typed'
ORACLES["correlation_matrix"] = f"WITH {CLEAN} {_correlations('clean', CORRELATION_COLUMNS)}"
ORACLES["correlation_lineitem"] = _correlations("lineitem", _LINE)
ORACLES["histogram"] = f"WITH {CLEAN} {_histogram('clean', CORRELATION_COLUMNS, 30)}"
ORACLES["histogram_lineitem"] = _histogram("lineitem", ["l_quantity", "l_extendedprice"], 40)
ORACLES["geo_points"] = f"""WITH {CLEAN} SELECT LATITUDE, LONGITUDE, count(*) AS n FROM clean
WHERE LATITUDE IS NOT NULL AND LONGITUDE IS NOT NULL GROUP BY LATITUDE, LONGITUDE"""
ORACLES["top_k"] = f"""WITH {TYPED}, nulls AS ({_null_counts('typed', _TYPED_COLUMNS)})
SELECT "column", null_count,
  cast(row_number() OVER (ORDER BY null_count DESC, "column") AS INTEGER) AS "rank"
FROM nulls ORDER BY null_count DESC, "column" LIMIT 5"""

# ---------------------------------------------------- sampling and splits ---
ORACLES["sample_n"] = f"""WITH {CLEAN} SELECT * FROM clean
ORDER BY {_hash("'42' || " + _ID, 13)}, event_id LIMIT 300"""
_LINE_ID = "concat_ws('|', l_orderkey, l_linenumber)"
ORACLES["sample_n_lineitem"] = f"""SELECT DISTINCT l_orderkey, l_linenumber,
  {_hash("'42' || " + _LINE_ID, 13)} AS h FROM lineitem
ORDER BY h, l_orderkey, l_linenumber LIMIT 2500"""
ORACLES["sample_n_lineitem"] = (
    f"SELECT l_orderkey, l_linenumber FROM ({ORACLES['sample_n_lineitem']})"
)
_GAPPY = "CASE WHEN l_linenumber <> 1 THEN l_orderkey END"
_K = f"coalesce(cast({_GAPPY} AS VARCHAR), '<null>')"
ORACLES["keyed_split_nulls"] = f"""SELECT part, fold, is_validation, count(*) AS n,
  sum(l_quantity) AS quantity FROM (SELECT l_quantity,
    CASE WHEN {_hash(f"concat_ws('|', {_K}, l_suppkey)")} % 100 < 70 THEN 'train' ELSE 'test' END AS part,
    cast({_hash(f"'fold' || {_K}")} % 3 AS INTEGER) AS fold,
    {_hash(f"'validation' || {_K}")} % 100 < 15 AS is_validation FROM lineitem) GROUP BY ALL"""
ORACLES["sample_n_nulls"] = f"""SELECT {_GAPPY} AS k, l_orderkey, l_linenumber FROM lineitem
ORDER BY {_hash(f"'42' || concat_ws('|', {_K}, l_orderkey, l_linenumber)", 13)} LIMIT 2500"""
ORACLES["sample_n_ties"] = f"""SELECT l_suppkey, l_orderkey, l_linenumber FROM lineitem
ORDER BY {_hash("'42' || cast(l_suppkey AS VARCHAR)", 13)},
  {_hash("'row' || concat_ws('|', l_suppkey, l_orderkey, l_linenumber)", 13)} LIMIT 2500"""
ORACLES["sample_share"] = (
    f"WITH {CLEAN} SELECT count(*) AS n, cast(sum(event_id) AS BIGINT) AS id_sum, "
    "true AS share_ok FROM clean"
)
_ODD = """odd AS (SELECT CASE l_linenumber WHEN 1 THEN 'nan'::DOUBLE WHEN 2 THEN 'inf'::DOUBLE
  WHEN 3 THEN '-inf'::DOUBLE ELSE cast(l_extendedprice / l_quantity AS DOUBLE) END AS unit_price
  FROM lineitem), finite AS (SELECT unit_price FROM odd WHERE isfinite(unit_price))"""
ORACLES["histogram_non_finite"] = f"WITH {_ODD} {_histogram('finite', ['unit_price'], 20)}"
ORACLES["non_finite_counts"] = f"""WITH {_ODD} SELECT 'unit_price' AS "column",
  count(*) FILTER (isnan(unit_price)) AS n_nan, count(*) FILTER (isinf(unit_price)) AS n_inf,
  round(min(unit_price) FILTER (isfinite(unit_price)), 6) AS lo,
  round(max(unit_price) FILTER (isfinite(unit_price)), 6) AS hi FROM odd"""
ORACLES["quantiles_refined"] = " UNION ALL ".join(
    f"SELECT cast({p} AS DOUBLE) AS p, cast(quantile_disc(l_extendedprice, {p}) AS DOUBLE) AS x FROM lineitem"
    for p in (0.01, 0.25, 0.5, 0.9, 0.999)
)
ORACLES["random_split"] = (
    f"WITH {CLEAN} SELECT count(*) AS n, cast(sum(event_id) AS BIGINT) AS id_sum, "
    "true AS share_ok FROM clean"
)
ORACLES["keyed_split"] = f"WITH {PARTS} SELECT event_id, part, TMP_C FROM parts"
ORACLES["split_tables"] = ORACLES["keyed_split"]
ORACLES["keyed_split_lineitem"] = f"""SELECT part, count(*) AS n, sum(l_quantity) AS quantity FROM (
  SELECT l_quantity, CASE WHEN {_hash(_LINE_ID)} % 100 < 70 THEN 'train' ELSE 'test' END AS part
  FROM lineitem) GROUP BY part"""
ORACLES["validation_flag"] = (
    f"WITH {CLEAN} SELECT event_id, "
    + _hash("'validation' || " + _ID)
    + " % 100 < 15 AS is_validation FROM clean"
)
ORACLES["kfold_assign"] = (
    f"WITH {CLEAN} SELECT event_id, cast("
    + _hash("'fold' || " + _ID)
    + " % 3 AS INTEGER) AS fold FROM clean"
)

# ---------------------------------------------------------------- features ---
ORACLES["impute_median"] = f"""WITH {TYPED}, med AS (
  SELECT quantile_disc(TMP_C, 0.5) AS mt, quantile_disc(DEW_C, 0.5) AS md,
    quantile_disc("SLP_hPa", 0.5) AS ms FROM typed)
SELECT STATION, "DATE", TMP_C, DEW_C, "SLP_hPa", coalesce(TMP_C, mt) AS "TMP_C_imp",
  coalesce(DEW_C, md) AS "DEW_C_imp", coalesce("SLP_hPa", ms) AS "SLP_hPa_imp" FROM typed, med"""
ORACLES["impute_mode"] = f"""WITH {TOKENS}, best AS (
  SELECT WND_TYPE AS m FROM tok WHERE WND_TYPE IS NOT NULL
  GROUP BY WND_TYPE ORDER BY count(*) DESC, WND_TYPE LIMIT 1)
SELECT event_id, coalesce(WND_TYPE, m) AS WND_TYPE FROM tok, best"""
_WIND_TYPES = ["9", "C", "N", "V"]
ORACLES["one_hot"] = f"WITH {TOKENS} SELECT event_id, " + ", ".join(
    f"cast(coalesce(WND_TYPE = '{v}', false) AS INTEGER) AS \"WND_TYPE={v}\"" for v in _WIND_TYPES
) + " FROM tok"
ORACLES["one_hot_lineitem"] = "SELECT " + ", ".join(
    f"count(*) FILTER (l_returnflag = '{v}') AS \"l_returnflag={v}\"" for v in ("A", "N", "R")
) + " FROM lineitem"
ORACLES["standardize"] = f"WITH {CLEAN} SELECT event_id, " + ", ".join(
    f"round(({_q(c)} - avg({_q(c)}) OVER ()) / stddev_samp({_q(c)}) OVER (), 6) + 0.0 AS {_q(c)}"
    for c in LINEAR_FEATURES
) + " FROM clean"
_PREPARED = [
    "year", "month", "day", "hour", "LATITUDE", "LONGITUDE", "ELEVATION", "WND_DIR_DEG",
    "WND_SPD_MS", "CIG_HEIGHT_M", "VIS_DIST_M", "DEW_C", "SLP_hPa",
]
_STATION = "try_cast(STATION AS BIGINT)"
ORACLES["prepare_features"] = f"WITH {PARTS} SELECT event_id, " + ", ".join(
    [f"cast(coalesce({_STATION}, (SELECT quantile_disc({_STATION}, 0.5) FROM train)) AS DOUBLE) AS STATION"]
    + [f"cast({_q(c)} AS DOUBLE) AS {_q(c)}" for c in _PREPARED]
    + [f"cast(WND_TYPE = '{v}' AS DOUBLE) AS \"WND_TYPE={v}\"" for v in _WIND_TYPES]
) + " FROM test"


_FILLED = {
    "STATION": _STATION,
    **{c: _q(c) for c in ("LATITUDE", "LONGITUDE", "ELEVATION", "TMP_C", "DEW_C", "SLP_hPa", "VIS_m", "year", "month")},
}
ORACLES["prepare_features_nulls"] = f"""WITH {TYPED},
med AS (SELECT {', '.join(f'quantile_disc({x}, 0.5) AS {_q(c)}' for c, x in _FILLED.items())} FROM typed)
SELECT count(*) AS n, {', '.join(f'round(cast(sum(coalesce(t.{x}, med.{_q(c)})) AS DOUBLE), 3) AS {_q(c)}' for c, x in _FILLED.items()).replace('t.try_cast(STATION', 'try_cast(t.STATION')}
FROM typed t, med"""

# ------------------------------------------------------------------ models ---
def _solved(
    table: str, features: Sequence[str], label: str, penalty: str = "0.0", tag: str = ""
) -> str:
    """One-row tables that end in ``fit``: the slopes w1.. on standardised features.

    ``g`` holds the correlations plus the penalty on the diagonal; step k clears
    column k below the diagonal; the slopes then follow from the last to the first.
    """
    p = len(features)
    idx = range(1, p + 1)
    x = {i: _q(f) for i, f in zip(idx, features)}
    cells = [f"corr({x[i]}, {x[j]}) AS g0_{i}_{j}" for i in idx for j in idx if i < j]
    cells += [f"1.0 + {penalty} AS g0_{i}_{i}" for i in idx]
    cells += [f"corr({x[i]}, {_q(label)}) AS c0_{i}" for i in idx]
    cells += [f"avg({x[i]}) AS m_{i}, stddev_pop({x[i]}) AS s_{i}" for i in idx]
    cells += [
        f"stddev_samp({x[i]}) AS t_{i}" for i in idx
    ] + [f"avg({_q(label)}) AS my, stddev_pop({_q(label)}) AS sy, count(*) AS n"]
    chain = [f"e{tag}0 AS (SELECT {', '.join(cells)} FROM {table})"]
    for k in range(1, p):
        a = k - 1
        new = []
        for i in range(k + 1, p + 1):
            f = f"g{a}_{k}_{i} / g{a}_{k}_{k}"
            new += [f"g{a}_{i}_{j} - {f} * g{a}_{k}_{j} AS g{k}_{i}_{j}" for j in range(i, p + 1)]
            new.append(f"c{a}_{i} - {f} * c{a}_{k} AS c{k}_{i}")
        chain.append(f"e{tag}{k} AS (SELECT *, {', '.join(new)} FROM e{tag}{a})")
    last = f"e{tag}{p - 1}"
    for k in range(p, 0, -1):
        a = k - 1
        rest = "".join(f" - g{a}_{k}_{j} * w_{j}" for j in range(k + 1, p + 1))
        chain.append(f"b{tag}{k} AS (SELECT *, (c{a}_{k}{rest}) / g{a}_{k}_{k} AS w_{k} FROM {last})")
        last = f"b{tag}{k}"
    chain.append(f"fit{tag} AS (SELECT * FROM {last})")
    return ",\n".join(chain)


def _slope(i: int) -> str:
    return f"(w_{i} * sy / s_{i})"


def _intercept(p: int) -> str:
    return "(my" + "".join(f" - {_slope(i)} * m_{i}" for i in range(1, p + 1)) + ")"


def _prediction(features: Sequence[str]) -> str:
    terms = "".join(f" + {_slope(i)} * {_q(f)}" for i, f in enumerate(features, 1))
    return _intercept(len(features)) + terms


def _coefficient_rows(
    features: Sequence[str], values: Sequence[str], intercept: str, digits: int = 6
) -> str:
    rows = [
        f"SELECT '{f}' AS feature, round({v}, {digits}) + 0.0 AS coefficient FROM fit"
        for f, v in zip(features, values)
    ]
    rows.append(
        f"SELECT '(intercept)' AS feature, round({intercept}, {digits}) AS coefficient FROM fit"
    )
    return " UNION ALL ".join(rows)


_P = len(LINEAR_FEATURES)
_OLS = _solved("train", LINEAR_FEATURES, "TMP_C")
ORACLES["ols_fit"] = f"WITH {PARTS}, {_OLS} " + _coefficient_rows(
    LINEAR_FEATURES, [_slope(i) for i in range(1, _P + 1)], _intercept(_P)
)
_LINE_X = ["l_quantity", "l_discount", "l_tax"]
ORACLES["ols_fit_lineitem"] = f"WITH {_solved('lineitem', _LINE_X, 'l_extendedprice')} " + (
    _coefficient_rows(_LINE_X, [_slope(i) for i in (1, 2, 3)], _intercept(3), 3)
)


def _ridge_penalty(lam: float) -> str:
    # Features have sample deviation 1, so population variance (n - 1) / n; the
    # penalty is divided by the population deviation of the label.
    return f"{lam} / stddev_pop(TMP_C) * count(*) / (count(*) - 1)"


def _ridge(lam: float) -> tuple[str, list[str]]:
    values = [f"(w_{i} * sy * t_{i} / s_{i})" for i in range(1, _P + 1)]
    return _solved("train", LINEAR_FEATURES, "TMP_C", _ridge_penalty(lam)), values


_RIDGE_SQL, _RIDGE_VALUES = _ridge(0.3)
ORACLES["ridge_fit"] = f"WITH {PARTS}, {_RIDGE_SQL} " + _coefficient_rows(
    LINEAR_FEATURES, _RIDGE_VALUES, "my"
)


def _descent(table: str, candidates: Sequence[tuple[float, float]], sweeps: int = 150) -> str:
    """Tables that end in ``fit``: slopes ``w`` on standardised features per (alpha, lam).

    One step solves for one coordinate with the others held; ``g`` and ``c`` are covariances of
    the standardised features with each other and with the label.
    """
    x = [_q(f) for f in LINEAR_FEATURES]
    dev = [f"stddev_samp({i})" for i in x]
    g = ", ".join(
        "[" + ", ".join(f"covar_pop({a}, {b}) / ({s} * {t})" for b, t in zip(x, dev)) + "]"
        for a, s in zip(x, dev)
    )
    c = ", ".join(f"covar_pop({a}, TMP_C) / {s}" for a, s in zip(x, dev))
    means = ", ".join(f"avg({a}) AS m_{i}, {s} AS t_{i}" for i, (a, s) in enumerate(zip(x, dev), 1))
    tried = ", ".join(f"({a}, {r})" for a, r in candidates)
    return f"""mom AS (SELECT [{g}] AS g, [{c}] AS c, avg(TMP_C) AS my, stddev_pop(TMP_C) AS sy, {means} FROM {table}),
tried(alpha, lam) AS (VALUES {tried}),
steps AS (SELECT cast(alpha AS DOUBLE) AS alpha, cast(lam AS DOUBLE) AS lam, 0 AS k,
    cast(list_transform(range({_P}), lambda i: 0.0) AS DOUBLE[]) AS w FROM tried
  UNION ALL
  SELECT alpha, lam, k + 1, list_transform(w, lambda v, i: CASE WHEN i = j THEN
      sign(r) * greatest(abs(r) - lam * alpha, 0.0) / (gj + lam * (1 - alpha) / sy) ELSE v END)
  FROM (SELECT alpha, lam, k, w, sy, j, g[j][j] AS gj,
      c[j] - list_inner_product(g[j], w) + g[j][j] * w[j] AS r
    FROM (SELECT *, k % {_P} + 1 AS j FROM steps WHERE k < {_P * sweeps}), mom)),
fit AS (SELECT alpha, lam, w, mom.* FROM steps, mom WHERE k = {_P * sweeps})"""


def _shrunk(lam: float, alpha: float) -> str:
    return f"WITH RECURSIVE {PARTS}, {_descent('train', [(alpha, lam)])} " + _coefficient_rows(
        LINEAR_FEATURES, [f"w[{i}]" for i in range(1, _P + 1)], "my", 4
    )


ORACLES["lasso_fit"] = _shrunk(0.1, 1.0)
ORACLES["enet_fit"] = _shrunk(0.1, 0.5)

# fixed values: penalties tried for each mixing weight
_RIDGE_PENALTIES = (1e-6, 1e-5, 1e-4, 1e-3, 3e-3, 1e-2, 3e-2, 1e-1, 3e-1, 1.0)
_OTHER_PENALTIES = (1e-5, 1e-4, 1e-3, 3e-3, 1e-2, 3e-2, 1e-1)


def _path() -> str:
    tried = [(0.0, r) for r in _RIDGE_PENALTIES]
    tried += [(a, r) for a in (0.25, 0.5, 0.75, 1.0) for r in _OTHER_PENALTIES]
    terms = " + ".join(f"w[{i}] * ({_q(f)} - m_{i}) / t_{i}" for i, f in enumerate(LINEAR_FEATURES, 1))
    return f"""WITH RECURSIVE {PARTS},
flagged AS (SELECT *, {_hash("'validation' || " + _ID)} % 100 < 20 AS v FROM train),
fitted AS (SELECT * FROM flagged WHERE NOT v), held AS (SELECT * FROM flagged WHERE v),
{_descent('fitted', tried)}
SELECT alpha, lam AS reg_param, round(sqrt(avg(power(TMP_C - (my + {terms}), 2))), 4) AS rmse
FROM fit, held GROUP BY alpha, lam"""


ORACLES["regularization_path"] = _path()


def _curve() -> str:
    chains, means = [], []
    for i in range(6):
        share = 0.1 + 0.9 / 5 * i
        rows = f"least(n_all, greatest(50, cast(floor(n_all * {share} + 1e-9) AS BIGINT)))"
        chains.append(f"sub{i} AS (SELECT * FROM ranked WHERE rn <= {rows})")
        parts = []
        for k in range(3):
            tag = f"c{i}{k}"
            chains.append(
                f"t{tag} AS (SELECT * FROM sub{i} WHERE fold <> {k}), "
                + _solved(f"t{tag}", LINEAR_FEATURES, "TMP_C", tag=tag)
            )
            error = f"power(TMP_C - ({_prediction(LINEAR_FEATURES)}), 2)"
            parts.append(
                f"SELECT sqrt(avg({error}) FILTER (fold <> {k})) AS tr, "
                f"sqrt(avg({error}) FILTER (fold = {k})) AS va, count(*) AS n FROM sub{i}, fit{tag}"
            )
        means.append(
            "SELECT max(n) AS size, round(avg(tr), 6) AS train_rmse, round(avg(va), 6) AS val_rmse"
            f" FROM ({' UNION ALL '.join(parts)})"
        )
    return f"""WITH {PARTS}, ranked AS (SELECT *, {_hash("'fold42' || " + _ID)} % 3 AS fold,
  row_number() OVER (ORDER BY {_hash("'42' || " + _ID, 13)}, event_id) AS rn,
  count(*) OVER () AS n_all FROM train), {', '.join(chains)} {' UNION ALL '.join(means)}"""


ORACLES["learning_curve"] = _curve()


def _stump(table: str, y: str, tag: str) -> str:
    """The split of the hour that lowers the variance most, and its two means."""
    return f"""g{tag} AS (SELECT "hour" AS h, count(*) AS n, sum({y}) AS s FROM {table} GROUP BY "hour"),
c{tag} AS (SELECT a.h + 0.5 * (lead(a.h) OVER (ORDER BY a.h) - a.h) AS cut,
    sum(n) OVER w AS ln, sum(s) OVER w AS ls, sum(n) OVER () AS an, sum(s) OVER () AS s_all
  FROM g{tag} a WINDOW w AS (ORDER BY h)),
k{tag} AS (SELECT cut AS cut{tag}, ls / ln AS lo{tag}, (s_all - ls) / (an - ln) AS hi{tag}
  FROM c{tag} WHERE cut IS NOT NULL
  ORDER BY ls * ls / ln + (s_all - ls) * (s_all - ls) / (an - ln) DESC LIMIT 1)"""


# The second tree is grown on the gradient of the squared error, twice the residual.
ORACLES["gbt_stumps"] = f"""WITH {PARTS}, {_stump('train', 'TMP_C', '1')},
second AS (SELECT "hour",
  2 * (TMP_C - CASE WHEN "hour" <= cut1 THEN lo1 ELSE hi1 END) AS r FROM train, k1),
{_stump('second', 'r', '2')}
SELECT event_id, "hour", round(CASE WHEN "hour" <= cut1 THEN lo1 ELSE hi1 END
  + 0.3 * CASE WHEN "hour" <= cut2 THEN lo2 ELSE hi2 END, 6) AS prediction FROM test, k1, k2"""

def _split(table: str, y: str, tag: str, features: Sequence[str] = ("hour", "month")) -> str:
    """One row: the feature and cut that lower the squared error most, the two means, the gain."""
    parts = []
    for i, f in enumerate(features):
        parts.append(f"""SELECT {i} AS i, v + 0.5 * (lead(v) OVER w - v) AS cut, sum(n) OVER w AS ln, sum(s) OVER w AS ls,
  sum(n) OVER () AS an, sum(s) OVER () AS total FROM (
    SELECT {_q(f)} AS v, count(*) AS n, sum({y}) AS s FROM {table} GROUP BY 1) WINDOW w AS (ORDER BY v)""")
    return f"""{tag} AS (SELECT i AS i{tag}, cut AS cut{tag}, ls / ln AS lo{tag}, (total - ls) / (an - ln) AS hi{tag},
  ls * ls / ln + (total - ls) * (total - ls) / (an - ln) - total * total / an AS gain{tag}
FROM ({' UNION ALL '.join(parts)}) WHERE cut IS NOT NULL ORDER BY gain{tag} DESC, i LIMIT 1)"""


def _goes_left(tag: str) -> str:
    return f'(CASE i{tag} WHEN 0 THEN "hour" ELSE "month" END <= cut{tag})'


_TREE = f"""{PARTS}, {_split('train', 'TMP_C', 'k0')},
left_rows AS (SELECT train.* FROM train, k0 WHERE {_goes_left('k0')}),
right_rows AS (SELECT train.* FROM train, k0 WHERE NOT {_goes_left('k0')}),
{_split('left_rows', 'TMP_C', 'k1')}, {_split('right_rows', 'TMP_C', 'k2')}"""
ORACLES["rf_tree"] = f"""WITH {_TREE} SELECT event_id, "hour", "month", round(CASE WHEN {_goes_left('k0')}
  THEN CASE WHEN {_goes_left('k1')} THEN lok1 ELSE hik1 END
  ELSE CASE WHEN {_goes_left('k2')} THEN lok2 ELSE hik2 END END, 6) AS prediction FROM test, k0, k1, k2"""


def _gain_shares(tags: Sequence[str]) -> str:
    of = lambda i: " + ".join(f"CASE WHEN i{t} = {i} THEN gain{t} ELSE 0 END" for t in tags)
    total = " + ".join(f"gain{t}" for t in tags)
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, round(({of(i)}) / ({total}), 6) + 0.0 AS importance FROM {', '.join(tags)}"
        for i, f in enumerate(("hour", "month"))
    )


ORACLES["rf_tree_importance"] = f"WITH {_TREE} {_gain_shares(['k0', 'k1', 'k2'])}"
ORACLES["gbt_stumps_importance"] = f"""WITH {PARTS}, {_split('train', 'TMP_C', 'k0')},
second AS (SELECT "hour", "month", 2 * (TMP_C - CASE WHEN {_goes_left('k0')} THEN lok0 ELSE hik0 END) AS r
  FROM train, k0), {_split('second', 'r', 'k1')} {_gain_shares(['k0', 'k1'])}"""


def _patience(rounds: int = 5, rate: float = 0.9, patience: int = 2) -> str:
    """Loss per round on the marked rows; rounds up to the least loss before the stop stay."""
    tables, gone = [], []
    at = '"hour"'
    for k in range(rounds):
        label = "TMP_C" if k == 0 else "r"
        tables.append(_split(f"r{k}", label, f"k{k}", ["hour"]))
        step = f"CASE WHEN {at} <= cutk{k} THEN lok{k} ELSE hik{k} END"
        weight = 1.0 if k == 0 else rate
        tables.append(
            f'r{k + 1} AS (SELECT TMP_C, {at}, f + {weight} * {step} AS f, '
            f"2 * (TMP_C - f - {weight} * {step}) AS r FROM r{k}, k{k})"
        )
        tables.append(
            f"h{k + 1} AS (SELECT TMP_C, {at}, f + {weight} * {step} AS f FROM h{k}, k{k})"
        )
        gone.append(f"SELECT {k + 1} AS \"round\", avg(power(TMP_C - f, 2)) AS loss FROM h{k + 1}")
    return f"""WITH {PARTS},
flagged AS (SELECT *, {_hash("'validation' || " + _ID)} % 100 < 15 AS v FROM train),
r0 AS (SELECT TMP_C, {at}, 0.0 AS f, TMP_C AS r FROM flagged WHERE NOT v),
h0 AS (SELECT TMP_C, {at}, 0.0 AS f FROM flagged WHERE v), {', '.join(tables)},
losses AS ({' UNION ALL '.join(gone)}),
best AS (SELECT *, arg_min("round", loss) OVER (ORDER BY "round") AS so_far FROM losses),
stop AS (SELECT coalesce(min("round"), {rounds}) AS last FROM best WHERE "round" - so_far >= {patience})
SELECT cast("round" AS INTEGER) AS "round", round(loss, 6) AS loss,
  "round" <= (SELECT so_far FROM best, stop WHERE "round" = last) AS kept FROM losses"""


ORACLES["gbt_patience"] = _patience()


def _boosted(
    rows: str, models: Sequence[dict], features: Sequence[str], rounds: int, depth: int = 1
) -> str:
    """Tables ``r<k>`` with the margin ``f`` of every row and model after k rounds, and ``s<k>_<l>``
    with the splits of level l. ``rows`` gives m, event_id, y, role and the features."""
    params = ", ".join(
        f"({m}, {p['learning_rate']!r}, {float(p['reg_lambda'])!r}, {float(p['reg_alpha'])!r}, {float(p['gamma'])!r}, "
        f"{float(p['min_child_weight'])!r}, {p['n_estimators']})" for m, p in enumerate(models)
    )
    names = ", ".join(_q(f) for f in features)
    tables = [
        f"params(m, rate, lam, alpha, gamma, least, rounds) AS (SELECT col0, col1::DOUBLE, col2::DOUBLE, col3::DOUBLE, "
        f"col4::DOUBLE, col5::DOUBLE, col6 FROM (VALUES {params}))",
        f"r0 AS MATERIALIZED (SELECT *, avg(y) FILTER (role = 1) OVER (PARTITION BY m) AS f FROM ({rows}))",
    ]
    score = lambda g, h: f"power(greatest(abs({g}) - alpha, 0), 2) / ({h} + lam)"
    for k in range(rounds):
        tables.append(f"n{k}_0 AS MATERIALIZED (SELECT *, 0 AS node FROM r{k})")
        for level in range(depth):
            cells = " UNION ALL ".join(
                f"SELECT m, node, {i} AS i, {_q(f)} AS v, sum(f - y) AS g, count(*) AS n FROM n{k}_{level} "
                f"WHERE role = 1 AND node >= {2**level - 1} GROUP BY m, node, v"
                for i, f in enumerate(features)
            )
            value = "CASE s.i " + " ".join(f"WHEN {i} THEN {_q(f)}" for i, f in enumerate(features)) + " END"
            tables.append(f"""s{k}_{level} AS MATERIALIZED (SELECT m, node, i, v, gain FROM (
  SELECT *, {score('gl', 'hl')} + {score('(g - gl)', '(h - hl)')} - {score('g', 'h')} AS gain FROM (
    SELECT m, node, i, v, sum(g) OVER w AS gl, sum(n) OVER w AS hl,
      sum(g) OVER (PARTITION BY m, node, i) AS g, sum(n) OVER (PARTITION BY m, node, i) AS h
    FROM ({cells}) WINDOW w AS (PARTITION BY m, node, i ORDER BY v)) JOIN params USING (m)
  WHERE hl >= least AND h - hl >= least AND h > hl)
WHERE gain > 1e-6 AND gain >= gamma QUALIFY row_number() OVER (PARTITION BY m, node ORDER BY gain DESC, i, v) = 1)""")
            tables.append(
                f"n{k}_{level + 1} AS MATERIALIZED (SELECT r.* EXCLUDE (node), CASE WHEN s.i IS NULL THEN r.node "
                f"WHEN {value} <= s.v THEN 2 * r.node + 1 ELSE 2 * r.node + 2 END AS node "
                f"FROM n{k}_{level} r LEFT JOIN s{k}_{level} s ON r.m = s.m AND r.node = s.node)"
            )
        tables.append(f"""w{k} AS MATERIALIZED (SELECT m, node, g, h, -sign(g) * greatest(abs(g) - alpha, 0) / (h + lam) AS w FROM (
  SELECT m, node, sum(f - y) AS g, count(*) AS h FROM n{k}_{depth} WHERE role = 1 GROUP BY m, node) JOIN params USING (m))""")
        tables.append(
            f"r{k + 1} AS MATERIALIZED (SELECT m, event_id, y, role, {names}, f + rate * w AS f "
            f"FROM n{k}_{depth} JOIN w{k} USING (m, node) JOIN params USING (m))"
        )
    return ", ".join(tables)


def _stopped(rounds: int, patience: int) -> str:
    """Table ``kept``: the rounds fitted and kept per model; ``losses`` has every round's sums."""
    losses = " UNION ALL ".join(
        f'SELECT m, {k} AS "round", avg(power(y - f, 2)) FILTER (role = 2) AS loss, '
        f"avg(power(y - f, 2)) FILTER (role IN (1, 2)) AS inside, "
        f"avg(power(y - f, 2)) FILTER (role = 3) AS outside FROM r{k} GROUP BY m"
        for k in range(1, rounds + 1)
    )
    return f"""losses AS MATERIALIZED (SELECT l.* FROM ({losses}) l JOIN params USING (m) WHERE "round" <= rounds),
best AS (SELECT *, arg_min("round", loss) OVER (PARTITION BY m ORDER BY "round") AS so_far FROM losses),
last AS (SELECT m, coalesce(min("round") FILTER ("round" - so_far >= {patience}), max("round")) AS fitted FROM best GROUP BY m),
kept AS (SELECT m, fitted, so_far AS kept FROM best JOIN last USING (m) WHERE "round" = fitted)"""


_PLAIN_PARAMS = {
    "learning_rate": 0.3, "reg_lambda": 1.0, "reg_alpha": 0.0, "gamma": 0.0, "min_child_weight": 1.0,
}
_REGULARISED = {**_PLAIN_PARAMS, "reg_alpha": 20.0, "gamma": 10500.0, "n_estimators": 2}
_BOTH = """SELECT 0 AS m, event_id, TMP_C AS y, CASE WHEN part = 'train' THEN 1 ELSE 0 END AS role, "hour", "month" FROM parts"""
_REGULARISED_SQL = f"WITH {PARTS}, {_boosted(_BOTH, [_REGULARISED], ['hour', 'month'], 2, 2)}"
ORACLES["gbt_regularised"] = (
    f"""{_REGULARISED_SQL} SELECT event_id, "hour", "month", round(f, 6) + 0.0 AS prediction FROM r2 WHERE role = 0"""
)


def _node_rows(rounds: int, depth: int, features: Sequence[str]) -> str:
    """Every node of the trees with its leaf weight, gain and rows."""
    name = "CASE s.i " + " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(features)) + " END"
    out = []
    for k in range(rounds):
        for level in range(depth + 1):
            split = f"LEFT JOIN s{k}_{level} s ON s.m = c.m AND s.node = c.node" if level < depth else "LEFT JOIN (SELECT NULL::INT AS m, NULL::INT AS node, NULL::INT AS i, NULL::DOUBLE AS gain) s ON false"
            out.append(f"""SELECT {k} AS tree, c.node, {name} AS feature,
  -sign(g) * greatest(abs(g) - alpha, 0) / (h + lam) AS value, coalesce(s.gain, 0.0) AS gain, h AS cover
FROM (SELECT m, node, sum(f - y) AS g, count(*) AS h FROM n{k}_{level} WHERE role = 1 AND node >= {2**level - 1} GROUP BY m, node) c
JOIN params p ON p.m = c.m {split}""")
    return " UNION ALL ".join(out)


ORACLES["gbt_nodes"] = f"""{_REGULARISED_SQL} SELECT tree::INTEGER AS tree, node::INTEGER AS node, feature,
  round(value, 4) + 0.0 AS value, round(gain, 4) + 0.0 AS gain, cover::DOUBLE AS cover FROM ({_node_rows(2, 2, ['hour', 'month'])})"""
_GAIN_FEATURES = ["hour", "month", "DEW_C"]
ORACLES["gbt_gain_importance"] = f"""WITH {PARTS}, {_boosted(
    "SELECT 0 AS m, event_id, TMP_C AS y, 1 AS role, hour, month, DEW_C FROM train",
    [{**_REGULARISED, "gamma": 0.0}], _GAIN_FEATURES, 3, 2)}
SELECT feature, round(avg(gain), 4) + 0.0 AS importance, row_number() OVER (ORDER BY avg(gain) DESC, feature)::INTEGER AS rank
FROM ({_node_rows(3, 2, _GAIN_FEATURES)}) WHERE feature IS NOT NULL GROUP BY feature"""

_FLAGGED = f"""flagged AS (SELECT *, {_hash("'validation' || " + _ID)} % 100 < 15 AS v FROM train)"""
_ROLE = "CASE WHEN v THEN 2 ELSE 1 END AS role"
ORACLES["gbt_patience_rounds"] = f"""WITH {PARTS}, {_FLAGGED}, {_boosted(
    f'SELECT 0 AS m, event_id, TMP_C AS y, {_ROLE}, "hour" FROM flagged',
    [{**_PLAIN_PARAMS, "learning_rate": 0.9, "n_estimators": 40}], ["hour"], 40)}, {_stopped(40, 2)}
SELECT "round"::INTEGER AS "round", round(loss, 6) AS loss, "round" <= kept AS kept FROM losses JOIN kept USING (m)
WHERE "round" <= fitted"""


def _drawn(draws: int = 20, seed: int = 42) -> list[dict]:
    """The published draws."""
    rng, out = np.random.RandomState(seed), []
    for _ in range(draws):
        d = {"n_estimators": int(rng.randint(200, 1201) // 100 * 100), "learning_rate": float(rng.uniform(0.01, 0.3))}
        d |= {"max_depth": int(rng.randint(3, 13)), "min_child_weight": int(rng.randint(1, 10))}
        d |= {"subsample": float(rng.uniform(0.5, 1.0)), "colsample_bytree": float(rng.uniform(0.5, 1.0))}
        d |= {"reg_alpha": float(rng.uniform(0.0, 1.0)), "reg_lambda": float(rng.uniform(0.0, 2.0))}
        out.append(d | {"gamma": float(rng.uniform(0.0, 2.0))})
    return out


_X1, _X2, _X3, _X4, _X5 = (  # the primes of xxhash64
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261,
)


def _times(x: str, by: int, plus: int = 0) -> str:
    return f"((({x})::UHUGEINT * {by}::UHUGEINT + {plus}::UHUGEINT) % 18446744073709551616::UHUGEINT)::UBIGINT"


def _rotated(x: str, by: int) -> str:
    return f"({_times(x, 2**by)} + (({x}) >> {64 - by}))"


def _steps(table: str, steps: Sequence[str]) -> str:
    """Columns h (8 bytes) of a table passed through the steps, one after the other."""
    for s in steps:
        table = f"(SELECT * REPLACE ({s} AS h) FROM {table})"
    return table


_LAST = ["xor(h, h >> 33)", _times("h", _X2), "xor(h, h >> 29)", _times("h", _X3), "xor(h, h >> 32)"]


def _of_int(x: str) -> list[str]:
    """xxhash64 of a number of four bytes on top of h."""
    first = [_times("h", 1, _X5 + 4), f"xor(h, {_times(x, _X1)})", _rotated("h", 23), _times("h", _X2, _X3)]
    return [*first, *_LAST]


_OF_KEY = [  # xxhash64 of the key, seed 42
    _times("key", _X2), _rotated("h", 31), _times("h", _X1), f"xor(h, {42 + _X5 + 8}::UBIGINT)", _rotated("h", 27),
    _times("h", _X1, _X4), *_LAST,
]


def _search(patience: int = 50, seed: int = 42, bins: int = 256) -> str:
    """Every draw on every prepared feature, a level of all trees per step of the recursion.

    Rows stand as bin numbers, gradients as whole numbers of a unit, so sums are exact and equal gains are equal.
    """
    draws = _drawn()
    n = len(_PREPARED) + 1 + len(_WIND_TYPES)
    names = list(draws[0])
    values = ", ".join("(" + ", ".join([str(i), *(repr(v) for v in d.values())]) + ")" for i, d in enumerate(draws))
    whole = ("n_estimators", "max_depth", "min_child_weight")
    typed = ", ".join(f"p{c}::{'BIGINT' if x in whole else 'DOUBLE'} AS {x}" for c, x in enumerate(names))
    rounds = max(d["n_estimators"] for d in draws)
    orders = [np.random.RandomState((seed, k)).permutation(n).tolist() for k in range(rounds)]
    ranks = ", ".join(f"({k}, {[o.index(f) for f in range(n)]})" for k, o in enumerate(orders))
    x = [f"cast({_q(c)} AS DOUBLE)" for c in _PREPARED]
    x.append(f"cast(coalesce({_STATION}, (SELECT quantile_disc({_STATION}, 0.5) FROM train)) AS DOUBLE)")
    x += [f"cast(WND_TYPE = '{v}' AS DOUBLE)" for v in _WIND_TYPES]
    shares = ", ".join(repr(i / bins) for i in range(1, bins))
    score = lambda g, h: f"(greatest(abs({g}) - reg_alpha, 0) * greatest(abs({g}) - reg_alpha, 0) / ({h} + reg_lambda))"
    weight = lambda g, h: f"(-(sign({g}) * greatest(abs({g}) - reg_alpha, 0)) / ({h} + reg_lambda))"
    picked = lambda t: f"(SELECT * EXCLUDE (h), role = 1 AND (subsample >= 1 OR (h & 1048575) < round_even(subsample * 1048576, 0)) AS used FROM {t})"
    return f"""WITH RECURSIVE {PARTS}, {_FLAGGED},
wide AS MATERIALIZED (SELECT row_number() OVER (ORDER BY event_id) AS r, {_hash(_ID, 15)}::UBIGINT AS key, TMP_C AS y,
  CASE WHEN v THEN 2 ELSE 1 END AS role, [{', '.join(x)}] AS xs FROM flagged),
long AS MATERIALIZED (SELECT r, unnest(range({n})) AS f, unnest(xs) AS x FROM wide),
cuts AS MATERIALIZED (SELECT DISTINCT f, unnest(quantile_disc(x, [{shares}])) AS c FROM long GROUP BY f),
cells AS MATERIALIZED (SELECT r, long.f, count(c)::INTEGER AS b FROM long LEFT JOIN cuts ON cuts.f = long.f AND c <= x GROUP BY r, long.f),
seeded AS MATERIALIZED {_steps('(SELECT r, key, y, role, 0::UBIGINT AS h FROM wide)', [*_OF_KEY, *_of_int(f'{seed}')])},
dat AS MATERIALIZED (SELECT r, y, role, h, bs FROM seeded JOIN (SELECT r, list(b ORDER BY f) AS bs FROM cells GROUP BY r) USING (r)),
sized AS (SELECT floor(log2(count(*)))::INTEGER + 1 AS bits, min(y) AS low, ceil(log2(greatest(max(y) - min(y), 1e-200))) AS reach,
  count(*) FILTER (role = 1) AS fits, count(*) FILTER (role = 2) AS stops FROM dat),
units AS (SELECT *, least(pow(2.0, 58 - bits - reach), pow(2.0, 52)) AS unit,
  pow(2.0, greatest(least(50 - bits - 2 * reach, 52), -1000)) AS eunit, pow(2.0, greatest(60 - bits, 0)) AS epart FROM sized),
based AS MATERIALIZED (SELECT any_value(COLUMNS(units.*)),
  any_value(low) + sum(round_even((y - low) * unit, 0)::BIGINT) FILTER (role = 1)::BIGINT::DOUBLE / any_value(unit) / any_value(fits) AS base FROM dat, units),
drawn AS MATERIALIZED (SELECT m, {typed} FROM (VALUES {values}) t(m, {', '.join(f'p{c}' for c in range(len(names)))})),
params AS MATERIALIZED (SELECT *, greatest(1, floor(colsample_bytree * {n} + 1e-9)) AS width, greatest(min_child_weight, 1) AS least FROM drawn),
ranks AS MATERIALIZED (FROM (VALUES {ranks}) t(k, rs)),
grown(m, r, k, level, node, f, w, used, best, best_k, live) USING KEY (m, r) AS (
  SELECT m, r, 0, 0, 0, base, 0.0::DOUBLE, used, NULL::DOUBLE, -1, true FROM {picked(_steps('(SELECT * FROM dat, based, params)', _of_int('0')))}
  UNION
  (WITH now AS (SELECT g.*, y, role, bs, round_even((g.f - y) * unit, 0)::BIGINT AS g FROM grown g JOIN dat USING (r), based WHERE live),
  inside AS (SELECT m, k, level, node, g, r FROM now WHERE used AND node >= (1 << level) - 1),
  nodes AS (SELECT m, node, any_value(k) AS k, any_value(level) AS level, sum(g)::BIGINT / any_value(unit) AS g, count(*) AS h FROM inside, based GROUP BY m, node),
  wide_nodes AS (SELECT nodes.*, params.* EXCLUDE (m), rs FROM nodes JOIN params USING (m) JOIN ranks USING (k) WHERE h >= 2 * least),
  sums AS (SELECT m, node, c.f, b, sum(inside.g)::BIGINT AS gl, count(*) AS hl
    FROM inside JOIN wide_nodes w USING (m, node) JOIN cells c USING (r) WHERE rs[c.f + 1] < width GROUP BY m, node, c.f, b),
  run AS (SELECT m, node, f, b, (sum(gl) OVER w)::BIGINT / unit AS gl, (sum(hl) OVER w)::BIGINT AS hl
    FROM sums, based WINDOW w AS (PARTITION BY m, node, f ORDER BY b)),
  gained AS (SELECT *, {score('gl', 'hl')} + {score('(g - gl)', '(h - hl)')} - {score('g', 'h')} AS gain
    FROM run JOIN wide_nodes USING (m, node) WHERE hl >= least AND h - hl >= least),
  splits AS (SELECT m, node, f, b, {weight('gl', 'hl')} AS wl, {weight('(g - gl)', '(h - hl)')} AS wr FROM gained
    WHERE gain > 1e-6 AND gain >= gamma QUALIFY row_number() OVER (PARTITION BY m, node ORDER BY gain DESC, f, b) = 1),
  roots AS (SELECT m, {weight('g', 'h')} AS w FROM nodes JOIN params USING (m) WHERE level = 0),
  grew AS (SELECT DISTINCT m FROM splits),
  moved AS (SELECT now.m, now.r, k, level, now.f, y, role, used, best, best_k, grew.m IS NULL OR level + 1 >= max_depth AS done,
      CASE WHEN s.f IS NULL THEN now.node WHEN bs[s.f + 1] <= s.b THEN 2 * now.node + 1 ELSE 2 * now.node + 2 END AS node,
      CASE WHEN s.f IS NULL THEN coalesce(roots.w, now.w) WHEN bs[s.f + 1] <= s.b THEN wl ELSE wr END AS w
    FROM now JOIN params USING (m) LEFT JOIN splits s ON s.m = now.m AND s.node = now.node
    LEFT JOIN grew ON grew.m = now.m LEFT JOIN roots ON roots.m = now.m),
  ended AS (SELECT moved.* REPLACE (moved.f + learning_rate * w AS f) FROM moved JOIN params USING (m) WHERE done),
  losses AS (SELECT m, any_value(k) AS k, any_value(best) AS best, any_value(best_k) AS best_k,
      (sum(round_even(sq, 0)::BIGINT)::BIGINT + sum(round_even((sq - round_even(sq, 0)) * epart, 0)::BIGINT)::BIGINT / any_value(epart)) / any_value(eunit) / any_value(stops) AS loss
    FROM (SELECT *, (f - y) * (f - y) * eunit AS sq FROM ended, based WHERE role = 2) GROUP BY m),
  judged AS (SELECT m, CASE WHEN best IS NULL OR loss < best THEN loss ELSE best END AS best, CASE WHEN best IS NULL OR loss < best THEN k ELSE best_k END AS best_k FROM losses),
  next AS (SELECT e.* REPLACE (j.best AS best, j.best_k AS best_k, k + 1 AS k), params.*, h, k - j.best_k < {patience} AND k + 1 < n_estimators AS live
    FROM ended e JOIN judged j ON j.m = e.m JOIN params ON params.m = e.m JOIN dat ON dat.r = e.r)
  SELECT m, r, k, level + 1, node, f, w, used, best, best_k, true FROM moved WHERE NOT done
  UNION ALL
  SELECT m, r, k, 0, 0, f, 0.0, used, best, best_k, live FROM (SELECT * EXCLUDE (used_) FROM {picked(_steps('(SELECT * RENAME (used AS used_) FROM next)', _of_int('k')))}))),
trials AS (SELECT m::BIGINT AS trial, {', '.join(c if c in whole else f'round({c}, 6) AS {c}' for c in names)},
  (any_value(best_k) + 1)::BIGINT AS trees, sqrt(any_value(best)) AS rmse FROM grown JOIN params USING (m) GROUP BY ALL)"""


ORACLES["gbt_search"] = f"{_search()} SELECT * REPLACE (round(rmse, 6) AS rmse) FROM trials"
ORACLES["gbt_best_params"] = (
    f"{_search()} SELECT * EXCLUDE (trial, trees, rmse) FROM trials ORDER BY trials.rmse, trial LIMIT 1"
)


def _boosted_curve(sizes: int = 6, folds: int = 3) -> str:
    params = [{**_PLAIN_PARAMS, "learning_rate": 0.8, "n_estimators": 4}] * (sizes * folds)
    share = "(0.1 + 0.9 / 5 * (m // 3))"
    limit = f"least(n_all, greatest(50, cast(floor(n_all * {share} + 1e-9) AS BIGINT)))"
    rows = f"""SELECT m, event_id, TMP_C AS y, "hour", "month",
  CASE WHEN fold = m % {folds} THEN 3 WHEN v THEN 2 ELSE 1 END AS role
FROM ranked, range({sizes * folds}) t(m) WHERE rn <= {limit}"""
    return f"""WITH {PARTS}, ranked AS (SELECT *, {_hash("'fold42' || " + _ID)} % 3 AS fold,
  {_hash("'validation42' || " + _ID)} % 100 < 15 AS v,
  row_number() OVER (ORDER BY {_hash("'42' || " + _ID, 13)}, event_id) AS rn,
  count(*) OVER () AS n_all FROM train), {_boosted(rows, params, ["hour", "month"], 4)}, {_stopped(4, 1)},
sized AS (SELECT m, count(*) AS size FROM r0 GROUP BY m)
SELECT size, round(avg(sqrt(inside)), 6) AS train_rmse, round(avg(sqrt(outside)), 6) AS val_rmse
FROM kept JOIN losses ON losses.m = kept.m AND "round" = kept JOIN sized ON sized.m = kept.m GROUP BY size"""


ORACLES["learning_curve_boosted"] = _boosted_curve()

SCORED = f"""{PARTS}, {_OLS}, scored AS (
  SELECT event_id, "DATE", TMP_C, {_prediction(LINEAR_FEATURES)} AS prediction FROM test, fit),
res AS (SELECT *, TMP_C - prediction AS residual FROM scored)"""
ORACLES["ols_predict"] = (
    f'WITH {SCORED} SELECT event_id, "DATE", round(TMP_C, 4) AS TMP_C, '
    "round(prediction, 4) AS prediction FROM scored"
)
ORACLES["model_roundtrip"] = f"WITH {PARTS} SELECT count(*) AS n, count(*) AS n_same FROM test"


# -------------------------------------------------------------- evaluation ---
def _metrics(digits: int) -> str:
    return f"""round(sqrt(avg(residual * residual)), {digits}) AS rmse,
  round(avg(abs(residual)), {digits}) AS mae,
  round(1.0 - sum(residual * residual) / (var_pop(TMP_C) * count(*)), {digits}) AS r2"""


ORACLES["regression_metrics"] = f"WITH {SCORED} SELECT {_metrics(6)} FROM res"
ORACLES["metrics_row"] = f"WITH {SCORED} SELECT 'ols' AS model, {_metrics(4)} FROM res"
for _part in ("hour", "month"):
    ORACLES[f"rmse_by_{_part}"] = f"""WITH {SCORED}
SELECT cast({_part}("DATE") AS INTEGER) AS "{_part}",
  round(sqrt(avg(residual * residual)), 6) AS rmse, round(avg(residual), 6) AS bias
FROM res GROUP BY {_part}("DATE")"""
ORACLES["calibration"] = f"""WITH {SCORED}
SELECT cast(floor(prediction) AS BIGINT) AS "bin", round(avg(TMP_C), 6) AS avg_true,
  round(avg(prediction), 6) AS avg_pred, count(*) AS n FROM res GROUP BY floor(prediction)"""
ORACLES["residuals"] = f"""WITH {SCORED} SELECT event_id, round(TMP_C, 4) AS TMP_C,
  round(prediction, 4) AS prediction, round(residual, 4) + 0.0 AS residual FROM res"""
ORACLES["residual_histogram"] = f"WITH {SCORED} {_histogram('res', ['residual'], 50)}"


def _normal_quantile(p: float) -> float:
    """By halving the interval in which the distribution function passes p."""
    low, high = -10.0, 10.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if (1 + math.erf(middle / math.sqrt(2))) / 2 < p else (low, middle)
    return low


_GRID = [(i / 100, _normal_quantile(i / 100)) for i in range(1, 100)]
_QQ = f"""{SCORED}, q AS (
  SELECT unnest(quantile_cont(residual, [{', '.join(str(p) for p, _ in _GRID)}])) AS sample,
    unnest([{', '.join(str(p) for p, _ in _GRID)}]) AS p,
    unnest([{', '.join(str(z) for _, z in _GRID)}]) AS theoretical FROM res)"""
ORACLES["residual_qq"] = f"""WITH {_QQ} SELECT round(cast(p AS DOUBLE), 6) AS p,
  round(cast(theoretical AS DOUBLE), 6) + 0.0 AS theoretical, round("sample", 6) AS "sample" FROM q"""
ORACLES["residual_qq_line"] = f"""WITH {_QQ}
SELECT round(regr_slope("sample", theoretical), 5) AS slope,
  round(regr_intercept("sample", theoretical), 5) AS intercept,
  round(corr("sample", theoretical), 5) AS r FROM q"""
ORACLES["pred_limits"] = f"""WITH {SCORED} SELECT round(least(min(TMP_C), min(prediction)), 6) AS lo,
  round(greatest(max(TMP_C), max(prediction)), 6) AS hi FROM scored"""
_TWO = ["DEW_C", "LATITUDE"]
ORACLES["coefficients"] = f"WITH {PARTS}, {_solved('train', _TWO, 'TMP_C')} " + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, round({_slope(i)}, 6) AS coefficient FROM fit"
    for i, f in enumerate(_TWO, 1)
)
_RIDGE_SQL, _RIDGE_VALUES = _ridge(0.003)
ORACLES["coef_diagnostics"] = f"""WITH {PARTS}, {_RIDGE_SQL},
cf AS (SELECT unnest([{', '.join(_RIDGE_VALUES)}]) AS c FROM fit)
SELECT count(*) FILTER (c <> 0) AS nonzero, round(sum(abs(c)), 6) AS l1_norm,
  round(sqrt(sum(c * c)), 6) AS l2_norm FROM cf"""


_RIDGE_SQL, _RIDGE_VALUES = _ridge(0.3)
ORACLES["result_json"] = f"""WITH {PARTS}, {_RIDGE_SQL},
scored AS (SELECT TMP_C, TMP_C - ({_prediction(LINEAR_FEATURES)}) AS residual FROM test, fit),
m AS (SELECT {_metrics(4)} FROM scored),
cf AS (SELECT unnest([{', '.join(f"'{f}'" for f in LINEAR_FEATURES)}]) AS feature,
  unnest([{', '.join(_RIDGE_VALUES)}]) AS c FROM fit)
SELECT 'ridge' AS model, m.*, (SELECT count(*) FILTER (c <> 0) FROM cf) AS nonzero,
  feature, round(c, 6) + 0.0 AS coefficient FROM m, cf"""


def _comparison() -> str:
    chains, rows = [], []
    for tag, features in (("a", ["DEW_C"]), ("b", ["SLP_hPa"]), ("c", LINEAR_FEATURES)):
        chains.append(_solved("train", features, "TMP_C", tag=tag))
        rows.append(
            f"""SELECT 'ols_{len(features)}_{features[0]}' AS model, {_metrics(4)},
  round(max(intercept), 4) AS intercept FROM (
    SELECT TMP_C, TMP_C - ({_prediction(features)}) AS residual,
      {_intercept(len(features))} AS intercept FROM test, fit{tag})"""
        )
    return f"WITH {PARTS}, {', '.join(chains)} " + " UNION ALL ".join(rows)


ORACLES["model_comparison"] = _comparison()


def _family() -> str:
    """The penalty with the least validation error per mixing weight, refitted on all training rows."""
    tried = [(0.0, r) for r in _RIDGE_PENALTIES]
    tried += [(a, r) for a in (0.25, 0.5, 0.75, 1.0) for r in _OTHER_PENALTIES]
    terms = " + ".join(f"w[{i}] * ({_q(f)} - m_{i}) / t_{i}" for i, f in enumerate(LINEAR_FEATURES, 1))
    trials = ORACLES["regularization_path"].replace("round(sqrt", "(sqrt").replace(", 2))), 4) AS rmse", ", 2)))) AS rmse")
    return f"""WITH RECURSIVE {PARTS}, {_descent('train', tried)},
trials AS ({trials}),
best AS (SELECT alpha, arg_min(reg_param, rmse) AS lam FROM trials GROUP BY alpha),
chosen AS (SELECT fit.* FROM fit JOIN best ON best.alpha = fit.alpha AND best.lam = fit.lam),
scored AS (SELECT alpha, lam, my AS intercept, TMP_C, TMP_C - (my + {terms}) AS residual FROM chosen, test)
SELECT CASE alpha WHEN 0 THEN 'Ridge' WHEN 1 THEN 'Lasso' ELSE 'Enet' END || ' (alpha=' || alpha || ')' AS model,
  alpha AS "elasticNetParam", round(lam, 4) AS "best_regParam", {_metrics(4)}, round(max(intercept), 4) AS intercept
FROM scored GROUP BY alpha, lam"""


ORACLES["family_comparison"] = _family()
