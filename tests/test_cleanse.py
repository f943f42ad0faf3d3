"""Hand-built rows for every rule of the cleansing and typed plans."""

import datetime as dt

import pytest

from skyledger import schema as S
from skyledger.operators import columns as C, filters as L
from skyledger.plans.cleanse import cleanse
from skyledger.plans.typed import typed_humidity

BASE = {
    "STATION": "01001099999", "DATE": "2024-01-02T03:04:05", "LATITUDE": "70.93",
    "LONGITUDE": "-8.66", "ELEVATION": "9.0", "WND": "180,1,N,0050,1", "CIG": "22000,1,9,N",
    "VIS": "016000,1,N,1", "TMP": "+0200,1", "DEW": "+0100,1", "SLP": "10132,1",
}


def raw(spark, *changes):
    rows = [tuple((BASE | c)[k] for k in S.RAW_COLUMNS) for c in changes]
    return spark.createDataFrame(rows, S.RAW_SCHEMA)


def test_base_row(spark):
    out = cleanse(raw(spark, {}))
    assert out.schema == S.CLEAN_SCHEMA
    assert tuple(out.first()) == (
        "01001099999", dt.datetime(2024, 1, 2, 3, 4, 5), 2024, 1, 2, 3, 70.93, -8.66, 9.0,
        180.0, "N", 5.0, 22000.0, 16000.0, 20.0, 10.0, 1013.2,
    )


DROPPED = [
    {"WND": "999,1,N,0050,1"}, {"WND": "999,1,C,0000,1"}, {"WND": "180,1,9,0050,1"},
    {"WND": "180,1,N,9999,1"}, {"CIG": "99999,9,9,N"}, {"VIS": "999999,9,N,1"},
    {"TMP": "+9999,9"}, {"TMP": "9999,9"}, {"DEW": "+9999,9"}, {"SLP": "99999,9"},
    {"SLP": "10132,A"}, {"WND": None}, {"VIS": "016000,1"}, {"CIG": ""}, {"TMP": None},
    {"WND": "180,3,N,0050,1"}, {"WND": "180,1,N,0050,3"}, {"CIG": "22000,3,9,N"},
    {"VIS": "016000,3,N,1"}, {"VIS": "016000,1,N,3"}, {"TMP": "+0200,3"},
    {"DEW": "+0100,3"}, {"SLP": "10132,3"},
]


@pytest.mark.parametrize("change", DROPPED, ids=str)
def test_dropped(spark, change):
    assert cleanse(raw(spark, change)).count() == 0


KEPT = [
    ({"WND": "999,1,V,0050,1"}, {"WND_DIR_DEG": 999.0, "WND_TYPE": "V"}),
    ({"WND": "180,1,9,0000,1"}, {"WND_TYPE": "9", "WND_SPD_MS": 0.0}),
    ({"CIG": "22000,1,9,9"}, {"CIG_HEIGHT_M": 22000.0}),
    ({"TMP": "-9999,1"}, {"TMP_C": -999.9}),
    ({"TMP": "+0200,A"}, {"TMP_C": 20.0}),
    ({"DEW": "-0130,U"}, {"DEW_C": -13.0}),
    ({"DATE": "bad"}, {"DATE": None, "year": None, "hour": None}),
    ({"LATITUDE": "north"}, {"LATITUDE": None}),
]


@pytest.mark.parametrize("change,expected", KEPT, ids=str)
def test_kept(spark, change, expected):
    (row,) = cleanse(raw(spark, change)).collect()
    assert {k: row[k] for k in expected} == expected


def test_variable_wind_as_null(spark):
    row = cleanse(raw(spark, {"WND": "999,1,V,0050,1"}), variable_wind_dir="null").first()
    assert row["WND_DIR_DEG"] is None
    with pytest.raises(ValueError):
        cleanse(raw(spark, {}), variable_wind_dir="drop")


def test_station_as_int(spark):
    ids = ["72495023234", "A0684700403", "01001099999"]
    out = cleanse(raw(spark, *[{"STATION": i} for i in ids]), station_as_int=True)
    assert [r[0] for r in out.select("STATION").collect()] == [None, None, 1001099999]


def test_absent_packed_column_is_left_alone(spark):
    df = raw(spark, {}).drop("CIG")
    out = C.split_packed(df, {"CIG": S.PACKED_LAYOUTS["CIG"]})
    assert out.columns == df.columns


def test_split_forms_agree(feed):
    a, b = C.split_packed(feed), C.split_packed(feed, once=True)
    assert a.columns == b.columns
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_each_field_is_split_once(feed):
    plan = cleanse(feed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(WND") == 1


def test_plan_is_one_narrow_stage_over_a_pruned_scan(spark, feed, tmp_path):
    feed.drop("event_id").write.parquet(f"{tmp_path}/raw")
    table = cleanse(spark.read.parquet(f"{tmp_path}/raw")).select("hour", "TMP_C")
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert "STATION" not in plan and "LATITUDE" not in plan


def test_own_codes(spark):
    df = raw(spark, {}, {"TMP": "it's,1"}, {"TMP": "\\N,1"})
    tokens = C.split_packed(df)
    assert L.drop_missing(tokens, {"TMP_RAW": ["it's", "\\N"]}).count() == 1
    assert L.keep_accepted(tokens, {"CIG_DET_CODE": ["8"]}).count() == 0


def test_column_order(spark):
    out = C.add_calendar(raw(spark, {}).withColumnRenamed("WND", "hour"))
    assert out.columns[:6] == ["STATION", "DATE", "year", "month", "day", "hour"]
    assert out.columns.count("hour") == 1
    assert C.select_present(out, ["nope", "SLP", "STATION"]).columns == ["SLP", "STATION"]
    assert C.model_columns(out, "TMP", ["DEW", "TMP"], ["DATE"]).columns == ["DATE", "TMP", "DEW"]
    assert C.column_kinds(out, ["SLP"])[0] == ["year", "month", "day", "hour"]


def test_funnel_and_rules_on_golden_counts(feed):
    tokens = C.split_packed(feed, once=True)
    funnel = {r["stage"]: r["n"] for r in L.cleanse_funnel(tokens).collect()}
    assert funnel == {"raw": 1000, "not_missing": 702, "accepted": 496}
    assert cleanse(feed).count() == 496
    assert cleanse(feed, station_as_int=True).filter("STATION IS NULL").count() == 193
    assert cleanse(feed).filter("WND_DIR_DEG = 999").count() == 6


def test_result_does_not_depend_on_partitions(feed):
    one = cleanse(feed.coalesce(1)).collect()
    eight = cleanse(feed.repartition(8)).collect()
    assert sorted(map(repr, one)) == sorted(map(repr, eight))


def typed_row(spark, change, rh=None, **kw):
    from pyspark.sql import functions as F

    df = raw(spark, change).withColumn("RH", F.lit(rh).cast("string"))
    return typed_humidity(df, **kw).first()


def test_typed_base(spark):
    row = typed_row(spark, {})
    assert round(row["RH_pct"], 6) == 52.541326
    assert (row["TMP_C"], row["DEW_C"], row["SLP_hPa"], row["VIS_m"]) == (20.0, 10.0, 1013.2, 16000)
    assert (row["year"], row["month"], row["STATION"]) == (2024, 1, "01001099999")


def test_typed_humidity_rules(spark):
    assert typed_row(spark, {}, rh="130")["RH_pct"] == 130.0
    assert typed_row(spark, {"TMP": "+0100,1", "DEW": "+0120,1"})["RH_pct"] == 100.0
    assert typed_row(spark, {"TMP": None})["RH_pct"] is None
    assert typed_row(spark, {"DEW": "+9999,9"})["RH_pct"] is None
    assert typed_row(spark, {}, rh="x")["RH_pct"] is not None


def test_typed_sentinels(spark):
    assert typed_row(spark, {"TMP": "+9999,9"})["TMP_C"] is None
    assert typed_row(spark, {"TMP": "+9999,9"}, missing_tokens="compat")["TMP_C"] == 999.9
    assert typed_row(spark, {"VIS": "999999,9"})["VIS_m"] is None
    assert typed_row(spark, {"VIS": "999999,9"}, missing_tokens="compat")["VIS_m"] == 999999
    assert typed_row(spark, {"SLP": ""})["SLP_hPa"] is None


def test_typed_absent_columns(spark):
    out = typed_humidity(raw(spark, {}).drop("ELEVATION", "VIS", "STATION"))
    assert (out.first()["ELEVATION"], out.first()["VIS_m"], out.first()["STATION"]) == (None,) * 3
    assert dict(out.dtypes)["VIS_m"] == "int" and dict(out.dtypes)["ELEVATION"] == "double"


def test_presence_of_packed_fields_reaches_the_scan(spark, feed, tmp_path):
    feed.write.parquet(f"{tmp_path}/raw")
    stored = spark.read.parquet(f"{tmp_path}/raw")
    plan = cleanse(stored, stored=True)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].split("]")[0]
    assert pushed.count("IsNotNull(") >= 5  # the plan's text may cut the list short
    assert cleanse(stored, stored=True).exceptAll(cleanse(feed)).isEmpty()
