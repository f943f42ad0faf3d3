"""Feeds of many layouts, columns of many values, and compaction of some partitions."""

import math
import os

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from skyledger.operators import features as X
from skyledger.sources import csv as SRC, tables as T
from tests.test_sources import files, put  # noqa: F401


def ordered(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_reading_by_place_is_reading_by_name(spark, files):  # noqa: F811
    wanted = ["STATION", "DATE", "TMP", "RH"]
    assert ordered(SRC.read_by_place(spark, str(files), wanted, "*.csv")) == ordered(
        SRC.read_raw(spark, str(files), wanted, "*.csv")
    )


def test_many_layouts_are_one_scan(spark, tmp_path):
    names = [f"X{i}" for i in range(20)]
    for i in range(20):
        put(tmp_path, f"f {i}+%.csv", ",".join([*names[:i], "STATION"]) + "\n" + "," * i + f"{i}\n")
    out = SRC.read_raw(spark, str(tmp_path), ["STATION", "DATE"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("csv") == 1
    assert sorted(int(r["STATION"]) for r in out.collect()) == list(range(20))
    put(tmp_path, "new.csv", "STATION\n77\n")
    again = SRC.read_by_place(spark, str(tmp_path), ["STATION"])
    assert again.count() == 21
    with pytest.raises(FileNotFoundError):
        SRC.read_by_place(spark, f"{tmp_path}/none*", ["STATION"])


def test_dictionary_gives_the_vectors_of_the_indexer(spark):
    rows = [(i, None if i % 9 == 0 else f"v{i % 7}") for i in range(60)] + [(100, "v3")] * 30
    df = spark.createDataFrame(rows, "id long, c string").repartition(4)
    names = X.dictionary(df.filter("c <> 'v5'"), "c")
    assert [(r["value"], r["number"]) for r in names.orderBy("number").collect()] == [
        (f"v{v}", i) for i, v in enumerate((0, 1, 2, 3, 4, 6))
    ]
    got = X.one_hot_by_dictionary(df, "c", names).select("id", "c", vector_to_array("c_vec").alias("v"))
    assert got.columns == ["id", "c", "v"] and got.count() == 90
    order = {r["value"]: r["number"] for r in names.collect()}
    for r in got.collect():
        want = [0.0] * 6
        if r["c"] in order:
            want[order[r["c"]]] = 1.0
        assert r["v"] == want
    assert X.dictionary(df.limit(0), "c").count() == 0


def test_compaction_leaves_other_partitions(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = spark.range(300).select(
        "id", F.when(F.col("id") % 3 < 2, F.col("id") % 3).alias("k"), F.lit("a b=c").alias("name")
    )
    df.filter("k is null or k = 1").repartition(6).write.partitionBy("k", "name").parquet(path)
    df.filter("k = 0").coalesce(1).write.mode("append").partitionBy("k", "name").parquet(path)

    def listing():
        return {r["k"]: sorted(r["files"]) for r in T.partition_files(spark, path, ["k", "name"]).collect()}

    before = listing()
    assert {k: len(f) for k, f in before.items()} == {None: 6, "1": 6, "0": 1}
    assert T.compact_touched(spark, path, ["k", "name"], most_small=2) == 2
    after = listing()
    assert after["0"] == before["0"] and all(len(after[k]) <= 2 for k in (None, "1"))
    assert ordered(spark.read.parquet(path).select("id", "k", "name")) == ordered(df)
    assert T.compact_touched(spark, path, ["k", "name"], most_small=2) == 0
    assert math.isclose(sum(os.path.getsize(f.removeprefix("file:")) > 0 for fs in after.values() for f in fs), sum(map(len, after.values())))


@pytest.mark.parametrize("short", [True, False])
def test_dictionary_vectors_need_no_name_per_slot(spark, monkeypatch, short):
    monkeypatch.setattr(X, "COMMON_ROWS", 50)
    monkeypatch.setattr(X, "SHORT_DICTIONARY", 1_000_000 if short else 0)
    rows = [(i, f"v{i}") for i in range(400)] + [(i, "v7") for i in range(90)] + [(0, None), (1, "none")]
    df = spark.createDataFrame(rows, "id long, c string").repartition(5)
    names = X.dictionary(df.filter("c <> 'none'"), "c")
    vectors = X.one_hot_by_dictionary(df, "c", names)
    assert vectors.schema["c_vec"].metadata == {"ml_attr": {"num_attrs": 400}}
    plan = vectors._jdf.queryExecution().executedPlan().toString()
    assert ("SortMergeJoin" in plan) != short
    sums = {r["slot"]: r["total"] for r in X.slot_sums(vectors, "c_vec").collect()}
    hot = names.filter("value = 'v7'").first()["number"]
    assert sums == {i: 91.0 if i == hot else 1.0 for i in range(400)}
    empty = [r["c_vec"] for r in vectors.filter("c is null or c = 'none'").collect()]
    assert [(v.size, v.numNonzeros()) for v in empty] == [(400, 0)] * 2
    assert vectors.count() == len(rows)
