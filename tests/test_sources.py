import json
import os

import pytest
from pyspark.sql import functions as F

from skyledger.plans.ingest import ingest_clean, ingest_raw, ingest_typed
from skyledger.session import persisted, scratch_path, shared_folder
from skyledger.sources import checks as K, csv as SRC, tables as T


def put(folder, name, text, encoding="utf-8"):
    (folder / name).write_text(text, encoding=encoding)


@pytest.fixture
def files(tmp_path):
    put(tmp_path, "a.csv", 'STATION,DATE,TMP\n1,d1,"+0010,1"\n2,d2,\n')
    put(tmp_path, "b.csv", 'RH,TMP,DATE,STATION\n55,"-0020,1",d3,3\n,"","d4",4\n')
    put(tmp_path, "c.csv", 'STATION,DATE,TMP,AA1,GA1\n5,d5,"say ""hi"", you",x,y\n')
    put(tmp_path, "d.csv", "STATION,DATE,TMP\n")
    put(tmp_path, "e.csv", "")
    put(tmp_path, "f.csv", "station,DATE,TMP\r\n6,d6,z\r\n", "utf-8-sig")
    put(tmp_path, "g [1]{x}#%20.csv", "TMP,STATION\nw,7\n")
    put(tmp_path, "note.txt", "not a table")
    return tmp_path


def test_read_raw_binds_by_name(spark, files):
    out = SRC.read_raw(spark, str(files), ["STATION", "DATE", "TMP", "RH"], pattern="*.csv")
    assert {t for _, t in out.dtypes} == {"string"}
    assert sorted(map(tuple, out.collect())) == [
        ("1", "d1", "+0010,1", None), ("2", "d2", None, None), ("3", "d3", "-0020,1", "55"),
        ("4", "d4", None, None), ("5", "d5", 'say "hi", you', None), ("6", "d6", "z", None),
        ("7", None, "w", None),
    ]


def test_read_raw_scans_only_what_is_used(spark, files):
    out = SRC.read_raw(spark, str(files), ["STATION", "DATE", "TMP"], pattern="*.csv")
    plan = out.select("TMP")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<TMP:string>" in plan and "DATE" not in plan


def test_unwanted_columns_do_not_make_groups(spark, files):
    groups = SRC.header_groups(spark, str(files), ["STATION", "DATE", "TMP"], "*.csv")
    places = {os.path.basename(r["path"]): r["places"] for r in groups.collect()}
    assert places == {
        "a.csv": "0,1,2", "c.csv": "0,1,2", "d.csv": "0,1,2", "f.csv": "0,1,2", "b.csv": "3,2,1",
        "g [1]{x}#%20.csv": "1,-1,0",
    }


def test_single_group_and_short_rows(spark, tmp_path):
    put(tmp_path, "a.csv", "STATION,X,TMP,Y\n1,x,t,y\n2,x\n3,x,t,y,more\n")
    put(tmp_path, "b.csv", "STATION,X,TMP\n4,x,u\n")
    out = SRC.read_raw(spark, f"{tmp_path}/*.csv", ["TMP", "STATION", "WND"])
    assert sorted(map(tuple, out.collect()), key=lambda r: r[1]) == [
        ("t", "1", None), (None, "2", None), ("t", "3", None), ("u", "4", None),
    ]
    assert out.count() == 4


def test_quoted_line_ends(spark, tmp_path):
    put(tmp_path, "a.csv", 'STATION,TMP\n1,"two\nlines"\n2,b\n')
    out = SRC.read_raw(spark, str(tmp_path), ["STATION", "TMP"], multiLine=True)
    assert sorted(map(tuple, out.collect())) == [("1", "two\nlines"), ("2", "b")]


def test_missing_input(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        SRC.read_raw(spark, f"{tmp_path}/nothing/*.csv")
    with pytest.raises(FileNotFoundError):
        SRC.read_raw(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        K.require_files(spark, str(tmp_path), "*.csv")


def test_column_checks(spark):
    df = spark.range(1).withColumn("x", F.lit(1))
    assert K.require_columns(df, ["x"]) is df
    with pytest.raises(ValueError, match="lacks columns .*'y'"):
        K.require_columns(df, ["x", "y"])


def test_project_raw(spark):
    out = SRC.project_raw(spark.range(1).withColumn("DATE", F.lit(5)), ["STATION", "DATE"])
    assert out.dtypes == [("STATION", "string"), ("DATE", "string")]
    assert tuple(out.first()) == (None, "5")


def parquet_files(path):
    return [f for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]


def months(spark, n, month=None):
    m = F.lit(month) if month else (F.col("id") % 3 + 1)
    return spark.range(n).select("id", F.lit(2024).alias("year"), m.cast("int").alias("month"))


def test_partitioned_write_has_few_files_and_prunes(spark, tmp_path):
    path = T.write_partitioned(months(spark, 3000).repartition(8), f"{tmp_path}/p")
    assert len(parquet_files(path)) <= 6
    back = T.read_table(spark, path)
    assert back.count() == 3000
    plan = back.filter("month = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    month = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 12 + 1)
    df = spark.range(0, 400_000, 1, 8).select(
        "id", F.md5(F.col("id").cast("string")).alias("text"),
        F.lit(2024).alias("year"), month.cast("int").alias("month"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1MB")
    try:
        path = T.write_partitioned(df, f"{tmp_path}/hot")
    finally:
        spark.conf.set(key, before)
    assert len(parquet_files(f"{path}/year=2024/month=1")) > 2
    assert T.read_table(spark, path).count() == 400_000


def test_null_partition_key_comes_back(spark, tmp_path):
    df = months(spark, 4).withColumn("month", F.when(F.col("id") > 1, F.col("month")))
    back = T.read_table(spark, T.write_partitioned(df, f"{tmp_path}/n"))
    assert back.filter("month IS NULL").count() == 2


def test_compaction_keeps_rows_in_fewer_files(spark, tmp_path):
    loose = f"{tmp_path}/loose"
    months(spark, 900).repartition(12).write.partitionBy("year", "month").parquet(loose)
    path = T.compact(spark, loose, f"{tmp_path}/dense")
    assert len(parquet_files(path)) < len(parquet_files(loose))
    a, b = T.read_table(spark, loose), T.read_table(spark, path)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_only_touched_partitions_are_replaced(spark, tmp_path):
    path = T.write_partitioned(months(spark, 30), f"{tmp_path}/d")
    T.write_partitioned(months(spark, 5, month=2), path, only_touched=True)
    counts = {r["month"]: r["count"] for r in T.read_table(spark, path).groupBy("month").count().collect()}
    assert counts == {1: 10, 2: 5, 3: 10}
    T.write_partitioned(months(spark, 5, month=2), path)
    assert T.read_table(spark, path).count() == 5


def test_single_file_and_records_per_file(spark, tmp_path):
    df = spark.range(100).repartition(4)
    assert len(parquet_files(T.write_table(df, f"{tmp_path}/one", num_files=1))) == 1
    assert len(parquet_files(T.write_table(df, f"{tmp_path}/many", 1, max_records=25))) == 4


def test_results_as_csv_and_json(spark, tmp_path):
    table = spark.createDataFrame([("a", 0.5), ('q"x,y', None)], "feature string, coefficient double")
    T.write_results({"coefs": table}, str(tmp_path))
    assert sorted(T.read_csv(spark, f"{tmp_path}/coefs", table.schema).collect(), key=str) == sorted(
        table.collect(), key=str
    )
    nested = table.agg(F.map_from_entries(F.collect_list(F.struct("feature", "coefficient"))).alias("m"))
    T.write_results({"nested": nested}, str(tmp_path), "json")
    (part,) = [f for f in os.listdir(tmp_path / "nested") if f.endswith(".json")]
    assert json.loads((tmp_path / "nested" / part).read_text())["m"]["a"] == 0.5


def test_counted_write_and_persist(spark, tmp_path):
    assert T.write_counted(spark.range(77), lambda d: T.write_table(d, f"{tmp_path}/c")) == 77
    df = spark.range(10)
    with persisted(df) as held:
        assert held.storageLevel.useMemory and not held.storageLevel.deserialized
    assert not df.storageLevel.useMemory
    assert T.spread(df, 3, ["id"]).rdd.getNumPartitions() == 3


def test_scratch_paths_lie_in_the_shared_folder(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(shared_folder(spark))


def test_ingest_jobs(spark, feed, tmp_path):
    rows = feed.drop("event_id")
    T.write_csv(rows.filter("RH IS NULL").drop("RH"), f"{tmp_path}/in/plain")
    T.write_csv(rows.filter("RH IS NOT NULL").select(*reversed(rows.columns)), f"{tmp_path}/in/rh")
    source = f"{tmp_path}/in/*"
    assert ingest_raw(spark, source, f"{tmp_path}/raw", "*.csv") == 1000
    assert ingest_clean(spark, source, f"{tmp_path}/clean", "*.csv") == 496
    assert ingest_typed(spark, source, f"{tmp_path}/typed", "*.csv") == 1000
    assert T.read_table(spark, f"{tmp_path}/raw").columns[0] == "STATION"
    typed = T.read_table(spark, f"{tmp_path}/typed")
    assert typed.filter("RH_pct IS NOT NULL").count() > 800 and typed.columns[-2:] == ["year", "month"]


def test_scratch_is_cleared_by_its_maker(spark, tmp_path):
    from skyledger import session

    kept = list(session._scratch)
    session._scratch.clear()
    path = session.scratch_path(spark, "t")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    assert session.clear_scratch(spark) == 1 and not os.path.exists(path)
    assert session.clear_scratch(spark) == 0
    session._scratch.extend(kept)
