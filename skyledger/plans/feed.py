"""Raw weather strings derived from the ``events`` table, for tests and queries.

The test tables hold no packed weather fields. The formulas use integer arithmetic
and functions that Spark SQL and DuckDB spell alike, so one text serves both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FEED_SQL = """
SELECT
  e AS event_id,
  CASE WHEN u % 10 = 0 THEN concat('A', lpad(cast(u AS string), 10, '0'))
       WHEN u % 3 = 0 THEN cast(72000000000 + u AS string)
       ELSE lpad(cast(1000000000 + u AS string), 11, '0') END AS STATION,
  concat('2024-', lpad(cast(1 + e % 12 AS string), 2, '0'), '-',
         lpad(cast(1 + e % 28 AS string), 2, '0'), 'T',
         lpad(cast(h AS string), 2, '0'), ':', lpad(cast(mi AS string), 2, '0'), ':00') AS DATE,
  cast((u * 37) % 181 - 90 AS string) AS LATITUDE,
  cast((u * 53) % 361 - 180 AS string) AS LONGITUDE,
  cast((u * 29) % 3000 AS string) AS ELEVATION,
  CASE WHEN e % 97 = 0 THEN NULL ELSE concat(
    CASE WHEN e % 19 = 0 THEN '999' ELSE lpad(cast((e * 13) % 360 AS string), 3, '0') END, ',',
    substr('0145911111236', cast(1 + e % 13 AS int), 1), ',',
    substr('NNNNV9C', cast(1 + e % 7 AS int), 1), ',',
    CASE WHEN e % 29 = 0 THEN '9999' WHEN e % 5 = 0 THEN '0000'
         ELSE lpad(cast((e * 17) % 250 AS string), 4, '0') END, ',',
    CASE WHEN e % 31 = 0 THEN '3' ELSE '1' END) END AS WND,
  concat(CASE WHEN e % 37 = 0 THEN '99999' WHEN e % 4 = 0 THEN '22000'
              ELSE lpad(cast((e * 11) % 9000 AS string), 5, '0') END, ',1,9,N') AS CIG,
  concat(CASE WHEN e % 41 = 0 THEN '999999'
              ELSE lpad(cast((e * 101) % 16093 AS string), 6, '0') END, ',1,N,',
         CASE WHEN e % 43 = 0 THEN '7' ELSE '1' END) AS VIS,
  concat(CASE WHEN e % 23 = 0 THEN '+9999'
              ELSE concat(CASE WHEN t < 0 THEN '-' ELSE '+' END,
                          lpad(cast(abs(t) AS string), 4, '0')) END, ',',
         CASE WHEN e % 47 = 0 THEN 'A' ELSE '1' END) AS TMP,
  concat(CASE WHEN e % 53 = 0 THEN '+9999'
              ELSE concat(CASE WHEN t - w < 0 THEN '-' ELSE '+' END,
                          lpad(cast(abs(t - w) AS string), 4, '0')) END, ',1') AS DEW,
  concat(CASE WHEN e % 59 = 0 THEN '99999'
              ELSE lpad(cast(9900 + (e * 31) % 500 AS string), 5, '0') END, ',',
         CASE WHEN e % 61 = 0 THEN '2' ELSE '1' END) AS SLP,
  CASE WHEN e % 6 = 0 THEN cast(e % 101 AS string) ELSE NULL END AS RH
FROM (
  SELECT event_id AS e, user_id AS u, hour(ts) AS h, minute(ts) AS mi,
         (event_id * 7919) % 500 - 200 + 10 * cast(hour(ts) AS bigint) AS t,
         (event_id * 104729) % 150 AS w
  FROM events
) src
"""


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw observation table (with ``event_id`` and ``RH``) for a data folder."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return spark.sql(FEED_SQL.replace("FROM events", "FROM {events}"), events=events)
