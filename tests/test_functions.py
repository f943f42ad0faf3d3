import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyledger.functions import calendar as CAL, numeric as N, text as T


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "alpha,label", [(0.0, "a0"), (0.25, "a0p25"), (0.5, "a0p5"), (0.75, "a0p75"), (1.0, "a1")]
)
def test_alpha_label(spark, alpha, label):
    assert one(spark, T.alpha_label(F.lit(alpha))) == label


@pytest.mark.parametrize(
    "text,value",
    [("+0123,1", 12.3), ("-0070,1", -7.0), ("0005", 0.5), ("x,1", None), ("", None), (None, None),
     (",1", None), ("+9999,1", None)],
)
def test_decode_tenths(spark, text, value):
    assert one(spark, T.decode_tenths(F.lit(text).cast("string"), [9999])) == value


def test_tokens(spark):
    assert one(spark, T.token(F.lit("a,b"), 1)) == "b"
    assert one(spark, T.token(F.lit("a,b"), 2)) is None
    assert one(spark, T.token(F.lit(""), 0)) == ""
    assert one(spark, T.strip_plus(F.lit("+1+"))) == "1+"
    assert one(spark, T.first_token(F.lit("ab"))) == "ab"


def test_timestamps(spark):
    good = dt.datetime(2024, 5, 6, 7, 8, 9)
    assert one(spark, CAL.parse_timestamp(F.lit("2024-05-06T07:08:09"))) == good
    assert one(spark, CAL.cast_timestamp(F.lit("2024-05-06T07:08:09"))) == good
    for text in ("2024-05-06", "2024-13-06T07:08:09", "x"):
        assert one(spark, CAL.parse_timestamp(F.lit(text))) is None


def test_key_hash_is_known_and_spread(spark):
    # md5("1") starts with c4ca4238
    assert one(spark, N.key_hash(F.lit(1))) == 0xC4CA4238
    shares = spark.range(20000).groupBy(N.key_bucket("id", buckets=4)).count().collect()
    assert len(shares) == 4 and all(4700 < r["count"] < 5300 for r in shares)


def test_unit_bin(spark):
    assert [one(spark, N.unit_bin(F.lit(v))) for v in (-0.1, 0.0, 0.99)] == [-1, 0, 0]
