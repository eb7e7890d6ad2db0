import hashlib
import random

import pytest
from pyspark.sql import functions as F

from almanack.functions import expressions as X


def test_series_keys_equal_the_hash_prefix(spark):
    names = ["Solar", "Wind", "Net imports", "Übertragung", ""]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    for row in df.select("name", X.series_key("name"), X.capacity_series_key("name")).collect():
        plain = int(hashlib.sha256(row[0].encode()).hexdigest()[:15], 16)
        spaced = int(hashlib.sha256(f"capacity::{row[0]}".encode()).hexdigest()[:15], 16)
        assert (row[1], row[2]) == (plain, spaced)


def test_published_totals_do_not_depend_on_order(spark):
    rng = random.Random(1)
    values = [rng.uniform(-1e6, 1e6) for _ in range(5000)]
    totals = set()
    for parts in (1, 3, 16):
        random.Random(parts).shuffle(values)
        df = spark.createDataFrame([(round(v, 6),) for v in values], "v double").repartition(parts)
        totals.add(df.agg(X.rounded(F.sum("v"), 2)).first()[0])
    assert len(totals) == 1


def test_published_values_keep_all_their_digits(spark):
    values = [(123456789012345.67, 2, 123456789012345.67), (98765432101.234567, 6, 98765432101.23457), (2.675, 2, 2.68),
              (-2.5, 0, -3.0), (1e22, 2, 1e22), (1e-12, 6, 0.0), (None, 2, None)]
    df = spark.createDataFrame([(v[0],) for v in values], "v double").coalesce(1)
    for digits in {v[1] for v in values}:
        got = [r[0] for r in df.select(X.rounded("v", digits)).collect()]
        assert all(got[i] == v[2] for i, v in enumerate(values) if v[1] == digits)


def test_month_mask_counts_distinct_months(spark):
    df = spark.createDataFrame([(1,), (1,), (12,), (7,), (None,)], "m int")
    mask = df.agg(X.months_mask(F.col("m")).alias("mask"))
    assert mask.select(X.month_count(F.col("mask"))).first()[0] == 3
    year = spark.range(1, 13).agg(X.months_mask(F.col("id")).alias("mask"))
    assert year.select(X.is_complete(F.col("mask"))).first()[0] is True


def test_percent_of_zero_is_null(spark):
    df = spark.createDataFrame([(0.0, 5.0), (4.0, 5.0)], "a double, b double")
    got = [r[0] for r in df.select(X.percent_change(F.col("a"), F.col("b"))).collect()]
    assert got == [None, 25.0]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "v double")
    assert df.where(X.is_missing("v", "double")).count() == 2


@pytest.mark.parametrize("first,expected", [(None, 2), (2001, 1)])
def test_year_limits_are_half_open(spark, first, expected):
    df = spark.createDataFrame([("2000-12-01",), ("2001-01-01",), ("2002-01-01",)], "d string")
    dated = df.select(F.col("d").cast("timestamp_ntz").alias("date"))
    assert dated.where(X.within_years(F.col("date"), first, 2002)).count() == expected
