import datetime as dt

import pytest
from pyspark.sql import functions as F

from almanack.operators import cleaning as C

FIELDS = (
    "entity string, entity_code string, is_aggregate_entity string, date string, series string, "
    "is_aggregate_series string, generation_twh string, share_of_generation_pct string, extra string"
)
GOOD = ("Germany", "DEU", "false", "2026-07-01", "Solar", "false", "8.0", "10.5", "kept")


def raw(spark, *changes):
    names = [f.split()[0] for f in FIELDS.split(", ")]
    data = [tuple(c.get(n, v) for n, v in zip(names, GOOD)) for c in changes]
    return spark.createDataFrame(data, FIELDS)


def test_types_and_extra_columns(spark):
    df = C.clean(raw(spark, {}), "generation")
    types = dict(df.dtypes)
    assert types["date"] == "timestamp_ntz" and types["generation_twh"] == "double"
    assert types["is_aggregate_series"] == "boolean"
    row = df.first()
    assert row["extra"] == "kept" and row["date"] == dt.datetime(2026, 7, 1)


def test_unknown_dataset_is_rejected(spark):
    with pytest.raises(ValueError, match="unknown dataset"):
        C.clean(raw(spark, {}), "weather")


@pytest.mark.parametrize("column", ["entity", "date", "generation_twh", "is_aggregate_entity"])
def test_missing_columns_are_rejected_before_any_job(spark, column):
    with pytest.raises(ValueError, match=column):
        C.clean(raw(spark, {}).drop(column), "generation")


@pytest.mark.parametrize(
    "change",
    [
        {"date": "July"},
        {"date": "2020-01-01T00:00:00+05:00"},
        {"date": "2020-01-01 00:00:00Z"},
        {"generation_twh": "8,0"},
        {"generation_twh": "1d"},
        {"generation_twh": "1.5f"},
        {"share_of_generation_pct": "n/a"},
        {"is_aggregate_series": "yes"},
        {"is_aggregate_entity": "1"},
    ],
)
def test_bad_values_fail_the_query(spark, change):
    with pytest.raises(Exception, match=next(iter(change))):
        C.clean(raw(spark, {}, change), "generation").collect()


@pytest.mark.parametrize("text", ["1", "-1.5", "+.5e-3", "7.", "1E5", "inf", "NaN", " 2 "])
def test_numbers_in_any_usual_form(spark, text):
    row = C.clean(raw(spark, {"generation_twh": text}), "generation").first()
    assert str(row["generation_twh"]) == str(float(text))


def test_empty_number_is_missing_not_an_error(spark):
    row = C.clean(raw(spark, {"generation_twh": ""}), "generation").first()
    assert row["generation_twh"] is None


def test_outliers_and_negative_values_stay(spark):
    df = C.clean(raw(spark, {"generation_twh": "-4", "share_of_generation_pct": "950"}), "generation")
    assert df.first()["generation_twh"] == -4.0 and df.first()["share_of_generation_pct"] == 950.0


def test_time_scope_leaves_capacity_alone(spark):
    dates = [("2009-12-01",), ("2010-01-01",)]
    df = spark.createDataFrame(dates, "d string").select(
        F.col("d").cast("timestamp_ntz").alias("date")
    )
    assert C.apply_project_scope(df, "demand").count() == 1
    assert C.apply_project_scope(df, "capacity").count() == 2


def test_backfill_scope_keeps_request_order(spark):
    requested = spark.createDataFrame(
        [(0, "fra"), (1, "DEU"), (2, "Fra"), (3, "aut")], "pos int, entity_code string"
    )
    project = spark.createDataFrame([("AUT",), ("DEU",), ("FRA",)], "entity_code string")
    narrow = spark.createDataFrame([("FRA",), ("AUT",)], "entity_code string")
    assert [r[1] for r in C.backfill_scope(requested, project).collect()] == ["FRA", "DEU", "AUT"]
    assert [r[1] for r in C.backfill_scope(requested, project, narrow).collect()] == ["FRA", "AUT"]
    bad = requested.union(spark.createDataFrame([(9, "USA")], requested.schema))
    assert [r[0] for r in C.unknown_backfill_countries(bad, project).collect()] == ["USA"]
    with pytest.raises(Exception, match="USA"):
        C.backfill_scope(bad, project).collect()


def test_dataset_names_for_a_backfill():
    assert C.resolve_datasets(["demand"]) == ["demand"]
    assert len(C.resolve_datasets(None)) == 5
    with pytest.raises(ValueError):
        C.resolve_datasets(["demand", "prices"])


def test_lookup_scopes():
    from almanack.sources.lookups import expected_countries

    assert len(expected_countries("generation")) == 41
    assert len(expected_countries("capacity")) == 13
