import pytest
from pyspark.sql import functions as F

from almanack import schemas as S
from almanack.operators import quality as Q
from conftest import rows
from fixtures import Source, month

ROW = ("DEU", month(2026, 7), "Solar", 8.0, 10.0)
FIELDS = (
    "entity_code string, date timestamp_ntz, series string, generation_twh double, "
    "share_of_generation_pct double"
)


def frame(spark, *data):
    return spark.createDataFrame(list(data) or [ROW], FIELDS)


def expected(spark):
    return spark.createDataFrame([("DEU",), ("FRA",)], "entity_code string")


def failing(report):
    return {(r["check_name"], r["column_name"], r["value"]) for r in report.collect() if not r["passed"]}


def test_valid_subset_passes(spark):
    assert failing(Q.silver_report(frame(spark), "generation", expected(spark))) == set()


def test_missing_columns_end_the_report(spark):
    report = Q.silver_report(
        frame(spark).drop("share_of_generation_pct", "date"), "generation", expected(spark)
    )
    assert [r["column_name"] for r in report.collect() if not r["passed"]] == [
        "date",
        "share_of_generation_pct",
    ]
    assert Q.verdict(report).first()["passed"] is False


@pytest.mark.parametrize("column", ["entity_code", "date", "series", "generation_twh"])
def test_null_in_every_required_column(spark, column):
    position = [f.split()[0] for f in FIELDS.split(", ")].index(column)
    other = ("FRA",) + ROW[1:]
    bad = other[:position] + (None,) + other[position + 1 :]
    report = Q.silver_report(frame(spark, ROW, bad), "generation", expected(spark))
    assert failing(report) == {("null_count", column, 1)}


def test_nan_is_a_null(spark):
    bad = ("FRA", month(2026, 7), "Solar", float("nan"), 10.0)
    report = Q.silver_report(frame(spark, bad), "generation", expected(spark))
    assert failing(report) == {("null_count", "generation_twh", 1)}


def test_three_duplicate_counts_differ(spark):
    df = frame(spark, ROW, ROW, ROW, ("FRA", month(2026, 7), "Solar", 1.0, 1.0))
    key = S.BUSINESS_KEYS["generation"]
    assert Q.duplicate_excess(df, key).first()[0] == 2
    assert Q.duplicate_rows(df, key).first()[0] == 3
    assert Q.duplicate_groups(df, key).first()[0] == 1
    assert failing(Q.silver_report(df, "generation", expected(spark))) == {("duplicate_keys", None, 2)}


def test_unexpected_country(spark):
    df = frame(spark, ROW, ("USA",) + ROW[1:], (None,) + ROW[1:])
    assert rows(Q.unexpected_countries(df, expected(spark))) == [("USA",)]


def test_null_counts(spark):
    df = frame(spark, (None, None, "Solar", float("nan"), 1.0))
    got = dict(rows(Q.null_counts(df, ["entity_code", "series", "generation_twh"])))
    assert got == {"entity_code": 1, "series": 0, "generation_twh": 1}


@pytest.fixture(scope="module")
def gold(spark):
    return Source().year("DEU", 2019).gold(spark)


def test_valid_model(spark, gold):
    assert failing(Q.gold_report(gold)) == set()
    assert Q.verdict(Q.gold_report(gold)).first()["passed"] is True
    assert set(Q.raise_if_persisted_invalid(gold)) == set(S.GOLD_TABLES)


def test_orphans(spark, gold):
    stray = gold["fact_demand"].limit(1).withColumn("entity_code", F.lit("FRA"))
    bad = gold | {"fact_demand": gold["fact_demand"].unionByName(stray)}
    assert failing(Q.foreign_key_report(bad)) == {("orphan_countries", "entity_code", 1)}
    keyed = gold["fact_capacity"].withColumn("capacity_series_key", F.lit(99).cast("bigint"))
    bad = gold | {"fact_capacity": keyed}
    assert failing(Q.foreign_key_report(bad)) == {("orphan_capacity_series", "capacity_series_key", 24)}


def test_null_key_is_an_orphan_unless_the_dimension_holds_null(spark, gold):
    nulled = gold["fact_demand"].withColumn("entity_code", F.lit(None).cast("string"))
    bad = gold | {"fact_demand": nulled}
    assert ("orphan_countries", "entity_code", 12) in failing(Q.foreign_key_report(bad))
    empty = gold["dim_country"].limit(1).withColumn("entity_code", F.lit(None).cast("string"))
    with_null = bad | {"dim_country": gold["dim_country"].unionByName(empty)}
    assert failing(Q.foreign_key_report(with_null)) == set()


def test_duplicate_dimension_and_grain_count_all_rows(spark, gold):
    double = gold | {"dim_country": gold["dim_country"].unionByName(gold["dim_country"])}
    assert failing(Q.dimension_report(double)) == {("duplicate_keys", None, 2)}
    demand = gold["fact_demand"].where(F.col("date") == F.lit("2019-01-01").cast("timestamp_ntz"))
    double = gold | {"fact_demand": gold["fact_demand"].unionByName(demand)}
    assert failing(Q.fact_report(double)) == {("duplicate_grain", None, 2)}


def test_null_measure(spark, gold):
    first = F.col("date") == F.lit("2019-01-01").cast("timestamp_ntz")
    nulled = gold["fact_demand"].withColumn(
        "demand_twh", F.when(~first, F.col("demand_twh"))
    )
    assert failing(Q.fact_report(gold | {"fact_demand": nulled})) == {
        ("null_measure", "demand_twh", 1)
    }


def test_persisted_check_values(spark, gold):
    ok = Q.persisted_table_check(gold, "fact_demand").first()
    assert tuple(ok)[1:] == (12, 0, 0, 0)
    with pytest.raises(ValueError):
        Q.persisted_table_check(gold, "fact_weather")


@pytest.mark.parametrize(
    "change,metric",
    [
        (lambda df: df.where("false"), "total_records"),
        (lambda df: df.withColumn("demand_twh", F.lit(None).cast("double")), "null_required_fields"),
        (lambda df: df.withColumn("entity_code", F.lit("XXX")), "invalid_foreign_keys"),
        (lambda df: df.unionByName(df), "duplicate_key_groups"),
    ],
)
def test_persisted_check_fails_closed(spark, gold, change, metric):
    bad = gold | {"fact_demand": change(gold["fact_demand"])}
    with pytest.raises(Q.QualityError, match="fact_demand"):
        Q.raise_if_persisted_invalid(bad)
    row = Q.persisted_table_check(bad, "fact_demand").first().asDict()
    assert (row[metric] == 0) is (metric == "total_records")


def test_persisted_check_does_not_match_nulls(spark, gold):
    nulled = gold["fact_demand"].withColumn("entity_code", F.lit(None).cast("string"))
    empty = gold["dim_country"].limit(1).withColumn("entity_code", F.lit(None).cast("string"))
    bad = gold | {"fact_demand": nulled, "dim_country": gold["dim_country"].unionByName(empty)}
    assert Q.persisted_table_check(bad, "fact_demand").first()["invalid_foreign_keys"] == 12


def test_mart_check(spark):
    schema = "country_name string, start_year bigint, end_year bigint"
    good = spark.createDataFrame([("A", 2019, 2025), ("B", 2019, 2025)], schema)
    assert Q.raise_if_mart_invalid(good, "m") == 2
    for bad in (good.where("false"), good.unionByName(good), good.withColumn("end_year", F.lit(None).cast("bigint"))):
        with pytest.raises(Q.QualityError):
            Q.raise_if_mart_invalid(bad, "m")
    with pytest.raises(Q.QualityError, match="end_year"):
        Q.raise_if_mart_invalid(good.drop("end_year"), "m")


def test_failed_report_names_the_checks(spark):
    with pytest.raises(Q.QualityError, match="duplicate_keys"):
        Q.raise_if_failed(Q.silver_report(frame(spark, ROW, ROW), "generation", expected(spark)), "x")
