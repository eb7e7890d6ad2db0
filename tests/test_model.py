import pytest
from pyspark.sql import functions as F

from almanack import schemas as S
from almanack.operators import dimensions as D, facts as M
from almanack.sources import lookups
from conftest import rows
from fixtures import Source


@pytest.fixture()
def source():
    return Source().year("DEU", 2019).year("BGR", 2020, months=range(1, 7))


def test_months_come_from_the_core_datasets(spark, source):
    source.capacity("DEU", 2025, [5], Solar=1.0)
    got = {r["date"].year: r["is_complete_year"] for r in D.dim_date(source.silver(spark)).collect()}
    assert got == {2019: True, 2020: False}


def test_completeness_is_over_all_countries(spark):
    split = Source().demand("A", 2019, 1, range(1, 7)).demand("B", 2019, 1, range(7, 13))
    silver = split.generation("A", 2018, [1], Solar=1).silver(spark)
    got = {r["year_month"]: r["is_complete_year"] for r in D.dim_date(silver).collect()}
    assert got["2019-03"] is True and got["2018-01"] is False


def test_calendar_columns(spark, source):
    row = D.dim_date(source.silver(spark)).where("month_number = 12").first()
    assert (row["quarter"], row["month_name"], row["year_month"]) == (4, "December", "2019-12")
    assert dict(D.dim_date(source.silver(spark)).dtypes)["year"] == "bigint"


def test_membership_is_the_fixed_list(spark, source):
    got = dict(
        rows(D.dim_country(source.silver(spark), lookups.members(spark)).select("entity_code", "eu_member_flag"))
    )
    assert got == {"DEU": True, "BGR": False}
    assert len(S.EU_MEMBER_CODES) == 17


def test_renamed_country_gives_two_rows(spark, source):
    source.rows["demand"].append(("Deutschland", "DEU", source.rows["demand"][0][2], 1.0))
    dim = D.dim_country(source.silver(spark), lookups.members(spark))
    assert dim.where("entity_code = 'DEU'").count() == 2


def test_unknown_series_is_unclassified(spark, source):
    source.generation("DEU", 2019, [1], Tidal=1.0)
    dim = D.dim_energy_series(source.silver(spark), lookups.series_classification(spark))
    got = {r["series_name"]: (r["technology_group"], r["energy_category"]) for r in dim.collect()}
    assert got["Tidal"] == ("Unclassified", "Unclassified")
    assert got["Gas"] == ("Gas", "Fossil") and got["Net imports"][1] == "Flow"
    assert "Wind" not in got  # capacity series stay out


def test_capacity_series_have_their_own_keys(spark, source):
    gold = source.gold(spark)
    energy = {r["series_key"] for r in gold["dim_energy_series"].collect()}
    capacity = {r["capacity_series_key"] for r in gold["dim_capacity_series"].collect()}
    assert not energy & capacity


def test_conflicting_flags_fail_the_fact(spark, source):
    first = source.rows["generation"][0]
    source.rows["generation"].append(first[:5] + (True,) + first[6:])
    with pytest.raises(Exception, match="not unique"):
        source.gold(spark)


def test_unmatched_series_keeps_a_null_key(spark, source):
    silver = source.silver(spark)
    dim = D.dim_energy_series(silver, lookups.series_classification(spark)).where("series_name <> 'Gas'")
    fact = M.fact_generation(silver["generation"], dim)
    assert fact.count() == silver["generation"].count()
    assert fact.where(F.col("series_key").isNull()).count() == 18


def test_nine_tables_with_declared_columns(spark, source):
    gold = source.gold(spark)
    assert tuple(gold) == S.GOLD_TABLES
    for name, df in gold.items():
        declared = [(f.name, f.dataType.simpleString()) for f in S.GOLD_SCHEMAS[name]]
        assert df.dtypes == declared
