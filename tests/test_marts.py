import pytest

from almanack.operators import marts as K
from conftest import rows
from fixtures import Source


def two_countries():
    """A and B complete in 2019 and 2021, A also in 2020; 2022 incomplete."""
    source = Source()
    source.year("AAA", 2019, solar=1, gas=3, flow=1, demand=4, emitted=10, intensity=200, solar_gw=2, wind_gw=4)
    source.year("AAA", 2020)
    source.year("AAA", 2021, solar=2, gas=2, flow=-1, demand=5, emitted=5, intensity=150, solar_gw=3, wind_gw=4)
    source.year("BBB", 2019, solar=0, gas=1, demand=1, emitted=0, solar_gw=0, wind_gw=1)
    source.year("BBB", 2021, solar=0, gas=4, demand=1, emitted=7, solar_gw=1, wind_gw=3)
    return source.year("AAA", 2022, months=range(1, 12))


@pytest.fixture(scope="module")
def gold(spark):
    return two_countries().gold(spark)


def test_period_is_the_newest_year_complete_in_all_sources(spark, gold):
    assert K.resolve_period(gold, 2026) == (2019, 2021)
    assert K.resolve_period(gold, 2021) == (2019, 2020)


def test_one_incomplete_source_moves_the_period(spark):
    source = two_countries()
    source.rows["capacity"] = [
        r for r in source.rows["capacity"] if not (r[4] == "Wind" and r[3].year == 2021 and r[3].month == 5)
    ]
    assert K.resolve_period(source.gold(spark), 2026) == (2019, 2020)


def test_source_coverage(spark, gold):
    got = {(r[0], r[1]): r[2] for r in K.comparison_sources(gold).collect()}
    assert got[("solar_capacity", 2019)] == 12 and got[("demand", 2022)] == 11
    assert len(got) == 6 * 4


def test_first_mart(spark, gold):
    got = K.generation_demand_summary(gold, 2026)
    assert [tuple(r) for r in got.collect()] == [
        ("Land AAA", "AAA", 2019, 2021, 48.0, 48.0, 0.0, 48.0, 60.0, 25.0, 12.0, -12.0),
        ("Land BBB", "BBB", 2019, 2021, 12.0, 48.0, 300.0, 12.0, 12.0, 0.0, 6.0, 6.0),
    ]
    assert got.columns[6] == "generation_change_pct"


def test_second_mart_counts_missing_categories_as_zero(spark, gold):
    got = K.energy_mix_transition_summary(gold, 2026).collect()
    first = got[0].asDict()
    assert (first["renewable_start_pct"], first["renewable_end_pct"]) == (25.0, 50.0)
    assert (first["renewable_change_pp"], first["fossil_change_pp"]) == (25.0, -25.0)
    assert (first["clean_start_pct"], first["clean_end_pct"], first["clean_change_pp"]) == (0, 0, 0)
    assert got[1]["fossil_end_pct"] == 100.0


def test_third_mart_orders_nulls_last(spark, gold):
    got = [tuple(r) for r in K.emissions_carbon_intensity(gold, 2026).collect()]
    assert got == [
        (2019, 2021, "Land AAA", 120.0, 60.0, -50.0, 200.0, 150.0, -50.0),
        (2019, 2021, "Land BBB", 0.0, 84.0, None, 100.0, 100.0, 0.0),
    ]


def test_fourth_mart(spark, gold):
    got = [tuple(r) for r in K.installed_solar_wind_capacity(gold, 2026).collect()]
    assert got == [
        (2019, 2021, "Land BBB", 0.0, 1.0, None, 1.0, 3.0, 200.0, 1.0, 4.0, 300.0),
        (2019, 2021, "Land AAA", 2.0, 3.0, 50.0, 4.0, 4.0, 0.0, 6.0, 7.0, 16.7),
    ]


def test_country_without_the_baseline_is_left_out(spark):
    gold = two_countries().year("CCC", 2021).gold(spark)
    for name, (_, build) in K.MARTS.items():
        names = {r["country_name"] for r in build(gold, 2026).collect()}
        assert names == {"Land AAA", "Land BBB"}, name


def test_country_incomplete_in_one_measure_is_left_out_of_that_mart(spark):
    source = two_countries()
    source.rows["demand"] = [
        r for r in source.rows["demand"] if not (r[1] == "BBB" and r[2].year == 2021 and r[2].month == 3)
    ]
    gold = source.gold(spark)
    assert K.generation_demand_summary(gold, 2026).count() == 1
    assert K.energy_mix_transition_summary(gold, 2026).count() == 2


def test_start_equal_to_end(spark):
    """Two marts need two different years, the others show no change."""
    gold = Source().year("AAA", 2019).gold(spark)
    assert K.resolve_period(gold, 2026) == (2019, 2019)
    assert K.generation_demand_summary(gold, 2026).count() == 0
    assert K.energy_mix_transition_summary(gold, 2026).count() == 0
    assert K.emissions_carbon_intensity(gold, 2026).first()["emissions_change_pct"] == 0.0
    assert K.installed_solar_wind_capacity(gold, 2026).first()["solar_wind_change_pct"] == 0.0


def test_no_complete_year_gives_empty_marts(spark):
    gold = Source().year("AAA", 2019, months=range(1, 12)).gold(spark)
    assert K.resolve_period(gold, 2026) is None
    for _, build in K.MARTS.values():
        assert build(gold, 2026).count() == 0


def test_yearly_reports_skip_the_current_and_incomplete_years(spark, gold):
    years = {(r["entity_code"], r["year"]) for r in K.generation_demand_yearly(gold, 2021).collect()}
    assert years == {("AAA", 2019), ("AAA", 2020), ("BBB", 2019)}
    mix = K.energy_mix_yearly(gold, 2026).collect()
    assert {r["year"] for r in mix} == {2019, 2020, 2021}
    assert [r["generation_share_pct"] for r in mix if r["entity_code"] == "AAA" and r["year"] == 2019] == [75.0, 25.0]


def test_months_are_counted_after_or_before_the_series_filter(spark):
    """December has net imports only: incomplete as component generation,
    complete for the domestic split and for the mix."""
    source = Source().generation("AAA", 2019, range(1, 12), Gas=1.0)
    source.generation("AAA", 2019, [12], Net_imports=1.0).demand("AAA", 2019, 1)
    source.capacity("AAA", 2019, [1], Solar=1.0)
    gold = source.gold(spark)
    assert K.annual_generation(gold, 2026).count() == 0
    assert rows(K.annual_domestic_net_imports(gold, 2026)) == [("AAA", 2019, 11.0, 1.0)]
    assert K.complete_country_years(gold, 2026).count() == 1


def test_zero_total_gives_a_null_share(spark):
    source = Source().generation("AAA", 2019, Gas=1.0, Solar=-1.0)
    source.capacity("AAA", 2019, [1], Solar=1.0)
    assert {r["generation_share_pct"] for r in K.annual_shares(source.gold(spark), 2026).collect()} == {None}


def test_registry():
    assert K.mart_table_name("emissions_carbon_intensity") == "analytics_emissions_carbon_intensity"
    assert len(K.MARTS) == 4
    with pytest.raises(ValueError):
        K.mart_table_name("weather")


def test_scans_skip_years_and_plans_have_no_cross_joins(spark, gold, tmp_path):
    from almanack.plans import gold as G

    G.publish_gold(spark, gold, str(tmp_path))
    stored = G.load_gold(spark, str(tmp_path))
    assert [tuple(r) for r in K.emissions_carbon_intensity(stored, 2026).collect()] == [
        tuple(r) for r in K.emissions_carbon_intensity(gold, 2026).collect()
    ]
    for _, build in K.MARTS.values():
        plan = build(stored, 2026)._jdf.queryExecution().executedPlan().toString()
        assert "IN (2019,2021)" in plan and "PartitionFilters: [isnotnull(year" in plan
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    period = K.comparison_period(stored, 2026)._jdf.queryExecution().executedPlan().toString()
    assert "generation_twh" not in period and "NestedLoop" not in period
