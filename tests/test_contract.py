"""The driver contract: every query over the statistics has SQL, and a
selection of them equals its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
import check_oracle
from almanack.contract.oracle import oracle
from almanack.contract.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SELECTION = [
    "silver_clean_generation",
    "increment_plan",
    "full_rebuild_plan",
    "mart_fingerprint",
    "annual_sums_wide_range",
    "silver_merge_keep_last",
    "bronze_roundtrip",
    "dq_silver_report",
    "dq_foreign_keys",
    "dq_persisted_table",
    "dim_country",
    "fact_generation",
    "comparison_sources",
    "energy_mix_yearly",
    "mart_generation_demand_summary_by_region",
    "mart_energy_mix_transition_summary_by_region",
    "mart_emissions_carbon_intensity_by_region",
    "mart_installed_solar_wind_capacity_by_region",
    "column_profile",
    "describe_measures",
    "iqr_screen_lines",
]


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle())
    assert not set(contract.oracle_sql()) - set(contract.queries())


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")
@pytest.mark.parametrize("name", SELECTION)
def test_query_equals_sql(spark, name):
    con = check_oracle.connect(SF_DIR)
    ok, _, note = check_oracle.compare(spark, con, name, SF_DIR, contract.oracle_sql()[name])
    assert ok, note


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")
def test_entry(spark):
    assert contract.entry(spark).count() == 3
