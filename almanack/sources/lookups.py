"""Small lookup tables built from the fixed values (sizes known up front)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from almanack import schemas as S


def series_classification(spark: SparkSession, rows=S.SERIES_CLASSIFICATION) -> DataFrame:
    return spark.createDataFrame(
        list(rows), "series_name string, technology_group string, energy_category string"
    )


def expected_countries(dataset: str) -> list[str]:
    """The dataset's own country list, else the project list."""
    own = {"capacity": S.CAPACITY_COUNTRIES}
    return list(own.get(S.require_dataset(dataset), S.PROJECT_COUNTRIES))


def country_scope(spark: SparkSession) -> DataFrame:
    """(dataset, entity_code) for every dataset."""
    rows = [(name, code) for name in S.DATASETS for code in expected_countries(name)]
    return spark.createDataFrame(rows, "dataset string, entity_code string")


def members(spark: SparkSession, codes=S.EU_MEMBER_CODES) -> DataFrame:
    return spark.createDataFrame([(code,) for code in codes], "entity_code string")
