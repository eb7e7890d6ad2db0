"""Conformed dimensions from the silver datasets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from almanack import schemas as S
from almanack.functions.expressions import (
    capacity_series_key,
    is_complete,
    months_mask,
    series_key,
)


def _distinct_union(frames: list[DataFrame]) -> DataFrame:
    """Distinct per input first, so only a few rows per task reach the union."""
    return reduce(DataFrame.unionByName, [frame.distinct() for frame in frames]).distinct()


def dim_date(silver: dict[str, DataFrame]) -> DataFrame:
    """One row per month of the core datasets; capacity dates do not count. A
    year is complete when all 12 months occur in it, whatever the country."""
    dates = _distinct_union([silver[name].select("date") for name in S.CORE_DATASETS])
    year = Window.partitionBy("year")  # at most the distinct dates of one year
    return (
        dates.withColumns(
            {
                "year": F.year("date").cast("bigint"),
                "quarter": F.quarter("date").cast("bigint"),
                "month_number": F.month("date").cast("bigint"),
                "month_name": F.date_format("date", "MMMM"),
                "year_month": F.date_format("date", "yyyy-MM"),
            }
        )
        .withColumn("is_complete_year", is_complete(months_mask(F.col("month_number")).over(year)))
        .select(*S.GOLD_SCHEMAS["dim_date"].fieldNames())
    )


def dim_country(silver: dict[str, DataFrame], members: DataFrame) -> DataFrame:
    """Distinct (code, name) over all datasets. A renamed country yields two
    rows on purpose; the dimension check reports it."""
    countries = _distinct_union([df.select("entity_code", "entity") for df in silver.values()])
    flags = members.select(F.col("entity_code").alias("member_code")).distinct()
    return countries.join(flags, F.col("entity_code") == F.col("member_code"), "left").select(
        "entity_code",
        F.col("entity").alias("country_name"),
        F.col("member_code").isNotNull().alias("eu_member_flag"),
    )


def dim_energy_series(silver: dict[str, DataFrame], classification: DataFrame) -> DataFrame:
    """Series of generation and emissions with group and category."""
    series = _distinct_union(
        [
            silver[name].select(F.col("series").alias("series_name"), "is_aggregate_series")
            for name in S.ENERGY_SERIES_DATASETS
        ]
    )
    return series.join(classification, "series_name", "left").select(
        series_key("series_name").alias("series_key"),
        "series_name",
        F.coalesce("technology_group", F.lit(S.UNCLASSIFIED)).alias("technology_group"),
        F.coalesce("energy_category", F.lit(S.UNCLASSIFIED)).alias("energy_category"),
        "is_aggregate_series",
    )


def dim_capacity_series(capacity: DataFrame) -> DataFrame:
    """Capacity series apart, as a name may be an aggregate only there."""
    return (
        capacity.select(F.col("series").alias("series_name"), "is_aggregate_series")
        .distinct()
        .select(
            capacity_series_key("series_name").alias("capacity_series_key"),
            "series_name",
            "is_aggregate_series",
        )
    )
