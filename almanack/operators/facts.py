"""Fact tables and the whole nine-table model."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from almanack import schemas as S
from almanack.operators import dimensions as D


def attach_key(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left join of the series key; an unmatched series keeps a null key and a
    series listed twice in the dimension fails the query."""
    unique = F.when(
        F.count("*") > 1,
        F.raise_error(F.concat(F.lit(f"{key} is not unique for series "), F.col("series_name"))).cast(
            "bigint"
        ),
    ).otherwise(F.max(key))
    lookup = dim.groupBy("series_name").agg(unique.alias(key))
    return df.join(lookup, df["series"].eqNullSafe(lookup["series_name"]), "left")


def _fact(df: DataFrame, table: str) -> DataFrame:
    return df.select(*S.GOLD_SCHEMAS[table].fieldNames())


def fact_generation(generation: DataFrame, dim_energy_series: DataFrame) -> DataFrame:
    return _fact(attach_key(generation, dim_energy_series, "series_key"), "fact_generation")


def fact_emissions(emissions: DataFrame, dim_energy_series: DataFrame) -> DataFrame:
    return _fact(attach_key(emissions, dim_energy_series, "series_key"), "fact_emissions")


def fact_demand(demand: DataFrame) -> DataFrame:
    return _fact(demand, "fact_demand")


def fact_carbon_intensity(carbon_intensity: DataFrame) -> DataFrame:
    return _fact(carbon_intensity, "fact_carbon_intensity")


def fact_capacity(capacity: DataFrame, dim_capacity_series: DataFrame) -> DataFrame:
    return _fact(attach_key(capacity, dim_capacity_series, "capacity_series_key"), "fact_capacity")


def dimension_tables(
    silver: dict[str, DataFrame], classification: DataFrame, members: DataFrame
) -> dict[str, DataFrame]:
    return {
        "dim_date": D.dim_date(silver),
        "dim_country": D.dim_country(silver, members),
        "dim_energy_series": D.dim_energy_series(silver, classification),
        "dim_capacity_series": D.dim_capacity_series(silver["capacity"]),
    }


#: The dataset each fact is made of.
DATASET_OF = {
    "fact_generation": "generation",
    "fact_emissions": "emissions",
    "fact_demand": "demand",
    "fact_carbon_intensity": "carbon_intensity",
    "fact_capacity": "capacity",
}


def fact_tables(silver: dict[str, DataFrame], dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Facts for given dimensions. Hand in written dimensions: only then does
    Spark know how small they are and looks keys up without moving the facts."""
    energy, capacity = dims["dim_energy_series"], dims["dim_capacity_series"]
    return {
        "fact_generation": fact_generation(silver["generation"], energy),
        "fact_emissions": fact_emissions(silver["emissions"], energy),
        "fact_demand": fact_demand(silver["demand"]),
        "fact_carbon_intensity": fact_carbon_intensity(silver["carbon_intensity"]),
        "fact_capacity": fact_capacity(silver["capacity"], capacity),
    }


def gold_model(
    silver: dict[str, DataFrame], classification: DataFrame, members: DataFrame
) -> dict[str, DataFrame]:
    """Four dimensions and five facts, all lazy."""
    dims = dimension_tables(silver, classification, members)
    return dims | fact_tables(silver, dims)
