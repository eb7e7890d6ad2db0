"""Yearly sums of the facts: what the reports need of a year, in a form that adds up.

For each entity, series and year a fact comes down to a sum, a number of values and the
months seen. The sum is kept in the two parts of `expressions.total`, so sums of sums are
the same as sums of rows. A year's rows depend on that year's facts alone, so they can be
stored by year and computed anew for touched years only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from almanack import schemas as S
from almanack.functions.expressions import months_mask, total_parts

#: Fact -> (columns beside the year, measure).
SUMMED = {
    "fact_generation": (("entity_code", "series_key"), "generation_twh"),
    "fact_demand": (("entity_code",), "demand_twh"),
    "fact_emissions": (("entity_code", "series_key"), "emissions_mtco2"),
    "fact_carbon_intensity": (("entity_code",), "emissions_intensity_gco2_per_kwh"),
    "fact_capacity": (("entity_code", "capacity_series_key"), "capacity_gw"),
}
COLUMNS = ("year", "months", "n", "lead", "rest")


def yearly_name(fact: str) -> str:
    return f"yearly_{fact}"


YEARLY_TABLES = tuple(yearly_name(fact) for fact in SUMMED)


def summed(rows: DataFrame, fact: str) -> DataFrame:
    """Yearly sums of fact rows that have `year` and `month_number` beside them."""
    keys, measure = SUMMED[fact]
    lead, rest = total_parts(measure)
    return rows.groupBy(*keys, F.col("year").cast("bigint").alias("year")).agg(
        months_mask(F.col("month_number")).alias("months"),
        F.count(measure).alias("n"),
        lead.alias("lead"),
        rest.alias("rest"),
    )


def year_sums(fact_rows: DataFrame, fact: str) -> DataFrame:
    """Yearly sums of a fact as it is stored."""
    dated = fact_rows.withColumns({"year": F.year("date"), "month_number": F.month("date")})
    return summed(dated, fact)


def sum_of(condition: Column | None = None) -> Column:
    """Aggregate over yearly sums: the sum of the values behind them; of rows that do not
    meet the condition, nothing."""
    parts = [F.col("lead"), F.col("rest")]
    if condition is not None:
        parts = [F.when(condition, part).otherwise(F.lit(0.0)) for part in parts]
    return F.sum(parts[0]) + F.sum(parts[1])


def mean_of() -> Column:
    """Aggregate over yearly sums: the mean of the values behind them."""
    return sum_of() / F.nullif(F.sum("n"), F.lit(0)).cast("double")


def schema_of(fact: str) -> str:
    keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.GOLD_SCHEMAS[fact] if f.name in SUMMED[fact][0])
    return f"{keys}, year bigint, months int, n bigint, lead double, rest double"
