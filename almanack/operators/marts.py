"""Yearly reports and baseline-versus-latest comparison marts.

Every function takes ``gold``, the nine tables by name. ``as_of_year`` stands
for the current year, which is always left out. No join carries a broadcast
hint: dimensions are written tables, so Spark sees their true size and falls
back to a shuffled join where one is too big.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from almanack import schemas as S
from almanack.functions.expressions import (
    is_complete,
    month_count,
    months_mask,
    percent,
    percent_change,
    rounded,
    total,
    within_years,
)
from almanack.operators import yearly

Gold = dict[str, DataFrame]
CATEGORIES = ("Renewable", "Fossil", "Clean")


def _years(df: DataFrame, first: int | None, before: int) -> DataFrame:
    """Rows dated ``first <= year < before``; stated on the year column as well
    where there is one, by which stored facts are partitioned."""
    conditions = []
    if "date" in df.columns:
        conditions.append(within_years(F.col("date"), first, before))
    if "year" in df.columns:
        year = F.col("year")
        conditions.append((year < before) if first is None else (year >= first) & (year < before))
    return df.where(reduce(Column.__and__, conditions))


def _dated(gold: Gold, fact: str, columns: Sequence[str], as_of_year: int) -> DataFrame:
    """Fact rows before the current year, with year and month."""
    rows = _years(gold[fact], None, as_of_year).select("date", *columns)
    days = _years(gold["dim_date"], None, as_of_year).select("date", "year", "month_number")
    return rows.join(days, "date")


def _component_keys(gold: Gold) -> DataFrame:
    series = gold["dim_energy_series"]
    return series.where(~F.col("is_aggregate_series") & (F.col("series_name") != S.NET_IMPORTS))


def _sums(gold: Gold, fact: str, as_of_year: int) -> DataFrame:
    """Yearly sums of a fact before the current year: the stored ones where the model has
    them, else from the fact's rows."""
    stored = gold.get(yearly.yearly_name(fact))
    if stored is not None:
        return stored.where(F.col("year") < as_of_year)
    keys, measure = yearly.SUMMED[fact]
    return yearly.summed(_dated(gold, fact, [*keys, measure], as_of_year), fact)


def _yearly(sums: DataFrame, by: Sequence[str], **measures: Column) -> DataFrame:
    """Group yearly sums by entity, year (and more) and keep groups with all 12 months."""
    grouped = sums.groupBy("entity_code", "year", *by).agg(
        F.bit_or("months").alias("_months"),
        *[measure.alias(name) for name, measure in measures.items()],
    )
    return grouped.where(is_complete(F.col("_months"))).drop("_months")


# --- generation and demand -------------------------------------------------


def annual_generation(gold: Gold, as_of_year: int) -> DataFrame:
    """Component generation per year; months are counted after the filter."""
    sums = _sums(gold, "fact_generation", as_of_year)
    sums = sums.join(_component_keys(gold).select("series_key"), "series_key")
    return _yearly(sums, [], generation_twh=yearly.sum_of())


def annual_demand(gold: Gold, as_of_year: int) -> DataFrame:
    return _yearly(_sums(gold, "fact_demand", as_of_year), [], demand_twh=yearly.sum_of())


def generation_demand_yearly(gold: Gold, as_of_year: int) -> DataFrame:
    """Yearly balance report."""
    both = annual_generation(gold, as_of_year).join(
        annual_demand(gold, as_of_year), ["entity_code", "year"]
    )
    return (
        both.join(gold["dim_country"], "entity_code")
        .select(
            "country_name",
            "entity_code",
            "year",
            rounded("generation_twh", 2).alias("generation_twh"),
            rounded("demand_twh", 2).alias("demand_twh"),
            rounded(F.col("generation_twh") - F.col("demand_twh"), 2).alias(
                "generation_demand_balance_twh"
            ),
        )
        .orderBy("country_name", "year")
    )


def annual_domestic_net_imports(gold: Gold, as_of_year: int) -> DataFrame:
    """Domestic generation and net imports side by side; months are counted over
    all series."""
    series = gold["dim_energy_series"].select("series_key", "series_name", "is_aggregate_series")
    sums = _sums(gold, "fact_generation", as_of_year).join(series, "series_key")
    flow = F.col("series_name") == S.NET_IMPORTS
    domestic = ~F.col("is_aggregate_series") & ~flow
    return _yearly(
        sums,
        [],
        domestic_generation_twh=yearly.sum_of(domestic),
        net_imports_twh=yearly.sum_of(flow),
    )


def annual_balance(gold: Gold, as_of_year: int) -> DataFrame:
    return annual_domestic_net_imports(gold, as_of_year).join(
        annual_demand(gold, as_of_year), ["entity_code", "year"]
    )


SOURCES = (
    "generation",
    "demand",
    "emissions",
    "carbon_intensity",
    "solar_capacity",
    "wind_capacity",
)


def _source_months(gold: Gold, as_of_year: int | None, first: int | None) -> DataFrame:
    """One row per year with the months seen in each of the six sources. The
    five facts are read side by side and combined per task; where the model has yearly
    sums, these say it."""
    if all(table in gold for table in yearly.YEARLY_TABLES):
        return _summed_months(gold, as_of_year, first)

    def limited(table: str) -> DataFrame:
        return gold[table] if as_of_year is None else _years(gold[table], first, as_of_year)

    plain = [
        limited(f"fact_{name}").select("date", F.lit(name).alias("source_name"))
        for name in SOURCES[:4]
    ]
    wanted = gold["dim_capacity_series"].where(F.col("series_name").isin("Solar", "Wind"))
    capacity = limited("fact_capacity").join(
        wanted.select("capacity_series_key", "series_name"), "capacity_series_key"
    )
    source = F.concat(F.lower("series_name"), F.lit("_capacity"))
    rows = reduce(
        DataFrame.unionByName, [*plain, capacity.select("date", source.alias("source_name"))]
    )
    days = limited("dim_date").select("date", "year", "month_number")
    month = F.col("month_number")
    return (
        rows.join(days, "date")
        .groupBy("year")
        .agg(
            *[
                months_mask(F.when(F.col("source_name") == name, month)).alias(name)
                for name in SOURCES
            ]
        )
    )


def _summed_months(gold: Gold, as_of_year: int | None, first: int | None) -> DataFrame:
    names = gold["dim_capacity_series"].where(F.col("series_name").isin("Solar", "Wind"))
    names = names.select("capacity_series_key", F.concat(F.lower("series_name"), F.lit("_capacity")).alias("source"))
    sums = [
        gold[yearly.yearly_name(f"fact_{name}")].select("year", "months", F.lit(name).alias("source")) for name in SOURCES[:4]
    ]
    capacity = gold[yearly.yearly_name("fact_capacity")].join(names, "capacity_series_key")
    rows = reduce(DataFrame.unionByName, [*sums, capacity.select("year", "months", "source")])
    if as_of_year is not None:
        rows = _years(rows, first, as_of_year)
    seen = [F.bit_or(F.when(F.col("source") == name, F.col("months"))).alias(name) for name in SOURCES]
    return rows.groupBy("year").agg(*seen)


def comparison_sources(gold: Gold, as_of_year: int | None = None) -> DataFrame:
    """(source_name, year, months) for the six series a year must be complete in."""
    masks = _source_months(gold, as_of_year, None)
    return (
        masks.unpivot("year", list(SOURCES), "source_name", "mask")
        .where(F.col("mask").isNotNull())
        .select("source_name", "year", month_count(F.col("mask")).alias("months"))
    )


def comparison_period(
    gold: Gold, as_of_year: int, baseline_year: int = S.BASELINE_YEAR
) -> DataFrame:
    """(start_year, end_year): the fixed baseline and the newest year complete in
    all six sources. No row when there is no such year."""
    complete = reduce(Column.__and__, [is_complete(F.col(name)) for name in SOURCES])
    return (
        _source_months(gold, as_of_year, baseline_year)
        .where(complete)
        .agg(F.max("year").alias("end_year"))
        .where(F.col("end_year").isNotNull())
        .select(F.lit(baseline_year).cast("bigint").alias("start_year"), "end_year")
    )


Period = tuple[int, int]


def resolve_period(gold: Gold, as_of_year: int, baseline_year: int = S.BASELINE_YEAR) -> Period | None:
    """The comparison period as two numbers: one row is read. The marts then
    state both years as literals, so the scans skip all other years."""
    row = comparison_period(gold, as_of_year, baseline_year).first()
    return None if row is None else (row["start_year"], row["end_year"])


#: Stands for a period the caller has not looked for; None is one that does not exist.
SEARCH: Period = (0, 0)


def _given(period: Period | None, gold: Gold, as_of_year: int, baseline_year: int) -> Period | None:
    return resolve_period(gold, as_of_year, baseline_year) if period is SEARCH else period


def _in_years(df: DataFrame, period: Period | None) -> DataFrame:
    """Rows dated in one of the two years; none when there is no period."""
    if period is None:
        return df.where(F.lit(False))
    years = sorted(set(period))
    if "date" not in df.columns:
        return df.where(F.col("year").isin(years))
    ranges = [within_years(F.col("date"), year, year + 1) for year in years]
    limited = df.where(reduce(Column.__or__, ranges))
    return limited.where(F.col("year").isin(years)) if "year" in df.columns else limited


def _bounds(period: Period | None) -> list[Column]:
    start, end = period or (None, None)
    return [
        F.lit(start).cast("bigint").alias("start_year"),
        F.lit(end).cast("bigint").alias("end_year"),
    ]


def _in_period(annual: DataFrame, period: Period | None) -> DataFrame:
    """Yearly rows of the two years, with the period beside them."""
    here = F.col("year").isin(*period) if period else F.lit(False)
    return annual.where(here).select("*", *_bounds(period))


def _for_years(gold: Gold, period: Period | None) -> Gold:
    """The model with facts, yearly sums and months limited to the two years."""
    dated = [t for t in gold if t in S.FACT_GRAINS or t == "dim_date" or t in yearly.YEARLY_TABLES]
    return gold | {table: _in_years(gold[table], period) for table in dated}


def _at_start(value: str, condition: Column | None = None) -> Column:
    hit = F.col("year") == F.col("start_year")
    return F.max(F.when(hit if condition is None else hit & condition, F.col(value)))


def _at_end(value: str, condition: Column | None = None) -> Column:
    hit = F.col("year") == F.col("end_year")
    return F.max(F.when(hit if condition is None else hit & condition, F.col(value)))


def _two_years() -> Column:
    """Aggregate: the group holds both years of the period."""
    return F.min("year") != F.max("year")


def country_period(annual: DataFrame, period: Period | None) -> DataFrame:
    """Entities present in both years of the period."""
    return (
        _in_period(annual, period)
        .groupBy("entity_code", "start_year", "end_year")
        .agg(_two_years().alias("_both"))
        .where("_both")
        .drop("_both")
    )


def generation_demand_summary(
    gold: Gold,
    as_of_year: int,
    baseline_year: int = S.BASELINE_YEAR,
    period: Period | None = SEARCH,
) -> DataFrame:
    """Mart 1. Both years are picked in one aggregation instead of two self joins."""
    period = _given(period, gold, as_of_year, baseline_year)
    values = {
        "generation": "domestic_generation_twh",
        "demand": "demand_twh",
        "net_imports": "net_imports_twh",
    }
    picked = [_at_start(col).alias(f"first_{name}") for name, col in values.items()]
    picked += [_at_end(col).alias(f"latest_{name}") for name, col in values.items()]
    compared = (
        _in_period(annual_balance(_for_years(gold, period), as_of_year), period)
        .groupBy("entity_code", "start_year", "end_year")
        .agg(_two_years().alias("_both"), *picked)
        .where("_both")
    )

    def both(name: str) -> list[Column]:
        return [
            rounded(f"{when}_{name}", 2).alias(f"{when}_{name}_twh") for when in ("first", "latest")
        ]

    def change(name: str) -> Column:
        return rounded(percent_change(F.col(f"first_{name}"), F.col(f"latest_{name}")), 1).alias(
            f"{name}_change_pct"
        )

    return (
        compared.join(gold["dim_country"], "entity_code")
        .select(
            "country_name",
            "entity_code",
            "start_year",
            "end_year",
            *both("generation"),
            change("generation"),
            *both("demand"),
            change("demand"),
            *both("net_imports"),
        )
        .orderBy("country_name")
    )


# --- energy mix --------------------------------------------------------------


def annual_mix(gold: Gold, as_of_year: int) -> DataFrame:
    """Component generation per entity, year and category, any number of months."""
    return monthly_to_annual_mix(monthly_mix(gold, as_of_year), gold).drop("months_available")


def monthly_mix(gold: Gold, as_of_year: int | None = None) -> DataFrame:
    rows = gold["fact_generation"]
    if as_of_year is not None:
        rows = _years(rows, None, as_of_year)
    return (
        rows.join(_component_keys(gold).select("series_key", "energy_category"), "series_key")
        .groupBy("entity_code", "date", "energy_category")
        .agg(total("generation_twh").alias("generation_twh"))
    )


def monthly_to_annual_mix(monthly: DataFrame, gold: Gold) -> DataFrame:
    days = gold["dim_date"].select("date", "year", "month_number")
    return (
        monthly.join(days, "date")
        .groupBy("entity_code", "year", "energy_category")
        .agg(
            month_count(months_mask(F.col("month_number"))).alias("months_available"),
            total("generation_twh").alias("generation_twh"),
        )
    )


def complete_country_years(gold: Gold, as_of_year: int) -> DataFrame:
    """(entity_code, year) with all 12 months over every generation row."""
    return _yearly(_sums(gold, "fact_generation", as_of_year), [])


def _mix_parts(gold: Gold, as_of_year: int) -> DataFrame:
    """Everything the yearly mix rests on, from one pass over the fact: per entity, year,
    category and kind of series the sum and the months seen. On that small result, months
    of all rows decide whether a year is complete, and components make up its total."""
    series = gold["dim_energy_series"].select("series_key", "series_name", "is_aggregate_series", "energy_category")
    sums = _sums(gold, "fact_generation", as_of_year)
    component = ~F.col("is_aggregate_series") & (F.col("series_name") != S.NET_IMPORTS)
    parts = (
        sums.join(series, "series_key", "left")
        .withColumn("_component", F.coalesce(component, F.lit(False)))
        .groupBy("entity_code", "year", "_component", F.when(F.col("_component"), F.col("energy_category")).alias("energy_category"))
        .agg(yearly.sum_of().alias("generation_twh"), F.bit_or("months").alias("_seen"))
    )
    year = Window.partitionBy("entity_code", "year")
    whole = total(F.when(F.col("_component"), F.col("generation_twh")), year)
    return (
        parts.withColumn("_months", F.bit_or("_seen").over(year))
        .withColumn("total_generation_twh", whole)
        .where(F.col("_component") & is_complete(F.col("_months")))
        .select("entity_code", "year", "energy_category", "generation_twh", "total_generation_twh")
    )


def annual_total(gold: Gold, as_of_year: int) -> DataFrame:
    parts = _mix_parts(gold, as_of_year)
    return parts.groupBy("entity_code", "year").agg(F.max("total_generation_twh").alias("total_generation_twh"))


def annual_shares(gold: Gold, as_of_year: int) -> DataFrame:
    """Unrounded share of every category in a complete year."""
    share = percent(F.col("generation_twh"), F.col("total_generation_twh"))
    return _mix_parts(gold, as_of_year).select(
        "entity_code", "year", "energy_category", "generation_twh", share.alias("generation_share_pct")
    )


def energy_mix_yearly(gold: Gold, as_of_year: int) -> DataFrame:
    """Yearly mix report."""
    return (
        annual_shares(gold, as_of_year)
        .join(gold["dim_country"], "entity_code")
        .select(
            "country_name",
            "entity_code",
            "year",
            "energy_category",
            rounded("generation_twh", 2).alias("generation_twh"),
            rounded("generation_share_pct", 1).alias("generation_share_pct"),
        )
        .orderBy("country_name", "year", "energy_category")
    )


def eligible_countries(gold: Gold, as_of_year: int, period: Period | None) -> DataFrame:
    return country_period(annual_total(_for_years(gold, period), as_of_year), period).select("entity_code")


def mix_pivot(gold: Gold, as_of_year: int, period: Period | None) -> DataFrame:
    """Start and end share of the three categories; a category without rows in a
    complete year counts as zero."""
    cells = []
    for name in CATEGORIES:
        category = F.col("energy_category") == name
        for when, pick in (("start", _at_start), ("end", _at_end)):
            cell = F.coalesce(pick("generation_share_pct", category), F.lit(0.0))
            cells.append(cell.alias(f"{name.lower()}_{when}_pct"))
    return (
        _in_period(annual_shares(_for_years(gold, period), as_of_year), period)
        .groupBy("entity_code", "start_year", "end_year")
        .agg(_two_years().alias("_both"), *cells)
        .where("_both")
        .drop("_both")
    )


def energy_mix_transition_summary(
    gold: Gold,
    as_of_year: int,
    baseline_year: int = S.BASELINE_YEAR,
    period: Period | None = SEARCH,
) -> DataFrame:
    """Mart 2. Changes are percentage points of the unrounded shares."""
    period = _given(period, gold, as_of_year, baseline_year)
    columns = []
    for name in (c.lower() for c in CATEGORIES):
        start, end = F.col(f"{name}_start_pct"), F.col(f"{name}_end_pct")
        columns += [
            rounded(start, 1).alias(f"{name}_start_pct"),
            rounded(end, 1).alias(f"{name}_end_pct"),
            rounded(end - start, 1).alias(f"{name}_change_pp"),
        ]
    return (
        mix_pivot(gold, as_of_year, period)
        .join(gold["dim_country"], "entity_code")
        .select("country_name", "entity_code", "start_year", "end_year", *columns)
        .orderBy("country_name")
    )


# --- emissions and carbon intensity -----------------------------------------


def annual_emissions(gold: Gold, as_of_year: int, period: Period | None) -> DataFrame:
    """Yearly emissions of the total series in the years of the period."""
    whole = gold["dim_energy_series"].where(F.col("series_name") == S.TOTAL_GENERATION)
    sums = _sums(_for_years(gold, period), "fact_emissions", as_of_year)
    sums = sums.join(whole.select("series_key"), "series_key")
    return _in_period(_yearly(sums, [], emissions_mtco2=yearly.sum_of()), period)


def annual_intensity(gold: Gold, as_of_year: int, period: Period | None) -> DataFrame:
    """Unweighted mean of the monthly intensities."""
    sums = _sums(_for_years(gold, period), "fact_carbon_intensity", as_of_year)
    return _in_period(_yearly(sums, [], avg_carbon_intensity_gco2_per_kwh=yearly.mean_of()), period)


def emissions_pivot(gold: Gold, as_of_year: int, period: Period | None) -> DataFrame:
    """Every country with its start and end values, null where there is none."""
    sides = []
    for build, value, name in (
        (annual_emissions, "emissions_mtco2", "emissions_{}_mtco2"),
        (annual_intensity, "avg_carbon_intensity_gco2_per_kwh", "carbon_intensity_{}"),
    ):
        frame = build(gold, as_of_year, period)
        sides.append(
            frame.groupBy("entity_code").agg(
                _at_start(value).alias(name.format("start")),
                _at_end(value).alias(name.format("end")),
            )
        )
    countries = gold["dim_country"].select("entity_code", "country_name").distinct()
    return countries.join(sides[0], "entity_code", "left").join(sides[1], "entity_code", "left")


def _present(*columns: str) -> Column:
    condition = F.lit(True)
    for column in columns:
        condition = condition & F.col(column).isNotNull()
    return condition


def emissions_carbon_intensity(
    gold: Gold,
    as_of_year: int,
    baseline_year: int = S.BASELINE_YEAR,
    period: Period | None = SEARCH,
) -> DataFrame:
    """Mart 3: emissions change in percent, intensity change absolute."""
    period = _given(period, gold, as_of_year, baseline_year)
    pivot = emissions_pivot(gold, as_of_year, period).where(
        _present(
            "emissions_start_mtco2",
            "emissions_end_mtco2",
            "carbon_intensity_start",
            "carbon_intensity_end",
        )
    )
    first, last = F.col("emissions_start_mtco2"), F.col("emissions_end_mtco2")
    return (
        pivot.select(
            *_bounds(period),
            "country_name",
            rounded(first, 2).alias("emissions_start_mtco2"),
            rounded(last, 2).alias("emissions_end_mtco2"),
            rounded(percent_change(first, last), 1).alias("emissions_change_pct"),
            rounded("carbon_intensity_start", 1).alias("carbon_intensity_start"),
            rounded("carbon_intensity_end", 1).alias("carbon_intensity_end"),
            rounded(F.col("carbon_intensity_end") - F.col("carbon_intensity_start"), 1).alias(
                "carbon_intensity_change_gco2_per_kwh"
            ),
        )
        .orderBy(F.asc_nulls_last("emissions_change_pct"))
    )


# --- installed capacity --------------------------------------------------------


def annual_capacity(gold: Gold, as_of_year: int, period: Period | None) -> DataFrame:
    """Mean capacity of solar and wind, each complete in its own year."""
    wanted = gold["dim_capacity_series"].where(F.col("series_name").isin("Solar", "Wind"))
    sums = _sums(_for_years(gold, period), "fact_capacity", as_of_year)
    sums = sums.join(wanted.select("capacity_series_key", "series_name"), "capacity_series_key")
    return _in_period(_yearly(sums, ["series_name"], avg_capacity_gw=yearly.mean_of()), period)


def capacity_pivot(gold: Gold, as_of_year: int, period: Period | None) -> DataFrame:
    cells = []
    for name in ("Solar", "Wind"):
        series = F.col("series_name") == name
        cells += [
            _at_start("avg_capacity_gw", series).alias(f"{name.lower()}_start_gw"),
            _at_end("avg_capacity_gw", series).alias(f"{name.lower()}_end_gw"),
        ]
    pivot = annual_capacity(gold, as_of_year, period).groupBy("entity_code").agg(*cells)
    countries = gold["dim_country"].select("entity_code", "country_name").distinct()
    return countries.join(pivot, "entity_code")


def installed_solar_wind_capacity(
    gold: Gold,
    as_of_year: int,
    baseline_year: int = S.BASELINE_YEAR,
    period: Period | None = SEARCH,
) -> DataFrame:
    """Mart 4. Solar, wind and their sum at both ends of the period."""
    period = _given(period, gold, as_of_year, baseline_year)
    ends = ("solar_start_gw", "solar_end_gw", "wind_start_gw", "wind_end_gw")
    pivot = capacity_pivot(gold, as_of_year, period).where(_present(*ends))
    sums = pivot.withColumns(
        {
            f"solar_wind_{when}_gw": F.col(f"solar_{when}_gw") + F.col(f"wind_{when}_gw")
            for when in ("start", "end")
        }
    )
    columns = []
    for name in ("solar", "wind", "solar_wind"):
        first, last = F.col(f"{name}_start_gw"), F.col(f"{name}_end_gw")
        columns += [
            rounded(first, 2).alias(f"{name}_start_gw"),
            rounded(last, 2).alias(f"{name}_end_gw"),
            rounded(percent_change(first, last), 1).alias(f"{name}_change_pct"),
        ]
    return (
        sums.select(*_bounds(period), "country_name", *columns)
        .orderBy(F.desc_nulls_last("solar_wind_change_pct"))
    )


# Registry of published marts: name -> (version, builder). The version belongs
# to the result's identity: raise it when a definition changes.
MARTS = {
    "generation_demand_summary": ("1", generation_demand_summary),
    "energy_mix_transition_summary": ("1", energy_mix_transition_summary),
    "emissions_carbon_intensity": ("1", emissions_carbon_intensity),
    "installed_solar_wind_capacity": ("1", installed_solar_wind_capacity),
}


def mart_table_name(mart: str) -> str:
    """Reporting tables stay apart from the model's tables."""
    if mart not in MARTS:
        raise ValueError(f"unknown mart {mart!r}")
    return f"analytics_{mart}"
