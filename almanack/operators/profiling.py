"""Profiles, distribution screens and small regressions over the datasets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from almanack import schemas as S
from almanack.functions.expressions import is_missing, mean, rounded, total, total_parts
from almanack.functions.quantiles import COUNT, VALUE, quantiles_of, value_counts
from almanack.session import hand_over

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- coverage -----------------------------------------------------------------


#: Rows in whose order the first values of a column are looked for before all rows are.
HEAD = 1000


def _first_values(df: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """(column, v, at): the values of columns as text, and the first place each has."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns]
    at = F.struct(*[F.col(c).alias(f"o_{c}") for c in order]).alias("at")
    types = dict(df.dtypes)
    known = [F.when(~is_missing(c, types[c]), cell) for c, cell in zip(columns, cells)]
    rows = df.select(at, F.explode(F.array(*known)).alias("cell")).where(F.col("cell").isNotNull())
    return rows.groupBy("cell.column", "cell.v").agg(F.min("at").alias("at"))


def _samples(df: DataFrame, unique: dict[str, int], order: Sequence[str]) -> DataFrame:
    """(column, sample_values): the first three values of each column in the given order.

    They mostly stand in the first rows; only columns that have more values than show
    there are looked through whole."""
    head = hand_over(df.orderBy(*order).limit(HEAD), "profile-head")
    place = F.struct(*[F.col(c).alias(f"o_{c}") for c in order])
    found = _first_values(head, df.columns, order)
    if head.count() == HEAD:  # rows beyond may share the last place
        found = found.where(F.col("at") < head.agg(F.max(place).alias("last")).select("last").scalar())
    found = hand_over(found, "profile-first")
    have = {r["column"]: r["count"] for r in found.groupBy("column").count().collect()}  # a row for each column
    missing = [c for c in df.columns if have.get(c, 0) < min(3, unique.get(c, 0))]
    if missing:
        whole = _first_values(df, missing, order)
        found = found.where(~F.col("column").isin(missing)).unionByName(whole)
    rank = F.row_number().over(Window.partitionBy("column").orderBy("at", "v"))
    top = found.withColumn("rank", rank).where(F.col("rank") <= 3).groupBy("column")
    top = top.agg(F.sort_array(F.collect_list(F.struct("rank", "v"))).alias("top"))
    return top.select("column", F.array_join(F.col("top.v"), ", ").alias("sample_values"))


def column_profile(df: DataFrame, dataset: str, order: Sequence[str]) -> DataFrame:
    """Type, nulls, distinct values and the first three values (in ``order``) of
    every column.

    All columns are unfolded into (column, value) and counted by value, which hash
    aggregation does map-side first; the order matters for the samples alone.
    """
    types = dict(df.dtypes)
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.when(~is_missing(c, types[c]), F.col(f"`{c}`").cast("string")).alias("v"),
        )
        for c in df.columns
    ]
    values = (
        df.select(F.explode(F.array(*cells)).alias("cell"))
        .groupBy(F.col("cell.column").alias("column"), F.col("cell.v").alias("v"))
        .agg(F.count("*").alias("n"))
    )
    nulls = F.sum(F.when(F.col("v").isNull(), F.col("n")).otherwise(F.lit(0).cast("bigint")))
    counts = values.groupBy("column").agg(
        F.sum("n").alias("row_count"), nulls.alias("null_count"), F.count("v").alias("unique_values")
    )
    counts = hand_over(counts, f"profile-{dataset}")  # a row for each column
    unique = {r["column"]: r["unique_values"] for r in counts.collect()}
    names = F.create_map(*[F.lit(x) for c in df.columns for x in (c, types[c])])
    return counts.join(_samples(df, unique, order), "column", "left").select(
        F.lit(dataset).alias("dataset"),
        "column",
        names[F.col("column")].alias("dtype"),
        "row_count",
        "null_count",
        rounded(F.lit(100.0) * F.col("null_count") / F.col("row_count"), 2).alias("null_pct"),
        "unique_values",
        F.coalesce("sample_values", F.lit("")).alias("sample_values"),
    )


def write_profile_csv(profile: DataFrame, path: str) -> None:
    profile.write.mode("errorifexists").option("header", True).option("encoding", "UTF-8").csv(path)


def dataset_coverage(silver: dict[str, DataFrame]) -> DataFrame:
    """Rows, countries and first/last date; an empty dataset is an error."""
    parts = []
    for name, df in silver.items():
        by_entity = df.groupBy("entity_code").agg(
            F.count("*").alias("n"), F.min("date").alias("lo"), F.max("date").alias("hi")
        )
        rows = F.when(
            F.sum("n").isNull(), F.raise_error(F.lit(f"dataset {name} is empty")).cast("bigint")
        ).otherwise(F.sum("n"))
        parts.append(
            by_entity.agg(
                rows.alias("row_count"),
                F.count("entity_code").alias("countries"),
                F.min("lo").alias("min_date"),
                F.max("hi").alias("max_date"),
            ).select(F.lit(name).alias("dataset"), "*")
        )
    return _union(parts)


def raw_coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: nulls per column, first and last date, number of dates."""
    types = dict(df.dtypes)
    by_date = df.groupBy("date").agg(
        F.count("*").alias("_n"),
        *[F.count_if(is_missing(c, types[c])).alias(f"_null_{c}") for c in columns],
    )
    return by_date.agg(
        F.sum("_n").alias("row_count"),
        *[F.sum(f"_null_{c}").alias(f"null_{c}") for c in columns],
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.count("date").alias("unique_dates"),
    )


# --- distributions -----------------------------------------------------------------


def _long(silver: dict[str, DataFrame]) -> DataFrame:
    """(dataset, measure, value) over all datasets."""
    parts = []
    for name, df in silver.items():
        long = df.select(*S.MEASURES[name]).unpivot([], list(S.MEASURES[name]), "measure", "value")
        parts.append(long.select(F.lit(name).alias("dataset"), "measure", "value"))
    return _union(parts)


def describe_measures(silver: dict[str, DataFrame]) -> DataFrame:
    """count, mean, std, min, quartiles and max of every measure, from one pass that
    counts equal values."""
    by = ["dataset", "measure"]
    counts = value_counts(_long(silver), by, "value")
    values, v, n = counts.where(F.col(VALUE).isNotNull()), F.col(VALUE), F.col(COUNT)
    lead, rest = total_parts(v, n)
    sums = values.groupBy(*by).agg(
        F.sum(n).alias("count"), (lead + rest).alias("total"), F.min(v).alias("min"), F.max(v).alias("max")
    )
    sums = hand_over(sums.withColumn("mean", F.col("total") / F.col("count")), "measure-sums")
    off = (v - F.col("mean")) * (v - F.col("mean")) * n
    spread = values.join(sums.select(*by, "mean", "count"), by).groupBy(*by).agg(
        F.sqrt(F.sum(off) / F.nullif(F.max("count") - 1, F.lit(0))).alias("std")
    )
    return sums.join(spread, by).join(quantiles_of(counts, by, QUARTILES), by).select(
        *by,
        "count",
        rounded("mean", 6).alias("mean"),
        rounded("std", 4).alias("std"),
        "min",
        *[rounded(q, 6).alias(q) for q in QUARTILES],
        "max",
    )


def _number(column: str) -> Column:
    """NaN as missing: Spark ranks it above every number."""
    return F.nanvl(F.col(column), F.lit(None).cast("double"))


def _unusual_flags() -> dict[str, Column]:
    return {
        "negative_generation": _number("generation_twh") < 0,
        "negative_share": _number("share_of_generation_pct") < 0,
        "share_above_100": _number("share_of_generation_pct") > 100,
    }


def unusual_rows(generation: DataFrame) -> DataFrame:
    return generation.where(reduce(Column.__or__, _unusual_flags().values())).select(
        "entity",
        "entity_code",
        "date",
        "series",
        "is_aggregate_series",
        "generation_twh",
        "share_of_generation_pct",
    )


def unusual_rows_top(generation: DataFrame, n: int = 30) -> DataFrame:
    """Largest shares first; the key settles ties."""
    return (
        unusual_rows(generation)
        .orderBy(
            _number("share_of_generation_pct").desc_nulls_last(), *S.BUSINESS_KEYS["generation"]
        )
        .limit(n)
    )


def unusual_breakdown(generation: DataFrame) -> DataFrame:
    """Counts and extremes per series with any unusual row."""
    flags = _unusual_flags()
    return (
        generation.groupBy("series")
        .agg(
            F.count("*").alias("observations"),
            *[F.count_if(flag).alias(name) for name, flag in flags.items()],
            F.min(_number("generation_twh")).alias("min_generation_twh"),
            F.max(_number("generation_twh")).alias("max_generation_twh"),
            F.min(_number("share_of_generation_pct")).alias("min_share_pct"),
            F.max(_number("share_of_generation_pct")).alias("max_share_pct"),
        )
        .where(reduce(Column.__or__, [F.col(name) > 0 for name in flags]))
    )


def components(df: DataFrame) -> DataFrame:
    """Rows of component series: no aggregates, no net imports."""
    return df.where(~F.col("is_aggregate_series") & (F.col("series") != S.NET_IMPORTS))


def series_list(df: DataFrame) -> DataFrame:
    return (
        df.select("series", "is_aggregate_series")
        .distinct()
        .orderBy("is_aggregate_series", "series")
    )


def _quartile_bounds(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    iqr = F.col("q3") - F.col("q1")
    return (
        quantiles_of(counts, by, QUARTILES)
        .withColumn("iqr", iqr)
        .withColumn("lower_bound", F.col("q1") - 1.5 * F.col("iqr"))
        .withColumn("upper_bound", F.col("q3") + 1.5 * F.col("iqr"))
    )


def iqr_screen(df: DataFrame, by: str = "series", value: str = "generation_twh") -> DataFrame:
    """Share of values beyond 1.5 interquartile ranges, among all rows with or without
    a value; diagnostic only. Equal values are counted together, in the one pass over the
    rows, before they meet the bounds."""
    counts = value_counts(df, [by], value)
    bounds = _quartile_bounds(counts, [by])
    v, n = F.col(VALUE), F.col(COUNT)
    outside = (v < F.col("lower_bound")) | (v > F.col("upper_bound"))
    joined = counts.join(bounds, by).groupBy(by)
    zero = F.lit(0).cast("bigint")
    return (
        joined.agg(
            *[F.max(c).alias(c) for c in ("q1", "q3", "iqr", "lower_bound", "upper_bound")],
            F.sum(F.when(outside, n).otherwise(zero)).alias("outlier_count"),
            F.sum(n).alias("n"),
        )
        .withColumn("outlier_pct", F.lit(100.0) * F.col("outlier_count") / F.col("n"))
        .select(
            by,
            *[rounded(c, 2).alias(c) for c in ("q1", "q3", "iqr", "lower_bound", "upper_bound")],
            "outlier_count",
            rounded("outlier_pct", 2).alias("outlier_pct"),
        )
        .orderBy(F.desc("outlier_pct"), by)
    )


def boxplot_stats(df: DataFrame, by: str = "series", value: str = "generation_twh") -> DataFrame:
    """Quartiles, the whiskers (furthest values within bounds) and extremes."""
    counts = value_counts(df, [by], value)
    bounds = _quartile_bounds(counts, [by])
    v = F.col(VALUE)
    inside = v.between(F.col("lower_bound"), F.col("upper_bound"))
    return (
        counts.where(v.isNotNull()).join(bounds, by)
        .groupBy(by)
        .agg(
            F.min(v).alias("min"),
            F.min(F.when(inside, v)).alias("lower_whisker"),
            *[F.max(q).alias(q) for q in QUARTILES],
            F.max(F.when(inside, v)).alias("upper_whisker"),
            F.max(v).alias("max"),
        )
        .select(
            by, "min", "lower_whisker", *[rounded(q, 6).alias(q) for q in QUARTILES],
            "upper_whisker", "max",
        )
    )


# --- one country ------------------------------------------------------------------------


def country_series_slice(df: DataFrame, entity_code: str, series: Sequence[str]) -> DataFrame:
    return df.where((F.col("entity_code") == entity_code) & F.col("series").isin(list(series)))


def seasonality(df: DataFrame, value: str = "generation_twh") -> DataFrame:
    """Mean per calendar month and series."""
    return df.groupBy(F.month("date").cast("bigint").alias("month"), "series").agg(
        rounded(mean(value), 6).alias(value)
    )


def demand_intensity_yearly(
    demand: DataFrame, intensity: DataFrame, entity_code: str
) -> DataFrame:
    """Yearly means over the months both datasets have."""
    here = F.col("entity_code") == entity_code
    measure = "emissions_intensity_gco2_per_kwh"
    both = (
        demand.where(here)
        .select("date", "demand_twh")
        .join(intensity.where(here).select("date", measure), "date")
    )
    return both.groupBy(F.year("date").cast("bigint").alias("year")).agg(
        rounded(mean("demand_twh"), 6).alias("avg_monthly_demand_twh"),
        rounded(mean(measure), 6).alias("avg_carbon_intensity"),
    )


def mix_by_date(
    generation: DataFrame,
    intensity: DataFrame,
    entity_code: str,
    clean: str = "Clean",
    fossil: str = "Fossil",
) -> DataFrame:
    """Clean and fossil share side by side with the intensity of the month. Two
    rows for the same month and series are an error, as in any pivot."""
    here = F.col("entity_code") == entity_code
    share = "share_of_generation_pct"

    def cell(series: str) -> Column:
        hit = F.col("series") == series
        many = F.raise_error(F.lit(f"several {series} rows in one month")).cast("double")
        return F.when(F.count_if(hit) > 1, many).otherwise(F.max(F.when(hit, F.col(share))))

    pivot = (
        generation.where(here & F.col("series").isin(clean, fossil))
        .groupBy("date")
        .agg(cell(clean).alias("clean_share_pct"), cell(fossil).alias("fossil_share_pct"))
    )
    measure = "emissions_intensity_gco2_per_kwh"
    return pivot.join(intensity.where(here).select("date", measure), "date")


MIX_COLUMNS = ("clean_share_pct", "fossil_share_pct", "emissions_intensity_gco2_per_kwh")


def mix_correlation(mix: DataFrame, minimum: int = 3) -> DataFrame:
    """Pearson matrix, one row per column; empty below the minimum of rows."""
    pairs = [
        F.corr(a, b).alias(f"{a}__{b}") for a in MIX_COLUMNS for b in MIX_COLUMNS if a < b
    ]
    one = mix.agg(F.count("*").alias("n"), *pairs).where(F.col("n") >= minimum)

    def value(a: str, b: str) -> Column:
        if a == b:
            return F.lit(1.0)
        return rounded(F.col("__".join(sorted((a, b)))), 6)

    rows = F.array(
        *[
            F.struct(F.lit(a).alias("variable"), *[value(a, b).alias(b) for b in MIX_COLUMNS])
            for a in MIX_COLUMNS
        ]
    )
    return one.select(F.explode(rows).alias("r")).select("r.*")


def intensity_trend(mix: DataFrame, minimum: int = 3) -> DataFrame:
    """Least-squares line of intensity on fossil share."""
    y, x = F.col("emissions_intensity_gco2_per_kwh"), F.col("fossil_share_pct")
    return (
        mix.agg(
            F.count("*").alias("n"),
            rounded(F.regr_slope(y, x), 6).alias("slope"),
            rounded(F.regr_intercept(y, x), 6).alias("intercept"),
            rounded(F.regr_r2(y, x), 6).alias("r2"),
        )
        .where(F.col("n") >= minimum)
    )


def country_ranking(intensity: DataFrame, year: int) -> DataFrame:
    """Mean intensity per country in one year, lowest first, with the number of
    months behind it."""
    measure = "emissions_intensity_gco2_per_kwh"
    low, high = (F.lit(f"{y:04d}-01-01").cast("timestamp_ntz") for y in (year, year + 1))
    monthly = (
        intensity.where((F.col("date") >= low) & (F.col("date") < high))
        .groupBy("entity", "entity_code", "date")
        .agg(total(measure).alias("_sum"), F.count(measure).alias("_n"))
    )
    return (
        monthly.groupBy("entity", "entity_code")
        .agg(
            rounded(total("_sum") / F.nullif(F.sum("_n"), F.lit(0)).cast("double"), 6).alias("avg_carbon_intensity"),
            F.count("date").alias("months_observed"),
        )
        .orderBy("avg_carbon_intensity", "entity_code")
    )


