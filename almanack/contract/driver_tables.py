"""The given tables read as the five monthly datasets.

Lines of orders stand for generation and emissions, orders for demand, supply
lines for capacity; the entity is the customer's (supplier's) nation or region.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from almanack import schemas as S
from almanack.functions.expressions import percent

LEVELS = ("nation", "region")
BASELINE_YEAR = 1995
AS_OF_YEAR = 2026
PROJECT_START = "1996-01"

SERIES_CLASSIFICATION = (
    ("ECONOMY", "Small scale", "Renewable"),
    ("SMALL", "Small scale", "Renewable"),
    ("MEDIUM", "Large scale", "Fossil"),
    ("LARGE", "Large scale", "Fossil"),
    ("STANDARD", "Standard", "Clean"),
    ("Net imports", "Net imports", "Flow"),
    ("Total generation", "Total generation", "Aggregate"),
)
CAPACITY_SERIES = {"SMALL": "Solar", "LARGE": "Wind"}

_MONEY = "decimal(18,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _month(column: str):
    return F.trunc(column, "month").cast("timestamp_ntz").alias("date")


def monthly_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines per customer nation, order month, part type and return flag.

    Orders meet customers first, so the lines are moved twice and not three
    times; everything after this works on nations x months x types x 2 rows.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.col("l_quantity").cast(_MONEY).alias("q"),
        (F.col("l_extendedprice").cast(_MONEY) * F.col("l_discount").cast(_MONEY)).alias("e"),
        (F.col("l_returnflag") == "R").alias("returned"),
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    placed = _placed_orders(spark, sf_dir).select("o_orderkey", "nationkey", "date")
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("nationkey", "date", "p_type", "returned")
        .agg(F.sum("q").alias("q"), F.sum("e").alias("e"))
    )


def _placed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        _month("o_orderdate"),
        F.col("o_totalprice").cast(_MONEY).alias("price"),
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).withColumnRenamed(
        "c_nationkey", "nationkey"
    )


def monthly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _placed_orders(spark, sf_dir)
        .groupBy("nationkey", "date")
        .agg(F.sum("price").alias("price"))
    )


def monthly_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", _month("l_shipdate"), F.col("l_quantity").cast(_MONEY).alias("q")
    )
    parts = (
        table(spark, sf_dir, "part")
        .where(F.col("p_type").isin(list(CAPACITY_SERIES)))
        .select("p_partkey", "p_type")
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.col("s_nationkey").alias("nationkey"), "date", "p_type")
        .agg(F.sum("q").alias("q"), F.count("*").alias("n"))
    )


def entities(spark: SparkSession, sf_dir: str, level: str) -> DataFrame:
    """nationkey -> (entity, entity_code) at nation or region level."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    if level == "nation":
        code = F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
        return nation.select("n_nationkey", F.col("n_name").alias("entity"), code.alias("entity_code"))
    if level != "region":
        raise ValueError(f"unknown level {level!r}")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    code = F.concat(F.lit("R"), F.col("r_regionkey").cast("string"))
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("r_name").alias("entity"), code.alias("entity_code")
    )


def member_codes(spark: SparkSession, sf_dir: str, level: str) -> DataFrame:
    """Entities of the EUROPE region carry the membership flag."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region").where(F.col("r_name") == "EUROPE")
    europe = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey")
    return (
        entities(spark, sf_dir, level).join(europe, "n_nationkey", "left_semi")
        .select("entity_code").distinct()
    )


def _at_level(df: DataFrame, where: DataFrame) -> DataFrame:
    return df.join(where, F.col("nationkey") == F.col("n_nationkey"))


def _with_total(components: DataFrame, measure: str, share: str) -> DataFrame:
    """Append the aggregate series and each row's share of it."""
    by = ["entity", "entity_code", "date"]
    total = (
        components.where(F.col("series") != S.NET_IMPORTS)
        .groupBy(*by)
        .agg(F.sum("amount").alias("amount"))
    )
    rows = components.withColumn("is_aggregate_series", F.lit(False)).unionByName(
        total.select(
            *by,
            F.lit(S.TOTAL_GENERATION).alias("series"),
            "amount",
            F.lit(True).alias("is_aggregate_series"),
        )
    )
    amount = F.col("amount").cast("double")
    part = F.coalesce(percent(amount, F.col("whole")), F.lit(0.0))
    whole = total.select("entity_code", "date", F.col("amount").cast("double").alias("whole"))
    return rows.join(whole, ["entity_code", "date"], "left").select(
        "entity",
        "entity_code",
        F.lit(False).alias("is_aggregate_entity"),
        "date",
        "series",
        "is_aggregate_series",
        amount.alias(measure),
        F.round(part, 6).alias(share),
    )


def generation(lines: DataFrame, where: DataFrame) -> DataFrame:
    net = F.col("p_type") == "PROMO"
    signed = F.when(net & F.col("returned"), -F.col("q")).otherwise(F.col("q"))
    components = (
        _at_level(lines, where)
        .groupBy(
            "entity",
            "entity_code",
            "date",
            F.when(net, F.lit(S.NET_IMPORTS)).otherwise(F.col("p_type")).alias("series"),
        )
        .agg(F.sum(signed).alias("amount"))
    )
    return _with_total(components, "generation_twh", "share_of_generation_pct")


def emissions(lines: DataFrame, where: DataFrame) -> DataFrame:
    net = F.col("p_type") == "PROMO"
    components = (
        _at_level(lines, where)
        .groupBy(
            "entity",
            "entity_code",
            "date",
            F.when(net, F.lit(S.NET_IMPORTS)).otherwise(F.col("p_type")).alias("series"),
        )
        .agg(F.sum(F.when(net, F.lit(0).cast("decimal(38,4)")).otherwise(F.col("e"))).alias("amount"))
    )
    return _with_total(components, "emissions_mtco2", "share_of_emissions_pct")


def demand(orders: DataFrame, where: DataFrame) -> DataFrame:
    return (
        _at_level(orders, where)
        .groupBy("entity", "entity_code", "date")
        .agg(F.sum("price").cast("double").alias("demand_twh"))
    )


def carbon_intensity(lines: DataFrame, where: DataFrame) -> DataFrame:
    ratio = F.sum("e").cast("double") / F.nullif(F.sum("q").cast("double"), F.lit(0.0))
    return (
        _at_level(lines, where)
        .where(F.col("p_type") != "PROMO")
        .groupBy("entity", "entity_code", "date")
        .agg(F.round(ratio, 6).alias("emissions_intensity_gco2_per_kwh"))
    )


def capacity(supply: DataFrame, where: DataFrame) -> DataFrame:
    name = F.create_map(*[F.lit(x) for pair in CAPACITY_SERIES.items() for x in pair])
    per_line = F.lit(1000.0) * F.col("capacity_gw") / F.col("n").cast("double")
    return (
        _at_level(supply, where)
        .groupBy("entity", "entity_code", "date", name[F.col("p_type")].alias("series"))
        .agg(F.sum("q").cast("double").alias("capacity_gw"), F.sum("n").alias("n"))
        .select(
            "entity",
            "entity_code",
            F.lit(False).alias("is_aggregate_entity"),
            "date",
            "series",
            # "Wind" is a total here although it is a component elsewhere.
            (F.col("series") == "Wind").alias("is_aggregate_series"),
            "capacity_gw",
            F.round(per_line, 6).alias("capacity_w_per_capita"),
        )
    )


BASES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "lines": monthly_lines,
    "orders": monthly_orders,
    "supply": monthly_supply,
}

# dataset -> (base it is made of, builder)
BUILDERS = {
    "generation": ("lines", generation),
    "demand": ("orders", demand),
    "emissions": ("lines", emissions),
    "carbon_intensity": ("lines", carbon_intensity),
    "capacity": ("supply", capacity),
}
