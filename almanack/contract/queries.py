"""The registered queries: each reads the given tables (or what Spark staged
from them) whole and returns a frame. ``oracle.py`` holds the SQL of each."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from almanack import schemas as S
from almanack.contract import driver_tables as T, staging
from almanack.functions.expressions import capacity_series_key, rounded, series_key, total as exact_total
from almanack.operators import (
    cleaning,
    dimensions,
    increments,
    marts,
    profiling,
    quality,
)
from almanack.plans import gold as gold_plan, ingest, publish, silver as silver_plan
from almanack.session import run_folder
from almanack.sources import bronze, tables
from almanack.streaming import silver_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF, BASE = T.AS_OF_YEAR, T.BASELINE_YEAR
SPLIT = "2000-01-01"
ENTITY = "N07"
LINE_KEY = ("l_orderkey", "l_linenumber")
MONTH_FILE = "ship/{}.json"


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return T.table(spark, sf, "lineitem")


def _nations(spark: SparkSession, sf: str) -> DataFrame:
    return T.entities(spark, sf, "nation").select("n_nationkey", "entity_code")


def _codes(spark: SparkSession, sf: str, condition: str) -> DataFrame:
    """Entity codes of the nations whose region key meets the condition."""
    chosen = T.table(spark, sf, "nation").where(condition).select("n_nationkey")
    return _nations(spark, sf).join(chosen, "n_nationkey", "left_semi").select("entity_code")


def _generation(spark: SparkSession, sf: str) -> DataFrame:
    return staging.silver_table(spark, sf, "nation", "generation")


# --- cleaning -------------------------------------------------------------------


@query
def silver_clean_generation(spark, sf):
    raw = increments.raw_text(_generation(spark, sf))
    return cleaning.clean(raw, "generation", T.PROJECT_START)


@query
def silver_scope_filter(spark, sf):
    parts = []
    for name, df in staging.silver(spark, sf).items():
        kept = cleaning.apply_project_scope(df, name, T.PROJECT_START)
        parts.append(
            kept.groupBy(F.lit(name).alias("dataset"), "entity_code", "date").agg(
                F.count("*").alias("kept_rows")
            )
        )
    return _union(parts)


@query
def silver_sorted_demand(spark, sf):
    return cleaning.sort_silver(staging.silver_table(spark, sf, "nation", "demand"))


@query
def silver_country_scope(spark, sf):
    overrides = _codes(spark, sf, "n_regionkey <= 1").select(
        F.lit("capacity").alias("dataset"), "entity_code"
    )
    names = spark.createDataFrame([(d,) for d in S.DATASETS], "dataset string")
    return cleaning.dataset_country_scope(_nations(spark, sf), overrides, names)


@query
def backfill_scope(spark, sf):
    """Every customer asks for its own nation, in lower case."""
    customers = T.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    requested = customers.join(
        _nations(spark, sf), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(F.col("c_custkey").alias("pos"), F.lower("entity_code").alias("entity_code"))
    allowed = _codes(spark, sf, "n_regionkey <= 1")
    return cleaning.backfill_scope(requested, _nations(spark, sf), allowed)


# --- increments -----------------------------------------------------------------

# dataset -> (state holds the newest date before this one, text appended to it)
STATE_CUTS = {
    "generation": ("2000-01-01", ""),
    "demand": ("2100-01-01", "T00:00:00"),
    "emissions": ("2000-01-01", "T00:00:00Z"),
    "capacity": ("2001-06-01", ""),
}


@query
def increment_plan(spark, sf):
    frames = staging.silver(spark, sf)
    state = []
    for name, (before, suffix) in STATE_CUTS.items():
        older = frames[name].where(F.col("date") < F.lit(before).cast("timestamp_ntz"))
        text = F.concat(F.date_format(F.max("date"), "yyyy-MM-dd"), F.lit(suffix))
        state.append(
            older.agg(text.alias("last_source_date")).select(
                F.lit(name).alias("dataset"), "last_source_date"
            )
        )
    return increments.increment_plan(
        ingest.latest_available(frames), _union(state), T.PROJECT_START
    )


@query
def increment_slice(spark, sf):
    scope = _codes(spark, sf, "n_regionkey = 3")
    return increments.increment_slice(_generation(spark, sf), scope, SPLIT)


@query
def state_advance(spark, sf):
    """One document per dataset and year, plus empty ones without a date."""
    parts = []
    for name, df in staging.silver(spark, sf).items():
        yearly = df.groupBy(F.year("date").alias("y")).agg(
            F.count("*").alias("n_rows"),
            F.concat(F.date_format(F.max("date"), "yyyy-MM-dd"), F.lit("T00:00:00Z")).alias(
                "declared_max"
            ),
        )
        parts.append(yearly.select(F.lit(name).alias("dataset"), "n_rows", "declared_max"))
        empty = yearly.select(
            F.lit(name).alias("dataset"),
            F.lit(0).cast("bigint").alias("n_rows"),
            F.lit(None).cast("string").alias("declared_max"),
        )
        parts.append(empty)
    return increments.state_advance(_union(parts))


def _ship_files(spark: SparkSession, sf: str) -> DataFrame:
    """One file per ship month: its rows as length, its last ship date as time."""
    month = F.date_format("l_shipdate", "yyyy-MM")
    return (
        _lines(spark, sf)
        .groupBy(F.concat(F.lit("ship/"), month, F.lit(".json")).alias("path"))
        .agg(F.max("l_shipdate").alias("mtime"), F.count("*").alias("length"))
    )


@query
def change_plan(spark, sf):
    files = _ship_files(spark, sf)
    recorded = files.where(F.col("path") < MONTH_FILE.format("2000-07"))
    return increments.change_plan(files, recorded)


@query
def full_rebuild_plan(spark, sf):
    """A recorded file has grown since."""
    files = _ship_files(spark, sf)
    grown = F.when(F.col("path") == MONTH_FILE.format("1997-03"), F.col("length") - 1)
    recorded = files.where(F.col("path") < MONTH_FILE.format("2000-07")).withColumn(
        "length", F.coalesce(grown, F.col("length"))
    )
    return increments.change_plan(files, recorded)


@query
def content_change_plan(spark, sf):
    """Recorded files with checksums: as they are, and with one edit that keeps path, time
    and length, which forces a rebuild."""
    total = _lines(spark, sf).groupBy(F.concat(F.lit("ship/"), F.date_format("l_shipdate", "yyyy-MM"), F.lit(".json")).alias("path"))
    tags = total.agg(F.sum("l_orderkey").cast("string").alias("tag"))
    files = _ship_files(spark, sf).join(tags, "path")
    recorded = files.where(F.col("path") < MONTH_FILE.format("2000-07"))
    edited = F.when(F.col("path") == MONTH_FILE.format("1997-03"), F.lit("edited")).otherwise(F.col("tag"))
    cases = {"same": recorded, "edited": recorded.withColumn("tag", edited)}
    return _union([increments.change_plan(files, r).withColumn("case", F.lit(name)) for name, r in cases.items()])


@query
def latest_object(spark, sf):
    """Newest of the ship files; order files with later times have another suffix."""
    month = F.date_format("o_orderdate", "yyyy-MM")
    others = (
        T.table(spark, sf, "orders")
        .groupBy(F.concat(F.lit("order/"), month, F.lit(".csv")).alias("path"))
        .agg(
            (F.max("o_orderdate") + F.expr("INTERVAL 10 YEARS")).alias("mtime"),
            F.count("*").alias("length"),
        )
    )
    return increments.latest_object(_ship_files(spark, sf).unionByName(others), ".json")


def _generation_increments(spark: SparkSession, sf: str) -> tuple[DataFrame, list[DataFrame]]:
    """A snapshot up to the split and two overlapping loads with changed values."""
    generation = _generation(spark, sf)
    snapshot = generation.where(F.col("date") < F.lit(SPLIT).cast("timestamp_ntz"))

    def load(since: str, path: str, change: Column, hour: int) -> DataFrame:
        rows = generation.where(F.col("date") >= F.lit(since).cast("timestamp_ntz"))
        rows = rows.withColumn("generation_twh", change)
        stamp = F.lit(f"2026-01-01 {hour:02d}:00:00").cast("timestamp")
        return increments.with_increment_sequence(
            rows, stamp, F.lit(path), F.month("date").cast("bigint")
        )

    value = F.col("generation_twh")
    first = load("1999-07-01", "load/a.json", value + 1, 1)
    second = load("2000-06-01", "load/b.json", value * 2, 2)
    return snapshot, [first, second]


@query
def silver_union_increments(spark, sf):
    snapshot, loads = _generation_increments(spark, sf)
    return increments.union_increments(snapshot, loads).select(
        "entity_code",
        "date",
        "series",
        "generation_twh",
        F.col("_source_rank").alias("source_rank"),
        F.col("_path").alias("path"),
        F.col("_pos").alias("pos"),
    )


@query
def silver_merge_generation(spark, sf):
    snapshot, loads = _generation_increments(spark, sf)
    return increments.merge_snapshot(snapshot, loads, "generation")


@query
def silver_merge_idempotent(spark, sf):
    """Merging the same loads into the merged state changes nothing."""
    snapshot, loads = _generation_increments(spark, sf)
    once = increments.merge_snapshot(snapshot, loads, "generation")
    return increments.merge_snapshot(once, loads, "generation")


@query
def silver_merge_keep_last(spark, sf):
    """The latest shipped version of every (order, line); other columns settle ties."""
    lines = _lines(spark, sf)
    rest = [c for c in lines.columns if c not in (*LINE_KEY, "l_shipdate")]
    return increments.keep_last(
        lines.withColumn("_seq", F.struct("l_shipdate", *rest)), LINE_KEY, ["_seq"]
    )


# --- raw documents --------------------------------------------------------------


def _yearly_loads(spark: SparkSession, sf: str) -> str:
    """Generation stored as one load per half of the time range."""
    root = run_folder(spark, "bronze")
    generation = _generation(spark, sf)
    split = F.lit(SPLIT).cast("timestamp_ntz")
    for stamp, rows in (
        ("first", generation.where(F.col("date") < split)),
        ("second", generation.where(F.col("date") >= split)),
    ):
        bronze.append_documents(
            bronze.to_documents(rows, 2000), root, "generation", "2026-01-01", stamp
        )
    return root


@query
def bronze_inventory(spark, sf):
    """What the inventory lists, by load: its place in load order, and the rows and
    wrong lengths of the files listed."""
    root = _yearly_loads(spark, sf)
    folder = bronze.dataset_path(root, "generation")
    files = bronze.bronze_inventory(spark, root, "generation")
    texts = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(folder)
    sizes = texts.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.sum(F.octet_length("value") + 1).alias("size"))
    rows = bronze.read_documents(spark, folder).groupBy("path").agg(F.sum(F.size("data")).cast("bigint").alias("rows"))
    load = F.regexp_extract("path", "generation_([a-z]+)/", 1)
    loads = files.join(sizes, "path").join(rows, "path").groupBy(load.alias("load")).agg(
        F.sum("rows").alias("rows"),
        F.count_if(F.col("length") != F.col("size")).alias("wrong_lengths"),
        F.min(F.struct("mtime", "path")).alias("first"),
    )
    place = F.row_number().over(Window.orderBy("first")).cast("bigint")  # a row for each load
    return loads.select("load", "rows", "wrong_lengths", place.alias("place"))


@query
def bronze_extra_columns(spark, sf):
    """A field that no schema knows comes back with its rows."""
    root = run_folder(spark, "bronze")
    rows = _generation(spark, sf).withColumn("note", F.upper("series"))
    bronze.append_documents(bronze.to_documents(rows, 2000), root, "generation", "2026-01-01", "x")
    read = bronze.document_rows(bronze.read_documents(spark, f"{root}/generation"), "generation")
    return read.select("entity_code", F.col("date").cast("timestamp_ntz").alias("date"), "series", "note")


@query
def source_date_texts(spark, sf):
    """Date texts of order lines in several forms; those in no ISO form are rejected."""
    form = F.when(F.col("l_returnflag") == "R", F.lit("garbage")).otherwise(
        F.when(F.col("l_returnflag") == "A", F.lit("T00:00:00Z")).otherwise(F.lit(""))
    )
    lines = _lines(spark, sf).select(
        "l_returnflag", F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), form).alias("text")
    )
    good = F.col("text").rlike(increments.SOURCE_DATE)
    date = increments.parse_source_date(F.when(good, F.col("text")))
    return lines.groupBy("l_returnflag", good.alias("accepted"), date.alias("date")).agg(F.count("*").alias("n"))


@query
def dataset_names(spark, sf):
    """Names from the given tables and the declared ones; only the latter are accepted."""
    names = T.table(spark, sf, "region").select(F.lower("r_name").alias("name"))
    names = names.unionByName(spark.createDataFrame([(d,) for d in S.DATASETS], "name string"))
    rows = []
    for (name,) in names.distinct().collect():  # a handful
        try:
            rows.append((name, S.require_dataset(name) == name))
        except ValueError:
            rows.append((name, False))
    return spark.createDataFrame(rows, "name string, accepted boolean")


@query
def bronze_roundtrip(spark, sf):
    path = bronze.dataset_path(_yearly_loads(spark, sf), "generation")
    rows = silver_plan.cleaned_increment(bronze.read_documents(spark, path), "generation", T.PROJECT_START)
    return rows.drop(*increments.SEQUENCE, bronze.REST)


def _entity_scope(spark: SparkSession, sf: str) -> DataFrame:
    names = F.explode(F.lit(list(S.DATASETS))).alias("dataset")
    return _nations(spark, sf).select(names, "entity_code")


@query
def silver_incremental_job(spark, sf):
    """Two loads, the silver job after each, then the published snapshot."""
    roots = run_folder(spark, "job")
    generation = _generation(spark, sf)
    split = F.lit(SPLIT).cast("timestamp_ntz")
    overlap = F.lit("1999-07-01").cast("timestamp_ntz")
    changed = generation.withColumn("generation_twh", F.col("generation_twh") + 1)
    for stamp, rows in (
        ("20260101", generation.where(F.col("date") < split)),
        ("20260102", changed.where(F.col("date") >= overlap)),
    ):
        documents = bronze.to_documents(rows, 2000)
        bronze.append_documents(documents, f"{roots}/bronze", "generation", "2026-01-01", stamp)
        silver_plan.update_silver(
            spark, f"{roots}/bronze", f"{roots}/silver", "generation",
            _nations(spark, sf), T.PROJECT_START,
        )
    return tables.read_snapshot(spark, f"{roots}/silver", "generation")


@query
def silver_stream_job(spark, sf):
    """The same two loads merged by the streaming runner."""
    roots = run_folder(spark, "stream")
    generation = _generation(spark, sf)
    split = F.lit(SPLIT).cast("timestamp_ntz")
    overlap = F.lit("1999-07-01").cast("timestamp_ntz")
    changed = generation.withColumn("generation_twh", F.col("generation_twh") + 1)
    for stamp, rows in (
        ("20260101", generation.where(F.col("date") < split)),
        ("20260102", changed.where(F.col("date") >= overlap)),
    ):
        documents = bronze.to_documents(rows, 2000)
        bronze.append_documents(documents, f"{roots}/bronze", "generation", "2026-01-01", stamp)
        silver_stream.run_available(
            spark, f"{roots}/bronze", f"{roots}/silver", "generation", f"{roots}/checkpoint",
            _nations(spark, sf), T.PROJECT_START,
        )
    return tables.read_snapshot(spark, f"{roots}/silver", "generation")


@query
def ingestion_job(spark, sf):
    """First run loads everything from the project start, the second nothing;
    a backfill in between leaves the state alone."""
    roots = run_folder(spark, "ingest")
    landing = staging.silver(spark, sf)
    scope = _entity_scope(spark, sf)
    rows = []
    for run in (1, 2):
        outcome = ingest.run_ingestion(
            spark, landing, f"{roots}/bronze", f"{roots}/state", scope, T.PROJECT_START
        )
        rows += [(run, o["dataset"], o["action"], o["last_source_date"]) for o in outcome]
        if run == 1:
            ingest.run_backfill(
                spark, landing, f"{roots}/bronze", ["n07"], ["demand"], "1995-01", scope,
                _nations(spark, sf), T.PROJECT_START,
            )
    loaded = bronze.document_rows(
        bronze.read_documents(spark, bronze.dataset_path(f"{roots}/bronze", "demand")), "demand"
    )
    rows.append((3, "demand", "documents", str(loaded.count())))
    return spark.createDataFrame(
        rows, "run bigint, dataset string, action string, last_source_date string"
    )


# --- quality ---------------------------------------------------------------------


@query
def dq_missing_columns(spark, sf):
    demand = staging.silver_table(spark, sf, "nation", "demand").drop("demand_twh")
    return quality.silver_report(demand, "demand", _nations(spark, sf))


@query
def dq_duplicate_excess(spark, sf):
    return quality.duplicate_excess(_lines(spark, sf), LINE_KEY)


@query
def dq_duplicate_all_rows(spark, sf):
    return quality.duplicate_rows(_lines(spark, sf), LINE_KEY)


@query
def dq_duplicate_groups(spark, sf):
    return quality.duplicate_groups(_lines(spark, sf), LINE_KEY)


@query
def dq_null_counts(spark, sf):
    """Zero discounts stand for null, zero taxes for NaN."""
    lines = _lines(spark, sf).withColumns(
        {
            "l_discount": F.nullif("l_discount", F.lit(0.0)),
            "l_tax": F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")),
        }
    )
    return quality.null_counts(lines, ["l_orderkey", "l_discount", "l_tax", "l_returnflag"])


@query
def dq_unexpected_countries(spark, sf):
    return quality.unexpected_countries(
        _generation(spark, sf), _codes(spark, sf, "n_regionkey <> 4")
    )


@query
def dq_silver_report(spark, sf):
    """Capacity is expected for fewer countries than it has."""
    parts = []
    for name, df in staging.silver(spark, sf).items():
        expected = _codes(spark, sf, "n_regionkey <= 1" if name == "capacity" else "true")
        parts.append(quality.silver_report(df, name, expected))
    return _union(parts)


@query
def dq_dimensions(spark, sf):
    return quality.dimension_report(staging.gold(spark, sf))


@query
def dq_facts(spark, sf):
    return quality.fact_report(staging.gold(spark, sf))


@query
def dq_foreign_keys(spark, sf):
    return quality.foreign_key_report(staging.gold(spark, sf))


@query
def dq_gold_verdict(spark, sf):
    return quality.verdict(quality.gold_report(staging.gold(spark, sf)))


@query
def dq_persisted_table(spark, sf):
    return quality.persisted_model_check(staging.gold(spark, sf))


@query
def dq_mart_checks(spark, sf):
    gold = staging.gold(spark, sf)
    period = marts.resolve_period(gold, AS_OF, BASE)
    return _union(
        [
            quality.mart_check(build(gold, AS_OF, BASE, period)).select(F.lit(name).alias("mart"), "*")
            for name, (_, build) in marts.MARTS.items()
        ]
    )


@query
def key_coverage(spark, sf):
    return quality.key_coverage(staging.silver(spark, sf))


# --- dimensions and facts -----------------------------------------------------------


@query
def series_keys(spark, sf):
    names = T.table(spark, sf, "customer").select(F.col("c_name").alias("name"))
    return names.select("name", series_key("name").alias("series_key"))


@query
def capacity_series_keys(spark, sf):
    names = T.table(spark, sf, "supplier").select(F.col("s_name").alias("name"))
    return names.select("name", capacity_series_key("name").alias("capacity_series_key"))


@query
def dim_date(spark, sf):
    return dimensions.dim_date(staging.silver(spark, sf))


@query
def dim_country(spark, sf):
    return dimensions.dim_country(staging.silver(spark, sf), T.member_codes(spark, sf, "nation"))


@query
def dim_energy_series(spark, sf):
    return dimensions.dim_energy_series(staging.silver(spark, sf), staging.classification(spark))


@query
def dim_capacity_series(spark, sf):
    return dimensions.dim_capacity_series(staging.silver_table(spark, sf, "nation", "capacity"))


def _fact_query(table: str) -> None:
    def build(spark: SparkSession, sf: str) -> DataFrame:
        return staging.lazy_facts(spark, sf)[table]

    QUERIES[table] = build


for _table in S.FACT_GRAINS:
    _fact_query(_table)


# --- marts -----------------------------------------------------------------------------


@query
def annual_generation(spark, sf):
    return marts.annual_generation(staging.gold(spark, sf), AS_OF)


@query
def annual_demand(spark, sf):
    return marts.annual_demand(staging.gold(spark, sf), AS_OF)


@query
def generation_demand_yearly(spark, sf):
    return marts.generation_demand_yearly(staging.gold(spark, sf), AS_OF)


@query
def annual_domestic_net_imports(spark, sf):
    return marts.annual_domestic_net_imports(staging.gold(spark, sf), AS_OF)


@query
def annual_balance(spark, sf):
    return marts.annual_balance(staging.gold(spark, sf), AS_OF)


@query
def comparison_sources(spark, sf):
    return marts.comparison_sources(staging.gold(spark, sf))


@query
def comparison_period(spark, sf):
    return marts.comparison_period(staging.gold(spark, sf), AS_OF, BASE)


def _with_period(build):
    """A query over the gold tables and their comparison period."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        gold = staging.gold(spark, sf)
        return build(gold, marts.resolve_period(gold, AS_OF, BASE))

    return run


QUERIES["country_period"] = _with_period(
    lambda gold, period: marts.country_period(marts.annual_balance(gold, AS_OF), period)
)


@query
def annual_mix(spark, sf):
    return marts.annual_mix(staging.gold(spark, sf), AS_OF)


@query
def complete_country_years(spark, sf):
    return marts.complete_country_years(staging.gold(spark, sf), AS_OF)


@query
def annual_total(spark, sf):
    return marts.annual_total(staging.gold(spark, sf), AS_OF)


@query
def energy_mix_yearly(spark, sf):
    return marts.energy_mix_yearly(staging.gold(spark, sf), AS_OF)


@query
def monthly_mix(spark, sf):
    return marts.monthly_mix(staging.gold(spark, sf))


@query
def annual_mix_months(spark, sf):
    gold = staging.gold(spark, sf)
    return marts.monthly_to_annual_mix(marts.monthly_mix(gold, AS_OF), gold)


@query
def annual_shares(spark, sf):
    return marts.annual_shares(staging.gold(spark, sf), AS_OF)


QUERIES["eligible_countries"] = _with_period(
    lambda gold, period: marts.eligible_countries(gold, AS_OF, period)
)
QUERIES["mix_pivot"] = _with_period(lambda gold, period: marts.mix_pivot(gold, AS_OF, period))
QUERIES["annual_emissions"] = _with_period(
    lambda gold, period: marts.annual_emissions(gold, AS_OF, period)
)
QUERIES["annual_intensity"] = _with_period(
    lambda gold, period: marts.annual_intensity(gold, AS_OF, period)
)
QUERIES["emissions_pivot"] = _with_period(
    lambda gold, period: marts.emissions_pivot(gold, AS_OF, period)
)
QUERIES["annual_capacity"] = _with_period(
    lambda gold, period: marts.annual_capacity(gold, AS_OF, period)
)
QUERIES["capacity_pivot"] = _with_period(
    lambda gold, period: marts.capacity_pivot(gold, AS_OF, period)
)


def _mart_query(name: str, level: str) -> None:
    build_mart = marts.MARTS[name][1]

    def build(spark: SparkSession, sf: str) -> DataFrame:
        return build_mart(staging.gold(spark, sf, level), AS_OF, BASE)

    QUERIES[f"mart_{name}" if level == "nation" else f"mart_{name}_by_{level}"] = build


for _level in T.LEVELS:
    for _name in marts.MARTS:
        _mart_query(_name, _level)


@query
def annual_sums_wide_range(spark, sf):
    """Yearly totals of very small and very large values, scaled back for comparison."""
    gold = staging.gold(spark, sf)
    fact = gold["fact_generation"]
    parts = []
    for name, scale in (("small", 1e-12), ("large", 1e21)):
        scaled = fact.withColumn("generation_twh", F.col("generation_twh") * F.lit(scale))
        yearly = marts.annual_generation({**gold, "fact_generation": scaled}, AS_OF)
        total = rounded(F.col("generation_twh") / F.lit(scale), 4)
        parts.append(yearly.select(F.lit(name).alias("scale"), "entity_code", "year", total.alias("total")))
    return _union(parts)


#: Published values of a wide range agree with exact arithmetic to this part of themselves.
TOLERANCE = 1e-14


@query
def published_wide_range(spark, sf):
    """The yearly report with totals near 1e14 and seasonal means near 1e9 (scaled by powers
    of two, which loses nothing): the exact sum in ten-thousandths before scaling, and
    whether the published value is that sum within TOLERANCE."""
    gold = staging.gold(spark, sf)
    names = {"fact_generation": "generation_twh", "fact_demand": "demand_twh"}
    total, mean = F.lit(2.0**33), F.lit(2.0**23)
    scaled = {t: gold[t].withColumn(c, F.col(c) * total) for t, c in names.items()}
    report = marts.generation_demand_yearly({**gold, **scaled}, AS_OF)

    units = (F.sum(F.col("generation_twh").cast("decimal(18,4)")) * 10_000).cast("bigint").alias("units")
    components = gold["dim_energy_series"].where("NOT is_aggregate_series").where(F.col("series_name") != S.NET_IMPORTS)
    lines = gold["fact_generation"].join(components, "series_key", "left_semi")
    exact = lines.groupBy("entity_code", F.year("date").alias("year")).agg(units)
    near = lambda value, scale: F.abs(F.col(value) / scale * 10_000 / F.col("units") - 1) <= TOLERANCE
    totals = report.join(exact, ["entity_code", "year"]).select(
        F.lit("total").alias("kind"),
        F.col("entity_code").alias("name"),
        F.col("year").cast("bigint").alias("period"),
        "units",
        near("generation_twh", total).alias("within"),
    )
    generation = profiling.components(_generation(spark, sf))
    season = profiling.seasonality(generation.withColumn("generation_twh", F.col("generation_twh") * mean))
    month = F.month("date").cast("bigint").alias("month")
    exact = generation.groupBy(month, "series").agg(units, F.count("generation_twh").alias("rows"))
    season = season.join(exact, ["month", "series"]).withColumn("sum", F.col("generation_twh") * F.col("rows"))
    means = season.select(
        F.lit("mean").alias("kind"), F.col("series").alias("name"), F.col("month").alias("period"), "units",
        near("sum", mean).alias("within"),
    )
    return totals.unionByName(means)


# Totals that no report rounds are published with six decimals.
TOTALS = (
    "annual_generation",
    "annual_demand",
    "annual_domestic_net_imports",
    "annual_balance",
    "annual_mix",
    "annual_mix_months",
    "annual_total",
    "monthly_mix",
    "annual_shares",
    "mix_pivot",
    "annual_emissions",
    "annual_intensity",
    "emissions_pivot",
    "annual_capacity",
    "capacity_pivot",
)


def _with_decimals(build: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        df = build(spark, sf)
        return df.select(
            *[rounded(c, 6).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes]
        )

    return run


for _name in TOTALS:
    QUERIES[_name] = _with_decimals(QUERIES[_name])


# --- publication ------------------------------------------------------------------------


@query
def mart_fingerprint(spark, sf):
    gold = staging.gold(spark, sf)
    period = marts.resolve_period(gold, AS_OF, BASE)
    return _union(
        [
            publish.fingerprint_frame(build(gold, AS_OF, BASE, period), version).select(
                F.lit(name).alias("mart"), "*"
            )
            for name, (version, build) in marts.MARTS.items()
        ]
    )


@query
def publish_skip_unchanged(spark, sf):
    """Publishing twice: the second run writes nothing."""
    root = run_folder(spark, "marts")
    gold = staging.gold(spark, sf)
    rows = []
    for run in (1, 2):
        for item in publish.publish_marts(spark, gold, root, AS_OF, BASE):
            rows.append((run, item["mart"], item["rows"], item["skipped"]))
    return spark.createDataFrame(rows, "run bigint, mart string, rows bigint, skipped boolean")


def _publish_model(spark: SparkSession, silver: dict[str, DataFrame], sf: str, root: str, **options):
    return gold_plan.build_and_publish(
        spark, silver, root, staging.classification(spark), T.member_codes(spark, sf, "nation"),
        **options,
    )


def _contents(gold: dict[str, DataFrame]) -> DataFrame:
    """Per table its rows, first and last date and the total of its first measure."""
    parts = []
    for name, df in gold.items():
        date = F.col("date") if "date" in df.columns else F.lit(None).cast("timestamp_ntz")
        total = exact_total(S.FACT_MEASURES[name][0]) if name in S.FACT_GRAINS else F.lit(None).cast("double")
        parts.append(
            df.agg(
                F.count("*").alias("row_count"),
                F.min(date).alias("first_date"),
                F.max(date).alias("last_date"),
                rounded(total, 2).alias("total"),
            ).select(F.lit(name).alias("table_name"), "*")
        )
    return _union(parts)


def _publish_years(spark: SparkSession, frames: dict[str, DataFrame], root: str, years: list[str] | None = None) -> None:
    """Silver snapshots in years; with `years`, only these are written and switched."""
    run, pointers, current = tables.new_run_id(), [], tables.current_tables(spark, root)
    for name, df in frames.items():
        rows = df.withColumn(tables.PART, F.year("date").cast("string"))
        rows = rows if years is None else rows.where(F.col(tables.PART).isin(years))
        location = tables.write_snapshot(rows, root, name, run, [tables.PART])
        counts = {r[0]: r["count"] for r in rows.groupBy(tables.PART).count().collect()}
        parts = [p for p in (current.get(name) or {}).get("parts", []) if p["part"] not in counts]
        parts += [{"part": y, "location": tables.part_location(location, y), "rows": n} for y, n in counts.items()]
        pointers.append({"table": name, "location": location, "parts": parts, "columns": df.schema.json()})
    tables.commit(spark, root, pointers)


@query
def reports_by_year(spark, sf):
    """The model by year, one year of generation loaded again, and the yearly balance report
    from the stored sums; beside it, the years that each run has computed."""
    root, silver = run_folder(spark, "by-year"), staging.core_silver(spark, sf)
    options = (staging.classification(spark), T.member_codes(spark, sf, "nation"))
    _publish_years(spark, silver, f"{root}/silver")
    gold_plan.update_gold_by_year(spark, f"{root}/silver", f"{root}/gold", *options)
    _publish_years(spark, {"generation": silver["generation"]}, f"{root}/silver", ["1997"])
    again = gold_plan.update_gold_by_year(spark, f"{root}/silver", f"{root}/gold", *options)
    computed = [f"{fact} {year}" for fact, years in again["years"].items() for year in years]
    report = marts.generation_demand_yearly(gold_plan.load_reporting(spark, f"{root}/gold"), AS_OF)
    return report.withColumn("computed_again", F.lit(", ".join(computed)))


@query
def publish_gold_roundtrip(spark, sf):
    root = run_folder(spark, "gold")
    _publish_model(spark, staging.core_silver(spark, sf), sf, root)
    return _contents(gold_plan.load_gold(spark, root))


@query
def publish_rollback(spark, sf):
    """A second publication fails at its sixth table; readers keep the first."""
    root = run_folder(spark, "gold")
    silver = staging.core_silver(spark, sf)
    split = F.lit(SPLIT).cast("timestamp_ntz")
    early = {name: df.where(F.col("date") < split) for name, df in silver.items()}
    _publish_model(spark, early, sf, root)
    staged = []

    def failing(df: DataFrame, where: str, table: str, run_id: str, **options) -> str:
        if len(staged) == 5:
            raise OSError("storage is gone")
        staged.append(table)
        return tables.write_snapshot(df, where, table, run_id, **options)

    try:
        _publish_model(spark, silver, sf, root, writer=failing)
    except OSError:
        pass
    return _contents(gold_plan.load_gold(spark, root))


@query
def registered_model_query(spark, sf):
    """The published model queried by table name."""
    root = run_folder(spark, "gold")
    _publish_model(spark, staging.core_silver(spark, sf), sf, root)
    prefix = f"v_{root.rsplit('-', 1)[-1]}_"
    gold_plan.register_gold(spark, root, prefix)
    return spark.sql(
        f"""
        SELECT c.country_name, s.energy_category, COUNT(*) AS observations
        FROM {prefix}fact_generation f
        JOIN {prefix}dim_country c ON c.entity_code = f.entity_code
        JOIN {prefix}dim_energy_series s ON s.series_key = f.series_key
        GROUP BY c.country_name, s.energy_category
        """
    )


@query
def registered_model_year(spark, sf):
    """A year of a registered fact: only that year's partition is opened."""
    root = run_folder(spark, "gold")
    _publish_model(spark, staging.core_silver(spark, sf), sf, root)
    prefix = f"v_{root.rsplit('-', 1)[-1]}_"
    gold_plan.register_gold(spark, root, prefix)
    return spark.sql(
        f"""
        SELECT f.entity_code, COUNT(*) AS observations, ROUND(SUM(f.generation_twh), 2) AS generation_twh
        FROM {prefix}fact_generation f WHERE f.year = 1995 GROUP BY f.entity_code
        """
    )


@query
def mart_schema(spark, sf):
    """Names and types of every mart's columns, from analysis alone."""
    gold = staging.gold(spark, sf)
    rows = [
        (name, place, column, kind)
        for name, (_, build) in marts.MARTS.items()
        for place, (column, kind) in enumerate(tables.result_schema(build(gold, AS_OF, BASE, (BASE, BASE))))
    ]
    return spark.createDataFrame(rows, "mart string, position bigint, column_name string, data_type string")


# --- profiling -----------------------------------------------------------------------------


@query
def column_profile(spark, sf):
    return profiling.column_profile(
        _generation(spark, sf), "generation", ["date", "entity_code", "series"]
    )


@query
def profile_csv(spark, sf):
    path = run_folder(spark, "profile")
    profile = column_profile(spark, sf)
    profiling.write_profile_csv(profile, path)
    read = spark.read.option("header", True).schema(profile.schema).csv(path)
    return read.withColumn("sample_values", F.coalesce("sample_values", F.lit("")))


@query
def dataset_coverage(spark, sf):
    return profiling.dataset_coverage(staging.silver(spark, sf))


@query
def describe_measures(spark, sf):
    return profiling.describe_measures(staging.silver(spark, sf))


@query
def unusual_rows_top30(spark, sf):
    return profiling.unusual_rows_top(_generation(spark, sf), 30)


@query
def unusual_breakdown(spark, sf):
    return profiling.unusual_breakdown(_generation(spark, sf))


def _with_nan(spark: SparkSession, sf: str) -> DataFrame:
    """Generation whose smallest positive shares, and the amounts there, are NaN."""
    low = F.col("share_of_generation_pct").between(0, 5)
    nan = F.lit(float("nan"))
    return _generation(spark, sf).withColumns(
        {c: F.when(low, nan).otherwise(F.col(c)) for c in ("generation_twh", "share_of_generation_pct")}
    )


@query
def unusual_breakdown_nan(spark, sf):
    return profiling.unusual_breakdown(_with_nan(spark, sf))


@query
def iqr_screen_nan(spark, sf):
    """Order lines without tax have NaN as price."""
    price = F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_extendedprice"))
    lines = _lines(spark, sf).withColumn("l_extendedprice", price)
    return profiling.iqr_screen(lines, "l_returnflag", "l_extendedprice")


@query
def boxplot_stats_nan(spark, sf):
    return profiling.boxplot_stats(profiling.components(_with_nan(spark, sf)))


@query
def series_list(spark, sf):
    return profiling.series_list(_generation(spark, sf))


@query
def component_rows(spark, sf):
    return profiling.components(_generation(spark, sf)).select(
        "entity_code", "date", "series", "generation_twh"
    )


@query
def iqr_screen(spark, sf):
    return profiling.iqr_screen(profiling.components(_generation(spark, sf)))


@query
def iqr_screen_lines(spark, sf):
    """The same screen over every order line."""
    return profiling.iqr_screen(_lines(spark, sf), "l_returnflag", "l_extendedprice")


@query
def boxplot_stats(spark, sf):
    return profiling.boxplot_stats(profiling.components(_generation(spark, sf)))


@query
def country_series_slice(spark, sf):
    return profiling.country_series_slice(
        profiling.components(_generation(spark, sf)), ENTITY, ["SMALL", "LARGE"]
    )


@query
def capacity_slice(spark, sf):
    capacity = staging.silver_table(spark, sf, "nation", "capacity")
    return profiling.country_series_slice(capacity, ENTITY, ["Solar", "Wind"])


@query
def seasonality(spark, sf):
    return profiling.seasonality(profiling.components(_generation(spark, sf)))


@query
def demand_intensity_yearly(spark, sf):
    frames = staging.silver(spark, sf)
    return profiling.demand_intensity_yearly(frames["demand"], frames["carbon_intensity"], ENTITY)


def _mix(spark: SparkSession, sf: str) -> DataFrame:
    frames = staging.silver(spark, sf)
    return profiling.mix_by_date(
        frames["generation"], frames["carbon_intensity"], ENTITY, "STANDARD", "LARGE"
    )


@query
def mix_pivot_by_date(spark, sf):
    return _mix(spark, sf)


@query
def mix_intensity_corr(spark, sf):
    return profiling.mix_correlation(_mix(spark, sf))


@query
def intensity_ols(spark, sf):
    return profiling.intensity_trend(_mix(spark, sf))


@query
def country_ranking(spark, sf):
    return profiling.country_ranking(
        staging.silver_table(spark, sf, "nation", "carbon_intensity"), 1999
    )


@query
def raw_coverage(spark, sf):
    orders = T.table(spark, sf, "orders").withColumnRenamed("o_orderdate", "date")
    return profiling.raw_coverage(orders, ["o_custkey", "o_totalprice"])
