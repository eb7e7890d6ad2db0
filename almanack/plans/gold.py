"""Silver snapshots to the published nine-table model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from almanack import schemas as S
from almanack.operators import facts, quality, yearly
from almanack.plans.silver import load_silver
from almanack.session import run_together
from almanack.sources import lookups, tables

Writer = Callable[..., str]


PARTITION = "year"


def arranged(table: str, df: DataFrame) -> DataFrame:
    """Facts get a partition column and evenly sized files, sorted by date. Spark
    cannot skip row groups by timestamps without zone, but it skips whole years."""
    if table not in S.FACT_GRAINS:
        return df
    return (
        df.withColumn(PARTITION, F.year("date"))
        .hint("rebalance", F.col(PARTITION))
        .sortWithinPartitions(PARTITION, *S.FACT_GRAINS[table])
    )


def partitions_of(table: str) -> tuple[str, ...]:
    return (PARTITION,) if table in S.FACT_GRAINS else ()


def _stage(
    spark: SparkSession, frames: dict[str, DataFrame], root: str, run_id: str, writer: Writer
) -> tuple[dict[str, str], dict[str, DataFrame]]:
    """Write the tables side by side and read them back with declared types."""

    def write(table: str) -> str:
        frame = arranged(table, frames[table])
        return writer(frame, root, table, run_id, partition_by=partitions_of(table))

    written = run_together([lambda t=t: write(t) for t in frames])
    locations = dict(zip(frames, written))
    return locations, {
        t: spark.read.schema(S.GOLD_SCHEMAS[t]).parquet(at) for t, at in locations.items()
    }


def _check_and_commit(
    spark: SparkSession,
    staged: dict[str, DataFrame],
    locations: dict[str, str],
    root: str,
    run_id: str,
) -> dict:
    quality.raise_if_failed(quality.gold_report(staged), "gold model")
    counts = {row["table_name"]: row["row_count"] for row in quality.row_counts(staged).collect()}
    empty = [table for table in S.GOLD_TABLES if not counts[table]]
    if empty:
        raise quality.QualityError(f"empty tables: {empty}")
    pointers = [
        {"table": t, "location": locations[t], "run_id": run_id, "row_count": counts[t]}
        for t in S.GOLD_TABLES
    ]
    version = tables.commit(spark, root, pointers)
    return {"version": version, "run_id": run_id, "row_counts": counts}


def publish_gold(
    spark: SparkSession,
    gold: dict[str, DataFrame],
    root: str,
    run_id: str | None = None,
    writer: Writer = tables.write_snapshot,
) -> dict:
    """Stage all nine tables, check what was written, then switch all of them in
    one commit. A failure before the commit leaves the old version in place."""
    if set(gold) != set(S.GOLD_TABLES):
        raise ValueError(f"the model must consist of {S.GOLD_TABLES}")
    run_id = run_id or tables.new_run_id()
    locations, staged = _stage(spark, gold, root, run_id, writer)
    return _check_and_commit(spark, staged, locations, root, run_id)


def build_and_publish(
    spark: SparkSession,
    silver: dict[str, DataFrame],
    root: str,
    classification: DataFrame | None = None,
    members: DataFrame | None = None,
    writer: Writer = tables.write_snapshot,
) -> dict:
    """Dimensions first; the facts then look their keys up in the written ones."""
    classification = lookups.series_classification(spark) if classification is None else classification
    members = lookups.members(spark) if members is None else members
    run_id = tables.new_run_id()
    dims = facts.dimension_tables(silver, classification, members)
    dim_locations, dims = _stage(spark, dims, root, run_id, writer)
    fact_locations, staged = _stage(spark, facts.fact_tables(silver, dims), root, run_id, writer)
    return _check_and_commit(spark, dims | staged, dim_locations | fact_locations, root, run_id)


def update_gold(spark: SparkSession, silver_root: str, gold_root: str, **options) -> dict:
    """Build the model from the published silver datasets and publish it."""
    return build_and_publish(spark, load_silver(spark, silver_root), gold_root, **options)


def _year_locations(pointer: dict | None) -> dict[str, dict]:
    return {p["part"]: p for p in (pointer or {}).get("parts") or []}


def _write_years(
    spark: SparkSession, frame: DataFrame, schema: T.StructType, root: str, table: str, run_id: str, writer: Writer,
    year: Column,
) -> tuple[DataFrame, dict[str, str], dict[str, int]]:
    """Write a table's rows by year and read them back: the frame (with the year as
    tables.PART), the location and the rows of each year."""
    rows = frame.withColumn(tables.PART, year.cast("string"))
    order = [c for c in S.FACT_GRAINS.get(table, ()) if c in rows.columns]
    rows = rows.hint("rebalance", F.col(tables.PART)).sortWithinPartitions(tables.PART, *order)
    location = writer(rows, root, table, run_id, partition_by=(tables.PART,))
    with_part = T.StructType([*schema.fields, T.StructField(tables.PART, T.StringType())])
    written = spark.read.schema(with_part).parquet(location)
    counts = {r[0]: r["count"] for r in written.groupBy(tables.PART).count().collect()}
    return written, {year: tables.part_location(location, year) for year in counts}, counts


def update_gold_by_year(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    classification: DataFrame | None = None,
    members: DataFrame | None = None,
    writer: Writer = tables.write_snapshot,
) -> dict:
    """Build the model from silver snapshots in years, and publish it with yearly sums of
    each fact: only years whose silver files are new are computed, written and checked.

    A stored year remembers the silver location it was made of. Dimensions are made
    anew (a scan of the columns they need) and switched if they differ; if one has lost a
    key, all years are built again, since their keys were checked against it."""
    silver_pointers = tables.current_tables(spark, silver_root)
    whole = [d for d in S.DATASETS if (silver_pointers.get(d) or {}).get("parts") is None]
    if whole:
        raise ValueError(f"not in years below {silver_root}: {whole}")
    pointers = tables.current_tables(spark, gold_root)
    classification = lookups.series_classification(spark) if classification is None else classification
    members = lookups.members(spark) if members is None else members
    run_id = tables.new_run_id()
    silver = {d: tables.read_pointer(spark, silver_pointers[d]) for d in S.DATASETS}
    dim_locations, dims = _stage(
        spark, facts.dimension_tables(silver, classification, members), gold_root, run_id, writer
    )
    before = {t: tables.read_pointer(spark, pointers[t], S.GOLD_SCHEMAS[t]) for t in dims if t in pointers}
    lost = len(before) < len(dims) or any(
        not df.join(dims[t], list(S.DIMENSION_KEYS[t]), "left_anti").isEmpty() for t, df in before.items()
    )
    alike = [t for t, df in before.items() if df.exceptAll(dims[t]).isEmpty() and dims[t].exceptAll(df).isEmpty()]

    changed, parts, staged, new = {}, {}, {}, []
    for fact, dataset in facts.DATASET_OF.items():
        now = _year_locations(silver_pointers[dataset])
        had = {} if lost else _year_locations(pointers.get(fact))
        changed[fact] = sorted(y for y, p in now.items() if had.get(y, {}).get("source") != p["location"])
        for table in (fact, yearly.yearly_name(fact)):
            old = _year_locations(pointers.get(table))
            parts[table] = [old[y] for y in sorted(now) if y not in changed[fact]]
        if not changed[fact]:
            staged[fact] = spark.createDataFrame([], S.GOLD_SCHEMAS[fact])
            if len(now) == len(had):
                continue
        rows = tables.read_pointer(spark, silver_pointers[dataset], parts=changed[fact])
        frame = facts.fact_tables({**silver, dataset: rows}, dims)[fact]
        year = F.year("date")
        written, at, counts = _write_years(spark, frame, S.GOLD_SCHEMAS[fact], gold_root, fact, run_id, writer, year)
        parts[fact] += [{"part": y, "location": at[y], "rows": counts[y], "source": now[y]["location"]} for y in at]
        staged[fact] = written.drop(tables.PART)
        sums = yearly.year_sums(written.drop(tables.PART), fact)
        schema = T.StructType.fromDDL(yearly.schema_of(fact))
        name = yearly.yearly_name(fact)
        _, at, counts = _write_years(spark, sums, schema, gold_root, name, run_id, writer, F.col("year"))
        parts[name] += [{"part": y, "location": at[y], "rows": counts[y], "source": now[y]["location"]} for y in at]
        new += [(fact, S.GOLD_SCHEMAS[fact]), (name, schema)]

    quality.raise_if_failed(quality.gold_report(dims | staged), "gold model")
    counts = {r["table_name"]: r["row_count"] for r in quality.row_counts(dims).collect()}
    counts |= {table: sum(p["rows"] for p in rows) for table, rows in parts.items()}
    empty = [table for table in S.GOLD_TABLES if not counts[table]]
    if empty:
        raise quality.QualityError(f"empty tables: {empty}")
    switched = [
        {"table": t, "location": dim_locations[t], "run_id": run_id, "row_count": counts[t]} for t in dims if t not in alike
    ] + [
        {
            "table": table,
            "location": tables.snapshot_location(gold_root, table, run_id),
            "run_id": run_id,
            "row_count": counts[table],
            "parts": sorted(parts[table], key=lambda p: p["part"]),
            "columns": schema.json(),
        }
        for table, schema in new
    ]
    version = tables.commit(spark, gold_root, switched) if switched else tables.current_version(spark, gold_root)
    return {"version": version, "run_id": run_id, "row_counts": counts, "years": changed}


def load_reporting(spark: SparkSession, gold_root: str) -> dict[str, DataFrame]:
    """The model with its yearly sums, from which reports and marts are made."""
    pointers = tables.current_tables(spark, gold_root)
    stored = [t for t in yearly.YEARLY_TABLES if t in pointers]
    return tables.read_published(spark, gold_root, [*S.GOLD_TABLES, *stored], S.GOLD_SCHEMAS)


def inputs_of(spark: SparkSession, gold_root: str) -> Callable[[tuple[int, int] | None], str]:
    """What a mart of a comparison period is made of: a text of the immutable locations
    of dimensions and of the period's yearly sums."""
    pointers = tables.current_tables(spark, gold_root)

    def text(period: tuple[int, int] | None) -> str:
        years = {str(y) for y in period or ()}
        used = [pointers[t]["location"] for t in S.DIMENSION_KEYS]
        for table in yearly.YEARLY_TABLES:
            used += [p["location"] for y, p in _year_locations(pointers.get(table)).items() if y in years]
        return "|".join(used)

    return text


def load_gold(spark: SparkSession, gold_root: str) -> dict[str, DataFrame]:
    return tables.read_published(spark, gold_root, S.GOLD_TABLES, S.GOLD_SCHEMAS)


def validate_published(spark: SparkSession, gold_root: str) -> dict[str, dict]:
    """Check the published tables as readers see them."""
    return quality.raise_if_persisted_invalid(load_gold(spark, gold_root))


def register_gold(spark: SparkSession, gold_root: str, prefix: str = "") -> list[str]:
    partitions = {table: partitions_of(table) for table in S.GOLD_TABLES}
    return tables.register_tables(spark, gold_root, S.GOLD_SCHEMAS, prefix, partitions)


def register_silver(spark: SparkSession, silver_root: str, prefix: str = "") -> list[str]:
    return tables.register_tables(spark, silver_root, S.SILVER_SCHEMAS, prefix)
