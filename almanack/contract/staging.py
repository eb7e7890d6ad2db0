"""The given tables, staged as the pipeline stages its data: each stage writes
its tables to the shared folder and the next one reads them.

Reading written tables gives Spark true sizes (so it broadcasts by size, never
by hint), computes the three-way line join once, and leaves nothing to compute
again when an executor is lost. A stage is written once per session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from almanack import schemas as S
from almanack.contract import driver_tables as T
from almanack.operators.facts import dimension_tables, fact_tables
from almanack.plans import gold as gold_plan
from almanack.session import run_folder, run_together
from almanack.sources.lookups import series_classification

# (application, sf_dir, stage, ...) -> (path, schema) of tables already written
_WRITTEN: dict[tuple, tuple] = {}


def _staged(spark: SparkSession, key: tuple) -> DataFrame | None:
    written = _WRITTEN.get((spark.sparkContext.applicationId, *key))
    return None if written is None else spark.read.schema(written[1]).parquet(written[0])


def _stage(spark: SparkSession, key: tuple, build, partition_by: tuple = ()) -> DataFrame:
    if _staged(spark, key) is None:
        path = run_folder(spark, "-".join(key[1:]))
        df = build()
        writer = df.write.mode("errorifexists")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        schema = StructType([f for f in df.schema if f.name not in partition_by])
        _WRITTEN[(spark.sparkContext.applicationId, *key)] = (path, schema)
    return _staged(spark, key)


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _stage(spark, (sf_dir, "base", name), lambda: T.BASES[name](spark, sf_dir))


def silver_table(spark: SparkSession, sf_dir: str, level: str, dataset: str) -> DataFrame:
    source, build = T.BUILDERS[dataset]
    return _stage(
        spark,
        (sf_dir, "silver", level, dataset),
        lambda: build(base(spark, sf_dir, source), T.entities(spark, sf_dir, level)),
    )


def silver(spark: SparkSession, sf_dir: str, level: str = "nation") -> dict[str, DataFrame]:
    keys = {name: (sf_dir, "silver", level, name) for name in S.DATASETS}
    if any(_staged(spark, key) is None for key in keys.values()):
        run_together([lambda n=n: base(spark, sf_dir, n) for n in T.BASES])
        run_together([lambda n=n: silver_table(spark, sf_dir, level, n) for n in keys])
    return {name: _staged(spark, key) for name, key in keys.items()}


def classification(spark: SparkSession) -> DataFrame:
    return series_classification(spark, T.SERIES_CLASSIFICATION)


def dims(spark: SparkSession, sf_dir: str, level: str = "nation") -> dict[str, DataFrame]:
    """The four dimensions, written and read back."""
    keys = {name: (sf_dir, "gold", level, name) for name in S.DIMENSION_KEYS}
    if any(_staged(spark, key) is None for key in keys.values()):
        frames = dimension_tables(
            silver(spark, sf_dir, level), classification(spark), T.member_codes(spark, sf_dir, level)
        )
        run_together([lambda t=t: _stage(spark, keys[t], lambda: frames[t]) for t in keys])
    return {name: _staged(spark, key) for name, key in keys.items()}


def lazy_facts(spark: SparkSession, sf_dir: str, level: str = "nation") -> dict[str, DataFrame]:
    return fact_tables(silver(spark, sf_dir, level), dims(spark, sf_dir, level))


def gold(spark: SparkSession, sf_dir: str, level: str = "nation") -> dict[str, DataFrame]:
    """The nine model tables, written as the publishing job writes them."""
    keys = {name: (sf_dir, "gold", level, name) for name in S.FACT_GRAINS}
    if any(_staged(spark, key) is None for key in keys.values()):
        frames = lazy_facts(spark, sf_dir, level)

        def write(table: str) -> DataFrame:
            parts = gold_plan.partitions_of(table)
            return _stage(spark, keys[table], lambda: gold_plan.arranged(table, frames[table]), parts)

        run_together([lambda t=t: write(t) for t in keys])
    return dims(spark, sf_dir, level) | {n: _staged(spark, key) for n, key in keys.items()}


def core_silver(spark: SparkSession, sf_dir: str, level: str = "nation") -> dict[str, DataFrame]:
    """Silver whose capacity is limited to the months of the core datasets, so
    that the model has no orphan dates and may be published."""
    frames = silver(spark, sf_dir, level)
    months = [frames[name].select("date") for name in S.CORE_DATASETS]
    known = months[0].union(months[1]).union(months[2]).union(months[3]).distinct()
    return frames | {"capacity": frames["capacity"].join(known, "date", "left_semi")}

