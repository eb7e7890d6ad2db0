"""Incremental loads and backfills from landing tables to raw documents."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from almanack import schemas as S
from almanack.operators import cleaning, increments
from almanack.session import hand_over
from almanack.sources import bronze, lookups, versions

STATE_SCHEMA = "dataset string, last_source_date string"


def read_state(spark: SparkSession, root: str) -> DataFrame:
    """(dataset, last_source_date) as last published."""
    log = f"{root}/_state"
    rows = versions.rows_of(spark, log, versions.newest(spark, log))
    return spark.createDataFrame([(r["dataset"], r["last_source_date"]) for r in rows], STATE_SCHEMA)


def _advance(spark: SparkSession, root: str, dataset: str, last: str) -> None:
    def change(current: list[dict], _: int) -> list[dict]:
        dates = {r["dataset"]: r["last_source_date"] for r in current} | {dataset: last}
        return [{"dataset": d, "last_source_date": t} for d, t in dates.items()]

    versions.advance(spark, f"{root}/_state", change)


def latest_available(landing: dict[str, DataFrame]) -> DataFrame:
    """(dataset, latest): the newest date each source offers, null if empty."""
    parts = [
        df.agg(F.date_format(F.max("date"), "yyyy-MM-dd").alias("latest")).select(
            F.lit(name).alias("dataset"), "latest"
        )
        for name, df in landing.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def _stamp() -> tuple[str, str]:
    now = dt.datetime.now(dt.timezone.utc)
    return now.strftime("%Y-%m-%d"), now.strftime("%Y%m%dT%H%M%S%fZ")


def _load(spark: SparkSession, rows: DataFrame, bronze_root: str, dataset: str) -> str | None:
    """Write one load; None when there is nothing to write. The slice is computed
    once and handed over."""
    rows = hand_over(rows, f"load-{dataset}")
    if rows.isEmpty():
        return None
    day, stamp = _stamp()
    return bronze.append_documents(bronze.to_documents(rows), bronze_root, dataset, day, stamp)


def declared_documents(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    documents = bronze.read_documents(spark, path)
    return documents.select(
        F.lit(dataset).alias("dataset"), F.size("data").cast("bigint").alias("n_rows"), "declared_max"
    )


def run_ingestion(
    spark: SparkSession,
    landing: dict[str, DataFrame],
    bronze_root: str,
    state_root: str,
    scope: DataFrame | None = None,
    project_start: str = S.PROJECT_START,
) -> list[dict]:
    """Load what is new per dataset; the state moves only after the documents
    are stored, and to the date they declare."""
    scope = lookups.country_scope(spark) if scope is None else scope
    plan = increments.increment_plan(
        latest_available(landing), read_state(spark, state_root), project_start
    )
    outcome = []
    for step in sorted(plan.collect(), key=lambda row: S.DATASETS.index(row["dataset"])):
        dataset = step["dataset"]
        result = {"dataset": dataset, "action": step["action"], "last_source_date": None}
        if step["action"] == "load":
            countries = scope.where(F.col("dataset") == dataset)
            start = step["start_date"].isoformat()
            rows = increments.increment_slice(landing[dataset], countries, start)
            target = _load(spark, rows, bronze_root, dataset)
            if target is None:
                result["action"] = "empty"
            else:
                stored = declared_documents(spark, target, dataset)
                last = increments.state_advance(stored).first()["last_source_date"].isoformat()
                _advance(spark, state_root, dataset, last)
                result |= {"last_source_date": last, "location": target}
        outcome.append(result)
    return outcome


def run_backfill(
    spark: SparkSession,
    landing: dict[str, DataFrame],
    bronze_root: str,
    countries: Sequence[str],
    datasets: Sequence[str] | None = None,
    start: str | None = None,
    scope: DataFrame | None = None,
    project_scope: DataFrame | None = None,
    project_start: str = S.PROJECT_START,
) -> list[dict]:
    """Load history for chosen countries. The ingestion state is left alone; the
    next silver run picks the new documents up."""
    names = cleaning.resolve_datasets(datasets)
    scope = lookups.country_scope(spark) if scope is None else scope
    if project_scope is None:
        project_scope = spark.createDataFrame([(c,) for c in S.PROJECT_COUNTRIES], "entity_code string")
    requested = spark.createDataFrame(list(enumerate(countries)), "pos int, entity_code string")
    unknown = cleaning.unknown_backfill_countries(requested, project_scope).collect()
    if unknown:
        raise ValueError(f"outside the project scope: {sorted(r[0] for r in unknown)}")
    begin = start or project_start
    begin = begin if len(begin) > 7 else f"{begin}-01"
    outcome = []
    for dataset in names:
        allowed = cleaning.backfill_scope(
            requested, project_scope, scope.where(F.col("dataset") == dataset)
        )
        rows = increments.increment_slice(landing[dataset], allowed, begin)
        target = _load(spark, rows, bronze_root, dataset)
        outcome.append({"dataset": dataset, "written": target is not None, "location": target})
    return outcome
