"""Strict typing and scoping of raw rows (raw -> silver)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from almanack import schemas as S


def _require_columns(df: DataFrame, columns: Iterable[str], what: str) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing {what} columns: {missing}")


def _fail(message: str, value: Column, data_type: str) -> Column:
    text = F.concat(F.lit(message + ": "), value.cast("string"))
    return F.raise_error(text).cast(data_type)


# A cast would also take type suffixes (1d, 1.5f) and drop a zone offset.
NUMBER = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?|nan)$"
ZONE_OFFSET = r":\d{2}(\.\d+)?\s*([A-Za-z]+|[+-]\d{1,2}(:?\d{2}){0,2})$"


def strict_double(name: str) -> Column:
    """Empty text is missing; anything else must be a number."""
    value = F.nullif(F.trim(F.col(name).cast("string")), F.lit(""))
    parsed = F.when(value.rlike(NUMBER), value.try_cast("double"))
    return F.when(
        value.isNotNull() & parsed.isNull(), _fail(f"{name} is not a number", value, "double")
    ).otherwise(parsed)


def strict_timestamp(name: str) -> Column:
    """Dates and times without a zone; a zone offset is refused, not dropped."""
    value = F.col(name)
    text = value.cast("string")
    parsed = F.when(~text.rlike(ZONE_OFFSET), value.try_cast("timestamp_ntz"))
    return F.when(
        value.isNotNull() & parsed.isNull(), _fail(f"{name} is not a date", text, "timestamp_ntz")
    ).otherwise(parsed)


def strict_boolean(name: str) -> Column:
    """Only true, false and null; no numbers, no yes/no text."""
    text = F.col(name).cast("string")
    return (
        F.when(text == "true", F.lit(True))
        .when(text == "false", F.lit(False))
        .when(text.isNull(), F.lit(None).cast("boolean"))
        .otherwise(_fail(f"{name} is not a boolean", text, "boolean"))
    )


def standardize_common_columns(df: DataFrame) -> DataFrame:
    _require_columns(df, S.COMMON_COLUMNS, "common")
    return df.withColumns(
        {
            "entity": F.col("entity").cast("string"),
            "entity_code": F.col("entity_code").cast("string"),
            "date": strict_timestamp("date"),
        }
    )


def standardize_dataset_types(df: DataFrame, dataset: str) -> DataFrame:
    measures = S.MEASURES[dataset]
    flags = S.FLAGS.get(dataset, ())
    _require_columns(df, measures, f"{dataset} measure")
    _require_columns(df, flags, f"{dataset} flag")
    typed = {name: strict_double(name) for name in measures}
    typed |= {name: strict_boolean(name) for name in flags}
    if "series" in df.columns:
        typed["series"] = F.col("series").cast("string")
    return df.withColumns(typed)


def apply_project_scope(
    df: DataFrame, dataset: str, project_start: str = S.PROJECT_START
) -> DataFrame:
    """Core datasets start with the project; capacity keeps what the source has."""
    if dataset not in S.CORE_DATASETS:
        return df
    start = project_start if len(project_start) > 7 else f"{project_start}-01"
    return df.where(F.col("date") >= F.lit(start).cast("timestamp_ntz"))


def sort_keys(df: DataFrame) -> list[str]:
    keys = ["entity_code", "date"]
    return keys + ["series"] if "series" in df.columns else keys


def sort_silver(df: DataFrame) -> DataFrame:
    """Total order for output that people read; jobs sort within files only."""
    return df.orderBy(*sort_keys(df))


def clean(df: DataFrame, dataset: str, project_start: str = S.PROJECT_START) -> DataFrame:
    """Typed, scoped rows. Outliers, negative imports, shares beyond 0..100 and
    missing observations stay as they are; other columns pass through."""
    S.require_dataset(dataset)
    return (
        df.transform(standardize_common_columns)
        .transform(standardize_dataset_types, dataset)
        .transform(apply_project_scope, dataset, project_start)
    )


def dataset_country_scope(
    project_scope: DataFrame, overrides: DataFrame, datasets: DataFrame
) -> DataFrame:
    """(dataset, entity_code): the dataset's own list where it has one, else the
    project list. ``overrides`` is (dataset, entity_code)."""
    own = overrides.select("dataset").distinct()
    project_wide = project_scope.select(
        "entity_code", F.explode(F.lit(list(S.DATASETS))).alias("dataset")
    )
    default = project_wide.join(datasets, "dataset", "left_semi").join(own, "dataset", "left_anti")
    return default.select("dataset", "entity_code").unionByName(
        overrides.join(datasets, "dataset", "left_semi").select("dataset", "entity_code")
    )


def backfill_scope(
    requested: DataFrame, project_scope: DataFrame, dataset_scope: DataFrame | None = None
) -> DataFrame:
    """Requested codes (pos, entity_code) upper-cased, without repeats, in their
    first order, restricted to the dataset's list. A code outside the project
    fails the query."""
    first = requested.groupBy(F.upper("entity_code").alias("entity_code")).agg(
        F.min("pos").alias("pos")
    )
    known = project_scope.select(F.col("entity_code").alias("known")).distinct()
    checked = first.join(known, F.col("entity_code") == F.col("known"), "left").select(
        "pos",
        F.when(
            F.col("known").isNull(),
            _fail("outside the project scope", F.col("entity_code"), "string"),
        )
        .otherwise(F.col("entity_code"))
        .alias("entity_code"),
    )
    allowed = project_scope if dataset_scope is None else dataset_scope
    return (
        checked.join(allowed.select("entity_code").distinct(), "entity_code", "left_semi")
        .orderBy("pos")
        .select("pos", "entity_code")
    )


def unknown_backfill_countries(requested: DataFrame, project_scope: DataFrame) -> DataFrame:
    """The codes that make a backfill request invalid."""
    return (
        requested.select(F.upper("entity_code").alias("entity_code"))
        .distinct()
        .join(project_scope, "entity_code", "left_anti")
    )


def resolve_datasets(names: Sequence[str] | None) -> list[str]:
    """All datasets, or the named ones; an unknown name is an error."""
    if names is None:
        return list(S.DATASETS)
    unknown = [name for name in names if name not in S.DATASETS]
    if unknown:
        raise ValueError(f"unknown datasets: {unknown}")
    return list(names)
