"""Data-quality checks as long metric frames.

A report is a frame (table_name, check_name, column_name, value, passed) with a
few rows, so that verdicts are computed by Spark and only the verdict is read.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from almanack import schemas as S
from almanack.functions.expressions import is_missing
from almanack.session import hand_over

Gold = dict[str, DataFrame]


class QualityError(ValueError):
    """A table did not pass its checks."""


def _types(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def _missing(df: DataFrame, columns: Iterable[str]) -> list[Column]:
    types = _types(df)
    return [is_missing(column, types[column]) for column in columns]


# --- building blocks ---------------------------------------------------------


def required_columns(dataset: str) -> list[str]:
    return [*S.BUSINESS_KEYS[S.require_dataset(dataset)], *S.MEASURES[dataset]]


def missing_columns(columns: Sequence[str], dataset: str) -> list[str]:
    """Required columns that are absent, in declared order."""
    return [c for c in required_columns(dataset) if c not in columns]


def key_statistics(df: DataFrame, key: Sequence[str], checked: Sequence[str]) -> DataFrame:
    """One row: row_count, the three duplicate measures, and null counts.

    A single shuffle on the key; every task first collapses its own rows, so a
    key with very many copies costs one row per task.
    """
    nulls = [
        F.sum(flag.cast("bigint")).alias(f"_null_{c}")
        for c, flag in zip(checked, _missing(df, checked))
    ]
    groups = df.groupBy(*key).agg(F.count("*").alias("_n"), *nulls)
    n = F.col("_n")

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0).cast("bigint"))

    return groups.agg(
        total(n).alias("row_count"),
        total(n - 1).alias("duplicate_excess"),
        total(F.when(n > 1, n).otherwise(F.lit(0).cast("bigint"))).alias("duplicate_rows"),
        F.count_if(n > 1).alias("duplicate_groups"),
        *[total(F.col(f"_null_{c}")).alias(f"null_{c}") for c in checked],
    )


def duplicate_excess(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key."""
    return key_statistics(df, key, []).select("duplicate_excess")


def duplicate_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """All rows of keys that occur more than once."""
    return key_statistics(df, key, []).select("duplicate_rows")


def duplicate_groups(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return key_statistics(df, key, []).select("duplicate_groups")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, nulls) in one pass; NaN counts as missing."""
    counted = df.agg(
        *[F.count_if(flag).alias(c) for c, flag in zip(columns, _missing(df, columns))]
    )
    return counted.unpivot([], list(columns), "column_name", "nulls")


def unexpected_countries(df: DataFrame, expected: DataFrame) -> DataFrame:
    """Non-null codes outside the expected list; expected ones may be absent."""
    codes = df.select("entity_code").where(F.col("entity_code").isNotNull()).distinct()
    return codes.join(expected.select("entity_code"), "entity_code", "left_anti").orderBy(
        "entity_code"
    )


def _metrics(one_row: DataFrame, table: str, metrics: Sequence[tuple[str, str | None, str]]) -> DataFrame:
    """Turn chosen columns of a one-row frame into metric rows. A metric passes
    when it is zero, except the row count, which is informative."""
    items = []
    for check, column, source in metrics:
        value = F.col(source).cast("bigint")
        items.append(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(check).alias("check_name"),
                F.lit(column).cast("string").alias("column_name"),
                value.alias("value"),
                (F.lit(True) if check == "row_count" else value == 0).alias("passed"),
            )
        )
    return one_row.select(F.inline(F.array(*items)))


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    """Union in halves: each frame is analysed a few times, not once per frame."""
    if len(frames) == 1:
        return frames[0]
    middle = len(frames) // 2
    return _union(frames[:middle]).unionByName(_union(frames[middle:]))


# --- silver ---------------------------------------------------------------------


def silver_report(df: DataFrame, dataset: str, expected: DataFrame) -> DataFrame:
    """Checks of one dataset. Absent required columns end the report there."""
    absent = missing_columns(df.columns, dataset)
    if absent:
        names = F.explode(F.lit(absent)).alias("column_name")
        one = df.agg(F.count("*").alias("row_count"))
        rows = one.select("row_count", names).select(
            F.lit(dataset).alias("table_name"),
            F.lit("missing_column").alias("check_name"),
            "column_name",
            F.lit(1).cast("bigint").alias("value"),
            F.lit(False).alias("passed"),
        )
        return rows.unionByName(_metrics(one, dataset, [("row_count", None, "row_count")]))
    checked = required_columns(dataset)
    statistics = key_statistics(df, S.BUSINESS_KEYS[dataset], checked)
    metrics = [
        ("row_count", None, "row_count"),
        ("duplicate_keys", None, "duplicate_excess"),
        *[("null_count", c, f"null_{c}") for c in checked],
    ]
    foreign = unexpected_countries(df, expected).agg(F.count("*").alias("n"))
    return _metrics(statistics, dataset, metrics).unionByName(
        _metrics(foreign, dataset, [("unexpected_countries", None, "n")])
    )


def null_metrics(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Aggregates (rows, null_<column>) that can be observed while the frame is written."""
    flags = zip(columns, _missing(df, columns))
    return [F.count(F.lit(1)).alias("rows"), *[F.count_if(flag).alias(f"null_{c}") for c, flag in flags]]


def written_report(
    df: DataFrame, dataset: str, expected: DataFrame, observed: dict, parts: str
) -> tuple[DataFrame, DataFrame]:
    """The checks of `silver_report` for rows that were counted while they were written
    (`observed`, by `null_metrics`), and (part, rows): one scan, of the key columns alone.

    Keys are grouped once, and the groups once more by part and country; unexpected
    countries and repeated keys follow from these few rows. What was counted while
    writing must be what is read."""
    key = S.BUSINESS_KEYS[dataset]
    groups = df.groupBy(parts, *key).agg(F.count(F.lit(1)).alias("n"))
    few = groups.groupBy(parts, "entity_code").agg(F.sum("n").alias("n"), F.sum(F.col("n") - 1).alias("excess"))
    few = hand_over(few, f"key-counts-{dataset}")
    codes = unexpected_countries(few, expected).agg(F.count("*").alias("foreign"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
    counted = F.struct(*[F.lit(v).alias(k) for k, v in observed.items()])
    one = few.agg(total("n"), total("excess")).withColumns({"observed": counted, "foreign": codes.scalar()})
    one = one.withColumn("lost", F.abs(F.col("n") - F.col("observed.rows")))
    metrics = [
        ("row_count", None, "n"),
        ("rows_not_as_written", None, "lost"),
        ("duplicate_keys", None, "excess"),
        *[("null_count", c, f"observed.null_{c}") for c in required_columns(dataset)],
        ("unexpected_countries", None, "foreign"),
    ]
    return _metrics(one, dataset, metrics), few.groupBy(parts).agg(F.sum("n").alias("rows"))


# --- model ------------------------------------------------------------------------


def dimension_report(gold: Gold) -> DataFrame:
    """Unique, non-null keys of the four dimensions."""
    parts = []
    for table, key in S.DIMENSION_KEYS.items():
        metrics = [("duplicate_keys", None, "duplicate_rows")]
        metrics += [("null_key", c, f"null_{c}") for c in key]
        parts.append(_metrics(key_statistics(gold[table], key, key), table, metrics))
    return _union(parts)


ORPHAN_CHECKS = {
    "date": "orphan_dates",
    "entity_code": "orphan_countries",
    "series_key": "orphan_series",
    "capacity_series_key": "orphan_capacity_series",
}


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0).cast("bigint"))


def fact_groups(fact: DataFrame, table: str) -> DataFrame:
    """The fact's one pass: per grain the rows, missing measures and rows with any null
    among what is required. All checks of a fact start from here; the foreign keys are
    part of the grain."""
    grain, measures = S.FACT_GRAINS[table], S.FACT_MEASURES[table]
    nulls = [F.sum(m.cast("bigint")).alias(f"_null_{c}") for c, m in zip(measures, _missing(fact, measures))]
    any_null = reduce(Column.__or__, [F.col(c).isNull() for c in (*grain, *measures)])
    return fact.groupBy(*grain).agg(F.count("*").alias("_n"), F.count_if(any_null).alias("_any_null"), *nulls)


def _known(gold: Gold, key: str) -> DataFrame:
    """How often a dimension holds each key."""
    column = F.col(key).alias(f"_dim_{key}")
    return gold[S.FOREIGN_KEYS[key]].groupBy(column).agg(F.count("*").alias(f"_times_{key}"))


def fact_statistics(gold: Gold, table: str) -> DataFrame:
    """One row with grain, measure and foreign-key counts of a fact, read once. Here a
    null matches a null in the dimension."""
    grain, measures = S.FACT_GRAINS[table], S.FACT_MEASURES[table]
    groups = fact_groups(gold[table], table)
    missing = dict(zip(grain, _missing(groups, grain)))
    keys = [c for c in ORPHAN_CHECKS if c in grain]
    for key in keys:
        known = _known(gold, key)
        groups = groups.join(known, F.col(key).eqNullSafe(F.col(f"_dim_{key}")), "left")
    n, zero = F.col("_n"), F.lit(0).cast("bigint")
    orphans = {name: F.lit(0).cast("bigint") for name in ORPHAN_CHECKS.values()}
    for key in keys:
        orphans[ORPHAN_CHECKS[key]] = _total(F.when(F.col(f"_times_{key}").isNull(), n).otherwise(zero))
    return groups.agg(
        _total(n).alias("row_count"),
        _total(F.when(n > 1, n).otherwise(zero)).alias("duplicate_rows"),
        *[_total(F.when(flag, n).otherwise(zero)).alias(f"null_{c}") for c, flag in missing.items()],
        *[_total(F.col(f"_null_{c}")).alias(f"null_{c}") for c in measures],
        *[count.alias(name) for name, count in orphans.items()],
    )


def _grain_metrics(table: str) -> list[tuple]:
    metrics = [("duplicate_grain", None, "duplicate_rows")]
    metrics += [("null_grain", c, f"null_{c}") for c in S.FACT_GRAINS[table]]
    return metrics + [("null_measure", c, f"null_{c}") for c in S.FACT_MEASURES[table]]


def _key_metrics() -> list[tuple]:
    return [(name, key, name) for key, name in ORPHAN_CHECKS.items()]


def fact_report(gold: Gold) -> DataFrame:
    """Unique, non-null grain and non-null measures of the five facts."""
    return _union([_metrics(fact_statistics(gold, t), t, _grain_metrics(t)) for t in S.FACT_GRAINS])


def foreign_key_report(gold: Gold) -> DataFrame:
    return _union([_metrics(fact_statistics(gold, t), t, _key_metrics()) for t in S.FACT_GRAINS])


def gold_report(gold: Gold) -> DataFrame:
    """All checks of the model; every fact is scanned and shuffled once."""
    facts = [
        _metrics(fact_statistics(gold, t), t, _grain_metrics(t) + _key_metrics()) for t in S.FACT_GRAINS
    ]
    return _union([dimension_report(gold), *facts])


def verdict(report: DataFrame) -> DataFrame:
    """One row: did everything pass, and how many checks did not."""
    return report.agg(
        F.coalesce(F.bool_and("passed"), F.lit(False)).alias("passed"),
        F.count("*").alias("checks"),
        F.count_if(~F.col("passed")).alias("failed"),
    )


def raise_if_failed(report: DataFrame, what: str) -> list:
    """Read the few metric rows; raise with the failing ones."""
    rows = report.collect()
    failed = [row.asDict() for row in rows if not row["passed"]]
    if failed or not rows:
        raise QualityError(f"{what} did not pass its checks: {failed}")
    return rows


def row_counts(frames: Gold) -> DataFrame:
    """(table_name, row_count); answered from file footers for stored tables."""
    return _union(
        [
            df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "*")
            for name, df in frames.items()
        ]
    )


# --- persisted tables ---------------------------------------------------------------


def persisted_table_check(gold: Gold, table: str) -> DataFrame:
    """One row over a stored table: total_records, null_required_fields,
    invalid_foreign_keys, duplicate_key_groups. Here null never matches."""
    if table not in S.GOLD_TABLES:
        raise ValueError(f"unknown table {table!r}")
    if table in S.FACT_GRAINS:
        groups = fact_groups(gold[table], table)
        key = S.FACT_GRAINS[table]
    else:
        df, key = gold[table], S.DIMENSION_KEYS[table]
        any_null = reduce(Column.__or__, [F.col(c).isNull() for c in key])
        groups = df.groupBy(*key).agg(F.count("*").alias("_n"), F.count_if(any_null).alias("_any_null"))
    # A key that a dimension holds twice meets every row twice.
    times, broken = F.lit(1).cast("bigint"), F.lit(False)
    for name in key if table in S.FACT_GRAINS else ():
        groups = groups.join(_known(gold, name), F.col(name) == F.col(f"_dim_{name}"), "left")
        times = times * F.coalesce(f"_times_{name}", F.lit(1).cast("bigint"))
        broken = broken | F.col(f"_times_{name}").isNull()
    zero = F.lit(0).cast("bigint")
    return groups.agg(
        _total(F.col("_n") * times).alias("total_records"),
        _total(F.col("_any_null") * times).alias("null_required_fields"),
        _total(F.when(broken, F.col("_n") * times).otherwise(zero)).alias("invalid_foreign_keys"),
        F.count_if(F.col("_n") > 1).alias("duplicate_key_groups"),
    ).select(F.lit(table).alias("table_name"), "*")


def persisted_model_check(gold: Gold) -> DataFrame:
    return _union([persisted_table_check(gold, table) for table in S.GOLD_TABLES])


def raise_if_persisted_invalid(gold: Gold) -> dict[str, dict]:
    """Check all stored tables in one job; the first bad one raises."""
    rows = {row["table_name"]: row.asDict() for row in persisted_model_check(gold).collect()}
    for table in S.GOLD_TABLES:
        row = rows[table]
        if row["total_records"] == 0 or any(
            row[name]
            for name in ("null_required_fields", "invalid_foreign_keys", "duplicate_key_groups")
        ):
            raise QualityError(f"stored table did not pass: {row}")
    return rows


MART_KEY = ("country_name", "start_year", "end_year")


def mart_check(mart: DataFrame) -> DataFrame:
    """One row: total_rows, invalid_rows, duplicate_groups of a reporting mart."""
    absent = [c for c in MART_KEY if c not in mart.columns]
    if absent:
        raise QualityError(f"mart lacks {absent}")
    invalid = reduce(Column.__or__, [F.col(c).isNull() for c in MART_KEY])
    groups = mart.groupBy(*MART_KEY).agg(F.count("*").alias("_n"))
    n = F.col("_n")
    return groups.agg(
        F.coalesce(F.sum(n), F.lit(0).cast("bigint")).alias("total_rows"),
        F.coalesce(F.sum(F.when(invalid, n)), F.lit(0).cast("bigint")).alias("invalid_rows"),
        F.count_if(n > 1).alias("duplicate_groups"),
    )


def raise_if_mart_invalid(mart: DataFrame, name: str) -> int:
    row = mart_check(mart).first()
    if row["total_rows"] == 0 or row["invalid_rows"] or row["duplicate_groups"]:
        raise QualityError(f"mart {name} is not publishable: {row.asDict()}")
    return row["total_rows"]


def key_coverage(silver: dict[str, DataFrame]) -> DataFrame:
    """Duplicates, countries and first/last date per dataset."""
    parts = []
    for name, df in silver.items():
        by_key = df.groupBy(*S.BUSINESS_KEYS[name]).agg(F.count("*").alias("_n"))
        by_entity = by_key.groupBy("entity_code").agg(
            F.sum(F.col("_n") - 1).alias("excess"),
            F.min("date").alias("min_date"),
            F.max("date").alias("max_date"),
        )
        parts.append(
            by_entity.agg(
                F.coalesce(F.sum("excess"), F.lit(0).cast("bigint")).alias("duplicates"),
                F.count("entity_code").alias("countries"),
                F.min("min_date").alias("min_date"),
                F.max("max_date").alias("max_date"),
            ).select(F.lit(name).alias("dataset"), "*")
        )
    return _union(parts)
