"""What to load next, what changed, and the keep-last merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from almanack import schemas as S
from almanack.session import hand_over


SOURCE_DATE = r"^(\d{4}-\d{2}-\d{2})([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def parse_source_date(text: str | Column) -> Column:
    """The date of ISO date or timestamp text, as it stands in front of any zone.
    The whole text must have that form; anything else is an error."""
    value = F.col(text) if isinstance(text, str) else text
    parsed = F.try_to_date(F.nullif(F.regexp_extract(value, SOURCE_DATE, 1), F.lit("")), "yyyy-MM-dd")
    wrong = F.raise_error(F.concat(F.lit("not an ISO date: "), value)).cast("date")
    return F.when(value.isNotNull() & parsed.isNull(), wrong).otherwise(parsed)


def project_start_date(value: str) -> Column:
    """``YYYY-MM`` stands for the first day of that month."""
    return F.to_date(F.lit(value if len(value) > 7 else f"{value}-01"))


def next_month(date: Column) -> Column:
    return F.add_months(F.trunc(date, "month"), 1)


def increment_plan(
    latest: DataFrame, state: DataFrame, project_start: str = S.PROJECT_START
) -> DataFrame:
    """One row per dataset: (dataset, latest, last_loaded, action, start_date).

    ``latest`` is (dataset, latest text); ``state`` (dataset, last_source_date
    text). A dataset without newer data is skipped; a dataset never loaded
    starts with the project; any other with the month after the last one.
    """
    plan = latest.join(state, "dataset", "left").select(
        "dataset",
        parse_source_date("latest").alias("latest"),
        parse_source_date("last_source_date").alias("last_loaded"),
    )
    skip = F.col("last_loaded").isNotNull() & (F.col("latest") <= F.col("last_loaded"))
    start = F.when(F.col("last_loaded").isNull(), project_start_date(project_start)).otherwise(
        next_month(F.col("last_loaded"))
    )
    return plan.select(
        "*",
        F.when(skip, F.lit("skip")).otherwise(F.lit("load")).alias("action"),
        F.when(~skip, start).alias("start_date"),
    )


def increment_slice(df: DataFrame, scope: DataFrame, start: str | Column) -> DataFrame:
    """Rows from ``start`` on for the entities in scope."""
    first = F.lit(start).cast("timestamp_ntz") if isinstance(start, str) else start
    return df.where(F.col("date") >= first).join(
        scope.select("entity_code").distinct(), "entity_code", "left_semi"
    )


def state_advance(documents: DataFrame) -> DataFrame:
    """(dataset, last_source_date): the newest date the documents declare.

    ``documents`` is (dataset, n_rows, declared_max text). Empty documents do
    not advance the state; a filled one without a declared date is an error.
    """
    declared = F.when(
        F.col("declared_max").isNull(),
        F.raise_error(F.concat(F.lit("no source date declared for "), F.col("dataset"))).cast(
            "date"
        ),
    ).otherwise(parse_source_date("declared_max"))
    return (
        documents.where(F.col("n_rows") > 0)
        .groupBy("dataset")
        .agg(F.max(declared).alias("last_source_date"))
    )


def latest_object(inventory: DataFrame, suffix: str = ".json") -> DataFrame:
    """The newest path with the suffix; equal times go to the larger path. One
    row, null when nothing matches."""
    return inventory.where(F.col("path").endswith(suffix)).agg(
        F.max_by("path", F.struct("mtime", "path")).alias("path")
    )


IDENTITY = ("path", "mtime", "length")
#: A checksum of the content; where both sides have it, it must agree as well.
TAG = "tag"


def rebuild_needed(inventory: DataFrame, manifest: DataFrame) -> Column:
    """Scalar: a recorded file changed or vanished, or is recorded twice."""
    tagged = TAG in inventory.columns and TAG in manifest.columns
    recorded = manifest.groupBy("path").agg(
        F.count("*").alias("times"),
        F.max("mtime").alias("old_mtime"),
        F.max("length").alias("old_length"),
        *([F.max(TAG).alias("old_tag")] if tagged else []),
    )
    differs = (
        (F.col("times") > 1)
        | F.col("length").isNull()
        | (F.col("length") != F.col("old_length"))
        | (F.col("mtime") != F.col("old_mtime"))
    )
    if tagged:
        differs = differs | F.coalesce(F.col(TAG) != F.col("old_tag"), F.lit(False))
    compared = inventory.join(recorded, "path", "full_outer").where(F.col("times").isNotNull())
    return compared.agg(F.coalesce(F.bool_or(differs), F.lit(False)).alias("rebuild")).scalar()


def change_plan(
    inventory: DataFrame, manifest: DataFrame | None, reusable: bool = True
) -> DataFrame:
    """Files to process: (path, mtime, length, full_rebuild), with the tag if there is one.

    Without a usable manifest, or when a recorded file is no longer the same,
    every file is processed again; otherwise only the files not yet recorded.
    """
    files = inventory.select(*IDENTITY, *([TAG] if TAG in inventory.columns else []))
    if manifest is None or not reusable:
        return files.withColumn("full_rebuild", F.lit(True))
    recorded = manifest.select(F.col("path").alias("recorded_path")).distinct()
    return (
        files.join(recorded, F.col("path") == F.col("recorded_path"), "left")
        .withColumn("full_rebuild", rebuild_needed(inventory, manifest))
        .where(F.col("full_rebuild") | F.col("recorded_path").isNull())
        .drop("recorded_path")
    )


# --- merge ---------------------------------------------------------------

SEQUENCE = ("_source_rank", "_mtime", "_path", "_pos")


def with_snapshot_sequence(snapshot: DataFrame) -> DataFrame:
    """The current snapshot comes before every increment."""
    return snapshot.withColumns(
        {
            "_source_rank": F.lit(0),
            "_mtime": F.lit(None).cast("timestamp"),
            "_path": F.lit(None).cast("string"),
            "_pos": F.lit(None).cast("bigint"),
        }
    )


def with_increment_sequence(increment: DataFrame, mtime, path, pos) -> DataFrame:
    """Increments follow by file time, path and position in the document."""
    return increment.withColumns(
        {
            "_source_rank": F.lit(1),
            "_mtime": mtime,
            "_path": path,
            "_pos": pos.cast("bigint"),
        }
    )


def union_increments(snapshot: DataFrame | None, increments: Sequence[DataFrame]) -> DataFrame:
    """One lazy sequence; a rebuild passes no snapshot."""
    parts = [] if snapshot is None else [with_snapshot_sequence(snapshot)]
    parts += list(increments)
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged


def keep_last(df: DataFrame, key: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """The last row of every key in the given sequence, sequence dropped.

    An aggregate rather than a ranked window: each task first reduces its own
    rows to one per key, so a key with very many versions is never gathered.
    Nulls count as equal key values.
    """
    payload = [c for c in df.columns if c not in set(key) | set(sequence)]
    if not payload:
        return df.select(*key).distinct()
    last = F.max_by(F.struct(*payload), F.struct(*sequence)).alias("_last")
    kept = df.groupBy(*key).agg(last).select(*key, "_last.*")
    return kept.select(*[c for c in df.columns if c not in set(sequence)])


def replace_keys(snapshot: DataFrame | None, latest: DataFrame, key: Sequence[str]) -> DataFrame:
    """The snapshot without the keys of ``latest``, and ``latest``. The snapshot has one
    row per key and always loses, so it is filtered only: with a small ``latest`` it is
    neither shuffled nor sorted. Nulls count as equal key values."""
    if snapshot is None:
        return latest
    keys = latest.select(*[F.col(c).alias(f"_key_{c}") for c in key]).distinct()
    same = F.lit(True)
    for c in key:
        same = same & snapshot[c].eqNullSafe(keys[f"_key_{c}"])
    return snapshot.join(keys, same, "left_anti").unionByName(latest, allowMissingColumns=True)


def latest_rows(increments: Sequence[DataFrame], dataset: str) -> DataFrame:
    """The last row of each business key among the increments."""
    return keep_last(union_increments(None, increments), S.BUSINESS_KEYS[dataset], SEQUENCE)


def merge_snapshot(
    snapshot: DataFrame | None, increments: Sequence[DataFrame], dataset: str
) -> DataFrame:
    """Snapshot plus increments, the later row winning per business key. The reduced
    increments are handed over, so that their size decides how they meet the snapshot."""
    latest = hand_over(latest_rows(increments, dataset), f"latest-{dataset}")
    return replace_keys(snapshot, latest, S.BUSINESS_KEYS[dataset])


def raw_text(df: DataFrame) -> DataFrame:
    """Every column as the text a document would hold."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


