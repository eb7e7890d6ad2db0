"""Raw documents to the merged, checked silver snapshot of a dataset.

A snapshot consists of years, and its pointer names a location for each. A run reduces
the new documents to the last row of each key, reads the years that these rows are in,
writes those anew and points to all others where they are: the history is neither read
nor written, checked or listed again beyond the years an increment touches.

The manifest says which documents a snapshot is made of, with a checksum of their
content, and which files each year has. It is a list of small tables, to which a run
adds one; a rebuild, or a long list, begins it anew.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from almanack import schemas as S
from almanack.operators import cleaning, increments, quality
from almanack.session import hand_over
from almanack.sources import bronze, lookups, tables

MANIFEST_VERSION = 2
#: Tables of a manifest; a longer list is written as one.
MANIFESTS = 40
_ENTRY = (
    "kind string, version int, dataset string, path string, mtime timestamp, length bigint, "
    "tag string, location string"
)
#: Whether the content of recorded documents is compared too, or only what a listing tells.
VERIFY_CONTENT = True


def snapshot_inventory(spark: SparkSession, locations: list[str]) -> DataFrame:
    """(path, mtime, length, location) of the stored files below the locations."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(locations)
    return files.select(
        "path", F.col("modificationTime").alias("mtime"), "length",
        F.regexp_extract("path", "^(.*)/[^/]+$", 1).alias("location"),
    )


def _entries(kind: str, dataset: str, files: DataFrame) -> DataFrame:
    absent = {c: F.lit(None).cast("string") for c in ("tag", "location") if c not in files.columns}
    return files.withColumns(absent).select(
        F.lit(kind).alias("kind"),
        F.lit(MANIFEST_VERSION).alias("version"),
        F.lit(dataset).alias("dataset"),
        "path", "mtime", "length", "tag", "location",
    )


def write_manifest(
    spark: SparkSession, root: str, dataset: str, run_id: str, documents: DataFrame, locations: list[str]
) -> str:
    """Record documents that a snapshot is made of, and the files of its new years."""
    target = f"{root}/_manifest/{dataset}/{run_id}"
    both = _entries("bronze", dataset, documents)
    if locations:
        both = both.unionByName(_entries("snapshot", dataset, snapshot_inventory(spark, locations)))
    both.write.mode("errorifexists").parquet(target)
    return target


def read_manifest(spark: SparkSession, paths: list[str] | None) -> DataFrame | None:
    if not paths:
        return None
    try:
        return spark.read.schema(_ENTRY).parquet(*paths)
    except AnalysisException as error:
        if tables.path_missing(error):
            return None
        raise


def _in_folder(locations: list[str]) -> Column:
    """Whether a file's folder is one of these; stores write their scheme in front."""
    plain = F.regexp_replace("location", "^[a-z0-9+.-]+:/*", "/")
    return plain.isin([f"/{at.split(':', 1)[-1].lstrip('/')}" for at in locations])


def manifest_usable(spark: SparkSession, manifest: DataFrame, dataset: str, pointer: dict) -> bool:
    """Right version and dataset, and the files of all years are still the ones
    the manifest was written for."""
    locations = tables.part_locations(pointer) if pointer.get("parts") is not None else []
    header = manifest.agg(
        F.count_if((F.col("version") != MANIFEST_VERSION) | (F.col("dataset") != dataset)).alias("foreign")
    ).first()
    if header["foreign"] or not locations:
        return False
    recorded = manifest.where(F.col("kind") == "snapshot").where(_in_folder(locations))
    try:
        live = snapshot_inventory(spark, locations).select(*increments.IDENTITY)
        both = live.withColumn("side", F.lit(1)).unionByName(
            recorded.select(*increments.IDENTITY).withColumn("side", F.lit(2))
        )
        unmatched = both.groupBy(*increments.IDENTITY).agg(F.sum("side").alias("sides"))
        return unmatched.where(F.col("sides") != 3).isEmpty()
    except AnalysisException as error:
        if tables.path_missing(error):
            return False
        raise


def cleaned_increment(documents: DataFrame, dataset: str, project_start: str = S.PROJECT_START) -> DataFrame:
    """Typed rows of the documents with their place in the load sequence; fields that no
    schema knows stay in a map."""
    rows = bronze.unfolded(documents, dataset)
    placed = increments.with_increment_sequence(rows, F.col("mtime"), F.col("path"), F.col("pos"))
    return cleaning.clean(placed.drop("mtime", "path", "pos"), dataset, project_start)


def _year(date: str = "date") -> Column:
    """The part a row is in; rows without a date are kept apart and fail the checks."""
    return F.coalesce(F.year(date).cast("string"), F.lit("none"))


def publish_increment(
    spark: SparkSession,
    silver_root: str,
    dataset: str,
    documents: DataFrame,
    recorded: DataFrame,
    pointer: dict | None,
    expected: DataFrame | None = None,
    project_start: str = S.PROJECT_START,
    batch: dict | None = None,
) -> dict:
    """Merge documents into the snapshot of a pointer (None: they are all there is) and
    publish it with a manifest that records them (`recorded`: path, mtime, length, tag).

    Written once, checked as written, and only then made visible: a failed check leaves
    snapshot and manifest as they were."""
    key = S.BUSINESS_KEYS[dataset]
    seen = Observation()
    cleaned = cleaned_increment(documents, dataset, project_start)
    cleaned = cleaned.observe(seen, bronze.rest_names().alias("names"))
    latest = hand_over(increments.latest_rows([cleaned], dataset), f"latest-{dataset}")
    latest = bronze.widened(latest, sorted({name for names in seen.get["names"] for name in names}))
    touched = sorted(r[0] for r in latest.select(_year()).distinct().collect())  # some tens of years
    kept = [p for p in (pointer or {}).get("parts") or [] if p["part"] not in touched]
    snapshot = None if pointer is None else tables.read_pointer(spark, pointer, parts=touched)
    merged = increments.replace_keys(snapshot, latest, key).withColumn(tables.PART, _year())

    run_id = tables.new_run_id()
    counted = Observation()
    ordered = merged.hint("rebalance", F.col(tables.PART)).sortWithinPartitions(tables.PART, *key)
    ordered = ordered.observe(counted, *quality.null_metrics(merged, quality.required_columns(dataset)))
    location = tables.write_snapshot(ordered, silver_root, dataset, run_id, [tables.PART])
    new = {part: tables.part_location(location, part) for part in touched}
    schema = merged.drop(tables.PART).schema
    written = spark.read.schema(merged.schema).parquet(location)
    if expected is None:
        scope = lookups.country_scope(spark).where(F.col("dataset") == dataset)
        expected = scope.select("entity_code")
    report, by_part = quality.written_report(written, dataset, expected, counted.get, tables.PART)
    quality.raise_if_failed(report, f"silver {dataset}")
    rows = {str(r[0]): r["rows"] for r in by_part.collect()}
    parts = kept + [{"part": p, "location": new[p], "rows": rows[p]} for p in touched if p in rows]
    row_count = sum(p["rows"] for p in parts)

    files = [new[p] for p in touched if p in rows]
    older = list((pointer or {}).get("manifest") or [])
    if len(older) >= MANIFESTS:
        before = read_manifest(spark, older)
        recorded = recorded.unionByName(
            before.where("kind = 'bronze'").select(*recorded.columns), allowMissingColumns=True
        )
        older, files = [], [p["location"] for p in parts]
    manifest = [*older, write_manifest(spark, silver_root, dataset, run_id, recorded, files)]
    batches = {**((pointer or {}).get("batches") or {}), **(batch or {})}
    tables.commit(
        spark,
        silver_root,
        [
            {
                "table": dataset,
                "location": location,
                "run_id": run_id,
                "row_count": row_count,
                "manifest": manifest,
                "parts": sorted(parts, key=lambda p: p["part"]),
                "columns": schema.json(),
                "batches": batches,
            }
        ],
    )
    return {"dataset": dataset, "changed": True, "rows": row_count, "location": location, "years": touched}


def _pending_documents(spark: SparkSession, root: str, dataset: str, pending: DataFrame) -> DataFrame:
    """The pending documents: the folders of their loads are read, and of these the files
    that are pending. No file name comes to the driver, only those of new loads."""
    folder = F.regexp_extract("path", "^(.*)/[^/]+$", 1)
    folders = [r[0] for r in pending.select(folder).distinct().collect()]
    files = pending.select(F.col("path").alias("_pending"))
    documents = bronze.read_documents(spark, [_decoded(f) for f in folders])
    return documents.join(files, F.col("path") == F.col("_pending"), "left_semi")


def _decoded(uri: str) -> str:
    return uri.replace("%20", " ") if "%" in uri else uri


def update_silver(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    dataset: str,
    expected: DataFrame | None = None,
    project_start: str = S.PROJECT_START,
    verify_content: bool = VERIFY_CONTENT,
    batch: dict | None = None,
) -> dict:
    """Merge new documents into the snapshot, or rebuild it when the recorded
    history no longer holds. Nothing is published unless the merged state
    passes its checks; the manifest is published together with the snapshot.

    With `verify_content` the recorded documents' checksums are taken anew and compared
    (a scan of their text without parsing); without it, path, time and length decide."""
    S.require_dataset(dataset)
    inventory = bronze.bronze_inventory(spark, bronze_root, dataset)
    pointer = tables.current_tables(spark, silver_root).get(dataset)
    manifest = read_manifest(spark, pointer["manifest"]) if pointer else None
    reusable = manifest is not None and manifest_usable(spark, manifest, dataset, pointer)
    recorded = None if manifest is None else manifest.where(F.col("kind") == "bronze")
    source = bronze.dataset_path(bronze_root, dataset)
    if verify_content:
        inventory = inventory.join(bronze.content_tags(spark, source), "path", "left")
    inventory = hand_over(inventory, f"inventory-{dataset}")

    pending = hand_over(increments.change_plan(inventory, recorded, reusable), f"pending-{dataset}")
    found = pending.agg(F.count("*").alias("files"), F.bool_or("full_rebuild").alias("all")).first()
    if not found["files"]:
        return {"dataset": dataset, "changed": False, "location": pointer["location"]}
    rebuild = found["all"]
    if rebuild:
        documents = bronze.read_documents(spark, source)
        kept = pointer and {"batches": pointer.get("batches")}
        batch = {**((kept or {}).get("batches") or {}), **(batch or {})}
    else:
        documents = _pending_documents(spark, bronze_root, dataset, pending)
    done = publish_increment(
        spark, silver_root, dataset, documents, pending.drop("full_rebuild"),
        None if rebuild else pointer, expected, project_start, batch,
    )
    return done | {"full_rebuild": rebuild, "documents": found["files"]}


def update_all(spark: SparkSession, bronze_root: str, silver_root: str, **options) -> list[dict]:
    return [update_silver(spark, bronze_root, silver_root, d, **options) for d in S.DATASETS]


def load_silver(spark: SparkSession, silver_root: str) -> dict[str, DataFrame]:
    """The five published datasets; a missing one is an error."""
    return tables.read_published(spark, silver_root, S.DATASETS)
