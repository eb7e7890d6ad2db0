"""The silver merge driven by a file stream instead of a schedule.

A micro-batch holds the documents themselves, with their paths, times and sizes, so the
merge needs no listing of the folder. The version that a batch publishes also says which
batch of which stream it was; a batch that is repeated after a failure finds itself
there and changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from almanack import schemas as S
from almanack.plans.silver import manifest_usable, publish_increment, read_manifest, update_silver
from almanack.session import hand_over
from almanack.sources import bronze, tables


def document_stream(spark: SparkSession, bronze_root: str, dataset: str) -> DataFrame:
    """New documents as they arrive, with the path, time and size of their files."""
    stream = (
        spark.readStream.schema(bronze.DOCUMENT)
        .option("mode", "FAILFAST")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .json(bronze.dataset_path(bronze_root, dataset))
    )
    return stream.select(*bronze.document_columns(), F.col("_metadata.file_size").alias("length"))


def merge_batch(
    spark: SparkSession,
    batch: DataFrame,
    number: int,
    stream: str,
    bronze_root: str,
    silver_root: str,
    dataset: str,
    expected: DataFrame | None = None,
    project_start: str = S.PROJECT_START,
) -> dict:
    """Merge one micro-batch (rows of `document_stream`). Documents that are recorded
    already (an earlier batch job may have met them) are left out; where the snapshot or its
    manifest cannot be built upon, the whole folder is merged anew."""
    pointer = tables.current_tables(spark, silver_root).get(dataset)
    if pointer and (pointer.get("batches") or {}).get(stream, -1) >= number:
        return {"dataset": dataset, "changed": False, "location": pointer["location"]}
    ledger = {stream: number}
    manifest = read_manifest(spark, pointer["manifest"]) if pointer else None
    if pointer and (manifest is None or not manifest_usable(spark, manifest, dataset, pointer)):
        return update_silver(spark, bronze_root, silver_root, dataset, expected, project_start, batch=ledger)
    documents = batch
    if manifest is not None:
        known = manifest.where("kind = 'bronze'").select("path", F.col("mtime"), "length")
        documents = batch.join(known, ["path", "mtime", "length"], "left_anti")
    files = hand_over(documents.groupBy("path", "mtime", "length").agg(F.count("*").alias("n")), f"batch-{dataset}")
    if files.isEmpty():
        return {"dataset": dataset, "changed": False, "location": pointer["location"] if pointer else None}
    changed = manifest is not None and not files.join(known.select("path"), "path", "left_semi").isEmpty()
    if changed:  # a recorded document was written anew
        return update_silver(spark, bronze_root, silver_root, dataset, expected, project_start, batch=ledger)
    recorded = files.select("path", "mtime", "length")
    return publish_increment(
        spark, silver_root, dataset, documents, recorded, pointer, expected, project_start, ledger
    )


def run_available(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    dataset: str,
    checkpoint: str,
    expected: DataFrame | None = None,
    project_start: str = S.PROJECT_START,
) -> None:
    """Process everything that has arrived and stop. The checkpoint names the stream."""

    def merge(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            merge_batch(
                batch.sparkSession, batch, number, checkpoint, bronze_root, silver_root, dataset, expected, project_start
            )

    query = (
        document_stream(spark, bronze_root, dataset)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
