"""Immutable snapshots and the numbered pointer files that publish them.

A table is written to ``<root>/<table>/<run_id>`` and never changed. A commit
adds one small file, named by its version, with the location of *every* current
table; readers follow the newest one. A commit is therefore all or nothing: until
its file appears, everyone sees the previous version, and old versions stay usable.

A table may consist of parts (years): its pointer then names a location for each part,
so a run writes the parts it touches and points to the others where they are.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

from almanack.sources import versions

FIELDS = (
    "version", "table", "location", "run_id", "row_count", "fingerprint", "manifest",
    "parts", "columns", "batches", "inputs",
)
PART = "_part"


class NotPublished(LookupError):
    """No published version holds the table."""


def new_run_id() -> str:
    stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")
    return f"{stamp}-{uuid.uuid4().hex[:8]}"


def snapshot_location(root: str, table: str, run_id: str) -> str:
    return f"{root}/{table}/{run_id}"


def write_snapshot(
    df: DataFrame, root: str, table: str, run_id: str, partition_by: Sequence[str] = ()
) -> str:
    """Write to a location of its own; an existing one is never touched."""
    location = snapshot_location(root, table, run_id)
    writer = df.write.mode("errorifexists").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(location)
    return location


def part_location(location: str, part: str) -> str:
    """Where write_snapshot(..., partition_by=[PART]) puts a part."""
    return f"{location}/{PART}={part}"


def part_locations(pointer: dict, parts: Iterable[str] | None = None) -> list[str]:
    """Locations of a table's parts, of all or of those that are there of the given ones."""
    wanted = None if parts is None else set(parts)
    return [p["location"] for p in pointer["parts"] if wanted is None or p["part"] in wanted]


def read_pointer(
    spark: SparkSession, pointer: dict, schema: T.StructType | None = None, parts: Iterable[str] | None = None
) -> DataFrame:
    """The table a pointer names, or of a table in parts the given ones; only their files
    are listed. Parts written before a column was there have null in it."""
    if pointer.get("parts") is None:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(pointer["location"])
    if schema is None:
        schema = T.StructType.fromJson(json.loads(pointer["columns"]))
    locations = part_locations(pointer, parts)
    return spark.read.schema(schema).parquet(*locations) if locations else spark.createDataFrame([], schema)


def path_missing(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(error.getCondition())


def current_version(spark: SparkSession, root: str, store: versions.Store | None = None) -> int:
    return versions.newest(spark, f"{root}/_log", store)


def current_tables(
    spark: SparkSession, root: str, version: int | None = None, store: versions.Store | None = None
) -> dict[str, dict]:
    """table -> pointer of the newest (or the given) version: one row per table."""
    version = current_version(spark, root, store) if version is None else version
    return {row["table"]: row for row in versions.rows_of(spark, f"{root}/_log", version, store)}


def _pointer(values: dict, version: int) -> dict:
    return {field: values.get(field) for field in FIELDS} | {"version": version}


def commit(
    spark: SparkSession, root: str, pointers: Iterable[dict], store: versions.Store | None = None
) -> int:
    """Publish a version in which the given tables are switched and all others stay,
    also those that another writer has switched meanwhile."""
    switched = {p["table"]: p for p in pointers}

    def change(current: list[dict], version: int) -> list[dict]:
        merged = {p["table"]: p for p in current} | switched
        return [_pointer(p, version) for p in merged.values()]

    return versions.advance(spark, f"{root}/_log", change, store)


def restore_version(spark: SparkSession, root: str, version: int) -> int:
    """Publish an earlier state again. Tables it did not have disappear."""
    rows = list(current_tables(spark, root, version).values())
    if not rows:
        raise NotPublished(f"version {version} of {root} does not exist")
    return versions.advance(spark, f"{root}/_log", lambda _, new: [_pointer(p, new) for p in rows])


def read_snapshot(
    spark: SparkSession, root: str, table: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """The published table, or None before its first publication."""
    pointer = current_tables(spark, root).get(table)
    if pointer is None:
        return None
    return read_pointer(spark, pointer, schema)


def read_published(
    spark: SparkSession, root: str, tables: Iterable[str], schemas: dict | None = None
) -> dict[str, DataFrame]:
    """Several tables of one version; a missing one is an error."""
    pointers = current_tables(spark, root)
    missing = [t for t in tables if t not in pointers]
    if missing:
        raise NotPublished(f"not published below {root}: {missing}")
    frames = {}
    for table in tables:
        frames[table] = read_pointer(spark, pointers[table], (schemas or {}).get(table))
    return frames


class SchemaChanged(ValueError):
    """A registered table has other columns than the published one."""


def _columns_of(schema: T.StructType, by: Sequence[str]) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema if f.name not in by] + [(c, "int") for c in by]


def _registered_columns(spark: SparkSession, name: str) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in spark.table(name).schema]


def _registered(spark: SparkSession, name: str, by: Sequence[str]) -> tuple[str, dict[str, str]]:
    """Location of a registered table and of its partitions, by the partition's SQL."""

    def location(rows) -> str:
        return next(r[1] for r in rows if r[0] == "Location" and r[1])

    base = location(spark.sql(f"DESCRIBE TABLE EXTENDED `{name}`").collect())
    parts = {}
    if by:
        for (text,) in spark.sql(f"SHOW PARTITIONS `{name}`").collect():  # a row for each year
            spec = ", ".join(f"`{k}` = {v}" for k, v in (item.split("=", 1) for item in text.split("/")))
            parts[spec] = location(spark.sql(f"DESCRIBE TABLE EXTENDED `{name}` PARTITION ({spec})").collect())
    return base, parts


def _published_parts(spark: SparkSession, pointer: dict, by: Sequence[str]) -> dict[str, str]:
    """Location of each partition of a published table; one without any is an error."""
    if pointer.get("parts") is not None:
        return {f"`{by[0]}` = {p['part']}": p["location"] for p in pointer["parts"]}
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(pointer["location"])
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [(s.getPath().getName(), s.getPath().toString()) for s in fs.listStatus(folder)]
    return {f"`{by[0]}` = {n.split('=', 1)[1]}": at for n, at in names if n.startswith(f"{by[0]}=")}


def _switch(spark: SparkSession, name: str, by: Sequence[str], base: str, parts: dict[str, str]) -> None:
    """Point a registered table and its partitions to these locations. Partitions change
    first and one by one; if one cannot be changed, all are put back."""
    old_base, old = _registered(spark, name, by)
    done: list[str] = []

    def point(spec: str, at: str | None) -> None:
        if at is None:
            spark.sql(f"ALTER TABLE `{name}` DROP IF EXISTS PARTITION ({spec})")
        else:
            spark.sql(f"ALTER TABLE `{name}` ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{at}'")
            spark.sql(f"ALTER TABLE `{name}` PARTITION ({spec}) SET LOCATION '{at}'")

    try:
        for spec in [*parts, *[s for s in old if s not in parts]]:
            if old.get(spec) != parts.get(spec):
                done.append(spec)
                point(spec, parts.get(spec))
        spark.sql(f"ALTER TABLE `{name}` SET LOCATION '{base}'")
    except Exception:
        for spec in done:
            point(spec, old.get(spec))
        spark.sql(f"ALTER TABLE `{name}` SET LOCATION '{old_base}'")
        raise
    finally:
        spark.sql(f"REFRESH TABLE `{name}`")


def register_tables(
    spark: SparkSession,
    root: str,
    schemas: dict[str, T.StructType],
    prefix: str = "",
    partitions: dict[str, Sequence[str]] | None = None,
) -> list[str]:
    """Make published tables queryable by name, as external tables of the catalog with
    their declared columns and partitions; with a lasting catalog also for later
    sessions.

    A table in parts has its years as partitions, wherever each of them lies.

    Repeating the call points the names to the current snapshots by ALTER, so a name is
    there at any time; new columns at the end are added. All pointers and their files are
    looked at first: a table that was not published, whose pointer leaves the snapshot
    area or names no readable files, or whose columns have changed otherwise, is an error
    that leaves every name as it was.
    """
    pointers = current_tables(spark, root)
    planned = []
    for table, schema in schemas.items():
        pointer = pointers.get(table)
        if pointer is None:
            raise NotPublished(f"{table} must be published before it is registered")
        by = list((partitions or {}).get(table, ())) or (["year"] if pointer.get("parts") is not None else [])
        base = pointer["location"]
        if f"{root}/{table}/" not in base:
            raise ValueError(f"{table} does not point to a snapshot: {base}")
        spark.read.schema(schema).parquet(*(part_locations(pointer) if pointer.get("parts") else [base])).limit(1).count()
        parts = _published_parts(spark, pointer, by) if by else {}
        planned.append((prefix + table, _columns_of(schema, by), by, base, parts))
    for name, columns, by, _, _ in planned:
        if spark.catalog.tableExists(name):
            have = _registered_columns(spark, name)
            head = len(have) - len(by)
            if have[:head] != columns[:head] or have[head:] != columns[len(columns) - len(by) :] or len(columns) < len(have):
                raise SchemaChanged(f"{name} is registered with other columns; drop it first: {have} and {columns}")
    for name, columns, by, base, parts in planned:
        if spark.catalog.tableExists(name):
            more = columns[len(_registered_columns(spark, name)) - len(by) : len(columns) - len(by)]
            if more:
                spark.sql(f"ALTER TABLE `{name}` ADD COLUMNS ({', '.join(f'`{c}` {t}' for c, t in more)})")
            _switch(spark, name, by, base, parts)
            continue
        clause = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in by)})" if by else ""
        body = ", ".join(f"`{c}` {t}" for c, t in columns)
        spark.sql(f"CREATE TABLE `{name}` ({body}) USING parquet {clause} LOCATION '{base}'")
        try:
            if by:
                _switch(spark, name, by, base, parts)
        except Exception:
            spark.sql(f"DROP TABLE `{name}`")  # it was not there before; its files stay
            raise
    return [name for name, *_ in planned]


def result_schema(df: DataFrame) -> list[tuple[str, str]]:
    """(name, type) of a result from analysis alone; no job runs."""
    columns = [(field.name, field.dataType.simpleString()) for field in df.schema]
    if not columns:
        raise ValueError("the result has no columns")
    return columns
