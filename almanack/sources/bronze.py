"""Raw documents: append-only JSON, one ``{"data": [...], "stats": {...}}`` per line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from almanack import schemas as S
from almanack.session import hand_over

# Rows are read as name -> text, so an absent field and a null stay different
# and nothing is converted before the strict casts.
DOCUMENT = (
    "data array<map<string,string>>, "
    "stats struct<query_value_range: struct<date: struct<max: string>>>"
)
ROWS_PER_DOCUMENT = 20_000

# Columns that every load has, null where its documents do not hold them.
OPTIONAL_COLUMNS = {
    "demand": ("is_aggregate_entity",),
    "carbon_intensity": ("is_aggregate_entity",),
}


def dataset_path(root: str, dataset: str) -> str:
    return f"{root}/{S.require_dataset(dataset)}"


def bronze_inventory(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """(path, mtime, length) of the dataset's documents, in load order. The file
    content is never read. No document at all is an error."""
    try:
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.json")
            .option("recursiveFileLookup", True)
            .load(dataset_path(root, dataset))
        )
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error.getCondition()):
            raise FileNotFoundError(f"no documents for {dataset!r}") from error
        raise
    listed = files.select(
        F.col("_metadata.file_path").alias("path"), F.col("modificationTime").alias("mtime"), "length"
    )
    if listed.isEmpty():
        raise FileNotFoundError(f"no documents for {dataset!r}")
    return listed.orderBy("mtime", "path")


def content_tags(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, tag) of each file: a checksum of its lines, in any order of theirs. Files
    are read in splits; only a few numbers of each are shuffled. An empty file has no row."""
    source = [paths] if isinstance(paths, str) else list(paths)
    lines = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(source)
    ).select(F.col("_metadata.file_path").alias("path"), "value")
    hashed = [F.xxhash64("value", F.lit(seed)).cast("decimal(38,0)") for seed in (1, 2)]
    sums = lines.groupBy("path").agg(F.count("*").alias("n"), *[F.sum(h).alias(f"s{i}") for i, h in enumerate(hashed)])
    return sums.select("path", F.concat_ws(":", F.col("n"), F.col("s0"), F.col("s1")).alias("tag"))


def read_documents(
    spark: SparkSession, paths: str | Sequence[str], multi_line: bool = False
) -> DataFrame:
    """(data, declared_max, path, mtime) per document. Malformed JSON and a
    document without ``data`` fail the read. ``multi_line`` is for documents
    spread over several lines, which Spark cannot split."""
    source = [paths] if isinstance(paths, str) else list(paths)
    documents = (
        spark.read.schema(DOCUMENT)
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .json(source)
    )
    return documents.select(*document_columns())


def document_columns() -> list[Column]:
    """(data, declared_max, path, mtime) of documents as read by any source of files."""
    data = F.when(
        F.col("data").isNull(),
        F.raise_error(F.concat(F.lit("document without data: "), F.col("_metadata.file_path"))).cast(
            "array<map<string,string>>"
        ),
    ).otherwise(F.col("data"))
    return [
        data.alias("data"),
        F.col("stats.query_value_range.date.max").alias("declared_max"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("mtime"),
    ]


def required_fields(dataset: str) -> list[str]:
    fields = [*S.COMMON_COLUMNS, *S.MEASURES[dataset], *S.FLAGS.get(dataset, ())]
    return fields + (["series"] if "series" in S.BUSINESS_KEYS[dataset] else [])


def known_fields(dataset: str) -> list[str]:
    return [*required_fields(dataset), *OPTIONAL_COLUMNS.get(dataset, ())]


def _has_field(name: str):
    return lambda row: F.map_contains_key(row, name)


#: The fields of a row beyond the known ones, as name -> text.
REST = "_rest"


def unfolded(documents: DataFrame, dataset: str) -> DataFrame:
    """One text row per element of ``data``: the known fields, the others in the map REST,
    and path, mtime and position.

    A field counts as present in a document when any of its rows has it; the
    check runs per document, before the rows are unfolded.
    """
    S.require_dataset(dataset)
    data, names = F.col("data"), known_fields(dataset)
    absent = F.array_compact(
        F.array(
            *[
                F.when(~F.exists(data, _has_field(name)), F.lit(name))
                for name in required_fields(dataset)
            ]
        )
    )
    message = F.concat(F.lit("missing "), F.array_join(absent, ", "), F.lit(" in "), F.col("path"))
    checked = F.when(
        F.size(absent) > 0, F.raise_error(message).cast("array<map<string,string>>")
    ).otherwise(data)
    rows = documents.select("path", "mtime", F.posexplode(checked).alias("pos", "row"))
    rest = F.map_filter(F.coalesce("row", F.create_map().cast("map<string,string>")), lambda k, _: ~k.isin(names))
    return rows.select(
        *[F.try_element_at("row", F.lit(name)).alias(name) for name in names],
        rest.alias(REST),
        "path",
        "mtime",
        "pos",
    )


def rest_names() -> Column:
    """Aggregate: the names in REST, as a few sorted lists of names."""
    return F.collect_set(F.array_sort(F.map_keys(REST)))


def widened(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """A column for each of the names in REST, which goes."""
    more = [F.try_element_at(REST, F.lit(name)).alias(name) for name in names]
    at = df.columns.index(REST)
    return df.select(*df.columns[:at], *more, *df.columns[at + 1 :])


def document_rows(documents: DataFrame, dataset: str) -> DataFrame:
    """As `unfolded`, with a column for every field that the documents have. They are
    parsed once: the rows are handed over, and the names come from what was written."""
    seen = Observation()
    rows = hand_over(unfolded(documents, dataset).observe(seen, rest_names().alias("names")), f"rows-{dataset}")
    return widened(rows, sorted({name for names in seen.get["names"] for name in names}))


def to_documents(
    df: DataFrame, rows_per_document: int = ROWS_PER_DOCUMENT, declared_max: str | None = None
) -> DataFrame:
    """Rows packed into documents of bounded size.

    Equal rows are counted first and numbered afterwards, so that even a row
    repeated endlessly is spread over documents, and no task sees a whole group.
    ``declared_max`` is the newest date the source states for the whole load.
    """
    columns = df.columns
    counted = df.groupBy(*columns).agg(F.count("*").alias("_copies"))
    total = F.lit(max(1, -(-df.count() // rows_per_document)))
    block = F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / rows_per_document))
    )
    in_block = F.least(
        F.lit(rows_per_document).cast("bigint"),
        F.col("_copies") - F.col("_block") * rows_per_document,
    )
    numbered = (
        counted.withColumn("_block", block)
        .withColumn("_bucket", F.pmod(F.xxhash64(*columns, "_block"), total))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), in_block)))
    )
    newest = F.max(F.col("date").cast("string")) if declared_max is None else F.lit(declared_max)
    packed = numbered.groupBy("_bucket").agg(
        F.collect_list(F.struct(*columns)).alias("data"), newest.alias("newest")
    )
    stats = F.struct(
        F.struct(F.struct(F.col("newest").alias("max")).alias("date")).alias("query_value_range")
    )
    return packed.select("data", stats.alias("stats"))


def append_documents(
    documents: DataFrame, root: str, dataset: str, ingestion_date: str, stamp: str
) -> str:
    """Store the documents below ``ingestion_date=...``; an existing load is
    never replaced."""
    target = f"{dataset_path(root, dataset)}/ingestion_date={ingestion_date}/{dataset}_{stamp}"
    documents.write.mode("errorifexists").option("ignoreNullFields", False).json(target)
    return target
