"""Small DataFrame helpers the operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almanack.session import hand_over


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(name: str = "text") -> Column:
    """The text, null as the empty one."""
    return F.coalesce(F.col(name), F.lit(""))


def fold(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 4; fold 2 is held out from all learning."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4))


#: Setting, Spark's default, and what the operators ask for instead.
_BATCHES = (
    ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "1900000b"),
    ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "2000"),
)


def bounded_batches(spark: SparkSession) -> None:
    """Sends texts to Python in batches of some megabytes, so that a worker's memory is
    small beside its executor's. What a session has set itself stays."""
    for key, default, value in _BATCHES:
        if spark.conf.get(key, None) == default:
            spark.conf.set(key, value)


#: Ids that may be broadcast, some 30 MB; more are joined by shuffle.
BROADCAST_IDS = 500_000


def with_column(df: DataFrame, value: Column) -> tuple[DataFrame, str]:
    """Adds a column under a name that no other column has."""
    name = f"_{uuid.uuid4().hex[:12]}"
    return df.withColumn(name, value), name


def sampled_by(df: DataFrame, key: Column, kind: str, rows: int) -> tuple[DataFrame, DataFrame]:
    """About `rows` rows of each value of the column `kind`, picked by the hash of a key,
    the same ones in each run, and how often each value occurs (kind, _rows). A value
    with no more rows than that keeps all of them, however many rows the others have."""
    sizes = hand_over(df.groupBy(kind).agg(F.count(F.lit(1)).alias("_rows")), "sample-sizes")
    part = (F.lit(float(rows << 30)) / F.col("_rows")).cast("long")
    drawn = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30))
    picked = df.join(sizes, kind).where((F.col("_rows") <= rows) | (drawn < part))
    return picked.drop("_rows"), sizes


#: Rows that one window task numbers, on average, in `numbered`.
RANK_ROWS = 5_000


def numbered(
    df: DataFrame, by: list[str], order: list[Column], bucket: Column, name: str
) -> DataFrame:
    """Numbers each key's rows without gaps from 0, no key in one task.

    `bucket` is a number in 0 .. buckets(count) - 1 that rises with the wanted order
    (or a hash, where any order will do); the rows of one key and bucket are numbered
    by `order` in one window, and begin where the key's earlier buckets end.
    """
    df = df.withColumn("_bucket", bucket.cast("long"))
    keys = [*by, "_bucket"]
    spec = ", ".join(f"`{k}`" for k in by)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    before = F.expr(
        f"sum(_size) over (partition by {spec} order by _bucket rows between unbounded preceding and current row) - _size"
    )
    starts = sizes.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], before.alias("_before"))
    # One column for key and bucket: a frame that lies by key alone is dealt out anew.
    window = Window.partitionBy(F.struct(*keys)).orderBy(*order)
    own = df.withColumn("_own", F.row_number().over(window).cast("long") - 1)
    match = [own[k].eqNullSafe(starts[f"_k{i}"]) for i, k in enumerate(keys)]
    condition = match[0]
    for m in match[1:]:
        condition = condition & m
    out = own.join(starts, condition, "left")
    return out.select(*[F.col(c) for c in df.columns if c != "_bucket"], (F.col("_own") + F.col("_before")).alias(name))


def numbered_alike(df: DataFrame, by: list[str], purpose: str, name: str) -> DataFrame:
    """Numbers each key's rows from 0, whichever comes first, also rows that nothing tells
    apart: they are dealt out by chance and written before they are numbered, so that a
    task which runs again sees the same."""
    drawn = hand_over(df.withColumn("_lot", F.rand(1)), purpose)
    lots = buckets(drawn.count())
    return numbered(drawn, by, [F.col("_lot")], F.floor(F.col("_lot") * lots), name).drop("_lot")


def buckets(count: int) -> int:
    return max(1, -(-count // RANK_ROWS))

