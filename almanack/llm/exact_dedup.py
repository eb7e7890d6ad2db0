"""Exact duplicates by 128-bit content hash, with the bytes compared.

Documents are grouped by a 128-bit hash of their text without white space; only hash,
length and id are shuffled. Texts travel for hashes that occur twice or more, to have
their bytes compared through the smallest and the largest of a group: both are equal
only if all are. All aggregates combine on the map side, so a group of any size reaches
a reducer as one row for each map task and distinct id. Groups whose bytes differ (a
collision) are split by the text itself.

Defined cases: a null text counts as empty; empty texts are equal to each other. Of
equal texts exactly one row stays: the one with the most code points in the original,
then the smallest id (null ids come last), and of rows that are alike in both any one,
picked by a row number. group_size counts rows. All columns are kept. An empty table
gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanack.llm.tables import BROADCAST_IDS, numbered_alike, text_of
from almanack.session import hand_over

WHITE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, WHITE, "")


def hash128(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _groups(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of each group of two rows or more: size, best length and id, and how many rows have both."""
    alike = rows.groupBy(*keys, "_points", "_id").agg(F.count(F.lit(1)).alias("_rows"))
    best = F.min(F.struct((-F.col("_points")).alias("less"), F.col("_id").isNull().alias("none"), "_id", "_rows"))
    groups = alike.groupBy(*keys).agg(F.sum("_rows").alias("_size"), best.alias("_best"))
    return groups.where(F.col("_size") > 1)


def _few(table: DataFrame) -> DataFrame:
    """Broadcast if it has few rows (of some 60 bytes); else texts move to it."""
    return F.broadcast(table) if table.count() <= BROADCAST_IDS else table


def grouped(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    content_hash: Callable[[Column], Column] = hash128,
) -> tuple[DataFrame, str]:
    """The documents with a struct column (keep_id, group_size, kept, text_sha256);
    second, that column's name, which no other column has."""
    name = f"_{uuid.uuid4().hex[:12]}"
    norm = normalised(text_of(text))
    rows = docs.select(
        F.col(doc_id).alias("_id"), F.char_length(text_of(text)).alias("_points"), norm.alias("_norm")
    ).withColumn("_hash", content_hash(F.col("_norm")))
    groups = hand_over(_groups(rows.drop("_norm"), ["_hash"]), "exact-groups")
    held = _few(groups.select("_hash"))
    texts = rows.join(held, "_hash", "left_semi").groupBy("_hash")
    texts = texts.agg(F.min("_norm").alias("low"), F.max("_norm").alias("high"))
    split = hand_over(texts.where(F.col("low") != F.col("high")).select("_hash"), "exact-split")

    own = F.struct(F.struct(*docs.columns).alias("doc"), F.col(doc_id).alias("_id"), F.char_length(text_of(text)).alias("_points"))
    keyed = docs.select(own.alias("own"), norm.alias("_norm")).withColumn("_hash", content_hash(F.col("_norm")))
    keyed = keyed.withColumn("_sha", F.sha2(F.col("_norm").cast("binary"), 256))
    if split.isEmpty():
        found = keyed.drop("_norm").join(_few(groups), "_hash", "left")
    else:
        plain = keyed.join(split, "_hash", "left_anti").drop("_norm").join(groups, "_hash", "left")
        apart = _groups(rows.join(split, "_hash", "left_semi"), ["_hash", "_norm"])
        found = keyed.join(split, "_hash", "left_semi").join(apart, ["_hash", "_norm"], "left").drop("_norm")
        found = plain.unionByName(found)
    alone = F.col("_best").isNull()
    best = F.col("own._points") == -F.col("_best.less")
    best = best & F.col("own._id").eqNullSafe(F.col("_best._id"))
    found = found.select(
        F.col("own.doc").alias("doc"),
        "_sha",
        F.when(alone, F.col("own._id")).otherwise(F.col("_best._id")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | best).alias("kept"),
        (~alone & best & (F.col("_best._rows") > 1)).alias("tied"),
    )
    tied = groups.where(F.col("_best._rows") > 1)
    if not (tied.isEmpty() and split.isEmpty()):
        first = numbered_alike(found.where("tied"), ["_sha"], "exact-tied", "_number")
        first = first.withColumn("kept", F.col("_number") == 0).drop("_number")
        found = found.where("NOT tied").unionByName(first)
    verdict = F.struct("keep_id", "group_size", "kept", F.col("_sha").alias("text_sha256")).alias(name)
    return found.select(*[F.col("doc")[c].alias(c) for c in docs.columns], verdict), name


def deduplicate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents that stay, with their own columns: one row of each text."""
    found, name = grouped(docs, text, doc_id)
    return found.where(F.col(name)["kept"]).drop(name)
