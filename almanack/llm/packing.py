"""Packing documents into windows of fixed length by best-fit decreasing.

Each document becomes its token ids and an end id. Overlong documents are first cut
into full windows, the rest is a piece of its own. Best fit decreasing then places
pieces from long to short, each into the open window with the least room that is
enough. Pieces of one length are interchangeable, and so are windows with the same
room, so the whole corpus is planned from the histogram of lengths (as many numbers
as a window has tokens, whatever the corpus): the plan maps "the a-th to b-th piece
of length L" to a run of windows. A segment tree indexed by remaining room finds the
tightest open windows. Spark numbers the pieces of each length and looks the plan up.

Defined cases: a null text is empty and consists of the end id alone; repeated rows
are packed each; pieces that differ in nothing are interchangeable; an empty table
gives no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import os
import zlib
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanack.llm import text as X
from almanack.llm.tables import bounded_batches, buckets, numbered
from almanack.session import hand_over

CAPACITY = 2048
END_ID = 1
#: Text whose words are looked up together: more than elsewhere, since new ones are sorted in.
SLICE_BYTES = 500_000
#: Plan rows that may be broadcast (48 bytes each).
PLAN_BROADCAST = 100_000
PLAN = ("_length", "_first", "_last", "_window", "_each", "_offset")
PIECES = "doc_tokens bigint, crcs array<bigint>"


@lru_cache(maxsize=2)
def _words(path: str) -> X.Remembered:
    """Ids of words. White space separates words for this tokenizer and is dropped, so
    the ids of a text are those of its words in turn."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return X.Remembered(lambda words: [e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)])


def token_pieces(text: Column, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> Column:
    """Number of tokens and the crc32 of the ids of each window-sized piece."""

    @F.arrow_udf(PIECES)
    def pieces(column: pa.Array) -> pa.Array:
        words, counts, crcs, sizes = _words(tokenizer), [], [], []
        for texts in X.slices(column, SLICE_BYTES):
            starts, stops, first = texts.runs(X.SPACE[texts.data])
            ids, per_word = words.of(texts, starts, stops)
            lengths = np.diff(np.concatenate(([0], np.cumsum(per_word)))[first])
            ends = np.cumsum(lengths + 1)
            whole = np.full(len(ids) + texts.n, end_id, "<u4")
            inner = np.ones(len(whole), bool)
            inner[ends - 1] = False
            whole[inner] = ids
            raw = memoryview(whole).cast("B")
            for end, length in zip(ends.tolist(), (lengths + 1).tolist()):
                cuts = range(end - length, end, capacity)
                crcs += [zlib.crc32(raw[4 * a : 4 * min(a + capacity, end)]) for a in cuts]
                sizes.append(len(cuts))
            counts.append(lengths + 1)
        total = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(crcs, pa.int64()))
        return pa.StructArray.from_arrays([pa.array(total, pa.int64()), lists], ["doc_tokens", "crcs"])

    return pieces(text)


class Room:
    """Segment tree over remaining room: which rooms some open window has."""

    def __init__(self, capacity: int):
        self.leaves = 1 << (capacity + 1).bit_length()
        self.any = bytearray(2 * self.leaves)

    def mark(self, room: int, present: bool) -> None:
        i = room + self.leaves
        self.any[i] = present
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] | self.any[2 * i + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest room of at least `least` that some window has."""
        i = least + self.leaves
        if self.any[i]:
            return least
        while i > 1:
            if not i & 1 and self.any[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i + (not self.any[2 * i])
                return i - self.leaves
            i //= 2
        return None


@dataclass
class Plan:
    """Best-fit decreasing over a histogram {length: pieces}.

    A row (length, first, last, window, each, offset): pieces first .. last - 1 of
    that length go to windows from `window` on, `each` in a window, one behind
    another from `offset`.
    """

    capacity: int
    windows: int = 0
    rows: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)

    def place(self, histogram: dict[int, int]) -> Plan:
        room, open_runs = Room(self.capacity), {}  # room -> [(first window, windows)]
        for length in sorted(histogram, reverse=True):
            placed, count = 0, histogram[length]
            while placed < count:
                left = room.tightest(length)
                if left is None:
                    left, each = self.capacity, self.capacity // length
                    begin, had = self.windows, -(-(count - placed) // each)
                    self.windows += had
                else:
                    each = left // length
                    begin, had = open_runs[left].pop()
                    if not open_runs[left]:
                        room.mark(left, False)
                used = min(had, -(-(count - placed) // each))
                put = min(count - placed, used * each)
                self.rows.append((length, placed, placed + put, begin, each, self.capacity - left))
                short = used * each - put  # pieces that the last window lacks
                full = used - (short > 0)
                for rest, first, n in (
                    (left, begin + used, had - used),
                    (left - each * length, begin, full),
                    (left - (each - short) * length, begin + full, used - full),
                ):
                    if n and rest:
                        open_runs.setdefault(rest, []).append((first, n))
                        room.mark(rest, True)
                placed += put
        return self

    def table(self) -> pa.Table:
        """The rows as an Arrow table, which becomes a frame without any Python worker (a
        list of rows starts a second kind of them beside those that hold the words)."""
        columns = np.array(self.rows, np.int64).reshape(-1, len(PLAN)).T
        return pa.table({name: pa.array(column) for name, column in zip(PLAN, columns)})


def packed(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    doc_id: str = "doc_id",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    bounded_batches(spark)
    whole = docs.select(F.col(doc_id).alias("doc_id"), token_pieces(F.col(text), tokenizer, capacity, end_id).alias("p"))
    start = F.col("k").cast("long") * capacity
    cut = whole.select("doc_id", F.col("p.doc_tokens").alias("doc_tokens"), F.posexplode("p.crcs").alias("k", "ids_crc32"))
    pieces = cut.select(
        "doc_id",
        start.alias("start"),
        F.least(F.lit(capacity).cast("long"), F.col("doc_tokens") - start).alias("length"),
        "ids_crc32",
        "doc_tokens",
    )
    # Written with a number, by which pieces are dealt out also where ids are null or repeat.
    pieces = hand_over(pieces.withColumn("_piece", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    plan = Plan(capacity).place(histogram)
    count = sum(histogram.values())
    bucket = F.pmod(F.xxhash64("_piece"), F.lit(buckets(count)))
    ranked = numbered(pieces, ["length"], [F.col("_piece")], bucket, "_rank")
    runs = spark.createDataFrame(plan.table())
    if len(plan.rows) <= PLAN_BROADCAST:
        runs = F.broadcast(runs)
    place = ranked.join(
        runs,
        (ranked["length"] == runs["_length"]) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_last")),
    )
    at = F.col("_rank") - F.col("_first")
    return place.select(
        *[c for c in pieces.columns if c != "_piece"],
        (F.col("_window") + (at - at % F.col("_each")) / F.col("_each")).cast("long").alias("sequence_id"),
        (F.col("_offset") + at % F.col("_each") * F.col("length")).alias("offset"),
    )
