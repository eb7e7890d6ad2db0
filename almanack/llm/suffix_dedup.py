"""Repeated passages, cut by a hash-compared sort of suffixes.

A byte goes if a string of `LENGTH` bytes that covers it also starts earlier (in a
document with a smaller id, or earlier in the same one). Every such string is the
beginning of a suffix, so equal strings are neighbours once suffixes are sorted.

* **Copies.** Of documents with equal texts (by 128-bit hash, with the bytes compared) all
  but the first are repeated whole and take no further part.
* **Anchors.** The string at each position (a window) has an anchor: of the `ANCHOR`
  bytes long strings inside it the one with the smallest hash, the first of several.
  Equal windows have equal anchors at the same place, so only windows that share an
  anchor need to be sorted together. Neighbouring windows mostly share theirs; they
  travel as one piece of text. Windows whose anchor occurs once in the corpus are
  unique and do not travel at all.
* **Sort.** Inside a group the suffixes that have the anchor at the same place are
  sorted by mergesort. Two of them are compared by their common extension, which a
  binary search finds with prefix polynomial hashes, and by the byte behind it. The
  order of all neighbours is then checked on the bytes themselves; where a hash
  collision has spoilt it, those suffixes are sorted by their bytes. Of equal windows
  all but the first are repeated.
* **Hot anchors** (a passage that very many documents share) are dealt out by place
  in chunks of bounded size. What is first in its chunk goes on as single windows,
  grouped by content, so that a second sort sees each window once per chunk.

Between the steps travel counts of anchors, places, the pieces whose anchors recur and
the resulting spans; whole texts only where the spans are too many to be broadcast
(they are counted first).

Defined cases: a null text is empty; texts shorter than LENGTH lose nothing. Rows
without an id come after all others. Rows that share an id are documents of their own,
in the order of a hash of their text; of rows that repeat id and text one is judged
like a single row, and the others repeat it whole. Ids of any type that has an order.
All columns stay. An empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanack.llm import text as X
from almanack.llm.tables import BROADCAST_IDS, bounded_batches, numbered_alike, text_of
from almanack.session import hand_over

LENGTH, ANCHOR = 100, 32
#: Pieces that one group sorts on average, and beyond which an anchor is dealt out.
GROUP, CHUNK = 4_000, 2_000
#: Bytes of spans that may be broadcast (100 for each document that has some, 8 for each
#: span); more meet the texts by shuffle.
BROADCAST_BYTES = 48_000_000
#: Bytes of text whose windows are looked at together; some 100 bytes of memory for each.
BLOCK = 1 << 17
#: Rows of LENGTH or so numbers that are looked at together, some megabytes.
LOT = 4_000

_ANCHORS = "array<struct<m: bigint, start: int, size: int>>"
_PIECES = "array<struct<m: bigint, at: int, start: int, piece: binary>>"
_CUT = T.StructType().add("n_bytes", T.LongType()).add("n_removed", T.LongType()).add("kept", T.BinaryType())


def _least(hashes: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` neighbours."""
    span = 1
    while 2 * span <= width:
        hashes, span = np.minimum(hashes[:-span], hashes[span:]), 2 * span
    return np.minimum(hashes[: len(hashes) - (width - span)], hashes[width - span :]) if span < width else hashes


def stretches(texts: X.Texts, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: where they begin, how many windows, the anchor's
    hash, and all hashes of anchor length."""
    none = np.zeros(0, np.int64)
    if len(texts.data) < length:
        return none, none, none.view(np.uint64), none.view(np.uint64)
    size = min(ANCHOR, length)
    at = np.arange(len(texts.data) - size + 1)
    hashes = texts.hashes(texts.sums(), at, at + size)
    least = _least(hashes, length - size + 1)
    count = np.maximum(np.diff(texts.offsets) - length + 1, 0)  # windows of each text
    edge = np.zeros(len(texts.data) + 1, np.int64)
    np.add.at(edge, texts.offsets[:-1], count > 0)
    np.add.at(edge, texts.offsets[:-1] + count, -(count > 0).astype(np.int64))
    inside = np.cumsum(edge)[: len(least)] > 0
    # The first of equal anchors counts, so a run ends with the window that its anchor begins.
    fresh = np.ones(len(least), bool)
    fresh[1:] = (least[1:] != least[:-1]) | (hashes[: len(least) - 1] == least[:-1]) | ~inside[:-1]
    starts = np.flatnonzero(fresh & inside)
    last = np.ones(len(least), bool)
    last[:-1] = fresh[1:] | ~inside[1:]
    stops = np.flatnonzero(last & inside) + 1
    return starts, stops - starts, least[starts], hashes


def _blocks(texts: X.Texts, length: int) -> Iterator[tuple[X.Texts, int]]:
    """A slice, or of one long text blocks that share no window, and where they begin."""
    if texts.n > 1 or len(texts.data) <= BLOCK:
        yield texts, 0
        return
    for begin in range(0, len(texts.data), BLOCK):
        data = texts.data[begin : begin + BLOCK + length - 1]
        yield X.Texts(data, np.array([0, len(data)])), begin


def _lists(counts: np.ndarray, fields: dict[str, pa.Array]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    values = pa.StructArray.from_arrays(list(fields.values()), list(fields))
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _joined(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def anchors(text: Column, length: int = LENGTH) -> Column:
    """For each text its runs of windows with one anchor: hash, first window, windows."""

    @F.arrow_udf(_ANCHORS)
    def runs(column: pa.Array) -> pa.Array:
        counts, m, start, size = [], [], [], []
        for whole in X.slices(column, BLOCK):
            per_text = np.zeros(whole.n, np.int64)
            for texts, base in _blocks(whole, length):
                at, windows, hashes, _ = stretches(texts, length)
                row = np.searchsorted(texts.offsets, at, "right") - 1
                per_text += np.bincount(row, minlength=whole.n)
                m.append(hashes.view(np.int64))
                start.append(at - texts.offsets[row] + base)
                size.append(windows)
            counts.append(per_text)
        fields = {
            "m": pa.array(_joined(m, np.int64)),
            "start": pa.array(_joined(start, np.int64).astype(np.int32)),
            "size": pa.array(_joined(size, np.int64).astype(np.int32)),
        }
        return _lists(_joined(counts, np.int64), fields)

    return runs(text)


def _anchor_places(starts: np.ndarray, m: np.ndarray, hashes: np.ndarray, width: int) -> np.ndarray:
    """How far behind a run's begin its anchor begins."""
    out = np.zeros(len(starts), np.int64)
    for a in range(0, len(starts), LOT):
        near = starts[a : a + LOT, None] + np.arange(width)
        out[a : a + LOT] = (hashes[near] == m[a : a + LOT, None]).argmax(axis=1)
    return out


def pieces(text: Column, begins: Column, ends: Column, length: int = LENGTH) -> Column:
    """The text of each run of windows within the given ranges of windows."""
    size = min(ANCHOR, length)

    @F.arrow_udf(_PIECES)
    def cut(column: pa.Array, begin: pa.Array, end: pa.Array) -> pa.Array:
        counts, m, at, start, where, data = np.zeros(len(column), np.int64), [], [], [], [], []
        row = 0
        for texts in X.slices(column, BLOCK):
            of = slice(row, row + texts.n)
            per = np.diff(begin.offsets.to_numpy())[of]
            lo = begin.flatten().to_numpy()[begin.offsets[row].as_py() - begin.offsets[0].as_py() :][: per.sum()]
            hi = end.flatten().to_numpy()[end.offsets[row].as_py() - end.offsets[0].as_py() :][: per.sum()]
            # Long ranges are cut, short ones are looked at together: some BLOCK bytes at once.
            cuts = -(-(hi - lo) // BLOCK).astype(np.int64)
            lo = (np.repeat(lo, cuts) + X.ranges(np.zeros(len(cuts), np.int64), cuts) * BLOCK).astype(np.int64)
            hi = np.minimum(np.repeat(hi, cuts), lo + BLOCK)
            owner = np.repeat(np.repeat(np.arange(texts.n), per), cuts)
            lengths = hi - lo + length - 1
            first = texts.offsets[owner] + lo
            lot = np.cumsum(lengths) // BLOCK
            batch = [0, *(np.flatnonzero(np.diff(lot)) + 1).tolist(), len(lot)] if len(lot) else [0]
            for a, b in zip(batch[:-1], batch[1:]):
                inner = X.Texts(
                    texts.data[X.ranges(first[a:b], lengths[a:b])], np.concatenate(([0], np.cumsum(lengths[a:b])))
                )
                s, windows, h, hashes = stretches(inner, length)
                part = np.searchsorted(inner.offsets, s, "right") - 1 + a
                counts[of] += np.bincount(owner[part], minlength=texts.n)
                m.append(h.view(np.int64))
                at.append(_anchor_places(s, h, hashes, length - size + 1))
                start.append(s - inner.offsets[part - a] + lo[part])
                where.append(windows + length - 1)
                data.append(inner.data[X.ranges(s, windows + length - 1)])
            row += texts.n
        sizes = _joined(where, np.int64)
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        raw = pa.py_buffer(_joined(data, np.uint8))
        fields = {
            "m": pa.array(_joined(m, np.int64)),
            "at": pa.array(_joined(at, np.int64).astype(np.int32)),
            "start": pa.array(_joined(start, np.int64).astype(np.int32)),
            "piece": pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), raw]),
        }
        return _lists(counts, fields)

    return cut(text, begins, ends)


class Suffixes:
    """Suffixes of some bytes, up to `length` bytes of each, compared by hashes."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length = data, length
        self.sums = X.Texts(data, np.array([0, len(data)])).sums()
        _, self.down = X.powers(len(data) + 1)

    def _hash(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.sums[at + size] - self.sums[at]) * self.down[at]

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common beginning, by binary search over prefix hashes."""
        common, step = np.zeros(len(a), np.int64), 1 << (self.length.bit_length() - 1)
        while step:
            longer = np.minimum(common + step, self.length)
            common = np.where(self._hash(a, longer) == self._hash(b, longer), longer, common)
            step //= 2
        return common

    def before(self, a: np.ndarray, b: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Whether suffix a comes before suffix b; `ties` where they are equal."""
        common = self.extension(a, b)
        inside = np.minimum(common, self.length - 1)
        return np.where(common == self.length, ties, self.data[a + inside] < self.data[b + inside])

    def sort(self, at: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """The order that sorts the suffixes of each segment; stable. Segments are
        numbered in rising order. All segments are merged together, level by level."""
        order = np.arange(len(at))
        begin = np.flatnonzero(np.append(True, segment[1:] != segment[:-1])) if len(at) else order
        sizes = np.diff(np.append(begin, len(at)))
        begin, size = np.repeat(begin, sizes), np.repeat(sizes, sizes)
        width = 1
        while len(sizes) and width < sizes.max():
            k = np.flatnonzero(size > width)
            local = k - begin[k]
            run = local // width
            other = begin[k] + (run ^ 1) * width
            stop = np.minimum(begin[k] + size[k], other + width)
            low, high = np.minimum(other, stop), stop.copy()
            mine = at[order[k]]
            right = (run & 1).astype(bool)  # equal ones of the left run stay in front
            todo = np.flatnonzero(low < high)
            while len(todo):
                middle = (low[todo] + high[todo]) // 2
                there = at[order[middle]]
                passed = self.before(there, mine[todo], right[todo])
                low[todo] = np.where(passed, middle + 1, low[todo])
                high[todo] = np.where(passed, high[todo], middle)
                todo = todo[low[todo] < high[todo]]
            rank = low - np.minimum(other, stop)
            merged = order.copy()
            merged[begin[k] + (run // 2) * 2 * width + local % width + rank] = order[k]
            order, width = merged, 2 * width
        return order

    def equal_to_next(self, at: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By the bytes: whether each sorted suffix equals the next one of its segment, and
        the segments that are not in order."""
        same, wrong = np.zeros(len(at), bool), []
        window = np.arange(self.length)
        for a in range(0, len(at) - 1, LOT):
            b = min(a + LOT, len(at) - 1)
            one, two = self.data[at[a:b, None] + window], self.data[at[a + 1 : b + 1, None] + window]
            differ = one != two
            some, where = differ.any(axis=1), differ.argmax(axis=1)
            row = np.arange(b - a)
            mine = segment[a:b] == segment[a + 1 : b + 1]
            same[a:b] = mine & ~some
            wrong.append(segment[a:b][mine & some & (one[row, where] > two[row, where])])
        return same, np.unique(_joined(wrong, np.int64))

    def settled(self, at: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order, equal to the next one), certain whatever the hashes do."""
        order = self.sort(at, segment)
        same, wrong = self.equal_to_next(at[order], segment)
        if len(wrong):
            for s in wrong.tolist():
                here = np.flatnonzero(segment == s)
                text = lambda k: self.data[at[k] : at[k] + self.length].tobytes()
                order[here] = sorted(here.tolist(), key=text)
            same, _ = self.equal_to_next(at[order], segment)
        return order, same


def _runs(group: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each run of consecutive numbers within a group."""
    fresh = np.ones(len(group), bool)
    fresh[1:] = (group[1:] != group[:-1]) | (number[1:] != number[:-1] + 1)
    first = np.flatnonzero(fresh)
    return first, np.diff(np.append(first, len(group)))


def settle(table: pa.Table, length: int = LENGTH) -> pa.Table:
    """Of a group of pieces (hot, m, at, id, fp, start, piece): the windows that repeat an
    earlier one as (id, fp, start, size); and where the anchor is hot, the remaining
    windows one by one, with their text."""
    ids = table["id"].combine_chunks()
    known = np.array([v is not None for v in ids.to_pylist()])
    rank = np.full(len(ids), len(ids))
    rank[known] = np.unique(np.array(ids.drop_null().to_pylist()), return_inverse=True)[1]
    fp, start = table["fp"].to_numpy(), table["start"].to_numpy().astype(np.int64)
    order = np.lexsort((start, fp, rank))
    step = np.zeros(len(order), np.int64)
    for key in (rank, fp, start):
        step[1:] |= key[order][1:] != key[order][:-1]
    place = np.zeros(len(order), np.int64)
    place[order] = np.cumsum(step)

    # Equal pieces: all but the first repeat it whole.
    coded = table["piece"].combine_chunks().dictionary_encode()
    code, texts = coded.indices.to_numpy(), coded.dictionary
    first = np.full(len(texts), len(ids))
    np.minimum.at(first, code, place)
    row = np.zeros(len(texts), np.int64)
    own = np.flatnonzero(place == first[code])
    row[code[own]] = own
    later = np.flatnonzero(place > first[code])
    sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]).astype(np.int64)
    windows = sizes - length + 1

    # Different pieces around one anchor: their suffixes are sorted, in order of place.
    hot = table["hot"].to_numpy(zero_copy_only=False)[row]
    _, family, members = np.unique(table["m"].to_numpy()[row], return_inverse=True, return_counts=True)
    chosen = np.flatnonzero((members[family] > 1) | hot)
    chosen = chosen[np.argsort(first[chosen])]
    some = texts.take(pa.array(chosen))
    begin = np.frombuffer(some.buffers()[1], np.int32)[some.offset : some.offset + len(some) + 1].astype(np.int64)
    data = np.frombuffer(some.buffers()[2], np.uint8) if some.buffers()[2] else np.zeros(0, np.uint8)
    each = windows[chosen]
    part = np.repeat(np.arange(len(chosen)), each)
    number = X.ranges(np.zeros(len(chosen), np.int64), each)
    at = begin[:-1][part] + number
    behind = table["at"].to_numpy().astype(np.int64)[row][chosen][part] - number
    segment = family[chosen][part] * length + behind
    by = np.argsort(segment, kind="stable")
    _, alike, times = np.unique(segment, return_inverse=True, return_counts=True)
    by = by[times[alike[by]] > 1]
    order, same = Suffixes(data, length).settled(at[by], segment[by])
    repeated = np.zeros(len(at), bool)
    repeated[by[order[1:]]] = same[:-1]

    gone = np.flatnonzero(repeated)
    head, count = _runs(part[gone], number[gone])
    spans = chosen[part[gone][head]]
    left = np.flatnonzero(hot[chosen][part] & ~repeated) if len(at) else gone
    rows = np.concatenate((later, row[spans], row[chosen[part[left]]]))
    shift = np.concatenate((np.zeros(len(later), np.int64), number[gone][head], number[left]))
    many = np.concatenate((windows[code[later]], count, np.ones(len(left), np.int64)))
    single = pa.array([None] * (len(later) + len(spans)) + [data[a : a + length].tobytes() for a in at[left].tolist()], pa.binary())
    return pa.table(
        {
            "id": ids.take(pa.array(rows)),
            "fp": pa.array(fp[rows]),
            "start": pa.array((start[rows] + shift).astype(np.int32)),
            "size": pa.array(many.astype(np.int32)),
            "piece": single,
        }
    )


def _merged(found: DataFrame, reach: int) -> DataFrame:
    """Ranges [start, start + size + reach) of each (id, fp), overlapping and adjoining
    ones as one: arrays `begins` and `ends`."""
    rows = found.select("id", "fp", "start", (F.col("start") + F.col("size") + reach).alias("stop"))
    of = Window.partitionBy("id", "fp").orderBy("start", "stop")
    before = F.max("stop").over(of.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("fresh", F.when(F.col("start") <= before, 0).otherwise(1))
    rows = rows.withColumn("run", F.sum("fresh").over(of.rowsBetween(Window.unboundedPreceding, 0)))
    spans = rows.groupBy("id", "fp", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    spans = spans.groupBy("id", "fp").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    return spans.select("id", "fp", F.col("spans.start").alias("begins"), F.col("spans.stop").alias("ends"))


def _meet(rows: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    """Texts with the spans of their (id, fp); few spans are broadcast, no text moves."""
    spans = spans.select(F.col("id").alias("_i"), F.col("fp").alias("_f"), "begins", "ends")
    size = spans.agg(F.sum(100 + 8 * F.size("begins"))).first()[0] or 0
    small = F.broadcast(spans) if size <= BROADCAST_BYTES else spans
    same = rows["id"].eqNullSafe(F.col("_i")) & (rows["fp"] == F.col("_f"))
    return rows.join(small, same, how).drop("_i", "_f")


def repeated_spans(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """Of rows (id, fp, text): the bytes to remove, as (id, fp, begins, ends) without
    documents that lose none."""
    spark = rows.sparkSession
    bounded_batches(spark)
    kind = dict(rows.dtypes)["id"]
    found = rows.select("id", "fp", F.explode(anchors(F.col("text"), length)).alias("a"))
    counts = found.groupBy(F.col("a.m").alias("m")).agg(F.count(F.lit(1)).alias("times"))
    counts = hand_over(counts.where("times > 1"), "anchors")
    total = counts.agg(F.sum("times")).first()[0] or 0
    recurring = found.select("id", "fp", "a.*").join(counts.select("m"), "m")
    spans = hand_over(_merged(recurring.select("id", "fp", "start", "size"), 0), "ranges")

    texts = _meet(rows, spans, "inner")
    parts = texts.select("id", "fp", F.explode(pieces(F.col("text"), F.col("begins"), F.col("ends"), length)).alias("p"))
    parts = parts.select("id", "fp", "p.*")
    crowds = counts.where(F.col("times") > CHUNK).select("m", F.ceil(F.col("times") / CHUNK).alias("chunks"))
    if total // CHUNK <= BROADCAST_IDS:  # that many anchors can be hot
        crowds = F.broadcast(crowds)
    parts = parts.join(crowds, "m", "left").withColumn("hot", F.col("chunks").isNotNull())
    chunk = F.coalesce(F.pmod(F.xxhash64("id", "fp", "start"), F.col("chunks")), F.lit(0))
    schema = f"id {kind}, fp bigint, start int, size int, piece binary"

    def sorted_by(frame: DataFrame, key: Column, groups: int) -> DataFrame:
        group = F.pmod(key, F.lit(max(1, groups))).alias("group")
        cut = frame.select(group, "hot", "m", "at", "id", "fp", "start", "piece")
        return cut.groupBy("group").applyInArrow(lambda t: settle(t, length), schema)

    one = hand_over(sorted_by(parts, F.xxhash64("m", chunk), -(-total // GROUP)), "sorted")
    gone = one.where(F.col("piece").isNull())
    single = one.where(F.col("piece").isNotNull())
    left = single.count()
    if left:
        single = single.select(F.lit(False).alias("hot"), F.xxhash64("piece").alias("m"), F.lit(0).alias("at"), "*").drop("size")
        gone = gone.unionByName(sorted_by(single, F.xxhash64("piece"), -(-left // (10 * GROUP))))
    return hand_over(_merged(gone.select("id", "fp", "start", "size"), length - 1), "spans")


def copies(rows: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """Of rows (id, fp, text): those to go on with, and (id, fp, begins, ends) of texts that
    an earlier row has as a whole."""
    long = rows.where(F.octet_length("text") >= length)
    hashed = F.unhex(F.md5(F.col("text").cast("binary")))
    narrow = long.select("id", "fp", F.octet_length("text").alias("size"), hashed.alias("hash"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("first")
    groups = narrow.groupBy("hash").agg(F.count(F.lit(1)).alias("rows"), first).where("rows > 1")
    groups = hand_over(groups.select(F.col("hash").alias("_hash"), F.col("first.id").alias("_first")), "copies")
    few = F.broadcast(groups) if groups.count() <= BROADCAST_IDS else groups
    same = F.col("hash") == F.col("_hash")
    texts = long.withColumn("hash", hashed).join(few, same, "left_semi").groupBy("hash")
    equal = texts.agg(F.min("text").alias("low"), F.max("text").alias("high")).where("low = high").select("hash")
    groups = hand_over(groups.join(equal, same, "left_semi"), "copies-equal")
    few = F.broadcast(groups) if groups.count() <= BROADCAST_IDS else groups
    later = F.col("_hash").isNotNull() & ~F.col("id").eqNullSafe(F.col("_first"))
    left = rows.withColumn("hash", hashed).join(few, same, "left").where(~later)
    whole = narrow.join(few, same, "left").where(later).select("id", "fp", "size").distinct()
    whole = whole.select("id", "fp", F.array(F.lit(0)).alias("begins"), F.array("size").alias("ends"))
    return left.select(*rows.columns), whole


@F.arrow_udf(_CUT)
def _cut(column: pa.Array, begins: pa.Array, ends: pa.Array) -> pa.Array:
    size, gone, kept = [], [], []
    row = 0
    for texts in X.slices(column):
        for i in range(texts.n):
            data, at = texts[i], 0
            out = []
            for a, b in zip(begins[row].as_py() or (), ends[row].as_py() or ()):
                out.append(data[at:a])
                at = b
            left = b"".join([*out, data[at:]])
            size.append(len(data))
            gone.append(len(data) - len(left))
            kept.append(left)
            row += 1
    return pa.StructArray.from_arrays(
        [pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())],
        ["n_bytes", "n_removed", "kept"],
    )


def cleaned(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH) -> tuple[DataFrame, str]:
    """The documents with a struct column (n_bytes, n_removed, spans, kept): the bytes
    before, those removed, the removed ranges and the bytes that stay; second, that
    column's name, which no other column has."""
    name = f"_{uuid.uuid4().hex[:12]}"
    rows = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text_of(text)).alias("fp"), text_of(text).alias("text"))
    rest, whole = copies(rows, length)
    spans = hand_over(repeated_spans(rest, length).unionByName(whole), "all-spans")
    keyed = docs.select(F.struct(*docs.columns).alias("doc"), F.col(doc_id).alias("id"), F.xxhash64(text_of(text)).alias("fp"))
    met = _meet(keyed, spans, "left")
    body = F.coalesce(F.col("doc")[text], F.lit(""))
    met = met.withColumn("cut", _cut(body, F.col("begins"), F.col("ends")))
    none = F.array().cast("array<struct<begin: int, end: int>>")
    ranges = F.coalesce(F.arrays_zip("begins", "ends").cast("array<struct<begin: int, end: int>>"), none)
    verdict = F.struct("cut.n_bytes", "cut.n_removed", ranges.alias("spans"), "cut.kept")
    found = met.select("doc", "id", "fp", verdict.alias(name))

    again = rows.groupBy("id", "fp").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    again = hand_over(again.select(F.col("id").alias("_i"), F.col("fp").alias("_f")), "repeated-rows")
    if not again.isEmpty():
        same = F.col("id").eqNullSafe(F.col("_i")) & (F.col("fp") == F.col("_f"))
        rest = numbered_alike(found.join(again, same, "left_semi"), ["id", "fp"], "repeated-rows", "number")
        whole = F.array(F.struct(F.lit(0).alias("begin"), F.col(name)["n_bytes"].cast("int").alias("end")))
        copy = F.col(name).withField("n_removed", F.col(name)["n_bytes"]).withField("spans", whole)
        copy = copy.withField("kept", F.lit(b""))
        repeats = (F.col("number") > 0) & (F.col(name)["n_bytes"] >= length)
        rest = rest.withColumn(name, F.when(repeats, copy).otherwise(F.col(name)))
        found = found.join(again, same, "left_anti").unionByName(rest.select(*found.columns))
    return found.select(*[F.col("doc")[c].alias(c) for c in docs.columns], name), name
