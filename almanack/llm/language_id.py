"""Language of a text from bit-sliced Bloom filters of byte n-grams.

An n-gram is four bytes of the lower-cased text, where every ASCII character that is
no letter counts as a space. A language holds an n-gram that makes up at least
`MIN_SHARE` of its n-grams in the learning sample and is not five times as common in
another one; so a language holds at most 1 / MIN_SHARE n-grams, whatever the corpus.
All languages share one filter whose slots are bit masks, a bit for each language:
the AND of an n-gram's slots gives all languages that (may) hold it at once. The
number of a text's n-grams that a language holds, less the false positives expected
from how full its bits are, decides.

Learning takes a bounded sample of the documents with a text and a language outside
fold 2: of each language about `fit_rows`, picked by hash, or all where there are fewer.

Defined cases: null texts and texts without a letter are "und" with score 0; so is all
when nothing could be learnt. If no language holds any n-gram, the one most frequent in
these documents, by the sample, is returned with score 0. Ties go to the name that sorts first. Repeated
rows are judged each; further columns are kept; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanack.llm import text as X
from almanack.llm.tables import bounded_batches, fold, sampled_by
from almanack.session import hand_over

N = 4
MIN_SHARE = 2e-5
CHARACTERISTIC = 0.2
#: Of each language.
FIT_ROWS = 8_000
SLOTS, HASHES = 1 << 20, 3
UNKNOWN = "und"

#: ASCII letters and all bytes of other characters; the rest becomes a space.
_LETTER = np.arange(256, dtype=np.uint8)
_LETTER[[i for i in range(128) if not chr(i).isalpha()]] = 0x20


def grams(texts: X.Texts) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams with a letter of all texts, and where each text's begin (and the end).

    A space is put between and around texts; no n-gram reaches across two texts.
    """
    data = np.insert(_LETTER[texts.data], texts.offsets, 0x20).astype(np.uint32)
    size = max(0, len(data) - N + 1)
    value = np.zeros(size, np.uint32)
    for k in range(N):
        value |= data[k : k + size] << np.uint32(8 * k)
    begin = texts.offsets[:-1] + np.arange(texts.n)
    stop = np.maximum(texts.offsets[1:] + np.arange(texts.n) + 2 - N + 1, begin)
    depth = np.zeros(size + 1, np.int8)
    np.add.at(depth, np.minimum(begin, size), 1)
    np.add.at(depth, np.minimum(stop, size), -1)
    good = (np.cumsum(depth[:-1], dtype=np.int8) > 0) & (value != 0x20202020)
    before = np.concatenate(([0], np.cumsum(good)))
    return value[good], np.append(before[np.minimum(begin, size)], before[np.minimum(stop, size)][-1:])


def _slots(values: np.ndarray) -> list[np.ndarray]:
    h = values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    mask = np.uint64(SLOTS - 1)
    return [((h >> np.uint64(s)) & mask).astype(np.int64) for s in (4, 24, 44)[:HASHES]]


@dataclass(frozen=True)
class Filters:
    """Slots of bit masks; languages beyond 64 have further arrays of slots."""

    languages: list[str]
    common: str
    slices: list[np.ndarray]
    chance: np.ndarray  # of a false positive, by language

    @staticmethod
    def of(languages: list[str], common: str, held: dict[str, np.ndarray]) -> Filters:
        slices, chance = [], []
        for begin in range(0, len(languages), 64):
            names = languages[begin : begin + 64]
            kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if np.iinfo(k).bits >= len(names))
            table = np.zeros(SLOTS, kind)
            for bit, name in enumerate(names):
                for at in _slots(held.get(name, np.zeros(0, np.uint32))):
                    table[at] |= kind(1 << bit)
                chance.append(float((table >> kind(bit) & kind(1)).mean()) ** HASHES)
            slices.append(table)
        return Filters(languages, common, slices, np.array(chance))

    def hits(self, texts: X.Texts) -> tuple[np.ndarray, np.ndarray]:
        """Corrected counts (text, language), and the number of n-grams of each text."""
        values, first = grams(texts)
        total = np.diff(first)
        out = np.zeros((texts.n, len(self.languages)))
        at = _slots(values)
        for k, table in enumerate(self.slices):
            mask = table[at[0]]
            for more in at[1:]:
                mask &= table[more]
            for bit in range(min(64, len(self.languages) - 64 * k)):
                held = (mask >> mask.dtype.type(bit)) & mask.dtype.type(1)
                sums = np.add.reduceat(np.append(held, held.dtype.type(0)), first[:-1], dtype=np.int64)
                out[:, 64 * k + bit] = np.where(total > 0, sums, 0)
        return np.maximum(out - total[:, None] * self.chance, 0) / (1 - self.chance), total

    def decide(self, texts: X.Texts) -> tuple[list[str], np.ndarray]:
        """The language of each text, and its lead over the second as a score."""
        if not self.languages:
            return [UNKNOWN] * texts.n, np.zeros(texts.n)
        counts, _ = self.hits(texts)
        best = counts.argmax(axis=1)
        ordered = np.sort(counts, axis=1)
        top = ordered[:, -1]
        second = ordered[:, -2] if counts.shape[1] > 1 else np.zeros(texts.n)
        score = np.where(top > 0, top / np.maximum(top + second, 1e-9), 0.0)
        names = [self.languages[b] if t > 0 else self.common for b, t in zip(best.tolist(), top.tolist())]
        return names, score


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of n-grams by language within a partition's batches."""
    for batch in batches:
        table = pa.table({"lang": batch["lang"], "text": pc.utf8_lower(batch["text"])})
        for name in pc.unique(table["lang"]).to_pylist():
            own = table.filter(pc.equal(table["lang"], name))["text"]
            found = [grams(t)[0] for t in X.slices(own)]
            values, counts = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(values), pa.string()), pa.array(values.astype(np.int64)), pa.array(counts)],
                ["lang", "gram", "n"],
            )


def fit(
    docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", fit_rows: int = FIT_ROWS
) -> Filters:
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    bounded_batches(docs.sparkSession)
    rows = rows.where((fold(F.col("_id")) != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # By id and text: rows without an id are not all drawn or all left.
    rows, sizes = sampled_by(rows, F.struct("_id", "text"), "lang", fit_rows)
    counts = rows.select("lang", "text").mapInArrow(_counted, "lang string, gram bigint, n bigint")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = hand_over(counts, "gram-counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))  # a row for each language
    shares = counts.join(totals, "lang").withColumn("share", F.col("n") / F.col("total")).drop("total")
    shares = shares.where(F.col("share") >= MIN_SHARE)
    most = F.max("share").over(Window.partitionBy("gram"))
    held = shares.withColumn("most", most).where(F.col("share") >= F.col("most") * CHARACTERISTIC)
    table = held.select("lang", "gram", "n").toArrow()  # at most 1 / MIN_SHARE rows for each language
    names = np.array(table["lang"].to_pylist(), object)
    values, weights = table["gram"].to_numpy().astype(np.uint32), table["n"].to_numpy()
    languages = sorted(set(names))
    own = {name: names == name for name in languages}
    stands_for = {r["lang"]: max(1.0, r["_rows"] / fit_rows) for r in sizes.collect()}
    common = min(languages, key=lambda x: (-int(weights[own[x]].sum()) * stands_for[x], x), default=UNKNOWN)
    return Filters.of(languages, common, {name: values[own[name]] for name in languages})


def predict(text: Column, filters: Filters) -> Column:
    """Struct (lang_pred, score) for a text."""

    @F.arrow_udf("lang_pred string, score double")
    def predictions(column: pa.Array) -> pa.Array:
        names, scores = [], []
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        letters = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False)
        for texts in X.slices(pc.utf8_lower(column)):
            found, score = filters.decide(texts)
            names += found
            scores.append(score)
        score = pa.array(np.concatenate(scores) if scores else np.zeros(0))
        name = pc.if_else(letters, pa.array(names, pa.string()), UNKNOWN)
        return pa.StructArray.from_arrays([name, pc.if_else(letters, score, 0.0)], ["lang_pred", "score"])

    return predictions.asNondeterministic()(text)
