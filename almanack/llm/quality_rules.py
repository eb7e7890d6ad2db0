"""Rules on words, symbols and repetition, and a line labelling that finds boilerplate.

A linear-chain conditional random field labels each line with a word as content or
boilerplate: line features (`features.line_features`) give the score of each label,
a matrix the score of each transition; Viterbi decoding finds the best sequence. The
share of content among the characters decides whether a document stays. The field is
trained by maximum likelihood (forward and backward sums) on labelled documents outside
fold 2, whose lines take the document's label: about `fit_rows` of the good and as many
of the poor ones, picked by the hash of the id, or all where there are fewer. Each class
weighs as much as it does among all labelled documents. Of a document with many lines
`FIT_RUNS` runs of RUN lines, spread over it, are used and weigh as much as all of them,
so that what comes to the driver is bounded.

Defined cases: null and empty texts have no words, zeros throughout, and fail the base
rules; lines without a word are no part of a sequence; long texts are decoded whole.
Contradicting labels of one id count as no label. Without poor rows no line counts as
boilerplate, of which a warning tells. Documents without any good row among them are an
error; if not `strict`, a warning, and no line counts as content. Repeated rows are judged each. Further
columns are kept. An empty table gives an empty result.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanack.llm import features as C
from almanack.llm import text as X
from almanack.llm.tables import bounded_batches, fold, sampled_by, with_column
from almanack.session import hand_over

MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
MIN_CONTENT = 0.5
#: Of the good labelled rows, and of the poor ones.
FIT_ROWS = 6_000
#: Training sequences are cut into runs of this many lines; of each document so many are used.
RUN, FIT_RUNS = 64, 8
STEPS = 150
CONTENT, BOILERPLATE = 0, 1

_COUNTS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "content_share double"
)


@dataclass(frozen=True)
class Field:
    emission: np.ndarray  # (features, 2)
    transition: np.ndarray  # (2, 2), from and to
    nothing_known: bool = False

    def decode(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The best label of each line; texts have `counts` lines, one after another."""
        if self.nothing_known:
            return np.full(len(features), BOILERPLATE, np.int8)
        return viterbi(features @ self.emission, self.transition, counts)


def viterbi(scores: np.ndarray, transition: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Best label sequences of many chains at once, one line of each per step."""
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    order = np.argsort(-counts, kind="stable")
    first, counts = first[order], counts[order]
    back = np.zeros((len(scores), 2), np.int8)
    best = np.zeros((len(counts), 2))
    longest = int(counts[0]) if len(counts) else 0
    active = np.searchsorted(-counts, -np.arange(1, longest + 1), side="right")
    for t in range(longest):
        n = active[t]
        at = first[:n] + t
        if t:
            through = best[:n, :, None] + transition
            back[at] = through.argmax(axis=1)
            best[:n] = through.max(axis=1) + scores[at]
        else:
            best[:n] = scores[at]
    labels = np.zeros(len(scores), np.int8)
    state = best.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at = first[:n] + t
        labels[at] = state[:n]
        state[:n] = back[at, state[:n]]
    return labels


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def train(
    features: np.ndarray, labels: np.ndarray, counts: np.ndarray, steps: int = STEPS, weigh: np.ndarray | None = None
) -> Field:
    """Maximum likelihood by gradient ascent (Adam), all chains in step, each by its weight."""
    width, n = features.shape[1], len(counts)
    weights, transition = np.zeros((width, 2)), np.zeros((2, 2))
    if not len(features):
        weights[-1, CONTENT] = 1.0
        return Field(weights, transition)
    weigh = np.ones(n) if weigh is None else weigh / weigh.mean()
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    longest = int(counts.max())
    steps_at = np.minimum(first[:, None] + np.arange(longest), len(features) - 1)
    real = np.arange(longest) < counts[:, None]
    given = np.eye(2)[labels]
    pairs = real[:, 1:]
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[steps_at[:, :-1]][pairs], labels[steps_at[:, 1:]][pairs]), np.repeat(weigh, pairs.sum(axis=1)))
    moment = [np.zeros_like(weights), np.zeros_like(transition)]
    square = [np.zeros_like(weights), np.zeros_like(transition)]
    for step in range(1, steps + 1):
        scores = (features @ weights)[steps_at]
        forward, backward = np.zeros((longest, n, 2)), np.zeros((longest, n, 2))
        forward[0] = scores[:, 0]
        for t in range(1, longest):
            go = _log_sum(forward[t - 1][:, :, None] + transition, 1) + scores[:, t]
            forward[t] = np.where(real[:, t, None], go, forward[t - 1])
        for t in range(longest - 2, -1, -1):
            go = _log_sum(transition[None] + (scores[:, t + 1] + backward[t + 1])[:, None, :], 2)
            backward[t] = np.where(real[:, t + 1, None], go, 0)
        total = _log_sum(forward[-1], 1)
        marginal = np.exp((forward + backward).transpose(1, 0, 2) - total[:, None, None])[real]
        gradient = features.T @ ((given[steps_at[real]] - marginal) * np.repeat(weigh, counts)[:, None]) / n
        expected = np.zeros((2, 2))
        for t in range(longest - 1):
            on = pairs[:, t]
            joint = forward[t][on][:, :, None] + transition + (scores[:, t + 1] + backward[t + 1])[on][:, None, :]
            expected += (np.exp(joint - total[on][:, None, None]) * weigh[on][:, None, None]).sum(axis=0)
        changes = [gradient - 1e-3 * weights, (seen - expected) / n - 1e-3 * transition]
        for k, (value, change) in enumerate(zip((weights, transition), changes)):
            moment[k] = 0.9 * moment[k] + 0.1 * change
            square[k] = 0.99 * square[k] + 0.01 * change**2
            value += 0.1 * (moment[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
    return Field(weights, transition)


_RUNS = (
    T.StructType().add("f", T.ArrayType(T.FloatType())).add("sizes", T.ArrayType(T.IntegerType())).add("runs", T.IntegerType())
)


@F.arrow_udf(_RUNS)
def _lines(column: pa.Array) -> pa.Array:
    """Features of the lines of up to FIT_RUNS runs of each text, how many lines each run
    has, and how many runs the text has."""
    values, sizes, runs = [], [], []
    for texts in X.slices(column):
        c = C.Counted(texts)
        features = C.line_features(c)
        begin = np.concatenate(([0], np.cumsum(c.n_lines))).tolist()
        for a, b in zip(begin, begin[1:]):
            starts = np.arange(a, b, RUN)
            runs.append(len(starts))
            picked = starts[np.unique(np.linspace(0, len(starts) - 1, FIT_RUNS).astype(int))] if len(starts) else starts
            sizes.append([min(RUN, b - x) for x in picked.tolist()])
            values.append(np.concatenate([features[x : min(x + RUN, b)] for x in picked.tolist()] or [features[:0]]).ravel())
    flat = np.concatenate(values) if values else np.zeros(0, np.float32)
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.float32)))
    arrays = [lists, pa.array(sizes, pa.list_(pa.int32())), pa.array(runs, pa.int32())]
    return pa.StructArray.from_arrays(arrays, ["f", "sizes", "runs"])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    fit_rows: int = FIT_ROWS,
    strict: bool = True,
) -> Field:
    """Trains on about `fit_rows` documents of each label outside fold 2."""
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    bounded_batches(docs.sparkSession)
    rows = rows.where(fold(F.col("_id")) != 2)
    known = labels.where(F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("_label_id"))
    known = known.agg(F.min("quality").alias("quality"), F.max("quality").alias("_high"))
    known = known.where(F.col("quality") == F.col("_high"))
    ids = rows.select("_id")
    joined = ids.join(known, ids["_id"] == known["_label_id"])
    good = (F.col("quality") == 1).cast("int").alias("good")
    labelled = hand_over(joined.select("_id", good), "labelled")
    picked, sizes = sampled_by(labelled, F.col("_id"), "good", fit_rows)
    size = {r["good"]: r["_rows"] for r in sizes.collect()}
    if 1 not in size and not docs.isEmpty():
        lacking = "no good labelled documents outside the held-out fold: the line labels cannot be learnt"
        if strict:
            raise ValueError(lacking)
        warnings.warn(lacking)
        return Field(np.zeros((C.LINE_FEATURES, 2)), np.zeros((2, 2)), nothing_known=True)
    if 1 in size and 0 not in size:
        warnings.warn("no poor labelled documents outside the held-out fold: no line counts as boilerplate")
    picked = hand_over(picked.select("_id", "good").distinct(), "fit-ids")  # at most twice `fit_rows`, about
    found = rows.join(F.broadcast(picked), "_id")
    table = found.select("_id", "good", _lines("_text").alias("l")).select("_id", "good", "l.*").orderBy("_id").toArrow()
    values = np.array(table["f"].combine_chunks().flatten()).reshape(-1, C.LINE_FEATURES).astype(float)
    sizes, runs = table["sizes"].to_pylist(), table["runs"].to_numpy()
    good = table["good"].to_numpy() == 1
    label = np.where(good, CONTENT, BOILERPLATE)
    weight = np.where(good, size.get(1, 0) / max(1, good.sum()), size.get(0, 0) / max(1, (~good).sum()))
    used = np.array([len(s) for s in sizes], np.int64)
    weight = weight * runs / np.maximum(used, 1)
    counts = np.array([n for s in sizes for n in s], np.int64)
    lines = np.array([sum(s) for s in sizes], np.int64)
    return train(values, np.repeat(label, lines), counts, weigh=np.repeat(weight, used))


def measure(text: Column, field: Field) -> Column:
    """Counts of the base rules and the share of content, as a struct."""

    @F.arrow_udf(_COUNTS)
    def measures(column: pa.Array) -> pa.Array:
        parts = [[] for _ in range(6)]
        for texts in X.slices(column):
            c = C.Counted(texts)
            labels = field.decode(C.line_features(c), c.n_lines)
            size = C.line_sizes(c)
            whole = np.bincount(c.line_doc, size, texts.n)
            content = np.bincount(c.line_doc, size * (labels == CONTENT), texts.n)
            found = (
                c.n_words,
                c.per_text(C.CLASS["lead"] & ~X.SPACE),
                c.per_text(C.CLASS["symbol"]),
                c.n_dup_lines,
                c.per_text_words(c.repeated),
                content / np.maximum(whole, 1),
            )
            for part, values in zip(parts, found):
                part.append(values)
        kinds = [pa.int64()] * 5 + [pa.float64()]
        arrays = [pa.array(np.concatenate(p) if p else [], k) for p, k in zip(parts, kinds)]
        names = [x.split()[0] for x in _COUNTS.split(", ")]
        return pa.StructArray.from_arrays(arrays, names)

    return measures.asNondeterministic()(text)


def judged(docs: DataFrame, field: Field, text: str = "text") -> tuple[DataFrame, str, Column, Column]:
    """The documents with their counts in a struct column, that column's name, and the
    columns base_failed and kept."""
    found, name = with_column(docs, measure(F.col(text), field))
    m = F.col(name)
    failed = (m["n_words"] < MIN_WORDS) | (m["n_repeat_words"] * 100 > m["n_words"] * MAX_REPEATED_PERCENT)
    return found, name, failed, ~failed & (m["content_share"] >= MIN_CONTENT)


def retained(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """The documents that stay, with their own columns."""
    found, name, _, kept = judged(docs, field, text)
    return found.where(kept).drop(name)
