"""Quality of documents, learnt from trusted positives and unlabelled text.

Positive-unlabelled learning: with prior p of positives, the risk

    p * E_P[loss(+)] + max(0, E_U[loss(-)] - p * E_P[loss(-)])

needs no negatives; its second part estimates the loss on negatives and is kept from
falling below zero, where the model would only fit noise (then the step goes the other
way). The model is linear in counts over the whole text (`features.text_features`),
the loss logistic. The prior is estimated by cross-fitting: the smallest ratio, over
all thresholds, of unlabelled to positive rows above it, with a margin for chance.

Fitting takes two bounded samples, picked by the hash of the id: about `fit_rows` of the
positives and as many of the unlabelled documents, or all where there are fewer. Rows of
fold 2 take no part in it. Rows labelled 0 are not used at all.

Defined cases: null and empty texts get the score of a text without any counts; a
missing label means unlabelled; contradicting labels of one id count as no label; with
documents but no positives or no unlabelled rows nothing can be learnt, which is an
error; if not `strict`, a warning, and every score is 0.5, below the threshold. Without any documents the score is the prior for all. Repeated rows get the same
score each. Further columns are kept. An empty table gives an empty result.
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

#: Of the positives, and of the unlabelled rows.
FIT_ROWS = 20_000
THRESHOLD = 0.7
STEPS, RATE, DECAY = 800, 0.5, 1e-4
PARTS = 3
START_PRIOR = 0.7


@F.arrow_udf(T.ArrayType(T.FloatType()))
def _features(column: pa.Array) -> pa.Array:
    parts = [C.text_features(C.Counted(t)) for t in X.slices(column)]
    flat = np.concatenate(parts) if parts else np.zeros((0, C.TEXT_FEATURES), np.float32)
    offsets = np.arange(len(flat) + 1, dtype=np.int32) * C.TEXT_FEATURES
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.ravel()))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def nn_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS) -> np.ndarray:
    """Weights that minimise the non-negative risk by gradient descent."""
    w = np.zeros(positive.shape[1])
    for _ in range(steps):
        gp, gu = positive @ w, unlabelled @ w
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        of_negative = unlabelled.T @ _sigmoid(gu) / len(gu) - prior * (positive.T @ _sigmoid(gp)) / len(gp)
        if negative < 0:
            step = -of_negative
        else:
            step = of_negative - prior * (positive.T @ _sigmoid(-gp)) / len(gp)
        w -= RATE * (step + DECAY * w)
    return w


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray, chance: float = 0.1) -> float:
    """Share of positives among unlabelled scores, by the best threshold."""
    if not len(positive) or not len(unlabelled):
        return START_PRIOR
    cuts = np.unique(np.quantile(np.concatenate((positive, unlabelled)), np.linspace(0, 0.99, 200)))
    p = 1 - np.searchsorted(np.sort(positive), cuts) / len(positive)
    u = 1 - np.searchsorted(np.sort(unlabelled), cuts) / len(unlabelled)
    margin = np.sqrt(np.log(4 / chance) / 2) * (len(positive) ** -0.5 + len(unlabelled) ** -0.5)
    some = p > 0
    best = np.argmin((u[some] + margin) / p[some])
    return float(np.clip(u[some][best] / p[some][best], 0.01, 0.99))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        return _sigmoid(((features - self.mean) / self.scale) @ self.weights)


def fit_arrays(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    """The model and the prior, which rests on scores by models that did not see the row."""
    width = C.TEXT_FEATURES
    if not len(positive) or not len(unlabelled):
        weights = np.zeros(width)
        weights[-1] = np.log(START_PRIOR / (1 - START_PRIOR))
        return Model(np.zeros(width), np.ones(width), weights, START_PRIOR)
    both = np.concatenate((positive, unlabelled))
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-3
    mean[-1], scale[-1] = 0, 1
    p, u = (positive - mean) / scale, (unlabelled - mean) / scale
    prior = START_PRIOR
    for _ in range(2):
        of_p, of_u = np.zeros(len(p)), np.zeros(len(u))
        for part in range(PARTS):
            in_p, in_u = np.arange(len(p)) % PARTS == part, np.arange(len(u)) % PARTS == part
            w = nn_pu(p[~in_p], u[~in_u], prior) if (~in_p).any() and (~in_u).any() else np.zeros(width)
            of_p[in_p], of_u[in_u] = p[in_p] @ w, u[in_u] @ w
        prior = estimated_prior(of_p, of_u)
    return Model(mean, scale, nn_pu(p, u, prior), prior)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    fit_rows: int = FIT_ROWS,
    strict: bool = True,
) -> Model:
    """Learns from documents outside fold 2 and labels (doc_id, quality)."""
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    bounded_batches(docs.sparkSession)
    rows = rows.where((fold(F.col("_id")) != 2) & F.col("_id").isNotNull())
    known = labels.where(F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("_label_id"))
    known = known.agg(F.min("quality").alias("_low"), F.max("quality").alias("_high"))
    ids = rows.select("_id")
    joined = ids.join(known, ids["_id"] == known["_label_id"], "left")
    role = F.when((F.col("_low") == 1) & (F.col("_high") == 1), 1).when(F.col("_low") != F.col("_high"), 0)
    role = F.coalesce(role, F.when(F.col("_label_id").isNull(), 0))
    roles = hand_over(joined.where(role.isNotNull()).select("_id", role.alias("role")), "roles")
    picked, sizes = sampled_by(roles, F.col("_id"), "role", fit_rows)
    have = {r["role"] for r in sizes.collect()}
    if have != {0, 1} and not docs.isEmpty():
        lacking = " or ".join(name for k, name in ((1, "positive"), (0, "unlabelled")) if k not in have)
        said = f"no {lacking} documents outside the held-out fold: the classifier cannot be fitted"
        if strict:
            raise ValueError(said)
        warnings.warn(said)
        return Model(np.zeros(C.TEXT_FEATURES), np.ones(C.TEXT_FEATURES), np.zeros(C.TEXT_FEATURES), START_PRIOR)
    picked = hand_over(picked.select("_id", "role").distinct(), "fit-ids")  # at most twice `fit_rows`, about
    found = rows.join(F.broadcast(picked), "_id").select("_id", "role", _features("_text").alias("f"))
    table = found.orderBy("_id").toArrow()
    width = C.TEXT_FEATURES
    values = np.array(table["f"].combine_chunks().flatten()).reshape(-1, width).astype(float)
    positive = table["role"].to_numpy() == 1
    return fit_arrays(values[positive], values[~positive])


def score(text: Column, model: Model) -> Column:
    """The probability that a text is of good quality."""

    @F.arrow_udf("double")
    def scores(column: pa.Array) -> pa.Array:
        parts = [model.scores(C.text_features(C.Counted(t))) for t in X.slices(column)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return scores.asNondeterministic()(text)


def accepted(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that reach the threshold, with their own columns."""
    scored, name = with_column(docs, score(F.col(text), model))
    return scored.where(F.col(name) >= threshold).drop(name)
