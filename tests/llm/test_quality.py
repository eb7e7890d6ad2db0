from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from almanack.llm import quality_classifier as Q
from almanack.llm import quality_rules as R
from almanack.llm.tables import read, with_column
from tests.llm.conftest import fold, frame, prose


def junk(seed):
    return " ".join(w + random.Random(seed).choice(["###", "$$$", "%%"]) for w in prose(seed, 80).split())


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, prose(i, 120) if i % 5 else junk(i)) for i in range(600)]
    labels = [(i, int(i % 5 > 0), 0) for i in range(0, 600, 2)]
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_held_out_accuracy(spark, corpus):
    docs, labels = corpus
    model = Q.fit(docs, labels)
    scored, name = with_column(docs, Q.score(F.col("text"), model))
    for r in scored.collect():
        if fold(r["doc_id"]) == 2:
            assert (r[name] >= Q.THRESHOLD) == (r["doc_id"] % 5 > 0)


def test_prior_is_estimated():
    rng = np.random.default_rng(1)
    positive = rng.normal(2, 1, 4000)
    for share in (0.3, 0.6, 0.9):
        n = int(4000 * share)
        unlabelled = np.concatenate((rng.normal(2, 1, n), rng.normal(-2, 1, 4000 - n)))
        assert abs(Q.estimated_prior(positive, unlabelled) - share) < 0.1


def test_non_negative_risk_needs_no_negatives():
    rng = np.random.default_rng(2)
    one = lambda x: np.column_stack((x, np.ones(len(x))))
    positive = one(rng.normal(1.5, 1, 3000))
    unlabelled = one(np.concatenate((rng.normal(1.5, 1, 1800), rng.normal(-1.5, 1, 1200))))
    w = Q.nn_pu(positive, unlabelled, 0.6)
    good, bad = one(rng.normal(1.5, 1, 2000)), one(rng.normal(-1.5, 1, 2000))
    assert ((good @ w > 0).mean() + (bad @ w < 0).mean()) / 2 > 0.9


def test_fit_of_a_tiny_case_equals_brute_force():
    """The least non-negative risk over a grid of all weights."""
    rng = np.random.default_rng(4)
    one = lambda x: np.column_stack((x, np.ones(len(x))))
    positive = one(rng.normal(1.0, 1, 60))
    unlabelled = one(np.concatenate((rng.normal(1.0, 1, 50), rng.normal(-1.0, 1, 50))))
    prior = 0.5

    def risk(w):
        gp, gu = positive @ w, unlabelled @ w
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        return prior * np.logaddexp(0, -gp).mean() + max(0.0, negative) + Q.DECAY / 2 * w @ w

    grid = np.linspace(-4, 4, 161)
    best = min(risk(np.array([a, b])) for a, b in itertools.product(grid, grid))
    assert risk(Q.nn_pu(positive, unlabelled, prior, steps=4000)) < best + 0.01
    table = np.column_stack((rng.normal(size=60), np.ones(60)))
    assert np.isfinite(Q.nn_pu(table[:30], table[30:], prior)).all()


def test_labels_of_fold_two_change_nothing(spark, corpus):
    docs, labels = corpus
    flipped = labels.collect()
    flipped = [(r[0], 1 - r[1] if fold(r[0]) == 2 else r[1], 0) for r in flipped]
    other = spark.createDataFrame(flipped, labels.schema)
    assert np.allclose(Q.fit(docs, labels).weights, Q.fit(docs, other).weights)
    assert np.allclose(R.fit(docs, labels).emission, R.fit(docs, other).emission)


def test_awkward_rows_get_scores(spark, corpus, awkward):
    docs, labels = corpus
    df = frame(spark, awkward).withColumn("score", F.lit("x")).withColumn("_id", F.lit(1))
    model = Q.fit(docs, labels)
    kept = Q.accepted(df, model, threshold=0.0)
    assert kept.columns == df.columns and kept.count() == len(awkward)
    empty = frame(spark, [])
    nothing = Q.fit(empty, labels)
    scores = df.select(Q.score(F.col("text"), nothing).alias("s")).collect()
    assert all(abs(r["s"] - Q.START_PRIOR) < 1e-9 for r in scores)
    assert Q.accepted(empty, model).count() == 0


def test_viterbi_equals_all_sequences():
    rng = np.random.default_rng(3)
    counts = np.array([4, 0, 1, 6, 3])
    scores, transition = rng.normal(size=(14, 2)), rng.normal(size=(2, 2))
    got, at = R.viterbi(scores, transition, counts), 0
    for n in counts:
        own = scores[at : at + n]

        def value(path):
            return sum(own[i, s] for i, s in enumerate(path)) + sum(transition[a, b] for a, b in zip(path, path[1:]))

        best = max(itertools.product((0, 1), repeat=n), key=value)
        assert tuple(got[at : at + n]) == best
        at += n


def test_training_climbs_to_the_likelihood_of_its_chains():
    rng = np.random.default_rng(4)
    counts = np.array([3, 5, 1, 4] * 20)
    labels = np.concatenate([np.repeat(rng.integers(0, 2), n) for n in counts])
    features = np.column_stack((labels * 2.0 - 1 + rng.normal(0, 1.5, len(labels)), np.ones(len(labels))))
    field = R.train(features, labels, counts)
    assert (field.decode(features, counts) == labels).mean() > 0.9
    assert field.transition[0, 0] > field.transition[0, 1]


def test_counts_and_verdicts(spark, corpus, awkward):
    docs, labels = corpus
    field = R.fit(docs, labels)
    rows = [*awkward, (30, prose(1, 200)), (31, " ".join(["buy now and win a big red car"] * 20)), (32, junk(9))]
    df = frame(spark, rows).withColumn("kept", F.lit(0)).withColumn("n_words", F.lit(0))
    found, name, failed, kept = R.judged(df, field)
    got = {r["doc_id"]: r for r in found.select("doc_id", F.col(name).alias("m"), failed.alias("f"), kept.alias("k")).collect()}
    assert (got[3]["m"]["n_words"], got[3]["f"], got[3]["k"]) == (0, True, False)
    assert got[30]["k"] and not got[30]["f"]
    assert got[31]["f"] and got[31]["m"]["n_repeat_words"] == 160
    assert not got[32]["f"] and not got[32]["k"]
    assert R.retained(df, field).columns == df.columns
    assert found.count() == len(rows)
    nothing = R.fit(frame(spark, []), labels)
    assert frame(spark, [(1, prose(1, 50))]).transform(lambda d: R.retained(d, nothing)).count() == 1


def test_given_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    model = Q.fit(docs, labels)
    scored, name = with_column(docs, Q.score(F.col("text"), model))
    both = scored.join(labels, "doc_id").select("doc_id", "quality", name).collect()
    held = [(r["quality"], r[name] >= Q.THRESHOLD) for r in both if fold(r["doc_id"]) == 2]
    assert np.mean([q == p for q, p in held]) > 0.95
