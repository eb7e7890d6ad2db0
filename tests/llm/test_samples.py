from __future__ import annotations

import numpy as np
import pytest

from almanack.llm import language_id as L
from almanack.llm import quality_classifier as Q
from almanack.llm import quality_rules as R
from tests.llm.conftest import fold, frame, prose

LABELS = "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="module")
def rare(spark):
    """3,000 documents, of which 24 have a label."""
    rows = [(i, prose(i, 30) if i % 2 else prose(i, 30).replace(" ", " ### ")) for i in range(3000)]
    labels = [(i, i % 2, 0) for i in range(24)]
    return frame(spark, rows), labels


def test_rare_labels_are_all_used(spark, rare, monkeypatch):
    docs, labels = rare
    seen = {}
    keep = lambda p, u: seen.update(p=len(p), u=len(u)) or Q.Model(None, None, None, 0.5)
    monkeypatch.setattr(Q, "fit_arrays", keep)
    Q.fit(docs, spark.createDataFrame(labels, LABELS), fit_rows=100)
    assert seen["p"] == sum(q and fold(i) != 2 for i, q, _ in labels)
    assert 60 <= seen["u"] <= 140
    monkeypatch.setattr(R, "train", lambda f, y, n, **kw: seen.update(y=y, w=kw["weigh"]))
    R.fit(docs, spark.createDataFrame(labels, LABELS), fit_rows=100)
    assert set(seen["y"]) == {R.CONTENT, R.BOILERPLATE}
    assert np.allclose(seen["w"], 1)


def test_a_drawn_class_keeps_its_weight(spark, rare, monkeypatch):
    docs, _ = rare
    seen = {}
    monkeypatch.setattr(R, "train", lambda f, y, n, **kw: seen.update(w=kw["weigh"]))
    many = [(i, int(i % 100 > 0), 0) for i in range(3000)]
    R.fit(docs, spark.createDataFrame(many, LABELS), fit_rows=100)
    poor, good = (sum(q == k and fold(i) != 2 for i, q, _ in many) for k in (0, 1))
    assert poor < 100 < good and seen["w"].min() == 1 and 0.6 * good / 100 < seen["w"].max() < 1.6 * good / 100


def test_weights_stand_for_repeated_chains():
    rng = np.random.default_rng(5)
    counts = np.array([3, 5, 2])
    x, y = rng.normal(size=(10, 4)), np.repeat([0, 1, 0], counts)
    twice = R.train(np.concatenate((x, x[:3])), np.concatenate((y, y[:3])), np.array([3, 5, 2, 3]))
    once = R.train(x, y, counts, weigh=np.array([2.0, 1.0, 1.0]))
    # The penalty counts per chain, of which there are 4 and 3.
    assert np.allclose(twice.emission, once.emission, atol=1e-6)
    assert np.allclose(twice.transition, once.transition, atol=1e-6)


def test_no_positives_is_an_error(spark, rare):
    docs, labels = rare
    none = spark.createDataFrame([(i, 0, 0) for i in range(24)], LABELS)
    with pytest.raises(ValueError, match="positive"):
        Q.fit(docs, none)
    with pytest.raises(ValueError, match="good"):
        R.fit(docs, none)
    with pytest.warns(UserWarning, match="poor"):
        R.fit(docs, spark.createDataFrame([(i, 1, 0) for i in range(24)], LABELS))


def test_without_labels_queries_report_and_accept_nothing(spark, rare):
    docs, _ = rare
    none = spark.createDataFrame([], LABELS)
    some = docs.limit(20)
    with pytest.warns(UserWarning, match="positive"):
        model = Q.fit(docs, none, strict=False)
    assert Q.accepted(some, model).count() == 0
    with pytest.warns(UserWarning, match="good"):
        field = R.fit(docs, none, strict=False)
    found, name, _, kept = R.judged(some, field)
    assert {(r[name]["content_share"], r["k"]) for r in found.withColumn("k", kept).collect()} == {(0.0, False)}


def test_contradicting_labels_are_no_labels(spark, rare, monkeypatch):
    docs, _ = rare
    seen = {}
    monkeypatch.setattr(R, "train", lambda f, y, n, **kw: seen.update(y=y))
    both = [(i, q, 0) for i in range(12) for q in (0, 1)] + [(i, i % 2, 0) for i in range(12, 40)]
    R.fit(docs, spark.createDataFrame(both, LABELS), fit_rows=1000)
    left = [r for r in range(12, 40) if fold(r) != 2]
    assert len(seen["y"]) == sum(len([x for x in t.split("\n") if x.strip()]) for i, t in docs.select("doc_id", "text").collect() if i in left)


def test_long_documents_bring_a_bounded_number_of_lines(spark, monkeypatch):
    text = "\n".join(f"line {i} of a long document" for i in range(5000))
    docs = frame(spark, [(i, text) for i in range(6)] + [(10 + i, "short line\nand another") for i in range(6)])
    seen = {}
    monkeypatch.setattr(R, "train", lambda f, y, n, **kw: seen.update(n=n, w=kw["weigh"]))
    R.fit(docs, spark.createDataFrame([(i, 1 if i < 10 else 0, 0) for i in range(20)], LABELS))
    long = sum(fold(i) != 2 for i in range(6))
    runs = -(-5000 // R.RUN)
    assert (seen["n"] == R.RUN).sum() <= long * R.FIT_RUNS and seen["n"].sum() < long * R.FIT_RUNS * R.RUN + 100
    assert np.isclose(seen["w"].max(), runs / R.FIT_RUNS)


def test_languages_that_tie_go_to_the_first_name(spark):
    rows = [(i, prose(1, 30, "aeiou"), "bb") for i in range(30)] + [(100 + i, prose(1, 30, "aeiou"), "aa") for i in range(30)]
    rows = [r for r in rows if fold(r[0]) != 2]
    same = min(sum(r[2] == k for r in rows) for k in ("aa", "bb"))
    rows = [r for k in ("aa", "bb") for r in [x for x in rows if x[2] == k][:same]]
    assert L.fit(frame(spark, rows)).common == "aa"


def test_a_rare_language_is_learnt(spark):
    rows = [(i, prose(i, 30), "aa") for i in range(3000)]
    rows += [(5000 + i, prose(i, 30, "zkwpyj"), "zz") for i in range(6)] + [(None, prose(7, 30, "éèçö"), "yy")]
    filters = L.fit(frame(spark, rows), fit_rows=20)
    assert filters.languages == ["aa", "yy", "zz"] and filters.common == "aa"
