from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from almanack.llm import language_id as L
from almanack.llm import language_model as M
from almanack.llm import text as X
from almanack.llm.tables import with_column
from tests.llm.conftest import fold, frame, prose


def brute_grams(text):
    data = b" " + bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in text.encode()) + b" "
    return [data[i : i + 4] for i in range(len(data) - 3) if data[i : i + 4].strip(b" ")]


def test_grams_equal_brute_force():
    texts = ["", "a", "ab c!d", "x" * 50, "日本 é", "", "!!", "one two"]
    for part in X.slices(pa.array(texts), 40):
        values, first = L.grams(part)
        for i in range(part.n):
            own = [int(v).to_bytes(4, "little") for v in values[first[i] : first[i + 1]]]
            assert own == brute_grams(part[i].decode())


def test_filters_return_all_languages_of_a_gram():
    rng = np.random.default_rng(1)
    names = [f"l{i:03}" for i in range(70)]
    held = {n: rng.integers(0, 2**32, 500, dtype=np.uint32) for n in names}
    filters = L.Filters.of(names, names[0], held)
    assert len(filters.slices) == 2
    for i in (0, 63, 64, 69):
        at = L._slots(held[names[i]])
        mask = filters.slices[i // 64][at[0]].copy()
        for more in at[1:]:
            mask &= filters.slices[i // 64][more]
        assert (mask >> mask.dtype.type(i % 64) & mask.dtype.type(1)).all()
    assert filters.chance.max() < 1e-6


@pytest.fixture(scope="module")
def learnt(spark):
    alphabets = {"aa": "aeioulnrst", "bb": "aeouzkwpyj", "cc": "éèaunçtels"}
    rows = [(i, prose(i, 60, alphabets[k]), k) for i, k in enumerate(list(alphabets) * 100)]
    docs = frame(spark, rows)
    return docs, rows, L.fit(docs)


def test_held_out_languages(spark, learnt):
    docs, rows, filters = learnt
    found, name = with_column(docs, L.predict(F.col("text"), filters))
    wanted = {i: k for i, _, k in rows}
    for r in found.collect():
        assert r[name]["lang_pred"] == wanted[r["doc_id"]] and 0.5 < r[name]["score"] <= 1


def test_language_of_awkward_rows(spark, learnt, awkward):
    df = frame(spark, awkward).withColumn("lang_pred", F.lit(1))
    found, name = with_column(df, L.predict(F.col("text"), learnt[2]))
    for r in found.collect():
        has = bool(re.search(r"[^\W\d_]", r["text"] or ""))
        assert (r[name]["lang_pred"] == "und") == (not has)
        assert 0 <= r[name]["score"] <= 1
    nothing = L.fit(frame(spark, []))
    assert {r[0]["lang_pred"] for r in df.select(L.predict(F.col("text"), nothing)).collect()} == {"und"}


def test_fold_two_is_not_learnt(spark, learnt):
    docs, rows, filters = learnt
    other = frame(spark, [(i, t, "zz" if fold(i) == 2 else k) for i, t, k in rows])
    assert L.fit(other).languages == filters.languages


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_scores(rows, order):
    own = [[Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) for k in range(1, order + 1)] for w in rows]
    total = [sum((o[k] for o in own), Counter()) for k in range(order)]
    size = sum(map(len, rows))
    out = []
    for w, counts in zip(rows, own):
        rest, score, backed = max(size - len(w), 1), 0.0, 0

        def other(gram):
            return total[len(gram) - 1][gram] - counts[len(gram) - 1][gram]

        def value(gram):
            if len(gram) == 1:
                return (other(gram) or M.BACKOFF) / rest
            if other(gram):
                return other(gram) / other(gram[:-1])
            return M.BACKOFF * value(gram[1:])

        for i in range(len(w)):
            gram = tuple(w[max(0, i - order + 1) : i + 1])
            backed += not other(gram)
            score += math.log(value(gram))
        out.append((len(w), backed, score / len(w) if w else None))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force(spark, awkward, order, monkeypatch):
    rows = [*awkward[:8], (None, "Ten nine one two three"), (40, "to be or not to be or to do")]
    rows += [(100 + i, prose(i % 7, 30)) for i in range(20)]
    monkeypatch.setattr(M, "BUCKET_WORDS", 100)
    got = M.scored(frame(spark, rows).withColumn("chunk", F.lit(1)), order=order).collect()
    want = brute_scores([words(t) for _, t in rows], order)
    want = Counter((i, n, b, None if s is None else round(s, 9)) for (i, _), (n, b, s) in zip(rows, want))
    assert Counter((r[0], r[1], r[2], None if r[3] is None else round(r[3], 9)) for r in got) == want


def test_scores_of_nothing(spark):
    assert M.scored(frame(spark, [])).count() == 0
    assert M.scored(frame(spark, [(1, None)])).collect()[0]["score"] is None
    one = M.scored(frame(spark, [(1, "a b")])).collect()[0]
    assert one["n_backoff"] == 2


@pytest.mark.parametrize("order", [1, 2, 3])
def test_joins_give_the_same_scores(spark, awkward, order):
    rows = [*awkward, *[(100 + i, prose(i % 9, 20 + i)) for i in range(30)]]
    df = frame(spark, rows)
    key = lambda r: (str(r["doc_id"]), r["n_words"], r["n_backoff"], None if r["score"] is None else round(r["score"], 9))
    packed, joined = (sorted(map(key, f(df, order=order).collect()), key=repr) for f in (M.scored, M.scored_by_join))
    assert packed == joined


def test_ids_of_any_type_are_scored(spark):
    df = spark.createDataFrame([("x", "a b a b"), ("y", "a b"), (None, "b")], "doc_id string, text string")
    assert {r["doc_id"] for r in M.scored(df).collect()} == {"x", "y", None}
