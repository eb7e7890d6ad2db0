from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from almanack.llm import suffix_dedup as sd
from tests.llm.conftest import frame, prose


def brute(rows, length=100):
    """Rows of different (id, text), None after all ids."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - length + 1):
            window = data[p : p + length]
            if window in seen:
                gone[p : p + length] = True
            seen.add(window)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(int), [0]))))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), int(gone.sum()), spans, kept))
    return sorted(out, key=repr)


def got(df, length=100):
    found, v = sd.cleaned(df, length=length)
    rows = [(r["doc_id"], r[v]) for r in found.collect()]
    return sorted(
        ((i, c["n_bytes"], c["n_removed"], [tuple(s) for s in c["spans"]], bytes(c["kept"])) for i, c in rows), key=repr
    )


def corpus(seed=1):
    rng = random.Random(seed)
    passage, line = prose(50, 60), prose(51, 25) + "\n"
    rows = [(i, prose(i, rng.randint(1, 120))) for i in range(40)]
    rows += [(100 + i, f"{prose(500 + i, rng.randint(1, 30))} {passage} {prose(700 + i, 20)}") for i in range(25)]
    rows += [(200 + i, passage[rng.randint(0, 120) : rng.randint(200, 400)]) for i in range(20)]
    rows += [(300 + i, line * rng.randint(1, 6) + prose(i, 9)) for i in range(8)]
    rows += [(400 + i, rows[i][1]) for i in range(0, 40, 7)]
    for i in range(12):  # near copies
        words = rows[i + 2][1].split(" ")
        words[rng.randrange(len(words))] = "changed"
        rows.append((500 + i, " ".join(words)))
    rows += [(600, "ab" * 300), (601, "ab" * 130 + "c" + "ab" * 60), (602, "z" * 400), (603, "é" * 120 + "日本語" * 60)]
    rng.shuffle(rows)
    return rows


def test_matches_brute_force(spark, awkward):
    rows = corpus() + [(i, t) for i, t in dict.fromkeys(awkward) if i not in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11)]
    rows += [(2000, "x" * 5000), (2001, "- " * 3000), (2002, None), (2003, ""), (2004, prose(5, 4000)), (2005, prose(5, 4000) + "!")]
    assert got(frame(spark, rows)) == brute(rows)


@pytest.mark.parametrize("chunk", [1, 3])
def test_hot_anchors_are_dealt_out(spark, monkeypatch, chunk):
    monkeypatch.setattr(sd, "CHUNK", chunk)
    monkeypatch.setattr(sd, "GROUP", 5)
    rows = corpus(2)
    assert got(frame(spark, rows)) == brute(rows)


def test_spans_that_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(sd, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(sd, "BLOCK", 150)
    monkeypatch.setattr(sd, "CHUNK", 2)
    rows = corpus(3)
    assert got(frame(spark, rows)) == brute(rows)


@pytest.mark.parametrize("length", [8, 30])
def test_other_lengths(spark, length):
    rows = [(i, prose(i, 40, "ab")) for i in range(20)]
    assert got(frame(spark, rows), length) == brute(rows, length)


def test_colliding_hashes_do_no_harm(monkeypatch):
    """A hash that sees the first two bytes of every sixteen only."""
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab") for _ in range(60)) for _ in range(30)] * 2
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    at = np.arange(0, len(data), 60)
    monkeypatch.setattr(sd.Suffixes, "_hash", lambda self, at, size: self.data[at].astype(int) * 100 + size // 16)
    order, same = sd.Suffixes(data, 40).settled(at, np.zeros(len(at), np.int64))
    cut = [t[:40] for t in texts]
    assert [cut[i] for i in order] == sorted(cut)
    assert same.tolist() == [a == b for a, b in zip(sorted(cut), sorted(cut)[1:])] + [False]


def test_sort_and_extension_of_suffixes():
    rng = random.Random(8)
    text = "".join(rng.choice("ab") for _ in range(1200)).encode() + b"b" * 200
    at = np.arange(len(text) - 100)
    sort = sd.Suffixes(np.frombuffer(text, np.uint8), 100)
    for k in range(200):
        a, b = rng.randrange(len(at)), rng.randrange(len(at))
        common = next((i for i in range(100) if text[a + i] != text[b + i]), 100)
        assert sort.extension(np.array([a]), np.array([b]))[0] == common
    segment = np.sort(at % 3)
    at = np.concatenate([at[at % 3 == s] for s in range(3)])
    order = sort.sort(at, segment)
    want = sorted(range(len(at)), key=lambda k: (segment[k], text[at[k] : at[k] + 100], k))
    assert order.tolist() == want


def test_rows_that_repeat_an_id(spark):
    a, b = prose(1, 40), prose(2, 40)
    rows = [(1, a), (1, a), (1, a), (2, b + a), (None, a), (None, a), (3, "short"), (3, "short"), (4, b), (4, a[:150])]
    found = got(frame(spark, rows))
    size = len(a)
    assert [r[2] for r in found if r[0] == 1] == [0, size, size] or sorted(r[2] for r in found if r[0] == 1) == [0, size, size]
    assert [r[2] for r in found if r[0] is None] == [size, size]
    assert [r[2] for r in found if r[0] == 3] == [0, 0]
    assert [r[2] for r in found if r[0] == 2] == [size]
    assert sorted(r[2] for r in found if r[0] == 4) == sorted([len(b), 150])
    assert all(len(r[4]) == r[1] - r[2] for r in found)


def test_two_texts_under_one_id_are_two_documents(spark):
    a = prose(1, 40)
    found = got(frame(spark, [(7, a + " one"), (7, a + " two")]))
    assert sorted(r[2] for r in found) == [0, len(a) + 1]  # which comes first is decided by a hash


def test_columns_of_any_name_ids_of_any_type_and_empty_tables(spark):
    a = prose(1, 60)
    df = spark.createDataFrame([("b", a, 1), ("a", a, 2), (None, a, 3)], "doc_id string, text string, id int")
    df = df.withColumn("begins", F.lit(1)).withColumn("cut", F.lit(2)).withColumn("fp", F.lit("x"))
    found, v = sd.cleaned(df)
    assert found.columns == [*df.columns, v]
    assert {(r["doc_id"], r["id"]): r[v]["n_removed"] for r in found.collect()} == {
        ("a", 2): 0, ("b", 1): len(a), (None, 3): len(a)
    }
    assert sd.cleaned(df.limit(0))[0].count() == 0


def test_settle_keeps_rows_apart():
    piece = prose(1, 60).encode()[:120]
    rows = [(False, 5, 3, i, 0, 10 * i, piece if i < 2 else piece[:119] + b"#") for i in range(3)]
    names = ["hot", "m", "at", "id", "fp", "start", "piece"]
    table = pa.table({n: pa.array([r[k] for r in rows]) for k, n in enumerate(names)})
    out = sd.settle(table).to_pylist()
    assert [(r["id"], r["start"], r["size"]) for r in out] == [(1, 10, 21), (2, 20, 20)]


def test_memory_of_a_slice_is_bounded():
    """Windows are looked at in lots of a few megabytes, however many there are."""
    import tracemalloc

    rng = np.random.default_rng(3)
    data = rng.integers(97, 123, 100_000).astype(np.uint8)
    suffixes = sd.Suffixes(data, 100)
    at = np.arange(40_000)
    at = at[np.argsort(np.lib.stride_tricks.sliding_window_view(data, 100)[:40_000].copy().view("S100").ravel())]
    tracemalloc.start()
    same, wrong = suffixes.equal_to_next(at, np.zeros(len(at), np.int64))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert not same.any() and not len(wrong)
    assert peak < 12_000_000
