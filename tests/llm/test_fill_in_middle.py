from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from almanack.llm import fill_in_middle as fim
from tests.llm.conftest import frame, prose


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def run(df, **options):
    found, v = fim.transformed(df, **options)
    back = fim.restored(F.col(v)["output"], F.col(v)["form"])
    return [(r["doc_id"], *r[v], r["back"], r["text"]) for r in found.withColumn("back", back).collect()]


def order(rows):
    return sorted(rows, key=repr)


def test_matches_brute_force(spark, awkward):
    rows = [*awkward, *[(100 + i, prose(i, 5 + i)) for i in range(120)]]
    rows += [(300, "a<P>b"), (301, "a<S"), (302, "<M>"), (303, "<P<S<M"), (304, "\r\n \x85 $1 \\2"), (305, "x")]
    rows += [(400 + i, "😀é\n" * i) for i in range(1, 40)]
    got = run(frame(spark, rows))
    assert order(r[:6] for r in got) == order(brute(*r) for r in rows)
    assert all(r[6] == (r[7] or "") for r in got)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_long_texts_are_counted_by_blocks(spark):
    rows = [(i, ("ab😀\n" * 3000)[: 1024 * 8 + i - 1]) for i in range(3)] + [(7, "é" * 2_000_000)]
    got = run(frame(spark, rows))
    assert order(r[:6] for r in got) == order(brute(*r) for r in rows)


def test_markers_half_written_at_the_cuts_are_no_markers(spark):
    rows = [(i, "<P<S<M>S>P>M<<>"[: 2 + i % 14] * (1 + i % 3)) for i in range(400)]
    got = run(frame(spark, rows))
    assert order(r[:6] for r in got) == order(brute(*r) for r in rows)
    assert all(r[6] == r[7] for r in got)


@pytest.mark.parametrize("kind", ["line", "word"])
def test_other_units_make_up_the_text(spark, kind):
    rows = [(i, prose(i, 60) + "\n" * (i % 3)) for i in range(40)] + [(99, " \n\n "), (98, "")]
    split = {"line": r"[^\n]*\n|[^\n]+", "word": r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+"}[kind]
    for r in run(frame(spark, rows), unit=fim.UNITS[kind]):
        units = re.findall(split, r[7])
        assert "".join(units) == r[7] and len(units) == r[1]
        if r[2] == "psm":
            a, b = r[3], r[3] + r[4]
            assert r[5] == f"<P>{''.join(units[:a])}<S>{''.join(units[b:])}<M>{''.join(units[a:b])}"
        assert r[6] == r[7]


def test_columns_of_any_name_and_empty_tables(spark):
    df = frame(spark, [(1, "abc"), (1, "abc"), (1, "abcdef")])
    df = df.withColumn("form", F.lit(1)).withColumn("n", F.lit("x")).withColumn("output", F.lit(2))
    found, v = fim.transformed(df)
    assert found.columns == [*df.columns, v] and found.count() == 3
    assert fim.transformed(df.limit(0))[0].count() == 0
    ids = spark.createDataFrame([("a", "some text"), (None, None)], "doc_id string, text string")
    assert order(r[:6] for r in run(ids)) == order([brute("a", "some text"), brute(None, None)])
