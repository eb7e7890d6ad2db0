from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from almanack.llm import spelling
from tests.llm.conftest import frame, prose


def brute_words(rows):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    words = brute_words(rows)
    near = {w: [v for v in words if is_near(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        if near[w]:
            best = min(near[w], key=lambda v: (-words[v], v))
            if words[best] >= 2 * n:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def got(df):
    return {tuple(r) for r in spelling.variants(df).collect()}


def test_matches_brute_force(spark, awkward):
    rng = random.Random(3)
    rows = [*awkward, *[(100 + i, prose(i, 400, "aaé")) for i in range(40)]]
    chain = ["colour"] * 200 + ["coloure"] * 90 + ["colouré"] * 30 + ["xcolouré"] * 12 + ["xcolourée"] * 5
    rng.shuffle(chain)
    rows += [(500 + i, " ".join(chain[i * 20 : i * 20 + 20])) for i in range(17)]
    rows += [(700, "École école ÉCOLE " * 3), (701, "aaaaa aaaab aaaba abaaa " * 4), (702, "listen silent enlist " * 3)]
    want = brute(rows)
    assert got(frame(spark, rows)) == want
    assert len({r[2] for r in want if r[1]}) > 2 and any(r[1] and r[1] != r[2] for r in want)


def test_every_edit_shares_a_signature(spark):
    rng = random.Random(9)
    letters = spelling.LETTERS
    pairs = []
    for _ in range(400):
        a = "".join(rng.choice(letters) for _ in range(rng.randint(5, 14)))
        at, c = rng.randrange(len(a)), rng.choice(letters)
        for b in (a[:at] + a[at + 1 :], a[:at] + c + a[at:], a[:at] + c + a[at + 1 :]):
            pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a string, b string")
    both = F.arrays_overlap(spelling.signatures(F.col("a")), spelling.signatures(F.col("b")))
    assert df.where(~both).count() == 0


def test_ties_and_damage(spark):
    rows = [(1, "hause house horse " * 6), (2, "hsuse " * 3)]
    assert got(frame(spark, rows)) == brute(rows)
    hit = next(i for i in range(10_000) if zlib.crc32(f"{i}:wonderful".encode()) % 97 == 0)
    rows = [(hit, "Wonderful WONDERFUL wonderful"), (hit + 1, "wonderful " * 8)]
    assert got(frame(spark, rows)) == brute(rows)
    assert any(r[1] == "wonderful" for r in got(frame(spark, rows)))


def test_other_columns_and_empty_tables(spark):
    df = frame(spark, [(1, "apple apple apple"), (1, "apple apple apple")])
    df = df.withColumn("word", F.lit(1)).withColumn("n", F.lit("x")).withColumn("size", F.lit(2))
    assert got(df) == {("apple", None, "apple", 6, 0, None)}
    assert got(df.limit(0)) == set()
    ids = spark.createDataFrame([("a", "apple " * 3), (None, None)], "doc_id string, text string")
    assert got(ids) == {("apple", None, "apple", 3, 0, None)}
