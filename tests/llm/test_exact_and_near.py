from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from almanack.llm import exact_dedup, near_dedup
from almanack.llm import text as X
from tests.llm.conftest import frame, prose


def exact(df):
    found, name = exact_dedup.grouped(df)
    return sorted((r["doc_id"], *r[name]) for r in found.where("doc_id is not null").collect())


def brute_exact(rows):
    groups = defaultdict(list)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    for i, t in rows:
        groups[norm(t)].append((-len(t or ""), i is None, i))
    best = {k: (min(v, key=lambda x: (x[0], x[1], x[2] or 0))[2], len(v)) for k, v in groups.items()}
    return {(i, *best[norm(t)]) for i, t in rows}


def test_exact_matches_brute_force(spark, awkward):
    rows = [*awkward, (20, "a b"), (21, "ab "), (22, "a  b"), (23, "ab\n\t")]
    found, name = exact_dedup.grouped(frame(spark, rows))
    got = {(r["doc_id"], r[name]["keep_id"], r[name]["group_size"]) for r in found.collect()}
    assert got == brute_exact(rows)
    assert found.count() == len(rows)


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_colliding_hashes_are_told_apart(spark, awkward, bits):
    weak = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << bits)).cast("string").cast("binary")
    found, name = exact_dedup.grouped(frame(spark, awkward), content_hash=weak)
    got = {(r["doc_id"], r[name]["keep_id"], r[name]["group_size"]) for r in found.collect()}
    assert got == brute_exact(awkward)


def test_exactly_one_row_of_each_text_stays(spark, awkward):
    rows = [*awkward, (5, "a b c"), (5, "abc"), (7, "zz"), (7, "zz"), (7, "z z"), (None, "q"), (None, "q"), *[(9, "hot")] * 50]
    df = frame(spark, rows)
    left = [re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "") for r in exact_dedup.deduplicate(df).collect()]
    assert sorted(left) == sorted({re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows})
    found, name = exact_dedup.grouped(df)
    got = [(r["doc_id"], r["text"], r[name]["kept"]) for r in found.collect()]
    assert sorted(k for i, t, k in got if (i, t) == (5, "abc")) == [False]
    assert sorted(k for i, t, k in got if i == 7 and t == "z z") == [True]
    assert sum(k for i, t, k in got if t == "hot") == 1 and len(got) == len(rows)
    weak = lambda c: F.lit("same").cast("binary")
    found, name = exact_dedup.grouped(df, content_hash=weak)
    assert found.where(F.col(name)["kept"]).count() == len(left)


def test_single_texts_are_not_shuffled(spark):
    """Beside ids and hashes only texts that occur twice are moved, and few verdicts are broadcast."""
    found, name = exact_dedup.grouped(frame(spark, [(i, f"text {i // 2}") for i in range(100)]))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_exact_keeps_columns_of_any_name(spark):
    df = frame(spark, [(1, "a"), (2, "a"), (3, "b")]).withColumn("kept", F.lit("x")).withColumn("keep_id", F.lit(7))
    left = exact_dedup.deduplicate(df)
    assert left.columns == df.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 3]
    assert exact_dedup.deduplicate(df.limit(0)).count() == 0


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_near(rows):
    """Rows are nodes of their own, linked also to rows of equal sets."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = list(range(len(sets)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:k]):
            if a and 100 * len(a & b) >= 75 * len(a | b):
                parent[top(k)] = top(j)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[top(k)] = min(i, least.get(top(k), i))
    return sorted((i, len(s), least[top(k)]) for k, (i, s) in enumerate(sets))


def edited(text, seed, share):
    rng = np.random.default_rng(seed)
    words = text.split()
    for at in rng.choice(len(words), int(len(words) * share), replace=False):
        words[at] = f"w{seed}x{at}"
    return " ".join(words)


def near(df):
    rows = near_dedup.near_duplicates(df).where("doc_id is not null").collect()
    for r in rows:  # with one text for each id, this is what staying means
        assert r["component_id"] == r["doc_id"] or not r["kept"]
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows)


def test_near_matches_brute_force(spark, awkward):
    rows = list(awkward)
    for g in range(12):
        base = prose(100 + g, 120)
        rows += [(1000 * g + 100 + k, edited(base, k, 0.012 * (k % 4))) for k in range(6)]
    chain = prose(7, 200).split()  # neighbours alike, the ends not
    rows += [(50_000 + k, " ".join(chain[8 * k : 8 * k + 90])) for k in range(10)]
    assert near(frame(spark, rows)) == brute_near(rows)


@pytest.mark.parametrize("many", [1, 6])
def test_crowded_buckets_equal_brute_force(spark, monkeypatch, many):
    """A passage that many documents share, and near copies among them."""
    monkeypatch.setattr(near_dedup, "MANY", many)
    passage = prose(900, 90)
    rows = [(i, f"{prose(2000 + i, 20 + i % 60)} {passage}") for i in range(80)]
    rows += [(100 + i, edited(rows[i][1], i, 0.01)) for i in range(0, 80, 3)]
    rows += [(300 + i, edited(passage, i, 0.03)) for i in range(25)]
    assert near(frame(spark, rows)) == brute_near(rows)


def test_small_sets_are_found(spark):
    rows = [(1, "a b c"), (2, "A B C"), (3, "a b"), (4, "a b c d e f g h i j k"), (5, "a b c d e f g h i j k l")]
    rows += [(6, "a b c d e f g h i j k l m n")]
    assert near(frame(spark, rows)) == brute_near(rows)


def test_large_group_of_near_copies(spark):
    base = prose(3, 150)
    rows = [(k, edited(base, k, 0.007)) for k in range(300)] + [(k + 1000, base) for k in range(200)]
    got = near(frame(spark, rows))
    assert got == brute_near(rows)
    assert len({r[2] for r in got}) == 1


def test_two_texts_under_one_id_are_two_nodes(spark):
    x, y, z = prose(11, 90), prose(12, 90), prose(13, 90)
    rows = [(3, x + " end"), (5, x), (5, y), (6, z), (6, z + " end"), (6, z.upper()), (7, y), (8, "a b c"), (8, "A B C")]
    df = frame(spark, rows)
    assert near(df) == brute_near(rows)
    left = [(r["doc_id"], r["text"]) for r in near_dedup.deduplicate(df).collect()]
    assert (5, y) in left and (3, x + " end") in left
    assert sorted(i for i, _ in left) == [3, 5, 6, 8]


def test_repeated_rows_leave_once(spark):
    x, y = prose(11, 90), prose(12, 90)
    rows = [(5, x), (5, x), (6, x), (7, y), (7, y), (7, y), (8, y + " end"), (9, None), (9, None), (None, x), (None, x)]
    df = frame(spark, rows)
    assert near(df) == brute_near(rows)
    left = [r["doc_id"] for r in near_dedup.deduplicate(df).collect()]
    assert sorted(map(str, left)) == ["5", "7", "9", "9", "None", "None"]


def test_ids_of_any_type(spark):
    x, y = prose(11, 90), prose(12, 90)
    df = spark.createDataFrame([("b", x), ("a", x + " end"), ("c", y), ("10", y)], "doc_id string, text string")
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(df).collect()}
    assert got == {("b", "a", False), ("a", "a", True), ("c", "10", False), ("10", "10", True)}
    assert {r["doc_id"] for r in near_dedup.deduplicate(df).collect()} == {"a", "10"}


def test_near_dedup_keeps_one_and_all_columns(spark):
    base = prose(3, 100)
    df = frame(spark, [(1, base), (2, base + " end"), (3, prose(4, 100)), (None, base)])
    df = df.withColumn("component_id", F.lit("x")).withColumn("node", F.lit(1)).withColumn("band", F.lit(2))
    left = near_dedup.deduplicate(df)
    assert left.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["1", "3", "None"]
    assert near_dedup.deduplicate(df.limit(0)).count() == 0


def test_estimate_is_close_and_corrected():
    rng = np.random.default_rng(1)
    universe = X.mix(np.arange(3000, dtype=np.uint64))
    for shared in (0, 300, 600, 900):
        pairs = []
        for _ in range(20):
            pick = rng.permutation(universe)
            pairs.append((np.sort(pick[:1000]), np.sort(np.concatenate((pick[:shared], pick[1000 : 2000 - shared])))))
        a = near_dedup.sketches([p[0] for p in pairs])
        b = near_dedup.sketches([p[1] for p in pairs])
        size = np.full(20, 1000.0)
        found = near_dedup.estimates(a, b, size, size).mean()
        assert abs(found - shared / (2000 - shared)) < 0.03


def test_every_register_is_filled():
    sets = [X.mix(np.arange(n, dtype=np.uint64)) for n in (1, 2, 5, 50, 500)]
    assert (near_dedup.sketches(sets) > 0).all()


def test_components_of_a_long_chain(spark):
    links = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    links = links.unionByName(spark.createDataFrame([(100, 101), (101, 103)], "a bigint, b bigint"))
    got = {tuple(r) for r in near_dedup.components(links, "a", "b").collect()}
    assert got == {(i, 0) for i in range(61)} | {(100, 100), (101, 100), (103, 100)}
