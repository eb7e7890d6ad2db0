from __future__ import annotations

import importlib
import sys
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from almanack.llm import sharding
from tests.llm.conftest import frame, prose


def check(got, rows, shards):
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert {(r["law"], r["grown_shard"]) for r in got} <= {("rows", None)}
    return slots


def test_awkward_rows(spark, awkward):
    df = frame(spark, awkward).withColumn("shard", F.lit(1)).withColumn("row", F.lit(2)).withColumn("group", F.lit(3))
    got = sharding.sharded(df).collect()
    check(got, awkward, 16)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in awkward)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert sharding.sharded(df.limit(0)).count() == 0


def test_copies_stay_together(spark):
    rows = [(i, f"text {i if i % 4 else i // 40}") for i in range(1200)]
    got = sharding.sharded(frame(spark, rows), shards=8).collect()
    check(got, rows, 8)
    text = dict(rows)
    homes = defaultdict(set)
    for r in got:
        homes[text[r["doc_id"]]].add(r["shard"])
    groups = {t for t, n in Counter(text.values()).items() if n > 1}
    assert sum(len(homes[t]) == 1 for t in groups) >= 0.9 * len(groups)


def test_a_group_with_a_third_of_the_rows(spark):
    rows = [(i, "same" if i % 3 == 0 else f"own {i}") for i in range(1500)]
    got = sharding.sharded(frame(spark, rows)).collect()
    check(got, rows, 16)
    hot = Counter(r["shard"] for r in got if r["doc_id"] % 3 == 0)
    # 500 copies need six shards of 94; most of them are in these.
    assert sum(n for _, n in hot.most_common(6)) >= 0.75 * 500


@pytest.fixture(scope="module")
def corpus(tmp_path_factory, spark):
    folder = str(tmp_path_factory.mktemp("corpus"))
    shout = lambda i: " ".join(w.upper() + "!!" for w in prose(i, 90).split())
    rows = [(i, prose(i, 150) if i % 6 else shout(i)) for i in range(400)]
    rows += [(1000 + i, rows[i][1].replace(" ", "  ")) for i in range(1, 60)]  # equal but for white space
    rows += [(2000 + i, rows[i][1] + " altered") for i in range(1, 60)]
    rows += [(3000, "too short"), (3001, None), (3002, "")]
    docs = frame(spark, rows).withColumn("extra", F.lit("e"))
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i % 6 > 0), 0) for i in range(0, 400, 2)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, docs


def test_stages(spark, corpus):
    folder, docs = corpus
    kept = docs
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, folder)
        assert kept.columns == docs.columns
        left[name] = {r["doc_id"] for r in kept.select("doc_id").collect()}
    clean = {i for i in range(400) if i % 6}
    assert left["quality_classifier"] & set(range(400)) == clean
    assert {3000, 3001, 3002} & left["quality_rules"] == set()
    assert left["quality_rules"] >= clean
    assert left["exact_dedup"] & set(range(400, 2000)) == {1000 + i for i in range(1, 60) if i % 6}
    assert not left["exact_dedup"] & set(range(60))  # the longer copies stay
    # One of each document, its spaced copy and its altered copy.
    assert len(left["minhash_near_dedup"]) == len(clean)
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in pieces} == left["minhash_near_dedup"]


def test_the_rest_does_without(monkeypatch):
    for name in list(sys.modules):
        if name.startswith("almanack.llm") or name in ("corpus_pipeline", "__spark_entry__"):
            monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "almanack.llm", None)
    entry = importlib.import_module("__spark_entry__")
    assert "mart_generation_demand_summary" in entry.queries()
    assert not any(q.startswith("op") for q in entry.queries())
    monkeypatch.delitem(sys.modules, "__spark_entry__")
