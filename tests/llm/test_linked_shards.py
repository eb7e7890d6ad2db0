from __future__ import annotations

import random
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from almanack.llm import sharding
from tests.llm.conftest import frame
from tests.llm.test_sharding_and_pipeline import check

TEXTS = {
    "pairs": ([f"t{i // 2}" for i in range(1600)], 0.97),
    # 94 rows hold four whole groups each: 16 of 75 groups do not fit a shard whole.
    "twenties": ([f"t{i // 20}" for i in range(1500)], 0.7),
    "a third and pairs": (["hot" if i < 533 else f"t{i // 2}" if i < 1550 else f"own {i}" for i in range(1600)], 0.95),
}


@pytest.mark.parametrize("name", TEXTS)
def test_where_nearly_all_rows_are_linked(spark, name):
    texts, wanted = TEXTS[name]
    rows = list(enumerate(texts))
    got = sharding.sharded(frame(spark, rows)).collect()
    check(got, rows, 16)
    homes = defaultdict(set)
    for r in got:
        homes[texts[r["doc_id"]]].add(r["shard"])
    groups = [t for t, n in Counter(texts).items() if 1 < n <= 90]
    assert sum(len(homes[t]) == 1 for t in groups) >= wanted * len(groups)


def test_full_shards_swap_in_a_ring():
    asked = np.zeros((3, 3, 2), np.int64)
    asked[0, 1, 0] = asked[1, 2, 0] = asked[2, 0, 0] = 5
    assert sharding.accepted(np.array([10, 10, 10]), asked, [10, 10, 10]) == ([2, 2, 2], [0.0, 0.0, 0.0])
    asked[2, 0, 0] = 0
    level, share = sharding.accepted(np.array([10, 10, 10]), asked, [10, 10, 10])
    assert level == [2, 0, 0] and share == [0.0, 0.0, 0.0]


def cut_links(groups, shard):
    """Pairs of equal texts in different shards."""
    return sum(a == b and shard[i] != shard[j] for i, a in enumerate(groups) for j, b in enumerate(groups[:i]))


def least_cut(groups, shards):
    """The smallest cut of any assignment with the same quotas, by trying all of them."""
    quota = sharding.quotas(len(groups), shards)
    # Shards of one size are alike, and so are rows of one group.
    best, seen = len(groups) ** 2, set()
    for sizes in set(permutations(quota)):
        for order in set(permutations([s for s, q in enumerate(sizes) for _ in range(q)])) if len(groups) <= 7 else ():
            key = tuple(sorted((g, s) for g, s in zip(groups, order)))
            if key not in seen:
                seen.add(key)
                best = min(best, cut_links(groups, order))
    return best


def test_cuts_of_small_inputs_are_near_the_least(spark):
    rng, ours, least = random.Random(2), [], []
    for case in range(10):
        groups = [f"g{rng.randint(0, 3)}" for _ in range(rng.randint(4, 7))]
        got = sharding.sharded(frame(spark, list(enumerate(groups))), shards=2).collect()
        shard = [r["shard"] for r in sorted(got, key=lambda r: r["doc_id"])]
        assert sorted(shard.count(s) for s in range(2)) == sorted(sharding.quotas(len(groups), 2))
        ours.append(cut_links(groups, shard))
        least.append(least_cut(groups, 2))
    assert all(a >= b for a, b in zip(ours, least))
    assert sum(ours) <= 1.5 * sum(least) + 2, (ours, least)


def test_large_groups_are_dealt_out_in_cells(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 50)
    rows = [(i, "hot" if i % 3 == 0 else f"text {i // 4}") for i in range(1200)]
    got = sharding.sharded(frame(spark, rows), shards=4).collect()
    assert [sum(r["shard"] == s for r in got) for s in range(4)] == [300] * 4
    for s in range(4):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(300))
    text, homes = dict(rows), {}
    for r in got:
        homes.setdefault(text[r["doc_id"]], []).append(r["shard"])
    assert len(homes["hot"]) == 400 and sum(len(set(h)) == 1 for t, h in homes.items() if t != "hot") > 0.9 * (len(homes) - 1)
