from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from almanack.llm import packing
from almanack.llm import text as X
from almanack.llm.queries import tokenizer_path
from tests.llm.conftest import frame

PATH = tokenizer_path("word_bpe_49k.json")


def placed(plan, histogram):
    """(window, offset, length) of every piece of a plan."""
    seen, out = Counter(), []
    for length, first, last, window, each, offset in plan.rows:
        seen[length] += last - first
        out += [(window + j // each, offset + j % each * length, length) for j in range(last - first)]
    assert seen == Counter(histogram)
    return out


def best_fit_decreasing(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [r for r in rooms if r >= length]
        if fitting:
            rooms[rooms.index(min(fitting))] -= length
        else:
            rooms.append(capacity - length)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(25))
def test_plan_equals_piece_by_piece_search(seed):
    rng = random.Random(seed)
    capacity = rng.choice([8, 16, 50, 64])
    lengths = [rng.randint(1, rng.choice([capacity, capacity // 2])) for _ in range(rng.randint(0, 200))]
    plan = packing.Plan(capacity).place(dict(Counter(lengths)))
    windows = defaultdict(list)
    for window, offset, length in placed(plan, Counter(lengths)):
        windows[window].append((offset, length))
    rooms = []
    for pieces in windows.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
        rooms.append(capacity - end)
    assert len(windows) == plan.windows
    assert sorted(rooms) == best_fit_decreasing(lengths, capacity)


def test_room_finds_the_tightest():
    room, marked = packing.Room(20), set()
    rng = random.Random(1)
    for _ in range(300):
        value = rng.randint(0, 20)
        room.mark(value, value not in marked)
        marked ^= {value}
        least = rng.randint(0, 20)
        assert room.tightest(least) == min((m for m in marked if m >= least), default=None)


def test_ids_by_word_equal_ids_of_the_whole_text():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    rng = random.Random(2)
    letters = "abcdefgXYZ 's't're,.!?12é́ÉßΣΣ日本 　\n\t\x0b\x1c 😀<|endoftext|>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(500)]
    texts += ["<|endoftext|> a", "it's <|endoftext|>we'll", ""]
    words = packing._words(PATH)
    at = 0
    for part in X.slices(pa.array(texts), 2000):
        starts, ends, first = part.runs(X.SPACE[part.data])
        ids, per_word = words.of(part, starts, ends)
        cuts = np.concatenate(([0], np.cumsum(per_word)))[first]
        for i in range(part.n):
            whole = tokenizer.encode(texts[at], add_special_tokens=False).ids
            assert ids[cuts[i] : cuts[i + 1]].tolist() == whole, texts[at]
            at += 1


def test_every_id_lies_in_one_piece(spark, awkward):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    df = frame(spark, awkward)
    got = packing.packed(df.withColumn("length", df.doc_id).withColumn("_rank", df.doc_id), PATH).collect()
    want = Counter()
    for i, t in awkward:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for a in range(0, len(ids), 2048):
            part = ids[a : a + 2048]
            want[i, a, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter(tuple(r[:5]) for r in got) == want
    windows = defaultdict(list)
    for r in got:
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in windows.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 2048
    assert packing.packed(df.limit(0), PATH).count() == 0


def test_the_plan_starts_no_python_workers(spark):
    """A list of rows becomes a frame through Python workers of a second kind, which stay."""
    plan = packing.Plan(16).place({5: 7, 3: 2, 16: 1})
    made = spark.createDataFrame(plan.table())
    assert sorted(map(tuple, made.collect())) == sorted(plan.rows)
    assert "ExistingRDD" not in made._jdf.queryExecution().toString()
    assert spark.createDataFrame(packing.Plan(16).place({}).table()).collect() == []
