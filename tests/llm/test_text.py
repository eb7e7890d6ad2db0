from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from almanack.llm import features as C
from almanack.llm import text as X

LETTERS = st.text(alphabet="ab \t\n\x0b\r#*!éÉ日😀Z.", max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), LETTERS), max_size=12), st.integers(1, 200))
def test_words_and_hashes(texts, size):
    found, hashes = [], {}
    for part in X.slices(pa.array(texts, pa.string()), size):
        starts, ends, first = part.runs(X.SPACE[part.data])
        h = part.hashes(part.sums(), starts, ends)
        raw = part.data.tobytes()
        for i in range(part.n):
            own = [raw[a:b].decode() for a, b in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]])]
            for w, x in zip(own, h[first[i] : first[i + 1]].tolist()):
                assert hashes.setdefault(w, x) == x
            found.append(own)
    assert found == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert len(set(hashes.values())) == len(hashes)


def counted(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    hit = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            hit |= set(range(i, i + 8))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


@settings(max_examples=150, deadline=None)
@given(st.lists(LETTERS, max_size=8))
def test_counts_equal_brute_force(texts):
    for part in X.slices(pa.array(texts, pa.string()), 300):
        c = C.Counted(part)
        for i in range(part.n):
            got = (
                c.n_words[i],
                c.per_text(C.CLASS["lead"] & ~X.SPACE)[i],
                c.per_text(C.CLASS["symbol"])[i],
                c.n_dup_lines[i],
                c.per_text_words(c.repeated)[i],
            )
            assert got == counted(part[i].decode())


def test_repeated_windows():
    text = "a b c d e f g h i a b c d e f g h z"
    for part in X.slices(pa.array([text, "q " * 30, text + " " + text])):
        c = C.Counted(part)
        assert c.per_text_words(c.repeated).tolist() == [counted(part[i].decode())[4] for i in range(3)]


def test_ranges():
    assert X.ranges(np.array([5, 0, 9]), np.array([2, 0, 3])).tolist() == [5, 6, 9, 10, 11]


def test_remembered_forgets():
    calls = []

    def encode(words):
        calls.append(len(words))
        return [[len(w)] for w in words]

    memory = X.Remembered(encode, entries=4)
    for text in ("a bb a", "bb ccc", "dddd eeeee f gg", "a"):
        for part in X.slices(pa.array([text])):
            starts, ends, _ = part.runs(X.SPACE[part.data])
            ids, lengths = memory.of(part, starts, ends)
            assert ids.tolist() == [len(w) for w in text.split()] and set(lengths.tolist()) == {1}
    assert calls == [2, 1, 4, 1]


def test_words_of_one_hash_are_told_apart(monkeypatch):
    weak = lambda self, sums, starts, ends: (ends - starts).astype(np.uint64) % np.uint64(2)
    monkeypatch.setattr(X.Texts, "hashes", weak)
    memory = X.Remembered(lambda words: [list(w.encode()) for w in words])
    long = [f"{k}2345678{m}0123456789abcd{k}" for k in "abc" for m in "xyz"]
    for text in ("a bb ccc a dd", "ccc e bb", "ff", "bb a g", " ".join(long), "12345678 123456789 2345678912345678 " + long[4]):
        (part,) = X.slices(pa.array([text]))
        starts, ends, _ = part.runs(X.SPACE[part.data])
        ids, counts = memory.of(part, starts, ends)
        assert ids.tolist() == list(text.replace(" ", "").encode())
        assert counts.tolist() == [len(w) for w in text.split()]


def test_a_full_memory_keeps_what_was_asked_for_again():
    asked = []
    memory = X.Remembered(lambda words: asked.extend(words) or [list(w.encode()) for w in words], entries=40)
    common = ["often", "a_word_of_more_than_sixteen_letters", "x"]
    for turn in range(30):
        words = [*common, *[f"rare{turn}_{k}" for k in range(9)], f"another_quite_long_word_number_{turn}"]
        (part,) = X.slices(pa.array([" ".join(words)]))
        starts, ends, _ = part.runs(X.SPACE[part.data])
        ids, counts = memory.of(part, starts, ends)
        assert ids.tolist() == list("".join(words).encode()) and counts.tolist() == [len(w) for w in words]
        assert len(memory.hashes) <= 40
    assert [asked.count(w) for w in common] == [1, 1, 1] and len(asked) == 3 + 30 * 10


def test_new_words_are_encoded_in_lots():
    """A tokenizer's own form of a word is large, so few of them may exist at once."""
    asked = []
    memory = X.Remembered(lambda words: asked.append(len(words)) or [list(w.encode()) for w in words])
    words = [f"word{k}" for k in range(3 * X.ENCODED + 1)]
    (part,) = X.slices(pa.array([" ".join(words)]))
    starts, ends, _ = part.runs(X.SPACE[part.data])
    ids, counts = memory.of(part, starts, ends)
    assert ids.tolist() == list("".join(words).encode()) and counts.tolist() == [len(w) for w in words]
    assert sum(asked) == len(words) and max(asked) <= X.ENCODED


def test_a_column_grows_in_place():
    column = X.Grown(np.int32)
    parts = [np.arange(k) + k for k in (3, 0, 70_000, 5, 200_000)]
    for part in parts:
        column.add(part)
    assert len(column) == 270_008 and column[np.arange(len(column))].tolist() == np.concatenate(parts).tolist()
    column.hold(column[np.array([1, 4])])
    assert len(column) == 2 and column[np.array([0, 1])].tolist() == [4, 70_001]
