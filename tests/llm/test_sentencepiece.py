from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from almanack.llm import sentencepiece as S
from almanack.llm import text as X
from almanack.llm.queries import tokenizer_path
from tests.llm.conftest import frame

PATH = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def samples():
    rng = random.Random(1)
    letters = [chr(i) for i in range(32, 127)] + list("éüñß日本語中文 \n\t😀▁") + [" "] * 30
    out = ["", " ", "   ", "a" * 300, "日本語のテキスト" * 20, "<0x0A> <unk> <s>", "\x00 a", " " * 70 + "x", "foo▁ ▁bar"]
    out += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 90))) for _ in range(400)]
    out += ["".join(rng.choice("abcdeghinorst  ") for _ in range(rng.randint(0, 300))) for _ in range(100)]
    return out


def test_ids_equal_the_library(library):
    texts, at = samples(), 0
    for part in X.slices(pa.array(texts), 3000):
        ids, counts, _ = S._slice_ids(PATH, part)
        ends = np.concatenate(([0], np.cumsum(counts)))
        for i in range(part.n):
            assert ids[ends[i] : ends[i + 1]].tolist() == library.encode(texts[at]), texts[at]
            at += 1


def test_stream_equals_the_library_in_a_small_window(library):
    pieces = S.Pieces(PATH)
    for text in [t for t in samples() if t][:80] + ["hello world " * 200, "日本語abc" * 500]:
        spaced = S.SPACE + text.replace(" ", S.SPACE)
        parts = [spaced[i : i + 7] for i in range(0, len(spaced), 7)]
        assert list(S.stream_ids(pieces, parts)) == library.encode(text)
    stream = S.Stream(pieces)
    early = list(stream.feed(S.SPACE + "words and more words without end " * 300))
    assert len(early) > 1500 and stream.widest <= 4 * pieces.longest


def test_all_segments_pass_the_window(library, monkeypatch):
    """Ids come from commits inside a bounded window, side by side and alone."""
    pieces = S.Pieces(PATH)
    rng = random.Random(5)
    words = ["".join(rng.choice("aeinorst日é") for _ in range(rng.randint(1, 9))) for _ in range(500)]
    long = ["".join(rng.choice("aeinorstlmé") for _ in range(rng.randint(30, 400))) for _ in range(150)]
    segments = [S.SPACE + w for w in sorted(words + long, key=len, reverse=True)]
    for few in (0, 48, 10_000):
        monkeypatch.setattr(S, "FEW", few)
        lanes = S.Lanes(pieces, segments)
        assert [library.encode(s[1:]) for s in segments] == lanes.run()
        assert lanes.searched == len(segments) and lanes.widest <= 4 * pieces.longest
        characters = sum(map(len, segments))
        assert lanes.commits >= len(segments) + (characters - len(segments) * 2 * pieces.longest) / (2 * pieces.longest)


def test_paths_that_meet_late_widen_their_own_window(library, monkeypatch):
    monkeypatch.setattr(S, "met", lambda back, size, reach: np.zeros(back.shape[1], np.int64))
    monkeypatch.setattr(S, "FEW", 0)
    segments = [S.SPACE + "abcdefgh" * n for n in (30, 20, 10, 1, 1)]
    assert [library.encode(s[1:]) for s in segments] == S.Lanes(S.Pieces(PATH), segments).run()


def test_other_model_types_are_refused(tmp_path):
    data = bytearray(open(PATH, "rb").read())
    assert S.model_type(bytes(data)) == "merges"
    spec = next(v for n, v in S._fields(bytes(data)) if n == 2)
    at = bytes(data).index(spec) + spec.index(b"\x18\x02")
    data[at + 1] = 1
    assert S.model_type(bytes(data)) == "unigram"
    other = tmp_path / "other.model"
    other.write_bytes(data)
    with pytest.raises(ValueError, match="unigram"):
        S.Pieces(str(other))


def test_pairs_stay_apart_as_merging_says(library):
    pieces = S.Pieces(PATH)
    rng = random.Random(3)
    names = [n for n in pieces.ids if S.SPACE not in n and n.isascii()]
    for _ in range(2000):
        a, b = rng.choice(names), rng.choice(names)
        merged = [library.id_to_piece(i) for i in library.encode("é" + a + b)][-2:]
        if library.encode("é" + a + b)[:-2] == library.encode("é") and pieces.stay_apart(pieces.ids[a], pieces.ids[b]):
            assert merged == [a, b]


def test_round_trip_in_spark(spark, awkward, library):
    df = frame(spark, awkward).withColumn("ids", F.lit(1)).withColumn("d", F.lit(2))
    rows = {(r["doc_id"], r["n_ids"], r["ids_crc32"], r["round_trip"]) for r in S.digests(df, PATH).collect()}
    want = set()
    for i, t in awkward:
        ids = library.encode(t or "")
        want.add((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), S.SPACE not in (t or "")))
    assert rows == want
    back = df.select("text", S.decode(S.encode(F.col("text"), PATH), PATH).alias("back")).collect()
    assert all(r["back"] == (r["text"] or "").replace(S.SPACE, " ") for r in back)
    assert S.digests(df.limit(0), PATH).count() == 0
