from __future__ import annotations

import random
import zlib

import pytest

from almanack.session import local_session

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        "4",
        **{
            "spark.sql.shuffle.partitions": "3",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    return session


def fold(doc_id) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 4


def frame(spark, rows):
    """Documents of (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed: int, words: int, letters: str = "aeioulnrst") -> str:
    rng = random.Random(seed)
    out = []
    while len(out) < words:
        size = rng.randint(4, 9)
        out += ["".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(size)]
        out[-1] += rng.choice([".", ".\n"])
    return " ".join(out[:words])


@pytest.fixture(scope="session")
def awkward():
    """Nulls, empty and long texts, repeated rows, ties, odd characters."""
    long = prose(5, 20_000)
    return [
        (1, "one two three four five six seven eight nine ten"),
        (2, "one two three four five six seven eight nine ten"),
        (2, "one two three four five six seven eight nine ten"),
        (3, None),
        (4, ""),
        (5, " \t\n"),
        (None, "no identity here at all, none"),
        (None, None),
        (6, long),
        (7, long + " tail"),
        (8, "ONE two\x00 three▁four \U0001f600 éÉ 日本語"),
        (9, "x" * 5000),
        (10, "- " * 3000),
        (11, "!!!"),
    ]
