"""Counts over lines and documents that the quality operators build on."""

from __future__ import annotations

import numpy as np

from almanack.llm import text as X

WINDOW = 8
_PLACE = X.mix(np.arange(101, 101 + WINDOW, dtype=np.uint64)) | np.uint64(1)


def _classes() -> dict[str, np.ndarray]:
    def has(characters: str) -> np.ndarray:
        out = np.zeros(256, bool)
        out[[ord(c) for c in characters]] = True
        return out

    digits, upper = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lead = np.ones(256, bool)
    lead[0x80:0xC0] = False  # continuation bytes begin no character
    far = lead & (np.arange(256) >= 0x80)
    plain = has(digits + upper + upper.lower()) | X.SPACE | (np.arange(256) >= 0x80)
    return {
        "lead": lead,
        "space": X.SPACE,
        "symbol": has("#*$%&|<>"),
        "upper": has(upper),
        "lower": has(upper.lower()),
        "digit": has(digits),
        "far": far,
        "stop": has(".,;:"),
        "shout": has("!?"),
        "bracket": has("{}[]()=_\\/\"`~^@+"),
        "other": ~plain & (np.arange(256) < 0x80),
    }


CLASS = _classes()


class Counted:
    """Words, lines and repetitions of a slice of texts."""

    def __init__(self, texts: X.Texts):
        self.texts = texts
        data = texts.data
        self.starts, self.ends, self.first = texts.runs(X.SPACE[data])
        self.n_words = np.diff(self.first)
        sums = texts.sums()
        self.words = texts.hashes(sums, self.starts, self.ends)
        self.word_doc = np.repeat(np.arange(texts.n), self.n_words)
        self.repeated = self._repeated()
        self.again = np.zeros(len(self.words), bool)  # equal to the word before
        self.again[1:] = (self.words[1:] == self.words[:-1]) & (self.word_doc[1:] == self.word_doc[:-1])
        self._lines(sums)

    def within(self, member: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How many bytes of a class each of some ascending byte ranges has."""
        if not len(starts):
            return np.zeros(0, np.int64)
        edges = np.column_stack((starts, ends)).ravel()
        flags = np.append(member[self.texts.data].view(np.uint8), np.uint8(0))
        found = np.add.reduceat(flags, edges, dtype=np.int64)[::2]
        return np.where(ends > starts, found, 0)

    def per_text(self, member: np.ndarray) -> np.ndarray:
        return self.within(member, self.texts.offsets[:-1], self.texts.offsets[1:])

    def per_text_words(self, flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(flags)))[self.first])

    def _repeated(self) -> np.ndarray:
        """Which words lie in an 8-word window that the text has twice or more."""
        n = len(self.words)
        size = max(0, n - WINDOW + 1)
        rolling = np.zeros(size, np.uint64)
        for k in range(WINDOW):
            rolling += self.words[k : k + size] * _PLACE[k]
        inside = self.word_doc[:size] == self.word_doc[n - size :]
        at = np.flatnonzero(inside)
        key = X.mix(rolling[at] ^ X.mix(self.word_doc[at].astype(np.uint64)))
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        twice = at[count[inverse] > 1]
        depth = np.zeros(n + 1, np.int64)
        depth[twice] += 1
        depth[twice + WINDOW] -= 1
        return np.cumsum(depth)[:n] > 0

    def _lines(self, sums: np.ndarray) -> None:
        """Lines with a word: their byte ranges, text numbers and earlier equals."""
        starts, ends, first = self.texts.runs(self.texts.data == 0x0A)
        doc = np.repeat(np.arange(self.texts.n), np.diff(first))
        begin = np.searchsorted(self.starts, starts)
        end = np.searchsorted(self.starts, ends)
        has = end > begin
        self.line_starts, self.line_ends, self.line_doc = starts[has], ends[has], doc[has]
        self.line_words = (begin[has], end[has])
        key = self.texts.hashes(sums, self.line_starts, self.line_ends)
        key = X.mix(key ^ X.mix(self.line_doc.astype(np.uint64)))
        _, at = np.unique(key, return_index=True)  # the first place of each
        self.line_repeats = np.ones(len(key), bool)
        self.line_repeats[at] = False
        self.n_lines = np.bincount(self.line_doc, minlength=self.texts.n)
        self.n_dup_lines = np.bincount(self.line_doc[self.line_repeats], minlength=self.texts.n)


LINE_FEATURES = 15


def line_sizes(c: Counted) -> np.ndarray:
    """Characters outside white space."""
    return np.maximum(c.within(CLASS["lead"] & ~X.SPACE, c.line_starts, c.line_ends), 1)


def line_features(c: Counted) -> np.ndarray:
    """One row per line with a word; the last column is 1."""
    out = np.zeros((len(c.line_starts), LINE_FEATURES), np.float32)

    def of(member):
        return c.within(member, c.line_starts, c.line_ends)

    size = line_sizes(c)
    words = c.line_words[1] - c.line_words[0]
    upper = of(CLASS["upper"])
    letters = upper + of(CLASS["lower"] | CLASS["far"])
    hot = np.concatenate(([0], np.cumsum(c.repeated)))
    out[:, 0] = np.sqrt(of(CLASS["symbol"]) / size)
    out[:, 1] = upper / np.maximum(letters, 1)
    out[:, 2] = np.sqrt(of(CLASS["digit"]) / size)
    out[:, 3] = np.sqrt(of(CLASS["shout"]) / size)
    out[:, 4] = np.sqrt(of(CLASS["bracket"]) / size)
    out[:, 5] = of(CLASS["stop"]) / size
    out[:, 6] = c.line_repeats
    out[:, 7] = np.log1p(words) / 5
    out[:, 8] = words < 5
    out[:, 9] = np.minimum(size / words, 20) / 10
    out[:, 10] = (hot[c.line_words[1]] - hot[c.line_words[0]]) / words
    out[:, 11] = letters / size
    out[:, 12] = CLASS["stop"][c.texts.data[c.ends[c.line_words[1] - 1] - 1]]
    again = np.concatenate(([0], np.cumsum(c.again)))
    out[:, 13] = (again[c.line_words[1]] - again[c.line_words[0]]) / words
    out[:, 14] = 1
    return out


TEXT_FEATURES = 23


def text_features(c: Counted) -> np.ndarray:
    """One row per text; the last column is 1. Empty texts have zeros before it."""
    out = np.zeros((c.texts.n, TEXT_FEATURES), np.float32)
    count = {k: c.per_text(m) for k, m in CLASS.items()}
    size = np.maximum(count["lead"] - count["space"], 1)
    words = np.maximum(c.n_words, 1)
    letters = count["upper"] + count["lower"] + count["far"]
    length = c.ends - c.starts
    last = c.texts.data[c.ends - 1] if len(c.ends) else np.zeros(0, np.uint8)
    begin = c.texts.data[c.starts] if len(c.starts) else np.zeros(0, np.uint8)
    key = X.mix(c.words ^ X.mix(c.word_doc.astype(np.uint64)))
    _, at = np.unique(key, return_index=True)
    distinct = np.bincount(c.word_doc[at], minlength=c.texts.n)
    out[:, 0] = np.sqrt(count["symbol"] / size)
    out[:, 1] = count["upper"] / np.maximum(letters, 1)
    out[:, 2] = np.sqrt(count["digit"] / size)
    out[:, 3] = np.sqrt(count["shout"] / size)
    out[:, 4] = np.sqrt(count["bracket"] / size)
    out[:, 5] = count["stop"] / size
    out[:, 6] = letters / size
    out[:, 7] = count["other"] / size
    out[:, 8] = c.per_text_words(c.repeated) / words
    out[:, 9] = c.n_dup_lines / np.maximum(c.n_lines, 1)
    out[:, 10] = distinct / words
    out[:, 11] = np.log1p(c.n_words) / 8
    out[:, 12] = np.minimum(size / words, 20) / 10
    out[:, 13] = c.per_text_words(length <= 3) / words
    out[:, 14] = c.per_text_words(length > 14) / words
    out[:, 15] = c.per_text_words(CLASS["stop"][last]) / words
    out[:, 16] = c.per_text_words(CLASS["symbol"][last] | CLASS["shout"][last]) / words
    out[:, 17] = c.per_text_words(CLASS["upper"][begin]) / words
    out[:, 18] = np.log1p(c.n_words / np.maximum(c.n_lines, 1)) / 5
    out[:, 19] = c.per_text_words((length == 1) & ~CLASS["lower"][last] & ~CLASS["upper"][last]) / words
    out[:, 20] = c.n_words < 5
    out[:, 21] = c.per_text_words(c.again) / words
    out[:, 22] = 1
    out[c.n_words == 0, :22] = 0
    return out
