"""Whole texts as byte arrays: words, lines and hashes of an Arrow batch at once.

Helpers for operators that run inside Spark tasks. A batch is cut into slices of
bounded size between texts (a longer text is a slice of its own), so memory
follows the longest text and not the number of rows in a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 500_000
_BASE = 0x9E3779B97F4A7C55  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)

#: The bytes of [\x20\x09-\x0D].
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (the finalizer of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, _BASE, np.uint64)
    down = np.full(size, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's first n powers and their inverses, modulo 2**64."""
    up, down = _powers(1 << max(12, int(n).bit_length()))
    return up[:n], down[:n]


class Texts:
    """Consecutive texts: their UTF-8 bytes and where each one begins."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self.n = len(offsets) - 1
        self.begins = np.zeros(len(data) + 1, bool)
        self.begins[offsets] = True

    def __getitem__(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def runs(self, outside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of bytes that are not outside, ended by a text's end.

        Returns their starts, their ends and the number of the first run of each
        text (with the total behind).
        """
        inside = ~outside
        edge = outside.copy()
        edge[1:] = outside[:-1]
        first = inside & (edge | self.begins[:-1])
        edge[:-1] = outside[1:]
        if len(edge):
            edge[-1] = True
        last = inside & (edge | self.begins[1:])
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def sums(self) -> np.ndarray:
        """Prefix sums from which the hash of any byte range follows."""
        up, _ = powers(len(self.data))
        out = np.zeros(len(self.data) + 1, np.uint64)
        each = out[1:]
        each[:] = self.data
        each += np.uint64(1)
        each *= up
        np.cumsum(each, out=each)
        return out

    def hashes(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte ranges; equal bytes have equal hashes."""
        _, down = powers(len(self.data) + 1)
        h = (sums[ends] - sums[starts]) * down[starts]
        return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[Texts]:
    """The column's texts in order, null as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    begin = 0
    while begin < len(column):
        limit = offsets[begin] + max_bytes
        end = max(begin + 1, int(np.searchsorted(offsets, limit, "right")) - 1)
        end = min(end, len(column))
        at = offsets[begin : end + 1]
        yield Texts(data[at[0] : at[-1]], at - at[0])
        begin = end


def lowered(texts: Texts) -> Texts:
    """The texts with A-Z as a-z."""
    return Texts(LOWER[texts.data], texts.offsets)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions start, start + 1, ... of several ranges, one range after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return np.arange(total) + shift


#: Masks of the first 0 .. 8 bytes of a little-endian number.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class Grown:
    """A column that grows at its end. Its array has room for half as much again; memory that
    nothing was written to is not taken yet."""

    def __init__(self, kind):
        self.room, self.n = np.empty(1 << 16, kind), 0

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, at):
        return self.room[: self.n][at]

    def __setitem__(self, at, value) -> None:
        self.room[: self.n][at] = value

    def hold(self, values: np.ndarray) -> None:
        """These values only."""
        self.n = 0
        self.add(values)

    def add(self, values: np.ndarray) -> None:
        n = self.n + len(values)
        if n > len(self.room):
            larger = np.empty(n + n // 2, self.room.dtype)
            larger[: self.n] = self.room[: self.n]
            self.room = larger
        self.room[self.n : n] = values
        self.n = n


#: Ranges encoded at once: a tokenizer's own form of a word takes a kilobyte or more.
ENCODED = 2_000


class Remembered:
    """Ids of byte ranges (words, say), each distinct one encoded once.

    Ranges are looked up by hash and then compared byte by byte; one whose hash belongs to
    another is encoded on its own. Holds at most `entries` ranges, `most` ids or twice as
    many bytes of long ranges (some 60 bytes of memory for a word); then only
    those stay that were asked for again, if they are less than half. What is remembered
    of a range is added in place (`Grown`), so that few outgrown copies lie between.
    """

    def __init__(
        self, encode: Callable[[list[str]], list[Sequence[int]]], entries: int = 700_000, most: int = 5_000_000
    ):
        self.encode, self.entries, self.most = encode, entries, most
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # sorted by hash
        self.ids, self.starts, self.lengths = Grown(np.uint32), Grown(np.int32), Grown(np.int32)
        self.sizes, self.heads, self.tails = Grown(np.int32), Grown(np.uint64), Grown(np.uint64)
        self.bytes, self.begins = Grown(np.uint8), Grown(np.int32)  # of ranges that these do not cover
        self.again = Grown(bool)

    def _condense(self) -> None:
        """Keep what was asked for in more than one slice."""
        mask = self.again[self.places]
        if np.count_nonzero(mask) > self.entries // 2:
            return self._forget()
        old = self.places[mask]
        lengths, sizes = self.lengths[old].astype(np.int64), self.sizes[old]
        kept = np.where(sizes > 16, sizes, 0).astype(np.int64)
        self.ids.hold(self.ids[ranges(self.starts[old].astype(np.int64), lengths)])
        self.bytes.hold(self.bytes[ranges(self.begins[old].astype(np.int64), kept)])
        self.starts.hold(np.cumsum(lengths) - lengths)
        self.begins.hold(np.cumsum(kept) - kept)
        for column in (self.lengths, self.sizes, self.heads, self.tails):
            column.hold(column[old])
        self.hashes, self.places = self.hashes[mask], np.arange(len(old), dtype=np.int32)
        self.again.hold(np.zeros(len(old), bool))

    @staticmethod
    def _edges(texts: Texts, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first eight bytes of ranges, and of those with more the last eight, as numbers."""
        padded = np.concatenate((texts.data, np.zeros(8, np.uint8)))
        eight = np.ndarray(len(texts.data) + 1, "<u8", padded, strides=(1,))  # at each byte
        sizes = ends - starts
        head = eight[starts] & _FIRST[np.minimum(sizes, 8)]
        return head, np.where(sizes > 8, eight[np.maximum(ends - 8, 0)], np.uint64(0))

    def _learn(self, texts: Texts, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> None:
        """Encodes and remembers ranges whose hashes (sorted) are new."""
        counts, ids = [], []
        for a in range(0, len(starts), ENCODED):
            of = slice(a, a + ENCODED)
            found = self.encode([texts.data[i:j].tobytes().decode() for i, j in zip(starts[of].tolist(), ends[of].tolist())])
            counts.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter(chain.from_iterable(found), np.uint32, int(counts[-1].sum())))
        counts, ids = np.concatenate(counts), np.concatenate(ids)
        near = np.searchsorted(self.hashes, hashes)
        self.places = np.insert(self.places, near, len(self.starts) + np.arange(len(hashes), dtype=np.int32))
        self.hashes = np.insert(self.hashes, near, hashes)
        sizes = ends - starts
        kept = np.where(sizes > 16, sizes, 0)
        head, tail = self._edges(texts, starts, ends)
        self.starts.add(len(self.ids) + np.cumsum(counts) - counts)
        self.begins.add(len(self.bytes) + np.cumsum(kept) - kept)
        self.ids.add(ids)
        self.bytes.add(texts.data[ranges(starts, kept)])
        self.lengths.add(counts)
        self.sizes.add(sizes)
        self.heads.add(head)
        self.tails.add(tail)
        self.again.add(np.zeros(len(hashes), bool))

    def _others(self, texts: Texts, starts: np.ndarray, ends: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The ranges that are not, byte by byte, what is remembered under their hash: by
        their first and last eight bytes, and where there are more by all of them."""
        sizes = ends - starts
        head, tail = self._edges(texts, starts, ends)
        unlike = (self.sizes[place] != sizes) | (self.heads[place] != head) | (self.tails[place] != tail)
        long = np.flatnonzero((sizes > 16) & ~unlike)
        if len(long):
            same = sizes[long]
            differ = texts.data[ranges(starts[long], same)] != self.bytes[ranges(self.begins[place[long]], same)]
            if differ.any():
                unlike[long[np.searchsorted(np.cumsum(same), np.flatnonzero(differ), "right")]] = True
        return np.flatnonzero(unlike)

    def of(self, texts: Texts, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the ranges, and how many each range has."""
        hashes = texts.hashes(texts.sums(), starts, ends)
        distinct, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) + len(distinct) > self.entries or max(len(self.ids), len(self.bytes) // 2) > self.most:
            self._condense()
        near = np.searchsorted(self.hashes, distinct)
        known = near < len(self.hashes)
        known[known] = self.hashes[near[known]] == distinct[known]
        self.again[self.places[near[known]]] = True
        new = np.flatnonzero(~known)
        if len(new):
            self._learn(texts, starts[at[new]], ends[at[new]], distinct[new])
        place = self.places[np.searchsorted(self.hashes, distinct)][inverse]
        lengths = self.lengths[place].astype(np.int64)
        others = self._others(texts, starts, ends, place)
        if not len(others):
            return self.ids[ranges(self.starts[place], lengths)], lengths
        own = self.encode([texts.data[starts[i] : ends[i]].tobytes().decode() for i in others.tolist()])
        every = [self.ids[a : a + n] for a, n in zip(self.starts[place].tolist(), lengths.tolist())]
        for i, ids in zip(others.tolist(), own):
            every[i] = np.array(ids, np.uint32)
        return np.concatenate(every), np.fromiter(map(len, every), np.int64, len(every))
