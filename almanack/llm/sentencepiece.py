"""SentencePiece ids of texts by a streaming Viterbi search, and back to text.

The lattice of a text has an edge for each piece that stands somewhere in it. A model
of merges (BPE) has one valid path: the one whose neighbouring pieces all stay apart
when the two are merged on their own. So each position has one surviving edge, found
from the edges that end there and the piece that survives where they begin; ids follow
from the back pointers. The search keeps a window: the positions that a piece can still
reach back to, as many as the longest piece has characters, and what leads there. When
the window holds twice as many, all surviving paths are followed back, and the ids up to
the boundary where they meet are committed and leave it. Characters without a piece
become bytes.

No piece goes on behind a space that follows another character, so all paths meet
there, and the ids are committed. What lies between two such boundaries is remembered. New
ones are searched side by side (`Lanes`: numpy, one character of each at a time, each
with its own window); when few are left, or a text comes in parts, each goes on with its
window alone (`Stream`). Both hold the same state and commit by the same rule.

Only models of merges are accepted; any other type is an error.

Defined cases: null and empty texts have no ids; very long texts are encoded whole, and
a text's length does not change the window. The character U+2581 stands for a space in
the model and comes back as one (round_trip is then false). Repeated rows are encoded
each; further columns are kept or not read; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanack.llm import text as X
from almanack.llm.tables import bounded_batches

SPACE = "▁"
#: Searches that go on side by side; fewer go on alone. And how many begin together.
FEW, TOGETHER = 48, 50_000
#: Model types, and their field in the file: trainer_spec (2) . model_type (3).
TYPES = {1: "unigram", 2: "merges", 3: "word", 4: "character"}
#: Slots of the table that remembers which pieces stay apart.
PAIRS = 1 << 21


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte, at = data[at], at + 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    at = 0
    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or number()
            yield key >> 3, data[at : at + size]
            at += size


def model_type(data: bytes) -> str:
    """What kind of model the content of a model file is."""
    spec = next((v for n, v in _fields(data) if n == 2), b"")
    return TYPES.get(next((v for n, v in _fields(spec) if n == 3), 1), "unknown")


class Pieces:
    """Vocabulary of a model file: its pieces, their scores and how they are merged."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        kind = model_type(model.serialized_model_proto())
        if kind != "merges":
            raise ValueError(f"{path} is a model of type {kind}; only merges have one valid path")
        self.size = model.get_piece_size()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(self.size)]
        self.names = [model.id_to_piece(i) for i in range(self.size)]
        self.bytes = {int(self.names[i][3:5], 16): i for i in range(self.size) if model.is_byte(i)}
        self.ids = {n: i for i, n in enumerate(self.names) if not special[i] and not model.is_byte(i)}
        self.scores = {n: model.get_score(i) for n, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        self._steps: dict[str, tuple[bool, list[tuple[float, str, str]]]] = {}
        self.keys = np.full(PAIRS, -1, np.int64)
        self.apart = np.zeros(PAIRS, bool)
        # Hashes of the pieces, for the search in step.
        hashes = np.array([_code_hash(n) for n in self.ids], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.hash_ids = hashes[order], np.array(list(self.ids.values()))[order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(hashes >> np.uint64(44)).astype(np.int64)] = True
        # Bytes of each id, for decoding.
        raw = [n.replace(SPACE, " ").encode() for n in self.names]
        for byte, i in self.bytes.items():
            raw[i] = bytes([byte])
        raw = [b"" if s else r for r, s in zip(raw, special)]
        self.byte_lengths = np.array([len(r) for r in raw], np.int64)
        self.byte_starts = np.concatenate(([0], np.cumsum(self.byte_lengths)[:-1]))
        self.byte_data = np.frombuffer(b"".join(raw), np.uint8)
        self.is_byte = np.zeros(self.size, bool)
        self.is_byte[list(self.bytes.values())] = True

    def steps(self, piece: str) -> tuple[bool, list[tuple[float, str, str]]]:
        """Merges of a piece on its own: each one's score, and the first and last symbol
        after it. First, whether the whole piece comes out."""
        if piece not in self._steps:
            symbols, steps = list(piece), []
            while len(symbols) > 1:
                found = [
                    (-self.scores[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in self.scores
                ]
                if not found:
                    break
                score, i = min(found)
                symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
                steps.append((-score, symbols[0], symbols[-1]))
            self._steps[piece] = len(symbols) == 1, steps
        return self._steps[piece]

    def whole(self, piece: int) -> bool:
        return self.steps(self.names[piece])[0]

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether merging the text of two pieces gives these two again.

        Both are merged side by side in the order of scores (the left one first when
        equal); they stay apart if no merge across the boundary comes first.
        """
        a, b = self.names[left], self.names[right]
        whole, of_a = self.steps(a)
        if not whole or not self.whole(right):
            return False
        of_b = self.steps(b)[1]
        low = float("-inf")
        last, first, i, j = a[-1], b[0], 0, 0
        while True:
            across = self.scores.get(last + first)
            next_a = of_a[i][0] if i < len(of_a) else low
            next_b = of_b[j][0] if j < len(of_b) else low
            if across is not None and across > next_a and across >= next_b:
                return False
            if i < len(of_a) and next_a >= next_b:
                last, i = of_a[i][2], i + 1
            elif j < len(of_b):
                first, j = of_b[j][1], j + 1
            else:
                return True

    def all_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """`stay_apart` for many pairs; left < 0 is a character without a piece."""
        key = (left + 1).astype(np.int64) << 32 | right
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(43)).astype(np.int64)
        miss = np.flatnonzero(self.keys[slot] != key)
        out = self.apart[slot]
        if len(miss):
            new, inverse = np.unique(key[miss], return_inverse=True)
            pairs = zip((new >> 32).tolist(), (new & 0xFFFFFFFF).tolist())
            found = np.array([self.stay_apart(a - 1, b) if a else self.whole(b) for a, b in pairs], bool)
            out[miss] = found[inverse]
            self.keys[slot[miss]] = key[miss]
            # Of several keys for one slot the last stays; take its own value.
            order = {int(k): bool(v) for k, v in zip(new.tolist(), found.tolist())}
            held = self.keys[slot[miss]]
            self.apart[slot[miss]] = [order[int(k)] for k in held.tolist()]
        return out


_BASE = np.uint64(0x9E3779B97F4A7C15)
_UP = np.multiply.accumulate(np.full(64, _BASE, np.uint64))
_DOWN = np.multiply.accumulate(np.full(64, pow(int(_BASE), -1, 1 << 64), np.uint64))


def _code_hash(piece: str) -> int:
    codes = np.frombuffer(piece.encode("utf-32-le"), "<u4").astype(np.uint64)
    value = ((codes + np.uint64(1)) * _UP[: len(codes)]).sum(dtype=np.uint64)
    return int(X.mix(np.array([value]))[0])


def met(back: np.ndarray, size: int, reach: int) -> np.ndarray:
    """The last boundary through which all paths from the last `reach` positions run, for
    each column of back pointers (0: they meet at the window's beginning only)."""
    ends = np.repeat(np.arange(size - reach + 1, size + 1)[:, None], back.shape[1], axis=1)
    column = np.arange(back.shape[1])[None, :]
    while True:
        furthest = ends.max(axis=0)
        if (furthest == ends.min(axis=0)).all():
            return furthest
        ends = np.where((ends == furthest) & (ends > ends.min(axis=0)), ends - back[ends, column], ends)


class Stream:
    """Encodes a text handed over in parts, with a window of bounded length."""

    def __init__(self, pieces: Pieces, window: str = "", back: list[int] | None = None, edge: list[int] | None = None):
        self.pieces = pieces
        self.window = window  # characters behind the last committed boundary
        self.back = back or [0]  # of each position in the window, the length of its surviving edge
        self.edge = edge or [-2]  # its piece; -1 a character without one, -2 the text's start
        self.widest = self.commits = 0

    def _end(self, i: int) -> tuple[int, int]:
        """Surviving edge into a position: its length and piece."""
        p = self.pieces
        for length in range(min(i, p.longest), 0, -1):
            piece = p.ids.get(self.window[i - length : i])
            if piece is None:
                continue
            before = self.edge[i - length]
            if p.stay_apart(before, piece) if before >= 0 else p.whole(piece):
                return length, piece
        return 1, -1

    def _commit(self) -> list[int]:
        """Ids up to the boundary through which all surviving paths run."""
        cut = int(met(np.array(self.back)[:, None], len(self.window), self.pieces.longest)[0])
        if not cut:
            return []
        ids = path_ids(self.pieces, self.window, self.back, self.edge, cut)
        self.window, self.back, self.edge = self.window[cut:], self.back[cut:], self.edge[cut:]
        self.commits += 1
        return ids

    def feed(self, part: str) -> Iterator[int]:
        for character in part:
            self.window += character
            length, piece = self._end(len(self.window))
            self.back.append(length)
            self.edge.append(piece)
            self.widest = max(self.widest, len(self.window))
            if len(self.window) >= 2 * self.pieces.longest:
                yield from self._commit()

    def finish(self) -> list[int]:
        ids = path_ids(self.pieces, self.window, self.back, self.edge, len(self.window))
        self.window, self.back, self.edge = "", [0], [-2]
        self.commits += 1
        return ids


def path_ids(pieces: Pieces, window: str, back: Sequence[int], edge: Sequence[int], end: int) -> list[int]:
    """Ids from a window's beginning to a position, by the back pointers."""
    out, at = [], end
    while at > 0:
        if edge[at] >= 0:
            out.append(edge[at])
        else:
            out += [pieces.bytes[b] for b in reversed(window[at - 1].encode())]
        at -= back[at]
    return out[::-1]


def stream_ids(pieces: Pieces, parts: Iterable[str]) -> Iterator[int]:
    """Ids of a text in parts; spaces must already be U+2581, with one before the text."""
    stream = Stream(pieces)
    for part in parts:
        yield from stream.feed(part)
    yield from stream.finish()


class Lanes:
    """The search of many segments side by side, each with a window of its own.

    Row j of `codes`, `sums`, `back` and `edge` is position j of each lane's window, which
    holds `size` characters; `done` says how many of a segment's characters were read.
    """

    def __init__(self, pieces: Pieces, segments: list[str]):
        """Segments in order of length, the longest first."""
        self.pieces, self.segments = pieces, segments
        self.room = 2 * pieces.longest
        self.ids: list[list[int]] = [[] for _ in segments]
        self.widest, self.commits, self.searched = 0, 0, 0

    def run(self) -> list[list[int]]:
        lengths = np.array([len(s) for s in self.segments])
        n, deep = len(lengths), min(self.room, int(lengths.max(initial=0)))
        codes = np.frombuffer("".join(self.segments).encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
        first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        self.sums, self.codes = np.zeros((deep + 1, n), np.uint64), np.zeros((deep + 1, n), np.uint64)
        self.back, self.edge = np.zeros((deep + 1, n), np.int32), np.full((deep + 1, n), -2, np.int32)
        size = np.zeros(n, np.int64)  # characters in each window
        live, done = n, 0
        while live:
            ended = live - int(np.searchsorted(-lengths[:live], -done, side="left"))
            if ended:  # all paths of a segment meet at its end
                for k in range(live - ended, live):
                    self._take(k, int(size[k]), done)
                live -= ended
                continue
            if live < FEW and done:
                for k in range(live):
                    self._alone(k, int(size[k]), done)
                break
            rows = np.arange(live)
            size[:live] += 1
            at = size[:live]
            self.codes[at, rows] = codes[first[:live] + done]
            self.sums[at, rows] = self.sums[at - 1, rows] + self.codes[at, rows] * _UP[at - 1]
            self._extend(rows, at)
            done += 1
            self.widest = max(self.widest, int(at.max()))
            full = np.flatnonzero(at == self.room)
            if len(full):
                size[full] -= self._commit(full, done)
                stuck = full[size[full] == self.room]
                for k in stuck.tolist():  # no boundary yet: this one goes on alone, with a wider window
                    self._alone(k, self.room, done)
                if len(stuck):
                    keep = np.setdiff1d(rows, stuck)
                    self._keep(keep)
                    lengths, first, size, live = lengths[keep], first[keep], size[keep], len(keep)
        return self.ids

    def _keep(self, lanes: np.ndarray) -> None:
        for name in ("codes", "sums", "back", "edge"):
            setattr(self, name, getattr(self, name)[:, lanes])
        self.order = getattr(self, "order", np.arange(len(self.segments)))[lanes]

    def _number(self, lane: int) -> int:
        return int(self.order[lane]) if hasattr(self, "order") else lane

    def _extend(self, rows: np.ndarray, at: np.ndarray) -> None:
        """The surviving edge into the newest position of each lane."""
        p = self.pieces
        self.back[at, rows], self.edge[at, rows] = 1, -1
        for length in range(min(int(at.max()), p.longest), 0, -1):
            start = at - length
            some = np.flatnonzero(start >= 0)
            value = self.sums[at[some], rows[some]] - self.sums[start[some], rows[some]]
            value = X.mix(value * np.where(start[some] > 0, _DOWN[start[some] - 1], np.uint64(1)))
            likely = pieces_maybe(p, value)
            some, value = some[likely], value[likely]
            found = np.minimum(np.searchsorted(p.hashes, value), len(p.hashes) - 1)
            good = p.hashes[found] == value
            some, piece = some[good], p.hash_ids[found[good]]
            if not len(some):
                continue
            fits = p.all_apart(self.edge[start[some], rows[some]], piece)
            done = some[fits]
            self.back[at[done], rows[done]], self.edge[at[done], rows[done]] = length, piece[fits]
            left = np.ones(len(rows), bool)
            left[done] = False
            rows, at = rows[left], at[left]
            if not len(rows):
                return

    def _window(self, lane: int, size: int, done: int) -> str:
        return self.segments[self._number(lane)][done - size : done]

    def _take(self, lane: int, size: int, done: int) -> None:
        """Commit what a segment's window holds at its end."""
        back, edge = self.back[:, lane].tolist(), self.edge[:, lane].tolist()
        self.ids[self._number(lane)] += path_ids(self.pieces, self._window(lane, size, done), back, edge, size)
        self.commits, self.searched = self.commits + 1, self.searched + 1

    def _alone(self, lane: int, size: int, done: int) -> None:
        number = self._number(lane)
        back, edge = self.back[: size + 1, lane].tolist(), self.edge[: size + 1, lane].tolist()
        stream = Stream(self.pieces, self._window(lane, size, done), back, edge)
        self.ids[number] += [*stream.feed(self.segments[number][done:]), *stream.finish()]
        self.widest = max(self.widest, stream.widest)
        self.commits, self.searched = self.commits + stream.commits, self.searched + 1

    def _commit(self, lanes: np.ndarray, done: int) -> np.ndarray:
        """Commit and cut off, in full windows, what all paths have in common; how much."""
        cuts = met(self.back[:, lanes], self.room, self.pieces.longest)
        for k, cut in zip(lanes.tolist(), cuts.tolist()):
            if not cut:
                continue
            back, edge = self.back[:, k].tolist(), self.edge[:, k].tolist()
            self.ids[self._number(k)] += path_ids(self.pieces, self._window(k, self.room, done), back, edge, cut)
            self.commits += 1
        moved = np.minimum(np.arange(self.room + 1)[:, None] + cuts[None, :], self.room)
        for table in (self.codes, self.back, self.edge):
            table[:, lanes] = np.take_along_axis(table[:, lanes], moved, axis=0)
        fresh = self.codes[1:, lanes] * _UP[: self.room, None]
        self.sums[0, lanes] = 0
        self.sums[1:, lanes] = np.cumsum(fresh, axis=0)
        return cuts


def pieces_maybe(pieces: Pieces, value: np.ndarray) -> np.ndarray:
    return np.flatnonzero(pieces.maybe[(value >> np.uint64(44)).astype(np.int64)])


def segment_ids(pieces: Pieces, segments: list[str]) -> list[list[int]]:
    """Ids of segments that begin where all paths meet."""
    out: list[list[int]] = [[]] * len(segments)
    order = sorted(range(len(segments)), key=lambda i: -len(segments[i]))
    for begin in range(0, len(order), TOGETHER):
        part = order[begin : begin + TOGETHER]
        for i, ids in zip(part, Lanes(pieces, [segments[i] for i in part]).run()):
            out[i] = ids
    return out


@lru_cache(maxsize=2)
def _loaded(path: str) -> tuple[Pieces, X.Remembered]:
    pieces = Pieces(path)
    return pieces, X.Remembered(lambda parts: segment_ids(pieces, [p.replace(" ", SPACE) for p in parts]))


def _slice_ids(path: str, texts: X.Texts) -> tuple[np.ndarray, np.ndarray, X.Texts]:
    """Ids of all texts, how many each has, and the texts with a space before each."""
    if SPACE.encode() in texts.data.tobytes():  # the model cannot tell it from a space
        plain = [texts[i].replace(SPACE.encode(), b" ") for i in range(texts.n)]
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in plain])))
        texts = X.Texts(np.frombuffer(b"".join(plain), np.uint8), offsets)
    filled = np.diff(texts.offsets) > 0
    data = np.insert(texts.data, texts.offsets[:-1][filled], 0x20)
    offsets = texts.offsets + np.concatenate(([0], np.cumsum(filled)))
    spaced = X.Texts(data, offsets)
    space = data == 0x20
    begin = space.copy()
    begin[1:] &= ~space[:-1]
    starts = np.flatnonzero(begin | spaced.begins[:-1])
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    ids, lengths = _loaded(path)[1].of(spaced, starts, ends)
    total = np.concatenate(([0], np.cumsum(lengths)))
    return ids, np.diff(total[np.searchsorted(starts, offsets)]), spaced


def decoded(pieces: Pieces, ids: np.ndarray, counts: np.ndarray) -> X.Texts:
    """The texts of ids, `counts` for each text, with the space before each."""
    lengths = pieces.byte_lengths[ids]
    data = pieces.byte_data[X.ranges(pieces.byte_starts[ids], lengths)]
    ends = np.concatenate(([0], np.cumsum(lengths)))
    return X.Texts(data, ends[np.concatenate(([0], np.cumsum(counts)))])


def encode(text: Column, model: str) -> Column:
    """The ids of a text, as an array."""

    @F.arrow_udf("array<int>")
    def ids_of(column: pa.Array) -> pa.Array:
        parts = [_slice_ids(model, t)[:2] for t in X.slices(column)]
        ids = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0)
        counts = np.concatenate([[0], *[p[1] for p in parts]])
        return pa.ListArray.from_arrays(pa.array(np.cumsum(counts).astype(np.int32)), pa.array(ids.astype(np.int32)))

    return ids_of(text)


def decode(ids: Column, model: str) -> Column:
    """The text of an array of ids; bytes that are no UTF-8 become U+FFFD."""

    @F.arrow_udf("string")
    def text_of(column: pa.Array) -> pa.Array:
        pieces, out = _loaded(model)[0], []
        for one in column:
            own = np.array(one.as_py() or [], np.int64)
            whole = decoded(pieces, own, np.array([len(own)]))[0]
            out.append(whole.removeprefix(b" ").decode(errors="replace"))
        return pa.array(out, pa.string())

    return text_of(ids)


def digest(text: Column, model: str) -> Column:
    """Struct of n_ids, n_bytes (ids that stand for bytes), ids_crc32 (of the ids as
    little-endian unsigned 32-bit) and round_trip (decoding gives the text again)."""

    @F.arrow_udf("n_ids bigint, n_bytes bigint, ids_crc32 bigint, round_trip boolean")
    def digests(column: pa.Array) -> pa.Array:
        pieces = _loaded(model)[0]
        out: list[list] = [[], [], [], []]
        for texts in X.slices(column):
            ids, counts, spaced = _slice_ids(model, texts)
            back = decoded(pieces, ids, counts)
            same = np.array_equal(back.data, spaced.data) and np.array_equal(back.offsets, spaced.offsets)
            same = same and len(spaced.data) == len(texts.data) + np.count_nonzero(counts)
            ends = np.concatenate(([0], np.cumsum(counts)))
            raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
            fallback = np.concatenate(([0], np.cumsum(pieces.is_byte[ids])))
            out[0] += counts.tolist()
            out[1] += np.diff(fallback[ends]).tolist()
            cuts = ends.tolist()
            out[2] += [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(cuts, cuts[1:])]
            out[3] += [True] * texts.n if same else [back[i][1:] == texts[i] for i in range(texts.n)]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
        arrays = [pa.array(v, k) for v, k in zip(out, kinds)]
        return pa.StructArray.from_arrays(arrays, ["n_ids", "n_bytes", "ids_crc32", "round_trip"])

    return digests(text)


def digests(docs: DataFrame, model: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_ids, n_bytes, ids_crc32, round_trip of each document."""
    bounded_batches(docs.sparkSession)
    found = docs.select(F.col(doc_id).alias("doc_id"), digest(F.col(text), model).alias("d"))
    return found.select("doc_id", "d.*")
