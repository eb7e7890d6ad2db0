"""Near duplicates by HyperMinHash sketches, verified on the full shingle sets.

A document's set holds the hashes of its distinct five-word shingles. Its sketch has
128 buckets; each keeps the smallest hash that falls into it, stored as a register of
the hash's leading-zero count and ten mantissa bits. Buckets that stay empty are
filled by further rounds with other hash functions, so that small sets have full
sketches too and each register agrees with the probability that is the similarity.
32 bands of four registers propose pairs; the similarity estimated from the equal
registers, corrected for registers that agree by chance, sorts out most of them; the
rest is decided on the full sets.

Equal sets are one node from the beginning, whatever their number. Inside a band's
bucket all nodes are compared with one of them, the hub, and not with each other:
what is linked to the hub is in one component anyway. Buckets that still hold several
components are then searched across these: small ones pair by pair, large ones (a
passage that very many documents share) by their rarest shingles, which is exact and
does not grow with the square of the bucket. No pair within a bucket goes untested
unless both are known to be connected, so components are those of all links that the
bands find. At a similarity of 0.75 a link escapes all 32 bands
with a probability of 5 in a million.

A node is a set, known by a 128-bit fingerprint, so two texts under one id are two nodes.
Of a component one text stays: that of the smallest id, then the smallest fingerprint,
then the smallest hash of the text.

Defined cases: null and empty texts have an empty set, no links, themselves as component
and stay; fewer words than five count as one shingle. Ids may be of any type that has an
order and may repeat: each row is judged by its own text, rows that repeat id and text
alike (`deduplicate` lets one of them stay). Rows without an id take no part in linking
and stay. Further columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanack.llm import text as X
from almanack.llm.tables import BROADCAST_IDS, bounded_batches, numbered_alike, text_of
from almanack.session import hand_over

WORDS, BUCKETS, ROWS = 5, 128, 4
MANTISSA = 10
#: A link needs 100 * |intersection| >= PERCENT * |union|.
PERCENT = 75
#: Pairs of the bands estimated below this are not verified: 5.2 standard errors under 0.75.
ESTIMATE = 0.55
#: In buckets of more nodes and several components, pairs are found by rare shingles.
MANY = 48
#: Sets whose shingles are counted together.
BLOCK = 256
_COUNTED = "block bigint, shingle bigint, sets bigint, low bigint, high bigint"
_PLACED = "shingle bigint, node binary, part bigint, n bigint, place bigint"

_PLACE = X.mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)
_SIGNATURE = "n_shingles bigint, fingerprint binary, registers binary, bands array<bigint>"


def shingle_sets(texts: X.Texts, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    texts = X.lowered(texts)
    starts, ends, first = texts.runs(X.SPACE[texts.data])
    h = texts.hashes(texts.sums(), starts, ends)
    rolling = np.zeros(max(0, len(h) - words + 1), np.uint64)
    for k in range(words):
        rolling += h[k : k + len(rolling)] * _PLACE[k]
    rolling = X.mix(rolling)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= words:
            sets.append(np.unique(rolling[a : b - words + 1]))
        elif b > a:
            whole = (h[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            sets.append(X.mix(np.array([whole])))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Registers (leading zeros * 2**10 + mantissa) of each set; empty sets give zeros."""
    n = len(sets)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    least = np.full(n * BUCKETS, np.uint64(2**64 - 1))
    filled = np.zeros(n * BUCKETS, bool)
    lane = np.repeat(np.arange(n), sizes)
    hashes = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    for turn in range(2 * BUCKETS):
        if not len(hashes):
            break
        v = X.mix(hashes + np.uint64(turn * 0x9E3779B97F4A7C15 % 2**64))
        if turn < BUCKETS:
            cell = lane * BUCKETS + (v >> np.uint64(57)).astype(np.int64)
        else:  # at last every bucket has a round of its own, so that none stays empty
            cell = lane * BUCKETS + (turn - BUCKETS)
        value = v << np.uint64(7)
        if turn:
            empty = ~filled[cell]
            cell, value = cell[empty], value[empty]
        np.minimum.at(least, cell, value)
        filled[cell] = True
        open_ = ~filled.reshape(n, BUCKETS).all(axis=1)
        more = open_[lane]
        lane, hashes = lane[more], hashes[more]
    least[least == 0] = 1
    fraction, exponent = np.frexp(least.astype(np.float64))
    zeros = np.clip(64 - exponent, 0, 63).astype(np.uint16)
    mantissa = np.minimum((fraction - 0.5) * (2 << MANTISSA), (1 << MANTISSA) - 1).astype(np.uint16)
    return ((zeros << MANTISSA) | mantissa).reshape(n, BUCKETS)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key per band: its four registers and its number."""
    raw = np.ascontiguousarray(registers).view(np.uint64)
    return X.mix(raw + X.mix(np.arange(raw.shape[1], dtype=np.uint64))[None, :]).view(np.int64)


def signature(text: Column) -> Column:
    @F.arrow_udf(_SIGNATURE)
    def signatures(column: pa.Array) -> pa.Array:
        count, prints, registers, bands = [], [], [], []
        for texts in X.slices(column):
            sets = shingle_sets(texts)
            table = sketches(sets)
            keys = band_keys(table)
            for i, s in enumerate(sets):
                count.append(len(s))
                prints.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                registers.append(table[i].tobytes() if len(s) else None)
                bands.append(keys[i] if len(s) else None)
        return pa.StructArray.from_arrays(
            [
                pa.array(count, pa.int64()),
                pa.array(prints, pa.binary()),
                pa.array(registers, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
            ],
            ["n_shingles", "fingerprint", "registers", "bands"],
        )

    return signatures(text)


@F.arrow_udf(T.BinaryType())
def _set_bytes(column: pa.Array) -> pa.Array:
    return pa.array([s.tobytes() for texts in X.slices(column) for s in shingle_sets(texts)], pa.binary())


def estimates(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Similarity from equal registers, less what agrees by chance.

    Two smallest values of different elements share a register if they share the
    cell; cells are 2**-10 of a power of two wide, which for sets of a and b elements
    comes to 2**-10 / (2 ln 2) * ab / (a + b)**2.
    """
    equal = (a == b).mean(axis=1)
    chance = 2.0**-MANTISSA / (2 * np.log(2)) * size_a * size_b / np.maximum(size_a + size_b, 1.0) ** 2
    return (equal - chance) / (1 - chance)


def _table(column: pa.Array, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


@F.arrow_udf(T.DoubleType())
def _estimate(ra: pa.Array, rb: pa.Array, na: pa.Array, nb: pa.Array) -> pa.Array:
    if not len(ra):
        return pa.array([], pa.float64())
    a, b = _table(ra, np.uint16, BUCKETS), _table(rb, np.uint16, BUCKETS)
    return pa.array(estimates(a, b, na.to_numpy().astype(float), nb.to_numpy().astype(float)))


@F.arrow_udf(T.LongType())
def _shared(sa: pa.Array, sb: pa.Array) -> pa.Array:
    out = []
    for a, b in zip(sa, sb):
        a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
        both = np.concatenate((a, b))
        both.sort(kind="stable")
        out.append(int(np.count_nonzero(both[1:] == both[:-1])))
    return pa.array(out, pa.int64())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node that each linked node reaches.

    Each round points every node to its smallest neighbour (and on to that one's),
    then keeps only links between different ends, drawn between the nodes pointed to. A
    star is gone after two rounds, a long chain shrinks by a factor each round. What a
    round leaves is written to the shared folder.
    """
    ends = links.select(F.least(a, b).alias("low"), F.greatest(a, b).alias("high"))
    edges = hand_over(ends.where(F.col("low") != F.col("high")).distinct(), "links")
    found = None
    while True:
        to = F.inline(F.array(*[F.struct(F.col(c).alias("node"), F.col("low").alias("to")) for c in ("high", "low")]))
        least = hand_over(edges.select(to).groupBy("node").agg(F.min("to").alias("to")), "labels")
        step = least.select(F.col("node").alias("to"), F.col("to").alias("far"))
        least = hand_over(least.join(step, "to").select("node", F.col("far").alias("to")), "labels")
        if found is None:
            found = least.withColumnRenamed("to", "component")
        else:
            found = found.join(least.withColumnRenamed("node", "component"), "component", "left")
            found = hand_over(found.select("node", F.coalesce("to", "component").alias("component")), "labels")
        low, high = (least.select(F.col("node").alias(c), F.col("to").alias(f"new_{c}")) for c in ("low", "high"))
        edges = edges.join(low, "low").join(high, "high")
        edges = edges.select(F.least("new_low", "new_high").alias("low"), F.greatest("new_low", "new_high").alias("high"))
        edges = hand_over(edges.where(F.col("low") != F.col("high")).distinct(), "links")
        if edges.isEmpty():
            return found


def _few(table: DataFrame) -> DataFrame:
    """Broadcast if it has few rows (of some 60 bytes); else the other side moves to it."""
    return F.broadcast(table) if table.count() <= BROADCAST_IDS else table


def _judged(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """One row per document: doc_id, key (a hash of the text), n_shingles, component_id, kept."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text_of(text)).alias("key"), F.col(text).alias("text"))
    signed = rows.select("doc_id", "key", signature(F.col("text")).alias("s")).select("doc_id", "key", "s.*")
    signed = hand_over(signed, "signatures")

    # Each set and the row that stands for it.
    known = signed.where(F.col("doc_id").isNotNull() & F.col("fingerprint").isNotNull())
    sets = known.groupBy(F.col("fingerprint").alias("node")).agg(F.min(F.struct("doc_id", "key")).alias("rep"))
    sets = hand_over(sets.select("node", F.col("rep.doc_id").alias("rep_id"), F.col("rep.key").alias("rep_key")), "sets")
    stands = (F.col("fingerprint") == F.col("node")) & (F.col("doc_id") == F.col("rep_id")) & (F.col("key") == F.col("rep_key"))
    nodes = known.join(sets, stands).groupBy("node").agg(
        F.first("rep_id").alias("rep_id"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers"), F.first("bands").alias("bands")
    )
    nodes = hand_over(nodes, "nodes")
    sketch = nodes.select("node", "n", "registers")
    # The hub is the node of the smallest id: of many edited copies mostly the original.
    bands = nodes.select("rep_id", "node", F.explode("bands").alias("band"))
    hubs = bands.groupBy("band").agg(F.min(F.struct("rep_id", "node"))["node"].alias("hub"), F.count(F.lit(1)).alias("n"))
    hubs = hubs.where("n > 1").select("band", "hub")
    shared = hand_over(bands.drop("rep_id").join(hubs, "band"), "buckets")
    to_hub = shared.where(F.col("hub") != F.col("node")).select(F.col("hub").alias("a"), F.col("node").alias("b"))
    to_hub = hand_over(_likely(sketch, to_hub.distinct()), "pairs-hub")
    first = hand_over(_verified(to_hub, _full_sets(rows, sets, _ends(to_hub))), "links-hub")
    parts = components(first, "a", "b")

    # Buckets that still hold several components.
    part = F.coalesce("component", "node")
    placed = shared.join(parts, "node", "left").select("band", "node", part.alias("part"))
    mixed = placed.groupBy("band").agg(
        F.min("part").alias("low"), F.max("part").alias("high"), F.count(F.lit(1)).alias("size")
    )
    mixed = mixed.where(F.col("low") != F.col("high")).select("band", "size")
    left = hand_over(placed.join(mixed, "band"), "buckets-mixed")
    few = left.where(F.col("size") <= MANY)
    other = few.select("band", F.col("node").alias("b"), F.col("part").alias("part_b"))
    across = few.withColumnRenamed("node", "a").join(other, "band")
    across = across.where((F.col("a") < F.col("b")) & (F.col("part") != F.col("part_b"))).select("a", "b").distinct()
    across = hand_over(_likely(sketch, across), "pairs-across")
    crowd = left.where(F.col("size") > MANY).select("node", F.xxhash64("part").alias("part")).distinct()
    crowd = hand_over(crowd, "crowd")
    full = _full_sets(rows, sets, _ends(across).unionByName(crowd.select("node")))
    second = _verified(across.unionByName(by_rarest(full, crowd)), full)
    second = hand_over(second, "links-across")
    if not second.isEmpty():
        parts = components(first.unionByName(second), "a", "b")

    # The row that stands for each component, or for a set without links.
    labelled = hand_over(sets.join(parts, "node", "left").withColumn("part", part), "labels-all")
    best = F.min(F.struct("rep_id", "node", "rep_key")).alias("best")
    stays = labelled.groupBy("part").agg(best)
    verdict = labelled.select("node", "part").join(stays, "part").select("node", "best")
    found = signed.join(verdict, signed["fingerprint"] == verdict["node"], "left")
    linked = F.col("doc_id").isNotNull() & F.col("best").isNotNull()
    chosen = (F.col("doc_id") == F.col("best.rep_id")) & (F.col("key") == F.col("best.rep_key"))
    chosen = chosen & (F.col("fingerprint") == F.col("best.node"))
    return found.select(
        "doc_id",
        "key",
        "n_shingles",
        F.when(linked, F.col("best.rep_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(linked, chosen).otherwise(F.lit(True)).alias("kept"),
    )


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    return _judged(docs, text, doc_id).drop("key")


def _sets_of(table: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.int64) for x in table["set"]]


def _count_block(table: pa.Table) -> pa.Table:
    """How many sets of the block hold each shingle, and the range of their components."""
    sets = _sets_of(table)
    shingles, at = np.unique(np.concatenate(sets), return_inverse=True)
    part = np.repeat(table["part"].to_numpy(), [len(s) for s in sets])
    low, high = np.full(len(shingles), np.iinfo(np.int64).max), np.full(len(shingles), np.iinfo(np.int64).min)
    np.minimum.at(low, at, part)
    np.maximum.at(high, at, part)
    block = np.full(len(shingles), table["block"][0].as_py())
    return pa.table(
        {"block": block, "shingle": shingles, "sets": np.bincount(at), "low": low, "high": high}
    )


def _first_places(held: pa.Table, met: pa.Table) -> pa.Table:
    """The shared shingles among the first n - ceil(0.75 n) + 1 of each set, those that
    stay within one component left out. What no other set holds comes first."""
    shingles = met["shingle"].to_numpy()
    order = np.argsort(shingles)
    shingles, times = shingles[order], met["sets"].to_numpy()[order]
    crosses = (met["low"].to_numpy() != met["high"].to_numpy())[order]
    out: dict[str, list] = {"shingle": [], "node": [], "part": [], "n": [], "place": []}
    for own, node, part in zip(_sets_of(held), held["node"].to_pylist(), held["part"].to_pylist()):
        n = len(own)
        at = np.searchsorted(shingles, own)
        known = at < len(shingles)
        known[known] = shingles[at[known]] == own[known]
        at = at[known]
        at = at[np.lexsort((shingles[at], times[at]))]
        place = n - len(at) + np.arange(len(at))
        good = (place < n - -(-n * PERCENT // 100) + 1) & crosses[at]
        out["shingle"] += shingles[at[good]].tolist()
        out["place"] += place[good].tolist()
        for name, value in (("node", node), ("part", part), ("n", n)):
            out[name] += [value] * int(good.sum())
    return pa.table({c: pa.array(v, pa.binary() if c == "node" else pa.int64()) for c, v in out.items()})


def by_rarest(full: DataFrame, crowd: DataFrame) -> DataFrame:
    """Pairs (a, b) across components of a crowd that could be similar enough; exact.

    With the shingles of a set in order of how many sets hold them, two similar sets
    have one in common among the first n - ceil(0.75 n) + 1 of each. What only one set
    holds comes first, so a set that shares no more than a common passage is out at
    once; the places of the shared shingle bound what two sets can still have in common.
    """
    held = full.join(crowd, "node").select("node", "part", "set")
    blocks = max(1, -(-crowd.count() // BLOCK))
    held = held.withColumn("block", F.pmod(F.xxhash64("node"), F.lit(blocks)))
    # Blocks of sets count their shingles first: a passage is a few rows for each.
    counts = held.groupBy("block").applyInArrow(_count_block, _COUNTED)
    counts = hand_over(counts, "shingle-counts")
    common = counts.groupBy("shingle").agg(
        F.sum("sets").alias("sets"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    met = counts.select("block", "shingle").join(common.where("sets > 1"), "shingle")
    index = held.groupBy("block").cogroup(met.groupBy("block")).applyInArrow(_first_places, _PLACED)
    index = hand_over(index, "rarest")
    side = lambda x: index.select("shingle", *[F.col(c).alias(f"{c}_{x}") for c in ("node", "part", "n", "place")])
    rest = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    both = side("a").join(side("b"), "shingle").where(
        (F.col("node_a") < F.col("node_b"))
        & (F.col("part_a") != F.col("part_b"))
        & (rest * (100 + PERCENT) >= (F.col("n_a") + F.col("n_b")) * PERCENT)
    )
    return both.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def deduplicate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents that stay, with their own columns: one row of each component."""
    judged = hand_over(_judged(docs, text, doc_id), "near-verdicts")
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col(doc_id).alias("id"), F.xxhash64(text_of(text)).alias("key"))
    pairs = lambda df: df.select(F.col("doc_id").alias("_i"), F.col("key").alias("_k"))
    same = F.col("id").eqNullSafe(F.col("_i")) & (F.col("key") == F.col("_k"))
    gone = hand_over(pairs(judged.where("NOT kept")).distinct(), "near-gone")
    left = rows.join(_few(gone), same, "left_anti")
    linked = judged.where("kept AND n_shingles > 0 AND doc_id IS NOT NULL")
    again = linked.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    again = hand_over(pairs(again), "near-repeated")
    if not again.isEmpty():
        first = numbered_alike(left.join(again, same, "left_semi"), ["id", "key"], "near-repeated", "number")
        left = left.join(again, same, "left_anti").unionByName(first.where("number = 0").drop("number"))
    return left.select(*[F.col("doc")[c].alias(c) for c in docs.columns])


def _sized() -> Column:
    return F.least("na", "nb") * 100 >= F.greatest("na", "nb") * PERCENT


def _likely(sketch: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes and sketches do not rule out."""
    side = lambda c: sketch.select(
        F.col("node").alias(c), F.col("registers").alias(f"r{c}"), F.col("n").alias(f"n{c}")
    )
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(_sized())
    return both.withColumn("e", _estimate("ra", "rb", "na", "nb")).where(F.col("e") >= ESTIMATE).select("a", "b")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))


def _full_sets(rows: DataFrame, sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, set) of the wanted nodes, each from the row that stands for it."""
    ids = hand_over(sets.join(wanted.distinct(), "node").select("node", "rep_id", "rep_key"), "wanted")
    same = (F.col("doc_id") == F.col("rep_id")) & (F.col("key") == F.col("rep_key"))
    full = rows.join(_few(ids), same).select("node", _set_bytes("text").alias("set"))
    full = hand_over(full, "full-sets")
    # Rows that repeat id and text stand for their set together; one is enough.
    return full if full.count() == ids.count() else full.groupBy("node").agg(F.first("set").alias("set"))


def _verified(likely: DataFrame, full: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = full.select(F.col("node").alias("a"), F.col("set").alias("sa"), (F.octet_length("set") / 8).alias("na"))
    right = full.select(F.col("node").alias("b"), F.col("set").alias("sb"), (F.octet_length("set") / 8).alias("nb"))
    both = likely.join(left, "a").join(right, "b").where(_sized()).withColumn("shared", _shared("sa", "sb"))
    union = F.col("na") + F.col("nb") - F.col("shared")
    return both.where(F.col("shared") * 100 >= union * PERCENT).select("a", "b").distinct()
