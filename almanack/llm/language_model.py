"""Stupid-backoff scores of documents under the n-gram counts of the whole corpus.

Words are those between white space with A-Z as a-z. The score of a word is the share
of its n-gram in its context's count, and 0.4 times the score at the next lower order
where the n-gram does not occur. Each document is scored by the counts of all others:
its own counts are taken off, so that it does not vouch for itself.

    chunks    documents as word sequences, some megabytes of text each
    requests  the distinct n-grams of each chunk with their counts, by hash bucket
    answers   in each bucket the counts are added up (the count table of that bucket)
              and joined back to the requests
    scores    each chunk's sequences with the counts they asked for, summed per document

A frequent n-gram is one entry per chunk, and buckets are dealt by the n-gram's hash;
so buckets are even, however skewed the words are. The number of buckets follows the
corpus. N-grams are identified by 64-bit hashes, which travel as compressed differences.

`scored_by_join` says the same with DataFrame joins alone: count tables by hash, joined to
the exploded n-grams, summed per document. It moves every n-gram of every document as a
row, which is what the packed form saves (figures in the README).

Defined cases: null and empty texts have no words and a null score; in a corpus of one
document nothing is known and all words have the score of an unseen one, 0.4 / max(N, 1)
with N words in other documents. Ids may be of any type; repeated rows count as further
documents; null ids are kept. Further columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from almanack.llm import text as X
from almanack.llm.tables import bounded_batches, text_of
from almanack.session import hand_over

ORDER = 2
BACKOFF = 0.4
CHUNK_BYTES = 8 << 20
#: Words of the corpus per bucket of the count tables.
BUCKET_WORDS = 1_500_000

_CHUNK = "chunk bigint, ids array<{}>, lengths array<int>, words bigint, vocabulary binary, sequence binary"
_PLACE = X.mix(np.arange(201, 233, dtype=np.uint64)) | np.uint64(1)


def _pack(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes: first all lowest bytes, then all second ones, ..."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpack(packed: bytes, kind: str) -> np.ndarray:
    n, width = int.from_bytes(packed[:8], "little"), np.dtype(kind).itemsize
    planes = pa.decompress(packed[8:], n * width, codec="zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(width, n).T.copy().view(kind).ravel()


def _chunk_rows(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId(), 0
    ids, lengths, hashes, size = [], [], [], 0

    def row() -> pa.RecordBatch:
        whole = np.concatenate(hashes)
        vocabulary, sequence, counts = np.unique(whole, return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")  # small numbers for frequent words
        rank = np.empty(len(order), "<u4")
        rank[order] = np.arange(len(order))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([(part << 32) + number], pa.int64()),
                pa.array([ids], pa.list_(kind)),
                pa.array([np.concatenate(lengths).astype(np.int32)], pa.list_(pa.int32())),
                pa.array([len(whole)], pa.int64()),
                pa.array([_pack(vocabulary[order])], pa.binary()),
                pa.array([_pack(rank[sequence])], pa.binary()),
            ],
            [x.split()[0] for x in _CHUNK.split(", ")],
        )

    for batch in batches:
        names, at = batch["id"].to_pylist(), 0
        for texts in X.slices(batch["text"]):
            texts = X.lowered(texts)
            starts, ends, first = texts.runs(X.SPACE[texts.data])
            ids += names[at : at + texts.n]
            lengths.append(np.diff(first))
            hashes.append(texts.hashes(texts.sums(), starts, ends))
            at, size = at + texts.n, size + len(texts.data)
            if size >= CHUNK_BYTES:
                yield row()
                number += 1
                ids, lengths, hashes, size = [], [], [], 0
    if ids:
        yield row()


def _grams(row: dict, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order 1 .. n: the n-gram hash that ends at each word, and whether the
    document has that many words up to there."""
    words = _unpack(row["vocabulary"], "<u8")[_unpack(row["sequence"], "<u4")]
    lengths = np.array(row["lengths"], np.int64)
    place = X.ranges(np.zeros(len(lengths), np.int64), lengths)  # of the word in its document
    out = []
    for k in range(1, order + 1):
        value = np.zeros(len(words), np.uint64)
        for j in range(k):
            value[k - 1 :] += words[j : len(words) - k + 1 + j] * _PLACE[j]
        out.append((X.mix(value + _PLACE[31 - k]), place >= k - 1))
    return out


def _distinct(row: dict, order: int, buckets: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(order, bucket, hashes, counts) of a chunk, for buckets that it has n-grams of."""
    for k, (values, whole) in enumerate(_grams(row, order), 1):
        hashes, counts = np.unique(values[whole], return_counts=True)
        bucket = _bucket(hashes, buckets)
        cut = np.flatnonzero(np.diff(bucket, prepend=-1))
        for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(hashes)]):
            yield k, int(bucket[a]), hashes[a:b], counts[a:b]


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Equal ranges of hashes, so that sorted hashes have sorted buckets."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _answer(table: pa.Table) -> pa.Table:
    """Adds up the counts of a bucket and gives each request the totals of its n-grams."""
    hashes = [np.cumsum(_unpack(x.as_py(), "<u8"), dtype=np.uint64) for x in table["hashes"]]
    counts = [_unpack(x.as_py(), "<u4") for x in table["counts"]]
    _, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(inverse, np.concatenate(counts)).astype("<u8")
    ends = np.cumsum([len(h) for h in hashes]).tolist()
    found = [_pack(total[inverse[b - len(h) : b]]) for h, b in zip(hashes, ends)]
    return pa.table(
        {"chunk": table["chunk"], "size": table["size"], "bucket": table["bucket"], "totals": pa.array(found, pa.binary())}
    )


def scored(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", order: int = ORDER, backoff: float = BACKOFF
) -> DataFrame:
    """doc_id, n_words, n_backoff (words whose longest n-gram no other document has)
    and score (mean natural logarithm per word)."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    id_type = rows.schema["id"].dataType
    kind, spec = to_arrow_type(id_type), _CHUNK.format(id_type.simpleString())
    chunks = hand_over(rows.mapInArrow(lambda batches: _chunk_rows(batches, kind), spec), "lm-chunks")
    words = chunks.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    buckets = max(1, -(-words // BUCKET_WORDS))

    def requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = list(_distinct(row, order, buckets))
                for a in range(0, len(found), 256):
                    part = found[a : a + 256]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["chunk"]] * len(part), pa.int64()),
                            pa.array([k for k, _, _, _ in part], pa.int32()),
                            pa.array([b for _, b, _, _ in part], pa.int64()),
                            pa.array([_pack(np.diff(h, prepend=np.uint64(0))) for _, _, h, _ in part], pa.binary()),
                            pa.array([_pack(c.astype("<u4")) for _, _, _, c in part], pa.binary()),
                        ],
                        ["chunk", "size", "bucket", "hashes", "counts"],
                    )

    def score(sequences: pa.Table, answers: pa.Table) -> pa.Table:
        out = {"doc_id": [], "n_words": [], "n_backoff": [], "score": []}
        replies = {}
        for k, b, t in zip(*(answers[c].to_pylist() for c in ("size", "bucket", "totals"))):
            replies[k, b] = _unpack(t, "<u8")
        for row in sequences.to_pylist():
            lengths = np.array(row["lengths"], np.int64)
            doc = np.repeat(np.arange(len(lengths)), lengths)
            total, backoffs = _score_words(row, replies, doc, lengths, order, buckets, words, backoff)
            has = lengths > 0
            sums = np.bincount(doc, total, len(lengths))
            out["doc_id"] += row["ids"]
            out["n_words"] += lengths.tolist()
            out["n_backoff"] += np.bincount(doc, backoffs, len(lengths)).astype(int).tolist()
            out["score"] += [s if h else None for s, h in zip((sums / np.maximum(lengths, 1)).tolist(), has)]
        kinds = (kind, pa.int64(), pa.int64(), pa.float64())
        return pa.table({c: pa.array(v, k) for (c, v), k in zip(out.items(), kinds)})

    asked = chunks.mapInArrow(requests, "chunk bigint, size int, bucket bigint, hashes binary, counts binary")
    answers = asked.groupBy("size", "bucket").applyInArrow(_answer, "chunk bigint, size int, bucket bigint, totals binary")
    both = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk"))
    return both.applyInArrow(score, f"doc_id {id_type.simpleString()}, n_words bigint, n_backoff bigint, score double")


def _score_words(
    row: dict,
    replies: dict,
    doc: np.ndarray,
    lengths: np.ndarray,
    order: int,
    buckets: int,
    words: int,
    backoff: float,
) -> tuple[np.ndarray, np.ndarray]:
    """The logarithm of each word's score, and whether it was backed off."""
    others = []  # counts of the n-gram ending at each word in other documents, by order
    salt = X.mix(doc.astype(np.uint64))
    for k, (values, whole) in enumerate(_grams(row, order), 1):
        hashes, inverse = np.unique(values[whole], return_inverse=True)
        bucket = _bucket(hashes, buckets)
        asked = sorted(set(bucket.tolist()))
        total = np.concatenate([replies[k, b] for b in asked]) if asked else np.zeros(0, np.uint64)
        _, own, count = np.unique(X.mix(values[whole] ^ salt[whole]), return_inverse=True, return_counts=True)
        found = np.zeros(len(values), np.int64)
        found[whole] = total[inverse].astype(np.int64) - count[own]
        others.append((found, whole))
    rest = np.maximum(words - lengths, 1)[doc].astype(float)
    single = others[0][0]
    score = np.where(single > 0, np.maximum(single, 1) / rest, backoff / rest)
    backed = single == 0
    for k in range(2, order + 1):
        found, whole = others[k - 1]
        context = np.concatenate(([0], others[k - 2][0][:-1]))  # ends one word earlier
        seen = whole & (found > 0)
        score = np.where(seen, found / np.maximum(context, 1), np.where(whole, backoff * score, score))
        backed = np.where(whole, ~seen, backed)
    return np.log(score), backed


def scored_by_join(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", order: int = ORDER, backoff: float = BACKOFF
) -> DataFrame:
    """What `scored` returns, by joins of DataFrames."""
    lower = F.translate(text_of(text), string.ascii_uppercase, string.ascii_lowercase)
    words = F.regexp_extract_all(lower, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), words.alias("words"))
    rows = hand_over(rows.withColumn("n_words", F.size("words").cast("long")), "lm-words")

    def grams(at: Column) -> Column:
        ends = [F.when(at >= k, F.xxhash64(F.lit(k), F.slice("words", at - k + 1, k))) for k in range(1, order + 1)]
        return F.array(*[F.struct(at.alias("at"), F.lit(k).alias("size"), g.alias("gram")) for k, g in enumerate(ends, 1)])

    each = F.flatten(F.transform(F.sequence(F.lit(1), F.size("words")), grams))
    asked = rows.where("n_words > 0").select("row", F.inline(each)).where(F.col("gram").isNotNull())
    own = asked.groupBy("row", "gram").agg(F.count(F.lit(1)).alias("own"))
    counts = asked.groupBy("gram").agg(F.count(F.lit(1)).alias("total"))
    others = own.join(counts, "gram").select("row", "gram", (F.col("total") - F.col("own")).alias("others"))
    found = hand_over(asked.join(others, ["row", "gram"]).select("row", "at", "size", "others"), "lm-found")
    # The context of an n-gram is the shorter one that ends a word earlier.
    shifted = found.select("row", (F.col("at") + 1).alias("at"), (F.col("size") + 1).alias("size"), F.col("others").alias("context"))
    both = found.join(shifted, ["row", "at", "size"], "left").groupBy("row", "at")
    of = lambda c, k: F.max(F.when(F.col("size") == k, F.col(c))).alias(f"{c}{k}")
    places = both.agg(*[of(c, k) for c in ("others", "context") for k in range(1, order + 1)])
    total = rows.agg(F.sum("n_words")).first()[0] or 0
    places = places.join(rows.select("row", "n_words"), "row")
    rest = F.greatest(F.lit(total) - F.col("n_words"), F.lit(1)).cast("double")
    score = F.when(F.col("others1") > 0, F.col("others1") / rest).otherwise(backoff / rest)
    backed = F.col("others1") == 0
    for k in range(2, order + 1):
        there, seen = F.col(f"others{k}").isNotNull(), F.col(f"others{k}") > 0
        score = F.when(~there, score).when(seen, F.col(f"others{k}") / F.col(f"context{k}")).otherwise(backoff * score)
        backed = F.when(there, ~seen).otherwise(backed)
    sums = places.groupBy("row").agg(F.count_if(backed).alias("n_backoff"), F.avg(F.log(score)).alias("score"))
    out = rows.drop("words").join(sums, "row", "left")
    return out.select("doc_id", "n_words", F.coalesce("n_backoff", F.lit(0)).cast("long").alias("n_backoff"), "score")
