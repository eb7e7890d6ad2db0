"""Spelling variants of the corpus' words, by PartEnum signatures of letter multisets.

One inserted, deleted or replaced letter changes a word's multiset of letters by at
most two, that is, two words that are near have binary vectors (one dimension for
each letter and how often it has come) at a Hamming distance of at most two. PartEnum
deals the dimensions into `PARTS` parts and takes, for each way to leave out two of
them, the projection on the others as a signature: two differences lie in at most two
parts, so near words agree in at least one signature. Here a letter's dimensions are
all in one part, and a projection is the word's sorted letters without those of two
parts, held together with the word's length. Words whose lengths differ by one differ in
one dimension only, so for them one part is left out. Hashed signatures meet in an
equi-join, and the pairs are verified by their edit distance; nothing is missed.

Words are counted by an aggregate that combines on the map side, so a frequent word
is one row for each task. A word's form is the most frequent of its near words if that
is at least twice as frequent; forms are followed to the last one by pointer jumping
(counts double with each step, so there are no circles).

Defined cases: a null text has no words; a null id is hashed as an empty text; rows that
repeat are counted each; ties go to the smaller word in code-point order. Other columns
are not read. An empty table gives no rows.
"""

from __future__ import annotations

import string
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanack.llm.tables import text_of
from almanack.session import hand_over

RUN = r"[A-Za-zÀ-ÿ]+"
#: One letter is deleted in a run of a document whose hash this number divides.
DAMAGE = 97
LEAST_LETTERS, LEAST_COUNT = 5, 3
#: A form is at least so many times as frequent as the word.
FACTOR = 2
#: Parts of the dimensions; leaving out two gives 21 signatures, leaving out one 14 more.
PARTS, DISTANCE = 7, 2
LETTERS = string.ascii_lowercase + "".join(map(chr, range(0xC0, 0x100)))


def parts(letters: str = LETTERS, count: int = PARTS) -> list[str]:
    """The alphabet dealt into parts, vowels and other neighbours apart."""
    return [letters[p::count] for p in range(count)]


def _without(word: Column, letters: str) -> Column:
    return F.translate(word, letters, "")


def runs(text: Column) -> Column:
    """All maximal runs of letters, A-Z lower-cased and no other."""
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lower, F.lit(RUN), F.lit(0))


def damaged(run: Column, doc_id: Column) -> Column:
    """The run with one letter deleted where id and run hash to a multiple of DAMAGE."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run)
    h = F.crc32(key.cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % DAMAGE == 0, cut).otherwise(run)


def counted(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(word, n): all words of enough letters that occur often enough."""
    run = docs.select(F.col(doc_id).alias("id"), F.explode(runs(text_of(text))).alias("run"))
    words = run.select(damaged(F.col("run"), F.col("id")).alias("word")).where(F.char_length("word") >= LEAST_LETTERS)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def signatures(word: Column) -> Column:
    """Hashed projections of the word's sorted letters. Even ones leave out two parts and
    hold the word's length: words of one length that differ in two dimensions share one.
    Odd ones leave out one part and hold the length of the longer word, here as the
    longer and as the shorter one: such words differ in one dimension only."""
    inside = F.array_join(F.array_sort(F.split(word, "")), "")
    size, dealt = F.char_length(word), parts()
    out = []
    for left_out in combinations(range(PARTS), DISTANCE):
        rest = _without(inside, "".join(dealt[p] for p in left_out))
        out.append(F.shiftleft(F.xxhash64(F.lit(str(left_out)), size, rest), 1))
    for p in range(PARTS):
        rest = _without(inside, dealt[p])
        out += [F.shiftleft(F.xxhash64(F.lit(str(p)), longer, rest), 1) + 1 for longer in (size, size + 1)]
    return F.array(*out)


def near_pairs(words: DataFrame) -> DataFrame:
    """All pairs (a, b, n_a, n_b) of near words, once each."""
    signed = words.select("word", "n", F.explode(signatures(F.col("word"))).alias("signature"))
    left = signed.select(F.col("word").alias("a"), F.col("n").alias("n_a"), "signature")
    right = signed.select(F.col("word").alias("b"), F.col("n").alias("n_b"), "signature")
    # Of two words of one length the smaller stands left, else the shorter one.
    one_length = (F.col("signature") % 2 == 0) & (F.col("a") < F.col("b"))
    longer = (F.col("signature") % 2 != 0) & (F.char_length("a") < F.char_length("b"))
    met = left.join(right, "signature").where((one_length | longer) & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "b", "n_a", "n_b").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of each (word, form): forms followed to the last, by jumps that
    double in length."""
    at = hand_over(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        step = at.select(F.col("word").alias("_root"), F.col("root").alias("_next"))
        new = at.join(step, at["root"] == step["_root"], "left")
        new = hand_over(
            new.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "forms"
        )
        at = new.select("word", "root")
        if new.where("moved").isEmpty():
            return at


def variants(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = hand_over(counted(docs, text, doc_id), "words")
    there = F.struct(F.col("a").alias("word"), F.col("n_b").alias("n"), F.col("b").alias("other"))
    back = F.struct(F.col("b").alias("word"), F.col("n_a").alias("n"), F.col("a").alias("other"))
    pairs = near_pairs(words).select(F.inline(F.array(there, back)))
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("other").alias("word")))
    near = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    wins = -F.col("best.n") >= F.col("n") * FACTOR
    found = joined.select(
        "word",
        F.when(wins, F.col("best.word")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(wins, -F.col("best.n")).alias("form_n"),
    )
    found = hand_over(found, "word-forms")
    end = roots(found.where(F.col("form").isNotNull()))
    found = found.join(end, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
