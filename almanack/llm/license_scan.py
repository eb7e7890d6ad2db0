"""Licence notices in texts, found through a positional index of rare words.

DataFrame functions only. Every template (a notice or a short phrase) is indexed by
its rarest words, rare by the number of documents that hold them in the whole corpus:
a posting is (word, template, place in the template). A document's indexed words meet
the postings; words that stand as far apart as in the template agree on where it would
begin. A template counts where its key phrase stands word for word and the rare words of
the key agree. At least one word of the key is indexed, so every place of a key phrase
is found, whichever words the corpus makes rare; what stands around it only adds to the
score. For base phrases, which are all key, one rare word is indexed.

Only documents with an indexed word are looked at further. The index holds some dozen
words for each of a fixed number of templates.

Defined cases: null texts count as empty, with no words, no places and score 0; labels
are empty strings where there are none; repeated rows are scanned each; further columns
are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanack.llm.tables import text_of
from almanack.session import hand_over

#: What stands between words, once A-Z have become a-z.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a template that are indexed, and how many of them must agree on a place, if
#: its key phrase has as many of them.
RAREST, AGREEING = 12, 3
#: Indexed words have at least this share of the inverse document frequency of the
#: template's rarest word, so that articles and the like are left out; the rarest word of
#: the key phrase is always indexed.
LEAST_IDF = 0.5
#: Words that one row holds of a document that is looked at further.
BLOCK = 2_000


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_at(self) -> int:
        """Where the key phrase begins in the template."""
        key, words = self.key.split(), self.words
        return next(i for i in range(len(words)) if words[i : i + len(key)] == key)


# The phrases asked for, and the wording of well-known notices.
BASE = [
    Template("cc-by", "cc by", "cc by", True),
    Template("gpl", "general public license", "general public license", True),
    Template("reserved", "all rights reserved", "all rights reserved", True),
]
NOTICES = [
    Template(
        "agpl",
        "under the terms of the gnu affero general public license as published by the free software foundation",
        "affero general public license",
    ),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met",
        "source and binary forms",
    ),
    Template(
        "boost",
        "distributed under the boost software license version 1 0 see accompanying file",
        "boost software license",
    ),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template(
        "cc-by-sa",
        "this work is licensed under a creative commons attribution sharealike 4 0 international license",
        "creative commons attribution sharealike",
    ),
    Template(
        "cc0",
        "to the extent possible under law the author has waived all copyright and related or neighboring rights "
        "to this work",
        "waived all copyright and related or neighboring rights",
    ),
    Template(
        "gpl-notice",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published "
        "by the free software foundation",
        "gnu general public license as published by the free software foundation",
    ),
    Template(
        "gpl-work",
        "this work is licensed under the gnu general public license version 3",
        "gnu general public license version 3",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is "
        "hereby granted",
        "with or without fee is hereby granted",
    ),
    Template("lgpl", "the gnu lesser general public license as published", "gnu lesser general public license"),
    Template("mit", "released under the mit license", "mit license"),
    Template(
        "mit-notice",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files",
        "free of charge to any person obtaining a copy",
    ),
    Template(
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "mozilla public license v 2 0",
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        "unencumbered software released into the public domain",
    ),
    Template(
        "zlib",
        "this software is provided as is without any express or implied warranty",
        "as is without any express or implied warranty",
    ),
]
# Other usual wordings, all key.
NOTICES += [
    Template(label, key, key)
    for label, keys in {
        "apache-2.0": ("apache license 2 0", "apache license v2 0", "apache 2 0 license"),
        "bsd": ("bsd 2 clause", "bsd 3 clause", "bsd license"),
        "boost": ("boost license 1 0",),
        "cc-by-nc": ("creative commons attribution noncommercial", "creative commons attribution non commercial"),
        "cc-by-sa": ("cc by sa", "creative commons attribution share alike"),
        "cc0": ("cc0 1 0", "creative commons zero"),
        "gpl-work": ("gnu general public license v3", "gnu gpl version 3", "gnu gpl v3"),
        "isc": ("isc license",),
        "mit": ("mit licence",),
        "mpl-2.0": ("mozilla public license 2 0", "mozilla public license version 2 0", "mozilla public license v2 0"),
        "unlicense": ("the unlicense",),
        "zlib": ("zlib license",),
    }.items()
    for key in keys
]


def words_of(text: Column) -> Column:
    # The Kelvin sign is the one character that would become an ASCII letter.
    low = F.lower(F.replace(text, F.lit("K"), F.lit("ĸ")))
    return F.array_remove(F.split(low, BETWEEN), "")


def document_counts(docs: DataFrame, words: list[str], text: str = "text") -> tuple[int, dict[str, int]]:
    """How many documents there are, and how many hold each of the given words."""
    known = F.array(*[F.lit(w) for w in words])
    found = docs.select(F.explode(F.array_intersect(words_of(text_of(text)), known)).alias("word"))
    counts = {r["word"]: r["count"] for r in found.groupBy("word").count().collect()}  # the templates' words at most
    return docs.count(), counts


def index_of(templates: list[Template], documents: int, counts: dict[str, int]) -> list[dict]:
    """Postings of each template's rarest words, by inverse document frequency."""
    postings = []
    for number, t in enumerate(templates):
        idf = {w: math.log((1 + documents) / (1 + counts.get(w, 0))) for w in t.words}
        rare = sorted(idf, key=lambda w: (-idf[w], w))[: 1 if t.base else RAREST]
        rare = [w for w in rare if idf[w] >= LEAST_IDF * idf[rare[0]]]
        key = sorted(set(t.key.split()), key=lambda w: (-idf[w], w))
        if not set(key) & set(rare):
            rare.append(key[0])
        need = 1 if t.base else min(AGREEING, len(set(key) & set(rare)))
        postings += [(w, number, i, need, len(rare)) for i, w in enumerate(t.words) if w in rare]
    return postings


def _rows(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A literal table."""
    structs = [F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def scanned(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", templates: list[Template] | None = None
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    spark = docs.sparkSession
    templates = BASE + NOTICES if templates is None else templates
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    vocabulary = sorted({w for t in templates for w in t.words})
    postings = index_of(templates, *document_counts(rows, vocabulary))
    indexed = F.array(*[F.lit(w) for w in sorted({p[0] for p in postings})])

    # How far the key phrase reaches before and behind an indexed word.
    before = max(place - templates[n].key_at for _, n, place, _, _ in postings)
    behind = max(templates[n].key_at + len(templates[n].key.split()) - place for _, n, place, _, _ in postings)
    before, behind = max(before, 0), max(behind, 1)

    words = rows.select("doc_id", words_of(text_of("text")).alias("words"))
    w = F.col("words")
    blocks = F.transform(
        F.sequence(F.lit(0), F.size(w) - 1, F.lit(BLOCK)),
        lambda start: F.struct(
            start.alias("start"),
            F.least(start, F.lit(before)).alias("lead"),
            F.slice(
                w, F.greatest(start - before, F.lit(0)) + 1, F.least(start, F.lit(before)) + BLOCK + behind
            ).alias("part"),
        ),
    )
    likely = words.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.size(w).cast("long").alias("n_words"),
        F.when(F.arrays_overlap(w, indexed), blocks).alias("blocks"),
    )
    likely = hand_over(likely, "license-words")

    part = F.col("part")
    held = likely.where(F.col("blocks").isNotNull()).select("row", F.inline("blocks"))
    held = held.withColumn("held", F.array_intersect(part, indexed)).where(F.size("held") > 0)
    inside = F.sequence(F.col("lead"), F.least(F.col("lead") + BLOCK, F.size(part)) - 1)
    hits = F.transform(
        F.filter(inside, lambda i: F.array_contains(F.col("held"), F.get(part, i))),
        lambda i: F.struct(
            (F.col("start") - F.col("lead") + i).alias("at"),
            F.get(part, i).alias("word"),
            F.least(i, F.lit(before)).alias("left"),
            F.slice(part, F.greatest(i - before, F.lit(0)) + 1, F.least(i, F.lit(before)) + behind).alias("near"),
        ),
    )
    places = held.select("row", F.inline(hits))
    index = F.broadcast(_rows(spark, ["word", "template", "place", "need", "rare"], postings))
    keys = [(i, t.label, t.base, t.key_at, t.key) for i, t in enumerate(templates)]
    keys = F.broadcast(_rows(spark, ["template", "label", "base", "key_at", "key"], keys))
    near = places.join(index, "word").join(keys, "template")
    wanted = F.size(F.split("key", " "))
    first = F.col("left") + F.col("key_at") - F.col("place") + 1  # of the key phrase among the words near by
    there = F.array_join(F.slice("near", F.greatest(first, F.lit(1)), wanted), " ") == F.col("key")
    votes = near.groupBy("row", "template", (F.col("at") - F.col("place")).alias("begin")).agg(
        F.count_distinct("word").alias("agree"),
        F.first("need").alias("need"),
        F.first("rare").alias("rare"),
        F.first("label").alias("label"),
        F.first("base").alias("base"),
        F.max((first >= 1) & there).alias("key_stands"),
    )
    found = votes.where((F.col("agree") >= F.col("need")) & F.col("key_stands"))
    base = F.col("base")
    result = found.groupBy("row").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("begin"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("begin"))).cast("long").alias("last_word"),
        F.collect_set(F.when(base, F.col("label"))).alias("base_labels"),
        F.collect_set("label").alias("labels"),
        F.max(F.col("agree") / F.col("rare")).alias("score"),
    )
    none = F.array().cast("array<string>")
    joined = lambda c: F.array_join(F.array_sort(F.coalesce(F.col(c), none)), ",").alias(c)
    return likely.select("row", "doc_id", "n_words").join(result, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        joined("base_labels"),
        joined("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
