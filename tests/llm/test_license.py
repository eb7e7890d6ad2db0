from __future__ import annotations

import re

from pyspark.sql import functions as F

from almanack.llm import license_scan as S
from tests.llm.conftest import frame, prose


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(rows):
    documents = len(rows)
    held = [set(words(t)) for _, t in rows]
    templates = S.BASE + S.NOTICES
    counts = {w: sum(w in h for h in held) for t in templates for w in t.words}
    index = {}
    for w, number, place, need, rare in S.index_of(templates, documents, counts):
        index.setdefault(number, (need, rare, []))[2].append((w, place))
    out = []
    for i, text in rows:
        w, base, labels, score = words(text), [], set(), 0.0
        for number, t in enumerate(templates):
            need, rare, postings = index[number]
            key = t.key.split()
            for begin in range(-len(t.words), len(w)):
                agree = {x for x, p in postings if 0 <= begin + p < len(w) and w[begin + p] == x}
                at = begin + t.key_at
                if at >= 0 and w[at : at + len(key)] == key and len(agree) >= need:
                    labels.add(t.label)
                    score = max(score, len(agree) / rare)
                    if t.base:
                        base.append((begin, t.label))
        starts = [b for b, _ in base]
        names = ",".join(sorted({x for _, x in base}))
        out.append((i, len(w), len(base), min(starts, default=None), max(starts, default=None), names, ",".join(sorted(labels)), score))
    return out


def key(row):
    return tuple(str(x) for x in row)


def test_scan_equals_brute_force(spark, awkward, monkeypatch):
    notices = [(200 + i, f"{prose(i, 30)}\n{t.text.title()}. {prose(i + 50, 20)}") for i, t in enumerate(S.NOTICES)]
    edited = [(300, "You may redistribute and use in source and BINARY forms, with or without big modification, are permitted")]
    many = [
        (400, "All rights reserved. all Rights-reserved cc by cc by! General public license, general. public; license"),
        (401, "reserved all rights"),
        (402, "rights reserved"),
        (403, "cc"),
        (404, ("x " * 60 + "All rights reserved. ") * 40),
        (405, "maKe ccKby ccby CC BY-NC 4.0"),
        (406, "All rights reserved"),
        (407, "Licensed under the Apache License, Version 2.0." * 3),
    ]
    rows = [*awkward, *notices, *edited, *many, *[(500 + i, prose(i, 40) + " the of and under this") for i in range(30)]]
    monkeypatch.setattr(S, "BLOCK", 50)
    df = frame(spark, rows).withColumn("words", F.lit(1)).withColumn("row", F.lit("r")).withColumn("label", F.lit(2))
    got = sorted((tuple(r) for r in S.scanned(df).collect()), key=key)
    assert got == sorted(brute(rows), key=key)
    assert {x for r in got for x in r[6].split(",")} >= {t.label for t in S.BASE + S.NOTICES}


def test_main_path_has_no_python(spark):
    plan = S.scanned(frame(spark, [(1, "All rights reserved")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_no_documents(spark):
    assert S.scanned(frame(spark, [])).count() == 0
