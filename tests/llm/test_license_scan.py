from __future__ import annotations

import random
import re

from railyard.llm import license_scan as S


def words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def plain_base(text):
    w = words(text)
    places = [(i, label) for label, phrase in S.BASE for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
    return (len(w), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None),
            ",".join(sorted({label for _, label in places})))


def plain_labels(text):
    """Labels and score by comparing all positions of text and templates."""
    w = words(text)
    labels, score = set(plain_base(text)[4].split(",")) - {""}, 1.0 if plain_base(text)[1] else 0.0
    for label, phrase in S.TEMPLATES:
        p = phrase.split()
        hits = sorted({(i - j, j) for i in range(len(w) - 2) for j in range(len(p) - 2) if w[i:i + 3] == p[j:j + 3]})
        groups = []
        for d, j in hits:
            if groups and d - groups[-1][0] <= S.NEAR:
                groups[-1][0] = d
                groups[-1][1].update((j, j + 1, j + 2))
            else:
                groups.append([d, {j, j + 1, j + 2}])
        for _, covered in groups:
            score = max(score, len(covered) / len(p))
            if len(covered) / len(p) >= (1 if len(p) <= S.SHORT else S.SHARE):
                labels.add(label)
    return ",".join(sorted(labels)), score


def check(rows, texts):
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_base(texts[r.doc_id]), texts[r.doc_id]
        labels, score = plain_labels(texts[r.doc_id])
        assert r.labels == labels and abs(r.score - score) < 1e-12, (texts[r.doc_id], r)


def test_cases(docs_of):
    rng = random.Random(4)
    texts = [None, "", " - ", "Under the MIT License", "under THE mit. license under the mit license", "CC BY-NC 4.0 cc-by-nc", "é_mit", "cc by",
             "Apache License, Version 2.0", "under the mit licence", "under the mit \u212a license", "cc by\u212a nc \u0130", "cc by nc " * 30000,
             "permission is hereby granted, free of any charge, to any person who is obtaining a copy of this software and associated documentation files",
             "All rights\nreserved.", "x" * 100000]
    pieces = [p for _, p in S.BASE + S.TEMPLATES]
    for _ in range(200):
        w = []
        for _ in range(rng.randint(1, 3)):
            p = rng.choice(pieces).split()
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(p))
                p[at:at + 1] = rng.choice([[], ["zz"], [p[at], "zz"]])
                p = p or ["zz"]
            w += p + ["yy"] * rng.randint(0, 3)
        texts.append(" ".join(w))
    docs = docs_of(texts, g="g", h="h", template="t", label="l", n="n", span="s")
    rows = S.scan(docs).collect()
    assert len(rows) == len(texts)
    check(rows, texts)


def test_repeated_rows_and_empty_table(docs_of):
    rows = S.scan(docs_of([(1, "cc by nc"), (1, "cc by nc"), (1, "none"), (None, "cc by nc")])).collect()
    assert sorted((r.doc_id or 0, r.n_base, r.labels) for r in rows) == [(0, 1, "cc-by-nc"), (1, 0, ""), (1, 1, "cc-by-nc"), (1, 1, "cc-by-nc")]
    assert S.scan(docs_of(["x"]).limit(0)).collect() == []


def test_whole_table(spark, sf001):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()}
    rows = S.op6_license_scan(spark, sf001).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    check(rows, texts)


def test_plan_has_no_python(docs_of):
    plan = S.scan(docs_of(["a"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
