from __future__ import annotations

import re

import corpus_pipeline as C
from railyard.llm import jaccard_join, packing, pii
from tests.llm.test_jaccard_join import brute


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def check(spark, docs):
    """Each stage against brute force on what the one before has kept."""
    columns = docs.columns
    first = C.language(spark, docs, "").cache()
    assert first.columns == columns
    assert not [r for r in first.collect() if not re.search(r"[^\W\d_]", r.text or "")]

    rows = [(r.doc_id, r.text) for r in first.collect()]
    best = {}
    for i, t in rows:
        best[squeezed(t)] = min(best.get(squeezed(t), (1, False, 0)), (-len(t), i is None, i or 0))
    second = C.exact_copies(spark, first, "").cache()
    assert second.columns == columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in second.collect()) == sorted(b[1:] for b in best.values())

    kept = [(r.doc_id, r.text) for r in second.collect()]
    groups = brute(kept, jaccard_join.Join(5, 8, 10))
    third = C.near_copies(spark, second, "").cache()
    assert third.columns == columns
    want = sorted(i for (i, t), (n, c) in groups.items() if i is not None and (n == 0 or i == c))
    assert sorted(r.doc_id for r in third.collect() if r.doc_id is not None) == want

    weights = pii.learn(third)
    texts = {r.doc_id: r.text for r in third.collect()}
    fourth = C.personal_data(spark, third, "").cache()
    assert fourth.columns == columns
    for r in fourth.collect():
        assert r.text == pii.redact(texts[r.doc_id], pii.find(texts[r.doc_id], weights)[1]) and r.n_chars == len(r.text)

    pieces = C.sequences(spark, fourth, "").collect()
    encoder = packing._Encoder.of(packing.word_tokens())
    total = sum(len(next(encoder.encode([r.text]))) // 4 for r in fourth.collect())
    assert sum(p.length for p in pieces) == total
    return len(rows), len(kept), len(texts)


def test_stages_on_a_table(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    n, distinct, different = check(spark, docs)
    assert docs.count() >= n > distinct >= different


def test_odd_rows(spark, docs_of):
    rows = [(1, None), (2, ""), (3, "12 !"), (4, "the cat and the dog " * 9), (5, "the cat and  the dog " * 9), (None, "a null id here"),
            (7, "mail a@b.co now please"), (8, "long words here " * 9000)]
    check(spark, docs_of(rows, row="r", h="h", ids="i"))
    assert C.sequences(spark, C.near_copies(spark, C.exact_copies(spark, docs_of(["x"]).limit(0), ""), ""), "").collect() == []


def test_stage_list():
    assert [name for name, _ in C.STAGES] == ["language ID", "exact dedup", "n-gram Jaccard join", "PII", "packing"]
    assert C.ORACLE_SQL is None
