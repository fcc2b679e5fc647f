from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from railyard.llm import quality_rules as Q


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    twice, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if twice[g] > 1:
            covered.update(range(i, i + 8))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def check(rows, texts):
    for r in rows:
        want = plain(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, texts[r.doc_id]
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


def test_counts(docs_of):
    rng = random.Random(2)
    texts = [None, "", " \n\t\x0b", "a", "é# <b>\n\n \nx\nx", "a b c d e f g h " * 3, "x " * 30, "\x1fa b", "A b", "one two " * 60000]
    texts += ["".join(rng.choice(["a", "b ", "a ", "\n", "\t", "#", "é "]) for _ in range(rng.randint(0, 150))) for _ in range(300)]
    docs = docs_of(texts, w="w", h="h", s="s", g="g", n_words="n")
    rows = Q.judged(docs).collect()
    assert len(rows) == len(texts)
    check(rows, texts)
    assert Q.judged(docs.limit(0)).collect() == []


def test_whole_table(spark, sf001):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()}
    rows = Q.op1_quality_rules(spark, sf001).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    check(rows, texts)


def test_agrees_with_labels(spark):
    sf = "/root/testdata/sf0.1"
    rows = Q.op1_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    counts = {(r.quality, r.kept): r["count"] for r in rows.groupBy("quality", "kept").count().collect()}
    caught = counts.get((0, False), 0) / max(1, counts.get((0, False), 0) + counts.get((0, True), 0))
    good = [r for r in rows.where("quality = 1 and not base_failed").groupBy("kept").count().collect()]
    lost = {r.kept: r["count"] for r in good}.get(False, 0) / max(1, sum(r["count"] for r in good))
    assert caught > 0.95 and lost < 0.005, counts


def test_em_finds_the_accuracies(spark):
    """Votes drawn from known accuracies; the same EM in numpy gives the same numbers."""
    rng = np.random.RandomState(1)
    truth = rng.rand(20000) < 0.7
    acc, rules = [(0.95, 0.6), (0.9, 0.8), (0.98, 0.5), (0.9, 0.9)], ["a", "b", "c", "d"]
    right = np.stack([rng.rand(20000) < np.where(truth, *p) for p in acc], 1)
    v = np.where(rng.rand(20000, 4) < 0.2, 0, np.where(right == truth[:, None], 1, -1))
    table = spark.createDataFrame([tuple(map(int, x)) for x in v], "a int, b int, c int, d int").groupBy(*rules).agg(F.count(F.lit(1)).alias("n"))
    rounds = 40
    accuracy, share = Q.estimate(table.cache(), rules, rounds)
    good, bad, s = np.full(4, Q.START_ACCURACY[0]), np.full(4, Q.START_ACCURACY[1]), Q.START_SHARE
    for _ in range(rounds):
        odds = np.log(s / (1 - s)) + (v == 1) @ np.maximum(0, np.log(good / (1 - bad))) + (v == -1) @ np.minimum(0, np.log((1 - good) / bad))
        p = (1 / (1 + np.exp(-odds)))[:, None]
        s = (p.sum() + 1) / (len(p) + 2)
        good = ((p * (v == 1)).sum(0) + Q.START_ACCURACY[0]) / ((p * (v != 0)).sum(0) + 1)
        bad = (((1 - p) * (v == -1)).sum(0) + Q.START_ACCURACY[1]) / (((1 - p) * (v != 0)).sum(0) + 1)
    assert [accuracy[r] for r in rules] == [pytest.approx(x, abs=1e-9) for x in zip(good, bad)] and share == pytest.approx(s, abs=1e-9)
    assert list(zip(good, bad)) == [pytest.approx(x, abs=0.05) for x in acc]


def test_plan_has_no_python(docs_of):
    plan = Q.text_counts(docs_of(["a"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan
