from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from railyard.llm import log_bilinear as B


def words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", text), None]


def check_base(rows, texts, held):
    counts = Counter(w for k, t in texts.items() if not held(k) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    for r in rows:
        w = words(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(w), sum(counts[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), rel=1e-9)


def test_whole_table(spark, sf001, monkeypatch):
    monkeypatch.setattr(B, "KNOWN", 300)  # most words take the way of the joined table
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()}
    rows = B.op10_lm_scoring(spark, sf001).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    check_base(rows, texts, lambda k: zlib.crc32(str(k).encode()) % 7 == 2)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # better than the unigram base on unseen texts


def test_edges(docs_of):
    rows = [(1, None), (2, ""), (3, "A b"), (4, "a B\x0bc " * 20000), (5, "new words"), (6, "é"), (7, "a a a b")]
    docs = docs_of(rows, w="w", n="n", suffix="s", rare="r")
    got = B.scores(docs, F.col("doc_id") != 5).collect()
    check_base(got, dict(rows), lambda k: k == 5)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    again = B.scores(docs_of([(1, "x y"), (1, "x y"), (None, "x")]), F.lit(True)).collect()
    assert len(again) == 3 and again[0].train_tokens == 8
    assert B.scores(docs.limit(0), F.lit(True)).collect() == []
    assert [r.n_known for r in B.scores(docs_of(["q"]), F.lit(False)).collect()] == [0]


def test_probabilities_sum_to_one(spark, sf001):
    texts = spark.read.parquet(f"{sf001}/documents.parquet").select("text")
    vocabulary, model, counts = B.learn(texts)
    m = vocabulary.start
    for two, one in [(m, m), (m, 0), (0, m - 1), (5, 9), (m - 1, m // 2)]:
        logs = model.log10(np.full(m, two), np.full(m, one), np.arange(m))
        assert (10.0 ** logs).sum() == pytest.approx(1, abs=1e-4)
    known = counts.toPandas()
    suffix = known["suffix"].to_numpy()
    _, n, unit, shared = vocabulary.look_up(known["w"].to_numpy().view(np.uint64), suffix)
    assert (~shared).sum() == B.own_words(vocabulary.n) + 1 and len(set(unit[~shared])) == B.own_words(vocabulary.n) + 1
    assert not set(unit[shared]) & set(unit[~shared]) and set(unit[shared]) <= set(vocabulary.suffix_units[1:])
    rest = counts.select(F.col("w"), F.col("n")).toPandas().set_index("w")["n"].loc[known["w"]].to_numpy()
    inside = np.bincount(suffix[shared], (rest[shared] + 1.0) / 10 ** vocabulary.share[suffix[shared]], B.SUFFIXES + 1)
    unseen = 10 ** -vocabulary.share  # one unseen word of each suffix
    assert inside[1:] + unseen[1:] == pytest.approx(np.ones(B.SUFFIXES), abs=1e-9)


def test_own_words_grow_with_the_tokens():
    assert [B.own_words(n) for n in (0, 10 ** 4, 10 ** 6, 10 ** 8)] == [95, 100, 1000, 10000]


def as_block(texts, start):
    return np.concatenate([np.concatenate([[start, start], t]) for t in texts])


def test_training_approaches_the_distribution():
    """On a known Markov chain of units the model nears its entropy."""
    rng = np.random.RandomState(0)
    p = rng.dirichlet(np.full(12, 0.3), 12)
    texts = []
    for _ in range(400):
        t = [rng.randint(12)]
        while len(t) < 100:
            t.append(rng.choice(12, p=p[t[-1]]))
        texts.append(np.array(t))
    counts = np.bincount(np.concatenate(texts), minlength=12)
    number = np.empty(12, int)
    number[np.argsort(-counts, kind="stable")] = np.arange(12)
    texts, p = [number[t] for t in texts], p[np.ix_(np.argsort(number), np.argsort(number))]
    new, touched = B.train(B.LogBilinear.new(np.sort(counts)[::-1]), (as_block(texts[k::20], 12) for _ in range(3) for k in range(20)))
    one, c = (np.concatenate(x) for x in ([t[1:-1] for t in texts], [t[2:] for t in texts]))
    two = np.concatenate([t[:-2] for t in texts])
    got, best = new.log10(two, one, c).mean(), np.log10(p[one, c]).mean()
    flat = np.log10(np.bincount(c, minlength=12)[c] / len(c)).mean()
    assert got > flat + 0.7 * (best - flat)
    assert (touched[:13] > 0).all()


def test_trains_on_every_token(docs_of, monkeypatch):
    """However large the corpus, every learning token is in one block of one round of a pass."""
    monkeypatch.setattr(B, "UNIT_BLOCK", 1000)
    rounds = []

    def seen(model, blocks, shares):
        rounds.extend((r.share, shares, r.units) for r in blocks.collect())
        return model

    monkeypatch.setattr(B, "trained", seen)
    texts = ["a b c d " * 3000, "a b c d " * 3000, *(f"{x} {y} {z}" for x in "abcd" for y in "abcd" for z in "abcd"), "", None]
    vocabulary, _, _ = B.learn(docs_of(texts).select("text"))
    assert all(0 <= share < shares == (vocabulary.n // 1000 + 1).bit_length() for share, shares, _ in rounds)
    unit = {int(h): int(u) for h, u in zip(vocabulary.hashes, vocabulary.units)}
    want = Counter()
    for t in texts:
        hashes, suffix, _ = B.tokens(np.frombuffer((t or "").encode(), np.uint8), np.array([0, len(t or "")]))
        want[tuple(unit[int(h)] if s else vocabulary.suffix_units[0] for h, s in zip(hashes, suffix))] += 1
    got = Counter()
    for _, _, block in rounds:
        text = None
        for u in [*block, vocabulary.start]:
            if u == vocabulary.start:
                if text:
                    got[tuple(text)] += 1
                text = []
            else:
                text.append(u)
    assert got == want and sum(len(t) * n for t, n in got.items()) == vocabulary.n


def test_score_by_hand(docs_of, monkeypatch):
    """The score of a text from the model's parameters, token by token in plain Python."""
    learnt = {}
    learn = B.learn
    monkeypatch.setattr(B, "learn", lambda texts: learnt.setdefault("all", learn(texts)))
    texts = [" ".join(f"w{i * i % (20 + k)}{'xyz'[i % 3]}" for i in range(300)) for k in range(40)] + ["unseen words", ""]
    docs = docs_of(texts)
    got = {r.doc_id: r.score for r in B.scores(docs, F.col("doc_id") != 40).collect()}
    vocabulary, model, counts = learnt["all"]
    count = {r.w: r.n for r in counts.collect()}
    rows, m, d = model.rows.astype(float), vocabulary.start, B.DIM
    targets = rows[m + 1:-2 * d]

    def log_share(q, own, at):
        s = [sum(x * y for x, y in zip(q, t[:d])) + t[d] for t in own]
        return (s[at] - math.log(sum(map(math.exp, s)))) / math.log(10)

    assert any(vocabulary.look_up(B.tokens(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[0], np.ones(len(t.split()) + 1, int))[3].any() for t in texts[:3])
    for r in docs.collect()[-5:]:
        data = np.frombuffer(r.text.encode(), np.uint8)
        hashes, suffix, _ = B.tokens(data, np.array([0, len(data)]))
        _, _, unit, shared = vocabulary.look_up(hashes, suffix)
        one, two, want = m, m, 0.0
        for h, s, u, of_many in zip(hashes, suffix, unit, shared):
            q = rows[one, :d] @ rows[-2 * d:-d, :d] + rows[two, :d] @ rows[-d:, :d]
            c = u // model.size
            want += log_share(q, targets[:model.classes], c)
            want += log_share(q, targets[model.classes:][c * model.size:min(m, (c + 1) * model.size)], u - c * model.size)
            if of_many:
                want += math.log10(count.get(int(h.view(np.int64)), 0) + 1) - vocabulary.share[s]
            one, two = u, one
        assert got[r.doc_id] == pytest.approx(want, rel=1e-4)


def test_known_words_change_no_score(docs_of, monkeypatch):
    """Few long texts: the end is rarer than the known words, and its class has no other token."""
    docs = docs_of([" ".join(f"w{i % (7 + k)}" for i in range(400)) + f" once{k}" for k in range(3)])
    want = {r.doc_id: r for r in B.scores(docs, F.lit(True)).collect()}
    monkeypatch.setattr(B, "KNOWN", 0)
    for r in B.scores(docs, F.lit(True)).collect():
        assert (r.score, r.base_score) == pytest.approx((want[r.doc_id].score, want[r.doc_id].base_score), rel=1e-9)
        assert r.n_known == want[r.doc_id].n_known


def test_one_normalisation_a_context_and_class(monkeypatch):
    """Trigrams of equal context whose units are of one class share the normalisation within it, too."""
    model = B.LogBilinear.new(np.arange(100, 0, -1))  # classes of ten units
    rng = np.random.RandomState(1)
    two, one, unit, times, inverse = B.distinct_trigrams(*(rng.randint(0, n, 5000) for n in (100, 3, 3)), 100)
    want, log_sums, normalised = model.log10(two[:1], one[:1], unit[:1]), B._log_sums, []
    monkeypatch.setattr(B, "_log_sums", lambda q, targets: normalised.append(len(q)) or log_sums(q, targets))
    got = model.log10(two, one, unit)
    contexts, pairs = set(zip(two, one)), set(zip(two, one, unit // model.size))
    assert sum(normalised) == len(contexts) + len(pairs) < len(unit)
    assert got[0] == pytest.approx(want[0]) and len(inverse) == times.sum() == 5000
    x = rng.permutation(len(unit))  # whatever the order
    assert model.log10(two[x], one[x], unit[x]) == pytest.approx(got[x], abs=1e-5)


def test_log_sums_of_large_products():
    q, targets = np.array([[300.0, 1], [0, 1], [-300, 1]], np.float32), np.array([[1, 0], [-1, 2]], np.float32)
    assert B._log_sums(q, targets) == pytest.approx([300, math.log(1 + math.e ** 2), 302])
    assert len(B._log_sums(q[:0], targets)) == 0


@pytest.mark.parametrize("most", [1, 50, 70_000, 2 ** 62])
def test_sorted_places_and_sums(most):
    rng = np.random.RandomState(2)
    keys = rng.randint(0, most, 3000)
    keys[::7] = keys[3]
    order, at = B.sorted_places(keys)
    assert (order == np.argsort(keys, kind="stable")).all() and (at == keys[order]).all()
    rows, first = rng.randn(3000, 3).astype(np.float32), B.run_starts(at)
    want = np.zeros((len(first), 3))
    np.add.at(want, np.unique(keys, return_inverse=True)[1], rows)
    assert B.sums_of_runs(rows, order, first) == pytest.approx(want, abs=1e-3)
    assert [len(x) for x in B.sorted_places(keys[:0])] == [0, 0] and len(B.run_starts(keys[:0])) == 0


def test_distinct_words_of_texts():
    """A word that isn't known is joined once a text, however often the text has it."""
    hashes, row = np.array([7, 7, 3, 7, 9, 3, 3], np.uint64), np.array([0, 0, 0, 2, 2, 4, 4])
    words, times, at = B.distinct_words(hashes, row, 6)
    got = [sorted(zip(words[a:b].tolist(), times[a:b].tolist())) for a, b in zip(at, at[1:])]
    assert got == [[(3, 1), (7, 2)], [], [(7, 1), (9, 1)], [], [(3, 2)], []]
    assert B.distinct_words(hashes[:0], row[:0], 2)[2].tolist() == [0, 0, 0]


def test_squares_of_long_tasks_dont_overflow(spark):
    # frequent trigrams and many steps in a task: the summed squares, times the steps, are beyond 64 bits
    model, m, steps = B.LogBilinear.new(np.full(4, 10.0)), 4, 300
    block = np.concatenate([[m, m], np.arange(1 << 18) % m])
    rows = spark.createDataFrame([(block.tolist(),)], "units array<int>").crossJoin(spark.range(steps)).select(F.lit(0).alias("share"), "units")
    alone, at = B.train(model, iter([block] * steps), 0)
    squares = alone.seen - model.seen
    assert (squares * at * B.SCALE).max() > 2.0 ** 63
    got = B.trained(model, rows.coalesce(1), 1)
    np.testing.assert_allclose(got.seen[at > 0], alone.seen[at > 0], rtol=1e-6)
    np.testing.assert_allclose(got.rows, alone.rows, atol=1e-5)
    two = B.trained(model, rows.repartition(2), 1).seen  # the sum over tasks was an error
    assert np.isfinite(two).all() and two.max() > 0.3 * alone.seen.max()
