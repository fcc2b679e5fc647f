import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from railyard.llm import importance_sampling as S
from railyard.llm.position_crc import PositionCrc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(text):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [zlib.crc32(" ".join(words[i:i + n]).encode()) % 10000
                        for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(docs, target):
    """(doc_id, n_features, weight, score, rank, n_words) of (doc_id, text) pairs."""
    made = [(doc, *runs(text)) for doc, text in docs]
    s = np.bincount([b for _, _, f in made for b in f], minlength=10000)
    t = np.bincount([b for text in target for b in runs(text)[1]], minlength=10000)
    gain = [math.floor(1000 * math.log((int(t[i]) + 1) * (int(s.sum()) + 10000) / ((int(s[i]) + 1) * (int(t.sum()) + 10000))))
            for i in range(10000)]
    rows = []
    for doc, n_words, f in made:
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append((doc, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), n_words))
    best = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    rank = {id(r): i + 1 for i, r in enumerate(best[:5 * len(best) // 100])}
    return [(*r[:4], rank.get(id(r)), r[4]) for r in rows]


def order(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("depth", [8, 256])
def test_crc_of_spans(depth):
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 50_000, dtype=np.uint8)
    starts = rng.integers(0, 20_000, 400)
    ends = starts + np.concatenate([rng.integers(1, 40, 200), rng.integers(200, 300, 150), rng.integers(300, 30_000, 50)])
    got = PositionCrc(depth).spans(data, starts, ends)
    assert got.tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends)]


def test_crc_in_runs_of_bounded_size(monkeypatch):
    monkeypatch.setattr("railyard.llm.position_crc.LAID_OUT", 100)
    data = np.random.default_rng(2).integers(0, 256, 2000, dtype=np.uint8)
    starts, ends = np.arange(0, 1700), np.arange(0, 1700) + 1 + np.arange(1700) % 290
    assert PositionCrc().spans(data, starts, ends).tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends)]


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.text("aB é9-\n!", max_size=60)), max_size=6), piece=st.sampled_from([1, 7, 40]))
def test_features_whatever_the_pieces(texts, piece):
    before, S.PIECE = S.PIECE, piece
    try:
        got, words = [[] for _ in texts], [0] * len(texts)
        for of, bucket, docs, counts in S.hashed_runs(texts):
            for d, b in zip(of.tolist(), bucket.tolist()):
                got[d].append(b)
            for d, n in zip(docs.tolist(), counts.tolist()):
                words[d] += n
    finally:
        S.PIECE = before
    want = [runs(t) for t in texts]
    assert words == [n for n, _ in want]
    assert [sorted(g) for g in got] == [sorted(f) for _, f in want]


def test_edge_rows(spark, docs_of):
    long_word, many = "x" * 200_000, " ".join(f"w{i % 977}" for i in range(60_000))
    texts = [None, "", "... !", "One", "one two", long_word + " " + long_word + " end", many, "é ü " * 30] + ["a b c d e f g h i j " * 3] * 60
    pairs = list(enumerate(texts)) + [(None, "null id " * 20), (7, texts[7])]
    docs = docs_of(pairs, weight="x", score="y", rank="z")
    target = docs_of(["one two three", None, "é ü é"])
    got = S.resample(docs, target).collect()
    assert order(got) == order(brute(pairs, ["one two three", None, "é ü é"]))


def test_empty_tables(spark, docs_of):
    assert S.resample(docs_of([]), docs_of(["a b"])).collect() == []
    got = S.resample(docs_of(["a b"]), docs_of([])).collect()
    assert order(got) == order(brute([(0, "a b")], []))


def test_ranks_across_many_parts_with_ties(spark):
    rows = [(i % 500 if i % 7 else None, 25 if i % 5 else 3, 0, 10, 100 - i % 3, i) for i in range(3000)]
    scored = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long, row long")
    got = {r.row: r["rank"] for r in S.drawn(scored, percent=50, rows_per_part=90).collect()}
    best = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[5]))
    want = {r[5]: None for r in rows} | {r[5]: i + 1 for i, r in enumerate(best[:len(best) // 2])}
    assert got == want


def test_query_and_sql_agree_on_whole_table(spark, sf001):
    got = S.op12_importance_sampling(spark, sf001).collect()
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf001}/{t}.parquet')")
    rows = con.execute(f"SELECT doc_id, n_features, weight, score, rank, n_words FROM ({S.OP12_SQL})").fetchall()
    assert order(got) == order(rows)
    docs = con.execute("SELECT doc_id, text FROM documents").fetchall()
    assert order(got) == order(brute(docs, [t for t, in con.execute("SELECT text FROM benchmark").fetchall()]))
