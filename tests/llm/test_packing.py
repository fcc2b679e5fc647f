from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest

from railyard.llm import packing as P


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.word_tokens().path)


def check(pieces, texts, tokenizer, window):
    """Round trip: every id lies in exactly one piece, sequences are gapless and full or a power of two."""
    ids = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], np.uint32) for i, t in texts}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start:p.start + p.length].tobytes())
        by_doc[p.doc_id].append((p.start, p.length))
        by_sequence[p.sequence_id].append((p.offset, p.length))
    copies = defaultdict(int)
    for i, _ in texts:
        copies[i] += 1
    for i, n in copies.items():
        cover = np.zeros(len(ids[i]) + 1, int)
        for s, k in by_doc[i]:
            assert k > 0
            cover[s:s + k] += 1
        assert (cover[:-1] == n).all() and cover[-1] == 0
    for spans in by_sequence.values():
        at = 0
        for o, k in sorted(spans):
            assert o == at
            at += k
        assert at <= window and (at == window or at & (at - 1) == 0)


@pytest.mark.parametrize("window", [64, 4096])
def test_round_trip(docs_of, tokenizer, window):
    rng = np.random.RandomState(window)
    texts = [(i, " ".join(["word"] * k)) for i, k in enumerate(rng.randint(0, 3 * window, 120))]
    texts += [(500, None), (501, ""), (502, " \n "), (503, "é <|endoftext|> Ünḯ a\x1cb\tc"), (504, "long, text. " * 9000)]
    texts += [(600 + i, "the same " * 9) for i in range(80)] + [(700, "twice given " * 7)] * 2
    pieces = P.pack(docs_of(texts, rest="r", rank="k", ids="i"), P.word_tokens(), window).collect()
    check(pieces, texts, tokenizer, window)


def test_spellings_of_a_word_are_encoded_once():
    encoder = P._Encoder(P.word_tokens())
    texts = ["The thent. THE, the\nThent the.", "thent, The  thent."]
    assert list(encoder.encode(texts)) == [ids + encoder.end for ids in encoder._plain(texts)]
    assert sorted(encoder.known) == ["", ",", ".", "the", "thent"]


@pytest.mark.parametrize("words", [800_000, 3])
def test_ids_are_the_tokenizers(monkeypatch, words):
    monkeypatch.setattr(P, "CACHED_WORDS", words)
    encoder = P._Encoder(P.word_tokens())
    texts = ["<|ENDOFTEXT|>. A, b", "A<|endoftext|>. The, end.", "\u212a \u0130 \u03a3. \u0391\u03a3, A\u0301. e\u0301, E\u030a", "a.\u0301 b. \u0301c",
             "don't. 's. 'S, X. it'LL, we'Re.", "a.. b., c,. . , .", "A.\r\nB,\tC.\x0bD,\x1cE. ", "\x00A. \u00a0B,\u2028c.\u00a0", "x1. 1. A1, 2,b.", "Q" * 5000 + ". r", ""]
    assert list(encoder.encode(texts + texts)) == 2 * [ids + encoder.end for ids in encoder._plain(texts)]


def test_small_tables(docs_of, tokenizer):
    assert P.pack(docs_of(["x"]).limit(0), P.word_tokens()).collect() == []
    texts = [(None, None)]
    assert [tuple(r) for r in P.pack(docs_of(texts), P.word_tokens()).collect()] == [
        (None, 0, 1, zlib.crc32(np.uint32(2).tobytes()), 1, 0, 0)]


def test_whole_table(spark, sf001, tokenizer):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()]
    check(P.op4_packing(spark, sf001).collect(), texts, tokenizer, 4096)


@pytest.mark.parametrize("seed", range(6))
def test_plan(seed):
    """Each item has one place; fills are exact; few items are cut."""
    rng = np.random.RandomState(seed)
    window = 256
    hist = np.zeros(window + 1, np.int64)
    np.add.at(hist, 1 + rng.lognormal(4, 1, 8000).astype(int) % (window - 1), 1)
    if seed > 3:
        hist[200] += 9000  # one length with half of the items
    plan = P.plan_of(hist, window)
    placed, fill = np.zeros(window + 1, np.int64), np.zeros(plan.sequences, np.int64)
    for a, lo, hi, seq, times, _ in plan.places:
        assert lo == placed[a]
        placed[a] = hi
        fill[seq:seq + (hi - lo) // times] += a * times
    assert (fill == window).all()
    left = hist - placed
    assert (left >= 0).all() and {a: int(placed[a]) for a in np.flatnonzero(left)} == plan.stream_from
    assert plan.stream_tokens == (left * np.arange(window + 1)).sum()
    if seed <= 3:
        assert left.sum() < 0.1 * hist.sum()


def test_nnls_against_enumeration():
    """The solution's residual is no worse than that of any small whole-number choice."""
    hist = np.zeros(13, np.int64)
    hist[[3, 4, 5, 6, 7, 9]] = [4, 3, 2, 5, 2, 1]
    combos = P.combinations_of(hist, 12)
    x = P.nnls(combos, hist, 2000)
    assert (x >= 0).all()
    a = np.array([[c.count(k) for c in combos] for k in range(13)])
    gradient = a.T @ (a @ x - hist)
    assert (gradient > -1e-3).all() and abs((gradient * x).sum()) < 1e-2  # optimality conditions
