from __future__ import annotations

import zlib

import numpy as np

from railyard.llm import language_id as L

EN = "the cat and the dog went to the market with their friends and the other people there"
DE = "der hund und die katze gehen mit ihren freunden auf den markt und die anderen leute nicht"


def test_counts_match_a_plain_count():
    texts = ["", "ab", "Abc!", "éa b 12", "  ", "aaaa"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    at = np.cumsum([0] + [len(t.encode()) for t in texts])
    got = L.trigram_counts(data, at)
    for i, t in enumerate(texts):
        b = [c if c >= 128 else ord(chr(c).lower()) if chr(c).isalpha() else 32 for c in t.encode()]
        want = np.zeros(L.DIMENSIONS)
        for x in range(len(b) - 2):
            code = b[x] << 16 | b[x + 1] << 8 | b[x + 2]
            if code != 0x202020:
                want[(code * 0x9E3779B1 & 0xFFFFFFFF) >> 20] += 1
        assert (got[i] == want).all()


def test_edges(docs_of, spark):
    rows = [(i, " ".join(np.random.RandomState(i).permutation(EN.split()))) for i in range(40)]
    rows_de = [(100 + i, " ".join(np.random.RandomState(i).permutation(DE.split()))) for i in range(40)]
    odd = [(200, None), (201, ""), (202, "12 34 !"), (203, EN * 2000), (None, DE), (203, EN), (204, "".join(chr(0x4E00 + 37 * i) for i in range(200)))]
    docs = docs_of(rows).unionByName(docs_of(rows_de, lang="de")).unionByName(docs_of(odd, lang=None))
    model = L.learn(docs)
    assert sorted(set(model.langs)) == ["de", "en"]
    got = {(r.row.doc_id, r.row.text): r for r in L.predict(docs, model).collect()}
    for i, _ in odd[:3]:
        r = next(v for k, v in got.items() if k[0] == i)
        assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
    assert got[203, EN].lang_pred == got[203, EN * 2000].lang_pred == "en" and got[None, DE].lang_pred == "de"
    assert got[odd[-1]].rejected and not got[None, DE].rejected
    assert all(0 <= r.score <= 1 for r in got.values())
    none = L.learn(docs.limit(0))
    assert {r.lang_pred for r in L.predict(docs, none).collect()} == {"und"}
    assert L.predict(docs.limit(0), model).collect() == []


def test_held_out_accuracy(spark, sf001):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()}
    rows = L.op2_language_id(spark, sf001).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out and len(docs[r.doc_id].text.split()) >= 5]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.97
    clean = [r for r in rows if len(docs[r.doc_id].text.split()) >= 5]
    assert np.mean([r.rejected for r in clean]) < 0.005
