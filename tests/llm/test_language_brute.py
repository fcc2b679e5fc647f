"""The prediction recomputed one text at a time, in plain Python, from the model's centroids and weights."""

import math
from collections import Counter

from railyard.llm import language_id as L


def trigrams(text):
    """Hashed trigrams of bytes: letters A-Z lower-cased, bytes of other scripts, everything else a blank."""
    out = []
    for b in (text or "").encode():
        out.append(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32)
    grams = Counter()
    for a, b, c in zip(out, out[1:], out[2:]):
        code = a << 16 | b << 8 | c
        if code != 0x202020:
            grams[(code * 0x9E3779B1 & 0xFFFFFFFF) >> 20] += 1
    return grams


def cosines(text, model):
    v = {f: n * float(model.idf[f]) for f, n in trigrams(text).items()}
    norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
    return [sum(x * float(c[f]) for f, x in v.items()) / norm for c in model.centroids]


def test_labels_are_those_of_the_nearest_centroid(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    model = L.learn(docs)
    got = {r.doc_id: r for r in L.op2_language_id(spark, sf001).collect()}
    assert len(model.langs) == len(model.centroids) > len(set(model.langs))
    predicted = {r.row.doc_id: r for r in L.predict(docs, model).collect()}
    checked = 0
    for row in docs.select("doc_id", "text").collect():
        near = cosines(row.text, model)
        best = max(range(len(near)), key=near.__getitem__)
        runner_up = max((c for k, c in enumerate(near) if model.langs[k] != model.langs[best]), default=0.0)
        if near[best] - runner_up < 1e-4 or not any(ch.isalpha() for ch in row.text or ""):
            continue  # a tie in single precision, or nothing to tell by
        assert predicted[row.doc_id].lang_pred == model.langs[best]
        checked += 1
    assert checked > 150 and set(got) == set(predicted)
