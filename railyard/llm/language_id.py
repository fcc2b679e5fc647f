"""Language identification by nearest centroid (operator 2).

A text is the TF-IDF vector of its byte trigrams (A-Z lower-cased, every other ASCII non-letter read as a blank),
hashed to ``DIMENSIONS`` and normalised. Each language has several centroids, found by spherical k-means; a text gets
the language of the centroid with the largest cosine. A text is marked rejected if its cosine is under ``REJECT_SHARE``
of what all but ``REJECT_QUANTILE`` of the language's learning rows reach; for texts of fewer than ``FULL_EVIDENCE``
different trigrams, whose cosines are small by nature, that bound shrinks with the root of their number.

Document frequencies cover all learning rows. Only the centroids are fitted on a sample, of at most ``FIT_DOCS`` rows a
language (smallest hashes of id and text). The model's size depends on the number of languages alone.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and rejected, as is everything when
there is nothing to learn from. Rows of null lang are predicted, never learnt from. Ties go to the first language in
alphabetical order. A null doc_id counts as the empty id. Repeated rows are predicted alike; other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from railyard.llm.common import bounded_batches, documents, remainder_is
from railyard.llm.wordhash import text_chunks

DIMENSIONS = 4096
CENTROIDS = 4
FIT_DOCS = 400
ROWS = 256  # texts whose vectors of DIMENSIONS are held at a time
REJECT_SHARE = 0.5
REJECT_QUANTILE = 0.02
FULL_EVIDENCE = 64
UNKNOWN = "und"

_letter = np.full(256, 0x20, np.uint32)
_letter[97:123] = np.arange(97, 123)
_letter[65:91] = np.arange(97, 123)
_letter[128:] = np.arange(128, 256)


def trigram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of hashed trigram counts for each text; trigrams of blanks only don't count."""
    n = len(offsets) - 1
    if len(data) < 3:
        return np.zeros((n, DIMENSIONS), np.float32)
    b = _letter[data]
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    row = np.repeat(np.arange(n), np.diff(offsets))
    inside = (row[:-2] == row[2:]) & (code != 0x202020)
    feature = ((code * np.uint32(0x9E3779B1)) >> np.uint32(20)).astype(np.int64)
    cell = (row[:-2] * DIMENSIONS + feature)[inside]
    return np.bincount(cell, minlength=n * DIMENSIONS).astype(np.float32).reshape(n, DIMENSIONS)


def unit_vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = counts * idf
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a task: in how many texts each feature occurs, then the number of texts."""
    total = np.zeros(DIMENSIONS + 1, np.int64)
    for batch in batches:
        for first, end, data, offsets in text_chunks(batch.column(0), rows=ROWS):
            total[:-1] += (trigram_counts(data, offsets) > 0).sum(0)
            total[-1] += end - first
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMENSIONS + 1)), pa.array(total)], ["feature", "n"])


def _vectors(idf: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offsets in text_chunks(batch.column(1), rows=ROWS):
            x = unit_vectors(trigram_counts(data, offsets), idf)
            at = pa.array(np.arange(end - first + 1, dtype=np.int32) * DIMENSIONS)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first),
                                              pa.ListArray.from_arrays(at, pa.array(x.ravel()))], ["lang", "vector"])


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids and each row's cosine to its own; started from rows far from those chosen before."""
    chosen = [int(np.argmax(x @ x.mean(0)))]
    while len(chosen) < min(k, len(x)):
        nearest = (x @ x[chosen].T).max(1)
        nearest[chosen] = np.inf
        chosen.append(int(np.argsort(nearest, kind="stable")[len(x) // 20 if len(x) // 20 < len(x) - len(chosen) else 0]))
    centroids = x[chosen].copy()
    for _ in range(rounds):
        own = np.argmax(x @ centroids.T, 1)
        for c in range(len(centroids)):
            if (own == c).any():
                mean = x[own == c].mean(0)
                centroids[c] = mean / max(float(np.sqrt(mean @ mean)), 1e-12)
    return centroids, (x @ centroids.T).max(1)


def _fit(rows: pd.DataFrame) -> pd.DataFrame:
    x = np.stack([np.asarray(v, np.float32) for v in rows["vector"]])
    x = x[np.lexsort(x[:, :8].T)]  # the same model in whatever order rows arrive
    centroids, cosines = spherical_kmeans(x, CENTROIDS)
    return pd.DataFrame({"lang": rows["lang"].iloc[0], "centroid": [c.tolist() for c in centroids],
                         "least": float(np.quantile(cosines, REJECT_QUANTILE))})


class Model:
    """Languages (one for each centroid), centroids, the least usual cosine, and the features' weights."""

    def __init__(self, langs: list[str], centroids: np.ndarray, least: np.ndarray, idf: np.ndarray):
        self.langs, self.centroids, self.least, self.idf = langs, centroids, least, idf


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    totals = dict(rows.select("text").mapInArrow(_frequencies, "feature long, n long").groupBy("feature").agg(
        F.sum("n").alias("n")).collect())
    n = totals.get(DIMENSIONS, 0)
    df = np.array([totals.get(i, 0) for i in range(DIMENSIONS)], np.float64)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    per_lang = docs.where(F.col(lang_col).isNotNull()).groupBy(F.col(lang_col).alias("lang")).agg(
        F.count(F.lit(1)).alias("in_lang"))
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = rows.withColumn("draw", draw).join(F.broadcast(per_lang), "lang").where(
        F.col("draw") * F.col("in_lang") <= 2 * FIT_DOCS + 50)
    first = Window.partitionBy("lang").orderBy("draw", "id")
    sample = some.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= FIT_DOCS).select("lang", "text")
    fitted = sample.mapInArrow(partial(_vectors, idf), "lang string, vector array<float>").groupBy("lang").applyInPandas(
        _fit, "lang string, centroid array<float>, least double").orderBy("lang").collect()
    return Model([r.lang for r in fitted],
                 np.array([r.centroid for r in fitted], np.float32).reshape(-1, DIMENSIONS),
                 np.array([r.least for r in fitted]), idf)


def _predict(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, text, has a letter) -> (row, language, score, rejected)."""
    for batch in batches:
        for first, end, data, offsets in text_chunks(batch.column(1), rows=ROWS):
            letters = batch.column(2).slice(first, end - first).to_numpy(zero_copy_only=False).astype(bool)
            n = end - first
            if len(model.langs):
                counts = trigram_counts(data, offsets)
                evidence = np.sqrt(np.minimum(1, (counts > 0).sum(1) / FULL_EVIDENCE))
                cosines = unit_vectors(counts, model.idf) @ model.centroids.T
                best = np.argmax(cosines, 1)
                score = np.clip(cosines[np.arange(n), best].astype(np.float64), 0, 1)
                far = score < REJECT_SHARE * evidence * model.least[best]
                langs = np.array(model.langs, object)[best]
            else:
                score, far, langs = np.zeros(n), np.ones(n, bool), np.full(n, UNKNOWN, object)
            langs[~letters] = UNKNOWN
            score[~letters] = 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, n), pa.array(langs, pa.string()), pa.array(score),
                 pa.array(far | ~letters)], ["row", "lang_pred", "score", "rejected"])


def predict(rows: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(row, lang_pred, score, rejected): ``row`` is a struct of all input columns."""
    row = F.struct(*[rows[f"`{c}`"] for c in rows.columns])
    three = rows.select(row.alias("row"), F.col(text_col).alias("text"),
                        F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    kind = three.schema["row"].dataType.simpleString()
    return three.mapInArrow(partial(_predict, model), f"row {kind}, lang_pred string, score double, rejected boolean")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = learn(docs.where(~remainder_is("doc_id", 4, 2)))
    rows = docs.select("doc_id", "text")
    out = predict(rows, model)
    held_out = F.crc32(F.coalesce(F.col("row.doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    return out.select("row.doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")
