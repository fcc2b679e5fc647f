"""Importance resampling of documents towards a target text collection (operator 12).

Features are all runs of one to three consecutive words; a feature's bucket is its CRC-32 modulo BUCKETS, computed for
all spans of a piece of text at once (``position_crc``). One pass counts the buckets of the corpus and of the target,
each task summing its own before the shuffle; the gains (one per bucket, so of fixed size) go to every task of the
second pass, which sums them over each document. Gumbel noise from a hash of the id turns the weights into a draw
without replacement: the highest scores are drawn.

Ranks are given without one global sort task: scores are dealt by range into a stored table, each part is ranked by
itself, and the rows in the parts before it (a number per part) are added.

Defined cases: a null or empty text has no features and weight 0. A null id takes part as an empty id and sorts last
among equal scores; rows that tie in score and id are ranked by weight, features and a row number. Repeated rows count
each time. Texts of any length are read in pieces of bounded size, unless one word is longer. An empty corpus or
target is fine. Other columns never take part, whatever their names.
"""

from __future__ import annotations

import functools
import math
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from railyard.llm.common import documents, stored
from railyard.llm.position_crc import PositionCrc

BUCKETS = 10000
MAX_RUN = 3
MIN_WORDS = 20
PERCENT = 5
SEED = "42"
# bytes of text whose spans are hashed together
PIECE = 1 << 16
# rows ranked by one task
ROWS_PER_PART = 1_000_000

_WORD_BYTES = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
# lower-cases A-Z and turns every byte that is no part of a word into a blank
_PLAIN = bytes(b if b in _WORD_BYTES else (b | 32 if 65 <= b <= 90 else 32) for b in range(256))
_BLANK = re.compile(b" ")


@functools.cache
def _crc() -> PositionCrc:
    return PositionCrc()


def _pieces(text: str | None) -> Iterator[tuple[bytes, int]]:
    """A text's words joined by one blank, in pieces of about PIECE bytes, each with how many words of the piece
    before it leads: the runs that end in the rest are the piece's own."""
    data, at, tail = (text or "").encode("utf-8", "replace").translate(_PLAIN), 0, []
    while at < len(data):
        gap = _BLANK.search(data, min(at + PIECE, len(data)))
        to = gap.start() if gap else len(data)
        words = data[at:to].split()
        if words:
            yield b" ".join(tail + words), len(tail)
            tail = (tail + words)[1 - MAX_RUN:]
        at = to


def hashed_runs(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(document, bucket) of every feature and (document, words) of every piece, a few pieces at a time."""
    held, size = [], 0
    for doc, text in enumerate(texts):
        for piece, led in _pieces(text):
            held.append((doc, piece, led))
            size += len(piece)
            if size >= PIECE:
                yield _hash_pieces(held)
                held, size = [], 0
    if held:
        yield _hash_pieces(held)


def _hash_pieces(held):
    docs = np.array([doc for doc, _, _ in held])
    led = np.array([n for _, _, n in held])
    counts = np.array([piece.count(b" ") + 1 for _, piece, _ in held])
    data = np.frombuffer(b" ".join(piece for _, piece, _ in held), np.uint8)
    gaps = np.flatnonzero(data == 32)
    starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(data)]])
    of = np.repeat(np.arange(len(held)), counts)                       # word -> piece
    own = np.arange(len(starts)) - np.repeat(np.cumsum(counts) - counts, counts) >= led[of]
    first, last = [], []
    for n in range(1, min(MAX_RUN, len(starts)) + 1):
        begin = np.arange(len(starts) - n + 1)
        end = begin + n - 1
        here = (of[begin] == of[end]) & own[end]
        first.append(begin[here])
        last.append(end[here])
    first, last = np.concatenate(first), np.concatenate(last)
    crc = _crc().spans(data, starts[first], ends[last])
    return docs[of[first]], (crc % np.uint32(BUCKETS)).astype(np.int64), docs, counts - led


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, bucket, _, _ in hashed_runs(batch.column(0).to_pylist()):
            total += np.bincount(bucket, minlength=BUCKETS)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])


def bucket_counts(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """How many features of all texts fall in each bucket."""
    per_task = df.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(_count, "bucket long, n long")
    out = np.zeros(BUCKETS, np.int64)
    for row in per_task.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS rows at most
        out[row.bucket] = row.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of the smoothed bucket shares), in doubles."""
    all_s, all_t = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log(float(t + 1) * all_s / (float(s + 1) * all_t)))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def _weigh(batches: Iterator[pa.RecordBatch], gain: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_rows
        words, features, weight = (np.zeros(n, np.int64) for _ in range(3))
        for of, bucket, docs, counts in hashed_runs(batch.column(1).to_pylist()):
            features += np.bincount(of, minlength=n)
            np.add.at(weight, of, gain[bucket])
            np.add.at(words, docs, counts)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words), pa.array(features), pa.array(weight)],
                                         ["doc_id", "n_words", "n_features", "weight"])


def gumbel(doc_id: Column, seed: str = SEED) -> Column:
    """Noise of an id: floor(-1000 ln(-ln u)), u from the first 32 bits of a SHA-256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("long")


def weighted(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row, and a row number; a stored table."""
    plain = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    schema = f"doc_id {plain.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long"
    rows = plain.mapInArrow(functools.partial(_weigh, gain=gain), schema)
    return stored(rows.select("*", (F.col("weight") + gumbel(F.col("doc_id"))).alias("score"),
                              F.monotonically_increasing_id().alias("row")), "weights")


def drawn(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
          rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3 ... for the drawn rows, null for all others."""
    eligible = scored.where(F.col("n_words") >= min_words)
    n = eligible.count()
    k = percent * n // 100
    best_first = [F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("weight"), F.asc("n_features"), F.asc("row")]
    dealt = stored(eligible.repartitionByRange(max(1, -(-n // rows_per_part)), *best_first)
                   .withColumn("part", F.spark_partition_id()), "score-ranges")
    # one row per part: the window over all of them is small
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(before, F.lit(0)).alias("before"))
    placed = dealt.join(F.broadcast(parts), "part")
    nr = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(*best_first))
    none = F.lit(None).cast("long")
    top = placed.where(F.col("before") < k).withColumn("rank", nr)
    top = top.withColumn("rank", F.when(F.col("rank") <= k, F.col("rank")))
    rest = placed.where(F.col("before") >= k).withColumn("rank", none)
    few = scored.where(F.col("n_words") < min_words).withColumn("rank", none)
    columns = [*scored.columns, "rank"]
    return top.select(columns).unionByName(rest.select(columns)).unionByName(few.select(columns))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score, rank, n_words of every row of ``docs``."""
    gain = gains(bucket_counts(docs, text_col), bucket_counts(target))
    ranked = drawn(weighted(docs, gain, id_col, text_col))
    return ranked.select("doc_id", "n_features", "weight", "score", "rank", "n_words")


def op12_importance_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return resample(documents(spark, sf_dir), benchmark)


_WORDS_SQL = (f"regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), "
              r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

# the same sums over a table of positions, joined instead of indexed
OP12_SQL = """
WITH RECURSIVE
bytes AS (SELECT b::BIGINT AS b FROM range(256) r(b)),
first_step(b, v, k) AS (
  SELECT b, b, 0 FROM bytes UNION ALL
  SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM first_step WHERE k < 8),
t0 AS MATERIALIZED (SELECT b, v FROM first_step WHERE k = 8),
runs AS MATERIALIZED (
  SELECT side, id, n_words, unnest(list_concat(w,
           list_transform(range(1, n_words), lambda i: w[i] || ' ' || w[i + 1]),
           list_transform(range(1, n_words - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS feature
  FROM (SELECT *, len(w) AS n_words FROM (
    SELECT 'd' AS side, row_number() OVER () AS id, {WORDS} AS w FROM documents
    UNION ALL
    SELECT 'b', item_id, {WORDS} FROM benchmark))),
counted AS MATERIALIZED (SELECT feature, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t, hex(encode(feature)) AS h FROM runs GROUP BY feature),
longest AS (SELECT max(length(h)) // 2 AS n FROM counted),
tab(d, b, v) AS (
  SELECT 0::BIGINT, b, v FROM t0 UNION ALL
  SELECT tab.d + 1, tab.b, xor(tab.v >> 8, t0.v) FROM tab JOIN t0 ON t0.b = tab.v & 255 WHERE tab.d + 1 < (SELECT n FROM longest)),
zeros(n, v) AS (
  SELECT 0::BIGINT, 4294967295::BIGINT UNION ALL
  SELECT zeros.n + 1, xor(zeros.v >> 8, t0.v) FROM zeros JOIN t0 ON t0.b = zeros.v & 255 WHERE zeros.n < (SELECT n FROM longest)),
spelt AS (SELECT feature, s, t, length(h) // 2 AS n, h, unnest(range(length(h) // 2)) AS p FROM counted),
crc AS (
  SELECT feature, any_value(s) AS s, any_value(t) AS t, any_value(n) AS n, bit_xor(tab.v) AS v
  FROM spelt JOIN tab ON tab.d = n - 1 - p AND tab.b = ('0x' || substr(h, 2 * p + 1, 2))::BIGINT GROUP BY feature),
bucketed AS MATERIALIZED (SELECT feature, s, t, xor(xor(crc.v, zeros.v), 4294967295) % 10000 AS bucket FROM crc JOIN zeros USING (n)),
total AS (SELECT sum(s) AS s, sum(t) AS t FROM bucketed),
gain AS (SELECT bucket, floor(1000 * ln((sum(g.t) + 1)::DOUBLE * (any_value(total.s) + 10000)::DOUBLE / ((sum(g.s) + 1)::DOUBLE * (any_value(total.t) + 10000)::DOUBLE)))::BIGINT AS gain
         FROM bucketed g, total GROUP BY bucket),
weights AS (SELECT id, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM runs JOIN bucketed USING (feature) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY id),
docs AS (SELECT row_number() OVER () AS id, doc_id, len({WORDS}) AS n_words FROM documents),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, n_words,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM docs LEFT JOIN weights USING (id)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, weight DESC, n_features) AS nr,
                  count(*) FILTER (n_words >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND nr <= 5 * n // 100 THEN nr END AS rank, n_words::BIGINT AS n_words FROM ranked
""".replace("{WORDS}", _WORDS_SQL)
