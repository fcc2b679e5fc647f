"""Packing token sequences by non-negative least squares over length combinations (operator 4).

Whole windows are cut off the front of each document; what is left of it is an item shorter than a window. The
histogram of item lengths (at most ``window - 1`` numbers, whatever the corpus) goes to the driver. There, combinations
of few lengths that fill a window exactly are enumerated, their repeat counts are solved by non-negative least squares
against the histogram and rounded down, and the residual items are packed greedily: first into exact fills, longest
item first, then end to end as a stream that is cut at window ends, the last window into powers of two. The outcome is
a table of at most a few rows per length which says where the item of a given length and rank goes; Spark ranks the
items and looks them up. No sequence needs padding.

Defined cases: a null text counts as empty; every document ends with ``end_id``, so an empty one has one token. Equal
rows, repeated ids and null ids are packed row by row. Other columns take no part. An empty table gives no pieces.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from railyard.llm import bloom
from railyard.llm.common import documents, stored

WINDOW = 4096
DEPTH = 8
COMBINATIONS = 16_000
CACHED_WORDS = 800_000


@dataclass(frozen=True)
class Tokens:
    """A tokenizer file, and the id that ends each document."""

    path: str
    end_id: int = 2


# --- tokens ----------------------------------------------------------------------------------------------------------

class _Encoder:
    """Ids of whole texts as little-endian 32-bit bytes, remembered by blank-separated piece of text.

    The tokenizers this is used with split at blanks and line feeds before anything else, so a text's ids are those of
    its pieces in order (``by_piece``). Most lower-case the text and split a full stop or comma from the word it ends,
    so that a word is remembered once for all its spellings (``by_word``; nothing is lower-cased that would become a
    special token), and split no word of a-z before the model does (``by_model``). Probes tell. The memory is bounded;
    beyond it pieces are encoded again."""

    kept: dict[Tokens, _Encoder] = {}
    PROBE = ["Ab c's, don't  x", "é\n1,2  ", " á b", "<|endoftext|> z", "The END. Of, it.\nSo.", "A.. b., 'c'. d.e É. x!."]
    apart = staticmethod(partial(re.compile(r"(?<=[a-zA-Z])([.,])(?=[ \n]|$)").sub, r" \1"))

    def __init__(self, tokens: Tokens):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokens.path)
        self.end = np.uint32(tokens.end_id).tobytes()
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {"": b""}
        self.by_piece = all(self._plain([t])[0] == b"".join(self._plain(t.replace("\n", " ").split(" "))) for t in self.PROBE)
        self.by_word = self.by_piece and all(self._plain([t])[0] == b"".join(self._plain(self._pieces(t))) for t in self.PROBE)
        words = ["a", "s", "the", "thent", "unbelievably", "x" * 99, "qzjvkwxq"]
        self.by_model = all(np.array(self._of_model(w), np.uint32).tobytes() == self._plain([w])[0] for w in words)

    @classmethod
    def of(cls, tokens: Tokens) -> _Encoder:
        if tokens not in cls.kept:
            cls.kept[tokens] = cls(tokens)
        return cls.kept[tokens]

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _of_model(self, word: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(word)]

    def _pieces(self, text: str) -> list[str]:
        """Pieces of a text in lower case (A-Z only), a full stop or comma that ends a word apart."""
        lower = text.encode().lower().decode()
        if any(s in lower for s in self.special):
            return text.replace("\n", " ").split(" ")
        return self.apart(lower).replace("\n", " ").split(" ")

    def _fresh(self, pieces: list[str]) -> dict[str, bytes]:
        words = [p for p in pieces if p.isascii() and p.isalpha() and p.islower()] if self.by_model else []
        out = {w: array("I", self._of_model(w)).tobytes() for w in words}
        others = [p for p in pieces if p not in out]
        return out | dict(zip(others, self._plain(others)))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        if not self.by_piece:
            for text in texts:
                yield self._plain([text])[0] + self.end
            return
        known = self.known
        for text in texts:
            pieces = self._pieces(text) if self.by_word else text.replace("\n", " ").split(" ")
            found = list(map(known.get, pieces))
            if None in found:
                fresh = self._fresh(list({p for p, ids in zip(pieces, found) if ids is None}))
                if len(known) < CACHED_WORDS:
                    known.update(fresh)
                found = [fresh[p] if ids is None else ids for p, ids in zip(pieces, found)]
            yield b"".join(found) + self.end


def _measure(tokens: Tokens, window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of tokens, and the CRC-32 of each whole window and of the rest."""
    encoder = _Encoder.of(tokens)
    for batch in batches:
        n, crcs = [], []
        for text in batch.column(1):
            ids = next(encoder.encode([text.as_py() or ""]))
            n.append(len(ids) // 4)
            crcs.append([zlib.crc32(ids[x:x + 4 * window]) for x in range(0, len(ids), 4 * window)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(crcs, pa.list_(pa.int64())),
                                          batch.column(2)], ["doc_id", "doc_tokens", "crcs", "text_hash"])


def _rests(tokens: Tokens, window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids after the last whole window."""
    encoder = _Encoder.of(tokens)
    for batch in batches:
        rest = []
        for text in batch.column(1):
            ids = next(encoder.encode([text.as_py() or ""]))
            rest.append(ids[len(ids) // (4 * window) * 4 * window:])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(rest, pa.binary())], ["doc_id", "text_hash", "ids"])


# --- the plan (on the histogram of item lengths) ------------------------------------------------------------------------

def combinations_of(hist: np.ndarray, window: int, limit: int = COMBINATIONS) -> list[tuple[int, ...]]:
    """Combinations of at most DEPTH present lengths that fill ``window`` exactly, longest length first."""
    out: set[tuple[int, ...]] = set()
    present = np.flatnonzero(hist)
    for a in present:  # one length, and pairs
        if window % a == 0 and window // a <= DEPTH:
            out.add((int(a),) * (window // a))
        b = window - a
        if b <= a and hist[b]:
            out.add((int(a), int(b)))
    each = max(1, limit // (2 * max(1, len(present))))
    for a in present:  # the best supported triples of each longest length
        b = present[(present <= a) & (2 * present >= window - a) & (present < window - a)]
        c = window - a - b
        support = np.minimum(np.minimum(hist[b], hist[c]), hist[a])
        for x in np.argsort(-support, kind="stable")[:each]:
            if support[x]:
                out.add((int(a), int(b[x]), int(c[x])))
    # deeper ones: lengths drawn by their share of the items, the last one closing the gap
    rng = np.random.RandomState(11)
    share = np.cumsum(hist[present]) / max(1, hist.sum())
    draws = present[np.minimum(np.searchsorted(share, rng.rand(6 * limit, DEPTH - 1)), len(present) - 1)] if len(present) else []
    for row in draws:
        if len(out) >= limit + len(present):
            break
        gap = window - np.cumsum(row)
        for d in range(1, DEPTH - 1):
            g = int(gap[d])
            if g <= 0:
                break
            if hist[g]:
                out.add(tuple(sorted((*map(int, row[:d + 1]), g), reverse=True)))
                break
    return sorted(out, reverse=True)


def nnls(combos: list[tuple[int, ...]], hist: np.ndarray, steps: int = 400) -> np.ndarray:
    """x >= 0 that makes sum(x * how often each length is in its combination) close to ``hist``.

    Accelerated projected gradient on the sparse matrix; lengths are weighted alike."""
    if not combos:
        return np.zeros(0)
    col = np.repeat(np.arange(len(combos)), [len(c) for c in combos])
    row = np.concatenate([np.array(c) for c in combos])
    target = hist.astype(float)

    def times(x):
        return np.bincount(row, x[col], len(hist))

    def transposed(r):
        return np.bincount(col, r[row], len(combos))

    v = np.ones(len(combos))
    for _ in range(20):  # the largest eigenvalue bounds the step
        v = transposed(times(v))
        norm = np.sqrt(v @ v)
        v /= norm
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, y - transposed(times(y) - target) / norm)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x


def greedy_fills(left: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """Exact fills from residual counts, longest length first; lowers ``left`` by what they use."""
    out = []
    aside = np.zeros(len(left), bool)
    present = list(np.flatnonzero(left))
    for a in reversed(list(present)):
        while left[a] and not aside[a]:
            combo, gap = [a], window - a
            used = {a: 1}
            while gap and len(combo) < 4 * DEPTH:
                x = int(np.searchsorted(present, gap, "right")) - 1
                while x >= 0 and left[present[x]] - used.get(present[x], 0) <= 0:
                    x -= 1
                if x < 0:
                    break
                combo.append(present[x])
                used[present[x]] = used.get(present[x], 0) + 1
                gap -= present[x]
            if gap:
                aside[a] = True
                break
            repeats = int(min(left[length] // k for length, k in used.items()))
            for length, k in used.items():
                left[length] -= repeats * k
            out.append((tuple(int(c) for c in combo), repeats))
            present = [p for p in present if left[p]] if any(not left[p] for p in used) else present
    return out


@dataclass
class Plan:
    """places: (length, first rank, end rank, first sequence, times in a sequence, offset of the first in it).

    Items of a length from rank ``stream_from[length]`` on go to the stream, at ``stream_at[length]`` tokens."""

    places: list[tuple[int, int, int, int, int, int]]
    stream_from: dict[int, int]
    stream_at: dict[int, int]
    sequences: int
    stream_tokens: int


def plan_of(hist: np.ndarray, window: int = WINDOW) -> Plan:
    combos = combinations_of(hist, window)
    repeats = np.floor(nnls(combos, hist) + 1e-6).astype(np.int64)
    left = hist.astype(np.int64).copy()
    fills = []
    for k in np.argsort(-repeats, kind="stable"):
        lengths, times = np.unique(combos[k], return_counts=True) if repeats[k] else ((), ())
        n = min([int(repeats[k]), *(int(left[a] // t) for a, t in zip(lengths, times))])
        if n > 0:
            left[lengths] -= n * times
            fills.append((combos[k], n))
    fills += greedy_fills(left, window)
    places, rank, sequence = [], np.zeros(len(hist), np.int64), 0
    for combo, n in fills:
        offset = 0
        lengths, times = np.unique(combo, return_counts=True)
        for a, t in zip(map(int, lengths), map(int, times)):
            places.append((a, int(rank[a]), int(rank[a] + n * t), sequence, t, offset))
            rank[a] += n * t
            offset += a * t
        sequence += n
    at, stream_at = 0, {}
    for a in np.flatnonzero(left)[::-1]:
        stream_at[int(a)] = at
        at += int(a * left[a])
    return Plan(places, {a: int(rank[a]) for a in stream_at}, stream_at, sequence, at)


def tail_starts(stream_tokens: int, window: int) -> list[int]:
    """Where the sequences of the stream's last, incomplete window start: its binary parts, largest first."""
    at, rest, out = stream_tokens // window * window, stream_tokens % window, []
    size = 1
    while size * 2 <= rest:
        size *= 2
    while rest:
        if size <= rest:
            out.append(at)
            at, rest = at + size, rest - size
        size //= 2
    return out


# --- Spark -----------------------------------------------------------------------------------------------------------

def _stream_pieces(items: DataFrame, plan: Plan, window: int) -> DataFrame:
    """Cut stream items at window ends and at the tail's sequence starts."""
    tail = tail_starts(plan.stream_tokens, window)
    whole = plan.stream_tokens // window * window
    begin, end = F.col("at"), F.col("at") + F.col("rest")
    cuts = [(F.floor(begin / window) + 1) * window, *[F.lit(t).cast("long") for t in tail]]
    starts = F.array_sort(F.array_distinct(F.array(begin, *[F.when((c > begin) & (c < end), c.cast("long")).otherwise(begin) for c in cuts])))
    cut = items.withColumn("starts", starts).select("*", F.posexplode("starts").alias("k", "begin"))
    piece_end = F.coalesce(F.try_element_at("starts", F.col("k") + 2), F.col("at") + F.col("rest"))
    begin = F.col("begin")
    tail_no, tail_at = F.lit(0).cast("long"), F.lit(whole).cast("long")
    for no, t in enumerate(tail):
        tail_no, tail_at = F.when(begin >= t, F.lit(no)).otherwise(tail_no), F.when(begin >= t, F.lit(t)).otherwise(tail_at)
    in_tail = begin >= whole
    return cut.select(
        "row_id", (begin - F.col("at")).alias("skip"), (piece_end - begin).alias("length"),
        (F.lit(plan.sequences) + F.when(in_tail, F.lit(whole // window) + tail_no).otherwise(F.floor(begin / window))).cast("long").alias("sequence_id"),
        F.when(in_tail, begin - tail_at).otherwise(begin % window).cast("long").alias("offset"))


def _places(ranked: DataFrame, plan: Plan, window: int) -> DataFrame:
    """(row_id, skip, length, sequence_id, offset) of the items' pieces."""
    spark = ranked.sparkSession
    by_length: dict[int, list] = {}
    for a, *rest in plan.places:
        by_length.setdefault(a, []).append(tuple(rest))
    rows = [(a, by_length.get(a, []), plan.stream_from.get(a), plan.stream_at.get(a)) for a in sorted({*by_length, *plan.stream_at})]
    table = spark.createDataFrame(rows, "rest long, places array<struct<lo:long,hi:long,sequence:long,times:long,offset:long>>, "
                                  "stream_from long, stream_at long")
    # one row a length: less than ``window`` of them whatever the corpus
    found = ranked.join(F.broadcast(table), "rest").withColumn(
        "place", F.get(F.filter("places", lambda p: (p.lo <= F.col("rank")) & (F.col("rank") < p.hi)), F.lit(0)))
    nth = F.col("rank") - F.col("place.lo")
    exact = found.where(F.col("place").isNotNull()).select(
        "row_id", F.lit(0).cast("long").alias("skip"), F.col("rest").alias("length"),
        (F.col("place.sequence") + F.floor(nth / F.col("place.times"))).cast("long").alias("sequence_id"),
        (F.col("place.offset") + (nth % F.col("place.times")) * F.col("rest")).cast("long").alias("offset"))
    stream = found.where(F.col("place").isNull()).select(
        "row_id", "rest", (F.col("stream_at") + (F.col("rank") - F.col("stream_from")) * F.col("rest")).alias("at"))
    return exact.unionByName(_stream_pieces(stream, plan, window))


def _ranked(items: DataFrame, by: list[str], value: Column, name: str) -> DataFrame:
    """Running total of ``value`` over earlier rows with equal ``by``, in order of row_id.

    Totals of each task's rows are summed first; no window holds more rows than a task has read or tasks there are."""
    part = F.shiftright("row_id", 33)
    own = items.withColumn("part", part)
    per_part = own.groupBy(*by, "part").agg(F.sum(value).alias("in_part"))
    before = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(*by, "part", F.coalesce(F.sum("in_part").over(before), F.lit(0).cast("long")).alias("earlier"))
    within = Window.partitionBy(*by, "part").orderBy("row_id").rowsBetween(Window.unboundedPreceding, -1)
    here = own.withColumn("here", F.coalesce(F.sum(value).over(within), F.lit(0).cast("long")))
    return here.join(offsets, [*by, "part"]).withColumn(name, F.col("here") + F.col("earlier")).drop("here", "earlier", "part")


def pack(docs: DataFrame, tokens: Tokens, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    three = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text).alias("text_hash"))
    kind = three.schema["doc_id"].dataType.simpleString()
    measured = three.mapInArrow(partial(_measure, tokens, window), f"doc_id {kind}, doc_tokens long, crcs array<long>, text_hash long")
    rows = stored(measured.withColumn("row_id", F.monotonically_increasing_id()), "measured").withColumns({
        "whole": F.floor(F.col("doc_tokens") / window).cast("long"), "rest": (F.col("doc_tokens") % window).cast("long")})
    items = rows.where("rest > 0").select("row_id", "rest")
    hist = np.zeros(window + 1, np.int64)
    for r in items.groupBy("rest").count().collect():
        hist[r.rest] = r["count"]
    plan = plan_of(hist, window)
    placed = _places(_ranked(items, ["rest"], F.lit(1).cast("long"), "rank"), plan, window)
    stream_sequences = plan.stream_tokens // window + len(tail_starts(plan.stream_tokens, window))
    long = rows.where("whole > 0").select("row_id", "whole", F.lit(0).alias("all"))
    whole = _ranked(long, ["all"], F.col("whole"), "before").select(
        "row_id", "before", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1)).alias("k"))
    whole = whole.select("row_id", F.col("k").alias("no"), (F.lit(plan.sequences + stream_sequences) + F.col("before") + F.col("k")).alias("sequence_id"))
    info = rows.select("row_id", "doc_id", "doc_tokens", "crcs", "text_hash", F.col("whole"), "rest")
    first = whole.join(info, "row_id").select(
        "doc_id", (F.col("no") * window).alias("start"), F.lit(window).cast("long").alias("length"),
        F.get("crcs", F.col("no").cast("int")).alias("ids_crc32"), "doc_tokens", "sequence_id", F.lit(0).cast("long").alias("offset"))
    last = stored(placed.join(info, "row_id"), "placed")
    uncut = last.where("length = rest").select(
        "doc_id", (F.col("whole") * window).alias("start"), "length", F.get("crcs", F.col("whole").cast("int")).alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset")
    cut = _cut_pieces(three, last.where("length < rest"), tokens, window)
    return first.unionByName(uncut).unionByName(cut)


def _cut_pieces(texts: DataFrame, pieces: DataFrame, tokens: Tokens, window: int) -> DataFrame:
    """CRCs of pieces of items: only the documents that hold them are encoded again."""
    keys = pieces.select("doc_id", "text_hash").distinct()
    n_words = bloom.words_for(keys.count())
    table = bloom.filter_table(keys, "text_hash", n_words)
    near = bloom.probe(texts, "text_hash", table, n_words, "maybe").where("maybe").select("doc_id", "text", "text_hash")
    kind = texts.schema["doc_id"].dataType.simpleString()
    rests = near.mapInArrow(partial(_rests, tokens, window), f"doc_id {kind}, text_hash long, ids binary").withColumnsRenamed(
        {"doc_id": "rest_doc", "text_hash": "rest_hash"})
    rests = rests.dropDuplicates(["rest_doc", "rest_hash"])
    same = F.col("doc_id").eqNullSafe(F.col("rest_doc")) & (F.col("text_hash") == F.col("rest_hash"))
    part = F.substring("ids", (F.col("skip") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int"))
    return pieces.join(rests, same).select(
        "doc_id", (F.col("whole") * window + F.col("skip")).alias("start"), "length", F.crc32(part).alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset")


def word_tokens() -> Tokens:
    import public_tokenizers

    return Tokens(public_tokenizers.path("word_bpe_49k.json"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), word_tokens())
