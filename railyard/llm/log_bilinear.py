"""Language-model scoring with a log-bilinear neural model (operator 10).

Tokens are lower-cased words and one end per text. The end and the most frequent words, as many as the square root of
the number of learning tokens (``own_words``), are units of the model; every other word belongs to one of ``SUFFIXES``
units given by its last and first bytes. Units are numbered by falling count, and about as many units as there are
classes form a class. A context vector is the sum of the vectors of the two units before, each times the matrix of its
position. Its products with the vectors of all classes give the class, those with the units of that class the unit, so a
token costs two normalisations over about the root of the number of units. Scoring does both in batched matrix products
and multiplies by the word's add-one share of its unit, which leaves room for words never seen: probabilities of all
tokens, the unseen one of each suffix included, sum to one.

Vectors, matrices and biases are trained in numpy by noise-contrastive estimation: classes against noise by their
frequencies, which a batch shares, units against even noise within their class, whose units are about as frequent. Word
counts and training cover every learning token. Texts are written as blocks of units and read ``PASSES`` times, in more
rounds the more blocks there are. In a round, tasks take Adagrad steps over their
blocks from the same parameters; Spark sums their changes, each parameter row's weighted by the steps that touched it,
as integers (of two parts where one could overflow), and the driver applies the means. Scores depend a little on how rows lie in partitions, as the steps do.

On the driver are the parameters (25 floats for each of at most about 2 * ``OWN_MOST`` rows), once more their summed
changes, and the counts of the ``KNOWN`` most frequent words (a little fewer: no count is split; the end and the ``TOP``
words are always in); counts of all other words stay in a table and are joined to the occurrences of such words.

Defined cases: a null text counts as empty and has the end token only; ties among frequent words go by hash; rows of
equal or null ids are scored row by row; other columns take no part. Without learning texts all counts are 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm.common import documents, remainder_is, stored
from railyard.llm.wordhash import list_column, lower_case, mix, text_chunks, words_in
from railyard.session import scratch_path
from railyard.sources import files

_U = np.uint64
TOP, SUFFIXES = 95, 32
OWN_MOST = 1 << 15
KNOWN = 100_000
BLOCK_TOKENS = 2_000_000
UNIT_BLOCK = 1 << 19  # tokens of a block to train on
DIM, BATCH, PASSES, RATE = 24, 1024, 1, 0.1
CLASS_NOISE, UNIT_NOISE = 16, 2  # noise classes of a batch, noise units of an example
CHUNK_BYTES = 4 << 20  # texts whose equal trigrams are scored once
SCORED, SCORES = 1 << 17, 1 << 10  # tokens whose context vectors and whose scores are held at a time
SAFE = 80  # exponentials of so much and less, both ways, fit 32-bit floats
SCALE = 1 << 20  # changes of parameters are summed as integers of this fraction
HIGH = 1 << 40  # those of the squares in two parts, as they grow with the square of a task's steps: beyond so much, and below
FILE_BLOCKS = 64  # blocks in a file at most: its reader holds all of them
END_HASH = np.uint64(0x5DEECE66D1234567)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and suffixes (from 1, 0 for the end) of all tokens, and the texts' offsets among them."""
    hashes, at, starts, ends = words_in(data, offsets)
    n = len(offsets) - 1
    at_all = at + np.arange(n + 1)
    place = np.arange(len(hashes)) + np.repeat(np.arange(n), np.diff(at))
    out, suffix = np.full(len(hashes) + n, END_HASH), np.zeros(len(hashes) + n, np.int64)
    out[place] = hashes
    if len(hashes):
        first, before, last = (lower_case(data[at]).astype(np.uint64) for at in (starts, np.maximum(ends - 2, 0), ends - 1))
        key = last | np.where(ends - starts > 1, before, 0) << _U(8) | first << _U(16)
        suffix[place] = (mix(key) % _U(SUFFIXES)).astype(np.int64) + 1
    return out, suffix, at_all


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(w, suffix, n) of blocks of tokens; Spark sums them."""
    def block(found: list) -> pa.RecordBatch:
        h, s = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        words = pa.array(h.view(np.int64)).dictionary_encode()
        of = words.indices.to_numpy()
        suffix = np.empty(len(words.dictionary), np.int64)
        suffix[of] = s  # equal hashes have equal suffixes
        return pa.RecordBatch.from_arrays([words.dictionary, pa.array(suffix), pa.array(np.bincount(of))], ["w", "suffix", "n"])

    found, size = [], 0
    for batch in batches:
        for _, _, data, offsets in text_chunks(batch.column(0)):
            found.append(tokens(data, offsets)[:2])
            size += len(found[-1][0])
            if size >= BLOCK_TOKENS:
                yield block(found)
                found, size = [], 0
    if found:
        yield block(found)


def own_words(n: int) -> int:
    """How many words are units of their own after ``n`` learning tokens."""
    return min(OWN_MOST, max(TOP, math.isqrt(n)))


@dataclass
class Vocabulary:
    """Known words by hash, their counts and units; totals; the log10 denominators of the shares within suffixes."""

    hashes: np.ndarray
    counts: np.ndarray
    units: np.ndarray  # -1: as the suffix says
    suffix_units: np.ndarray  # of suffixes, first the end's
    unit_counts: np.ndarray
    n: int
    v: int
    share: np.ndarray

    @property
    def start(self) -> int:
        """The unit before a text."""
        return len(self.unit_counts)

    def look_up(self, hashes: np.ndarray, suffix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(known, count, unit, shares its unit) of tokens."""
        known, count, own = np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64), np.full(len(hashes), -1)
        if len(self.hashes):
            # each different token is searched for once
            words = pa.array(hashes).dictionary_encode()
            distinct, of = words.dictionary.to_numpy(), words.indices.to_numpy()
            x = np.minimum(np.searchsorted(self.hashes, distinct), len(self.hashes) - 1)
            found = self.hashes[x] == distinct
            known = found[of]
            count = np.where(found, self.counts[x], 0)[of]
            own = np.where(found, self.units[x], -1)[of]
        own = np.where(suffix > 0, own, self.suffix_units[0])
        return known, count, np.where(own >= 0, own, self.suffix_units[suffix]), own < 0


def contexts(units: np.ndarray, at: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The units one and two tokens before, ``start`` before a text."""
    one, two = np.empty_like(units), np.empty_like(units)
    one[1:], two[2:] = units[:-1], units[:-2]
    first = at[:-1]
    one[first] = start
    two[first] = start
    second = first[np.diff(at) > 1] + 1
    two[second] = start
    return one, two


def _blocks(vocabulary: Vocabulary, shares: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(share, units) of blocks of whole texts, two starts before each; a task's blocks are dealt to the shares in turn."""
    turn = TaskContext.get().partitionId()

    def block(found: list) -> pa.RecordBatch:
        units = np.concatenate(found).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array([turn % shares], pa.int32()), pa.ListArray.from_arrays([0, len(units)], pa.array(units))], ["share", "units"])

    found, size = [], 0
    for batch in batches:
        for _, _, data, offsets in text_chunks(batch.column(0)):
            hashes, suffix, at = tokens(data, offsets)
            found.append(np.insert(vocabulary.look_up(hashes, suffix)[2], np.repeat(at[:-1], 2), vocabulary.start))
            size += len(hashes)
            if size >= UNIT_BLOCK:
                yield block(found)
                found, size, turn = [], 0, turn + 1
    if found:
        yield block(found)


# --- the model -------------------------------------------------------------------------------------------------------

@dataclass
class LogBilinear:
    """Parameter rows end to end: vectors of units as context (the start included), of classes, of units as targets, and
    the two matrices. The last column is a target's bias. ``seen``: mean squares of the gradients of each row, summed."""

    counts: np.ndarray  # of units, falling
    rows: np.ndarray
    seen: np.ndarray

    @classmethod
    def new(cls, counts: np.ndarray) -> LogBilinear:
        rng, m = np.random.RandomState(3), len(counts)
        out = cls(np.asarray(counts, np.float64) + 1.0, np.zeros((0, DIM + 1), np.float32), np.zeros(0))
        eye = np.hstack([np.eye(DIM), np.zeros((DIM, 1))])
        targets = rng.randn(out.classes + m, DIM + 1) * 0.1
        targets[:, DIM] = out.log_noise()
        vectors = rng.randn(m + 1, DIM + 1) * 0.1
        vectors[:, DIM] = 0
        out.rows = np.vstack([vectors, targets, eye * 0.5, eye * 0.3]).astype(np.float32)
        out.seen = np.full(len(out.rows), 1e-3)
        return out

    @property
    def size(self) -> int:
        """Units of a class, but for the last one."""
        return max(1, math.isqrt(len(self.counts)))

    @property
    def classes(self) -> int:
        return -(-len(self.counts) // self.size)

    @property
    def first_target(self) -> int:
        return len(self.counts) + 1

    def log_noise(self) -> np.ndarray:
        """Log frequencies of the classes, then of the units within their class."""
        per_class = np.add.reduceat(self.counts, np.arange(0, len(self.counts), self.size))
        inside = self.counts / per_class[np.arange(len(self.counts)) // self.size]
        return np.log(np.concatenate([per_class / per_class.sum(), inside]))

    def context(self, two: np.ndarray, one: np.ndarray) -> np.ndarray:
        """Context vectors with a last entry 1 that meets the targets' biases."""
        q = self.rows[one, :DIM] @ self.rows[-2 * DIM:-DIM, :DIM] + self.rows[two, :DIM] @ self.rows[-DIM:, :DIM]
        return np.hstack([q, np.ones((len(q), 1), np.float32)])

    def log10(self, two: np.ndarray, one: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """Normalised log10 probabilities of units after two units; neighbours of equal context share its vector."""
        out = np.empty(len(unit))
        targets, m = self.rows[self.first_target:-2 * DIM], len(self.counts)
        for a in range(0, len(unit), SCORED):
            some = slice(a, a + SCORED)
            t, o, word = two[some], one[some], unit[some]
            new = np.diff(t * (m + 1) + o, prepend=-1) != 0
            run, first = np.cumsum(new) - 1, np.flatnonzero(new)
            q = self.context(t[first], o[first])
            of = word // self.size
            # neighbours of equal context and class have both normalisations in common
            new |= np.diff(of, prepend=-1) != 0
            pair, first = np.cumsum(new) - 1, np.flatnonzero(new)
            of, pair_run = of[first], run[first]
            part = _products(q, pair_run, targets, of) - _log_sums(q, targets[:self.classes])[pair_run]
            order, at = sorted_places(of)
            starts = run_starts(at)
            for start, end in zip(starts, np.append(starts[1:], len(at))):
                pairs, c = order[start:end], at[start]
                own = targets[self.classes + c * self.size:self.classes + min((c + 1) * self.size, m)]
                part[pairs] -= _log_sums(q.take(pair_run[pairs], 0), own)
            out[some] = (part[pair] + _products(q, run, targets, self.classes + word)) / math.log(10)
        return out


def _log_sums(q: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Logs of the sums of the exponentials of the products with all targets."""
    out = np.empty(len(q))
    # no product is larger than the product of the norms: mostly too small for an exponential to overflow
    safe = len(q) and np.einsum("nd,nd->n", q, q).max() * np.einsum("nd,nd->n", targets, targets).max() < SAFE ** 2
    held, ones = np.empty((min(len(q), SCORES), len(targets)), np.float32), np.ones(len(targets), np.float32)
    for a in range(0, len(q), SCORES):
        some = q[a:a + SCORES]
        scores = np.matmul(some, targets.T, out=held[:len(some)])
        most = 0 if safe else scores.max(1)
        if not safe:
            scores -= most[:, None]
        out[a:a + SCORES] = np.log(np.exp(scores, out=scores) @ ones) + most
    return out


def _products(q: np.ndarray, of: np.ndarray, targets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The products of contexts ``of`` with targets ``at``."""
    out = np.empty(len(of))
    for a in range(0, len(of), SCORES):
        out[a:a + SCORES] = np.einsum("nd,nd->n", q.take(of[a:a + SCORES], 0), targets.take(at[a:a + SCORES], 0))
    return out


def sorted_places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order of whole numbers from 0, and the numbers in it. Numbers of 16 bits have a fast stable sort; larger
    ones are sorted with their place as one number, several times as fast as an argsort, if both fit."""
    bits, most = len(keys).bit_length(), int(keys.max(initial=0))
    if most < 1 << 16 or most >> (63 - bits):
        order = np.argsort(keys.astype(np.uint16) if most < 1 << 16 else keys, kind="stable")
        return order, keys.take(order)
    both = np.sort(keys.astype(np.int64) << bits | np.arange(len(keys)))
    return both & ((1 << bits) - 1), both >> bits


def run_starts(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    return np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1])))


def sums_of_runs(rows: np.ndarray, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sums of the rows that runs of ``order`` name, which begin at ``first``; runs of one row, the most, are copied."""
    out, length = rows.take(order.take(first), 0), np.diff(first, append=len(order))
    many = np.flatnonzero(length > 1)
    if len(many):
        out[many] = np.add.reduceat(rows.take(order[np.repeat(length > 1, length)], 0), np.cumsum(length[many]) - length[many])
    return out


def distinct_trigrams(units: np.ndarray, one: np.ndarray, two: np.ndarray, n_units: int) -> tuple[np.ndarray, ...]:
    """(two, one, unit) of different trigrams, the number of each and where every token's is among them."""
    order, code = sorted_places((two * (n_units + 1) + one) * n_units + units)
    first = run_starts(code)
    times = np.diff(first, append=len(code))
    inverse = np.empty(len(code), np.int64)
    inverse[order] = np.repeat(np.arange(len(first)), times)
    before, unit = np.divmod(code[first], n_units)
    return *np.divmod(before, n_units + 1), unit, times, inverse


def train(model: LogBilinear, blocks: Iterator[np.ndarray], seed: int = 0) -> tuple[LogBilinear, np.ndarray]:
    """Adagrad steps of noise-contrastive estimation over blocks of units; the new model and the steps that touched each
    row. Equal trigrams of a block are one example that weighs as many."""
    rng = np.random.default_rng(seed)
    rows, seen, touched = model.rows.copy(), model.seen.copy(), np.zeros(len(model.rows), np.int64)
    m, size, base, classes = len(model.counts), model.size, model.first_target, model.classes
    of_units = base + classes
    log_class = model.log_noise()[:classes].astype(np.float32) + np.float32(math.log(CLASS_NOISE))
    class_ends = np.cumsum(np.add.reduceat(model.counts, np.arange(0, m, size)))
    sizes = np.minimum(np.arange(1, classes + 1) * size, m) - np.arange(classes) * size
    log_unit = np.log(UNIT_NOISE / sizes).astype(np.float32)
    matrices = np.zeros((2, DIM + 1, DIM + 1), np.float32)  # a row for the bias column of the vectors, which is 0, as theirs
    always = np.concatenate([np.arange(base, of_units), np.arange(len(rows) - 2 * DIM, len(rows))])
    result = replace(model, rows=rows, seen=seen)

    def step(at: np.ndarray, grads: np.ndarray) -> None:
        squares = seen[at] + np.einsum("nd,nd->n", grads, grads) / (DIM + 1)
        seen[at] = squares
        grads *= (RATE / np.sqrt(squares)).astype(np.float32)[:, None]
        grads += rows.take(at, 0)
        rows[at] = grads
        touched[at] += 1

    for block in blocks:
        here = np.flatnonzero(block != m)
        two, one, unit, times, _ = distinct_trigrams(block[here], block[here - 1], block[here - 2], m)
        before, times = np.column_stack([one, two]), times.astype(np.float32)
        order = rng.permutation(len(unit))
        for a in range(0, len(order), BATCH):
            x = order[a:a + BATCH]
            by_unit, w = sorted_places(unit.take(x))
            x = x.take(by_unit)
            n, at, weight = len(x), before.take(x, 0), times.take(x)
            matrices[:, :DIM] = rows[-2 * DIM:].reshape(2, DIM, DIM + 1)
            both = rows.take(at, 0).reshape(n, -1)
            q = both @ matrices.reshape(-1, DIM + 1)
            q[:, DIM] = 1
            of = w // size
            # classes: towards the data, away from the noise that the batch shares
            noise = np.bincount(np.minimum(np.searchsorted(class_ends, rng.random(CLASS_NOISE) * class_ends[-1], "right"), classes - 1), minlength=classes)
            some = np.flatnonzero(noise)
            targets = rows[base:of_units]
            noise_rows = targets[some]
            g_noise = -_sigmoid(q @ noise_rows.T - log_class[some]) * noise[some].astype(np.float32) * weight[:, None]
            own = targets.take(of, 0)
            g_own = ((1 - _sigmoid(np.einsum("nd,nd->n", q, own) - log_class[of])) * weight)[:, None]
            # units: the same within the class; first the token's own, then the noise
            words = np.empty((1 + UNIT_NOISE, n), np.int64)
            words[0] = w
            words[1:] = of * size + (rng.random((n, UNIT_NOISE)) * sizes[of][:, None]).astype(np.int64).T
            words += of_units
            r = rows.take(words, 0)
            g = -_sigmoid(np.einsum("knd,nd->kn", r, q) - log_unit[of])
            g[0] += 1
            g *= weight
            r *= g[:, :, None]
            own *= g_own
            gq = g_noise @ noise_rows + own
            for of_row in r:
                gq += of_row
            dense = np.zeros((len(always), DIM + 1), np.float32)
            dense[some] = g_noise.T @ q
            first = run_starts(of)
            dense[of[first]] += np.add.reduceat(g_own * q, first)
            gq[:, DIM] = 0
            dense[classes:] = (both.T @ gq).reshape(matrices.shape)[:, :DIM].reshape(2 * DIM, DIM + 1)
            grads = np.empty((n * (3 + UNIT_NOISE), DIM + 1), np.float32)
            np.matmul(gq, matrices.reshape(-1, DIM + 1).T, out=grads[:2 * n].reshape(n, -1))
            np.multiply(g[:, :, None], q, out=grads[2 * n:].reshape(r.shape))
            by_row, at = sorted_places(np.concatenate([at.ravel(), words.ravel()]))
            first = run_starts(at)
            step(at[first], sums_of_runs(grads, by_row, first))
            step(always, dense)
    return result, touched


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _changes(model: LogBilinear, seed: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, times, c0, c1, ..., high): a task's changes of parameter rows and squares, times the steps that touched each."""
    blocks = (row.values.to_numpy(zero_copy_only=False).astype(np.int64) for batch in batches for row in batch.column(0))
    new, touched = train(model, blocks, seed * 1_000_003 + TaskContext.get().partitionId())
    at = np.flatnonzero(touched)
    change = np.column_stack([new.rows[at].astype(np.float64) - model.rows[at], new.seen[at] - model.seen[at]])
    whole = np.rint(change * (touched[at, None] * float(SCALE)))
    high = np.floor(whole[:, -1] / HIGH)
    whole[:, -1] -= high * HIGH
    columns = [pa.array(at.astype(np.int32)), pa.array(touched[at]), *map(pa.array, np.column_stack([whole, high]).astype(np.int64).T.copy())]
    yield pa.RecordBatch.from_arrays(columns, _CHANGE)


_CHANGE = ["row", "times", *(f"c{i}" for i in range(DIM + 2)), "high"]


def trained(model: LogBilinear, blocks: DataFrame, shares: int) -> LogBilinear:
    """The model after ``PASSES`` over the blocks (share, units), a share of them a round."""
    kinds = ", ".join(f"{c} {'int' if c == 'row' else 'long'}" for c in _CHANGE)
    for k in range(PASSES * shares):
        changes = blocks.where(F.col("share") == k % shares).select("units").mapInArrow(partial(_changes, model, k), kinds)
        sums = changes.groupBy("row").agg(*[F.sum(c).alias(c) for c in _CHANGE[1:]]).toArrow()
        at = sums["row"].to_numpy()
        total = np.column_stack([sums[c].to_numpy() for c in _CHANGE[2:-1]]).astype(np.float64)
        total[:, -1] += sums["high"].to_numpy() * float(HIGH)
        mean = total / SCALE / sums["times"].to_numpy()[:, None]
        model = replace(model, rows=model.rows.copy(), seen=model.seen.copy())
        model.rows[at] += mean[:, :-1].astype(np.float32)
        model.seen[at] += mean[:, -1]
    return model


# --- Spark -----------------------------------------------------------------------------------------------------------

def _score(vocabulary: Vocabulary, model: LogBilinear, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offsets in text_chunks(batch.column(1), CHUNK_BYTES):
            hashes, suffix, at = tokens(data, offsets)
            known, count, unit, shared = vocabulary.look_up(hashes, suffix)
            one, two = contexts(unit, at, vocabulary.start)
            *trigrams, _, inverse = distinct_trigrams(unit, one, two, vocabulary.start)
            n = end - first
            row = np.repeat(np.arange(n), np.diff(at))
            log_count = np.log10(count + 1.0)
            terms = model.log10(*trigrams)[inverse] + np.where(shared, log_count - vocabulary.share[suffix], 0.0)
            rare, times, rare_at = distinct_words(hashes[~known], row[~known], n)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(first, n), batch.column(2).slice(first, n), pa.array(np.diff(at)),
                pa.array(np.bincount(row[known], count[known] > 0, n).astype(np.int64)),
                pa.array(np.bincount(row, log_count, n)), pa.array(np.bincount(row, terms, n)),
                list_column(rare, rare_at), list_column(times, rare_at)],
                ["doc_id", "held_out", "n_tokens", "n_known", "base", "model", "rare", "times"])


def distinct_words(hashes: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different words of each of ``n`` texts, how often each occurs, and the texts' offsets among them."""
    words = pa.array(hashes).dictionary_encode()
    order, pair = sorted_places(row * max(len(words.dictionary), 1) + words.indices.to_numpy())
    first = run_starts(pair)
    at = order[first]
    return hashes[at], np.diff(first, append=len(pair)), np.searchsorted(row[at], np.arange(n + 1))


def _least_count(counts: DataFrame) -> int:
    """The smallest count, in steps of about one hundredth, that at most KNOWN words reach; the driver sees a row a step."""
    steps = counts.groupBy(F.floor(F.log("n") * 100).alias("step")).agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("words"))
    least, words = (1 << 62), 0
    for r in sorted(steps.collect(), key=lambda r: -r.step):
        words += r.words
        if words > KNOWN:
            break
        least = r.least
    return least


def learn(texts: DataFrame) -> tuple[Vocabulary, LogBilinear, DataFrame]:
    """Vocabulary, model and the table (w, suffix, n) of all word counts, from a column ``text``."""
    counts = stored(texts.mapInArrow(_counted, "w long, suffix long, n long").groupBy("w").agg(
        F.min("suffix").alias("suffix"), F.sum("n").alias("n")), "word-counts")
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    # the end and the TOP words are known whatever the threshold
    end = int(END_HASH.view(np.int64))
    first = [r.w for r in counts.where(F.col("w") != end).orderBy(F.desc("n"), "w").limit(TOP).select("w").collect()]
    known = counts.where((F.col("n") >= _least_count(counts)) | F.col("w").isin(end, *first)).toPandas().sort_values(["n", "w"], ascending=[False, True], ignore_index=True)
    per_suffix = np.zeros((2, SUFFIXES + 1), np.int64)
    for r in counts.where("suffix > 0").groupBy("suffix").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        per_suffix[:, r.suffix] = r.n, r.v
    w, n, suffix = known["w"].to_numpy(np.int64), known["n"].to_numpy(np.int64), known["suffix"].to_numpy(np.int64)
    own = np.flatnonzero(w != end)[:own_words(int(total.n or 0))]
    np.subtract.at(per_suffix[0], suffix[own], n[own])
    np.subtract.at(per_suffix[1], suffix[own], 1)
    per_suffix[0, 0] = n[w == end].sum()
    of_units = np.concatenate([per_suffix[0], n[own]])  # the end, the suffixes, the words
    falling = np.argsort(-of_units, kind="stable")
    number = np.empty(len(falling), np.int64)
    number[falling] = np.arange(len(falling))
    units = np.full(len(w), -1)
    units[own] = number[SUFFIXES + 1:]
    per_suffix[:, 0] = 0
    hashes = w.view(np.uint64)
    order = np.argsort(hashes)
    vocabulary = Vocabulary(hashes[order], n[order], units[order], number[:SUFFIXES + 1], of_units[falling], int(total.n or 0), int(total.v),
                            np.log10(per_suffix.sum(0) + 1.0))
    shares = (vocabulary.n // UNIT_BLOCK + 1).bit_length()
    path = scratch_path(texts.sparkSession, "unit-blocks")
    texts.mapInArrow(partial(_blocks, vocabulary, shares), "share int, units array<int>").write.partitionBy("share").option(
        "compression", "zstd").option("maxRecordsPerFile", FILE_BLOCKS).parquet(path)
    blocks = texts.sparkSession.read.schema("units array<int>, share int").parquet(path)
    model = trained(LogBilinear.new(vocabulary.unit_counts), blocks, shares)
    files.delete(texts.sparkSession, path)
    return vocabulary, model, counts


def scores(docs: DataFrame, learning, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``learning``: a Column that is true for the rows to learn from."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), (~learning).alias("held_out"))
    vocabulary, model, counts = learn(rows.where(~F.col("held_out")).select("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.select("doc_id", "text", "held_out").mapInArrow(
        partial(_score, vocabulary, model), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, model double, rare array<long>, times array<long>")
    scored = stored(scored.withColumn("row_id", F.monotonically_increasing_id()), "scored")
    rare = scored.select("row_id", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row_id", F.col("r.rare").alias("w"), "r.times")
    rare = rare.join(counts.select("w", "n"), "w").groupBy("row_id").agg(
        F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"))
    more, log_total = F.coalesce("more", F.lit(0.0)), math.log10(vocabulary.n + vocabulary.v + 1)
    return scored.drop("rare", "times").join(rare, "row_id", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0).cast("long"))).alias("n_known"),
        F.lit(vocabulary.n).cast("long").alias("train_tokens"), (F.col("base") + more - F.col("n_tokens") * log_total).alias("base_score"),
        (F.col("model") + more).alias("score"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(documents(spark, sf_dir), ~remainder_is("doc_id", 7, 2))
