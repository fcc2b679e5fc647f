"""Whitening of embeddings by bit-sliced integer scatter (operator 13).

Entries become integers; each distinct vector is fitted once. A task cuts every dimension of its rows, less the
smallest value there, into bit planes, packs a plane's bits across rows into 64-bit words, and gets each cross-product
as the sum of popcounts of two planes ANDed, weighted by their powers of two. All of it is exact, and so are the sums
over tasks (decimals) and the centring (integers), so that only ``eigh`` and the projection work in doubles. The
sums that reach the driver are one number per pair of dimensions.

Defined cases: a vector that is null, or holds a null, NaN or infinite entry, is left out. Shorter vectors are filled
up with zeros to the longest one; more than MAX_DIMS dimensions are an error, as the scatter is square in them. An
entry beyond 2^34 in size counts as that. A component without variance (all vectors equal, fewer vectors than
dimensions) has ``whitened`` null, is no part of ``identity_error`` (null if all are such) and explains what its
eigenvalue says, null where the trace is 0. A deviation that doesn't fit a long is null. Repeated rows are returned each; an empty
table, or one without a usable vector, gives an empty result. Other columns never take part, whatever their names.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm.common import stored

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
MAX_DIMS = 4096
LARGEST = float(2 ** 34)
# rows whose planes are held at a time
ROWS = 8192
# an eigenvalue below this share of the largest counts as none
NO_VARIANCE = 1e-12

_EXACT = "decimal(38,0)"


def usable(vector: Column) -> Column:
    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf")))
    return vector.isNotNull() & F.forall(vector, finite)


def integers(vector: Column) -> Column:
    """floor(64 c) + 1000000 of every entry."""
    def whole(c: Column) -> Column:
        bounded = F.greatest(F.least(c.cast("double"), F.lit(LARGEST)), F.lit(-LARGEST))
        return F.floor(bounded * SCALE).cast("long") + SHIFT
    return F.transform(vector, whole)


def bit_planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, dimension, bit) of the planes of ``y`` (rows x dims, not negative) that hold a bit."""
    rows, dims = y.shape
    words, of, bits = [], [], []
    for bit in range(int(y.max(initial=0)).bit_length()):
        plane = ((y >> bit) & 1).astype(np.uint8)
        some = np.flatnonzero(plane.any(axis=0))
        packed = np.packbits(plane[:, some].T, axis=1)
        packed = np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))
        words.append(np.ascontiguousarray(packed).view(np.uint64))
        of.append(some)
        bits.append(np.full(len(some), bit))
    if not words:
        return np.zeros((0, 0), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(words), np.concatenate(of), np.concatenate(bits)


def cross_products(y: np.ndarray) -> np.ndarray:
    """Exact sums over rows of y_i y_j, as Python integers."""
    dims = y.shape[1]
    out = np.zeros((dims, dims), object)
    words, of, bits = bit_planes(y)
    top = int(bits.max(initial=0))
    for p in range(len(words)):
        ones = np.bitwise_count(words[p:] & words[p]).sum(axis=1, dtype=np.int64)
        i, weight = of[p], 1 << int(bits[p])
        # counts below 2^14 (ROWS) times weights: whole in a long while planes reach 2^48
        if top < 48:
            sums = np.zeros(dims, np.int64)
            np.add.at(sums, of[p:], ones << bits[p:])
            sums = sums.astype(object)
        else:
            sums = np.zeros(dims, object)
            np.add.at(sums, of[p:], np.array([int(c) << int(b) for c, b in zip(ones, bits[p:])], object))
        # the pair (p, p) is met once, any other stands for (p, q) and (q, p)
        same = int(ones[0]) << int(bits[p])
        out[i] += weight * sums
        out[:, i] += weight * sums
        out[i, i] -= weight * same
    return out


def _vectors(batches: Iterator[pa.RecordBatch], dims: int, column: int = 0) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _scatter(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    """A task's number of rows (-1, -1), sums (i, -1) and cross-products (i, j), i <= j."""
    n, sums, cross = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
    for _, x in _vectors(batches, dims):
        low = x.min(axis=0)
        y = x - low
        s, m, rows = y.sum(axis=0).astype(object), low.astype(object), len(x)
        cross += cross_products(y) + np.outer(m, s) + np.outer(s, m) + rows * np.outer(m, m)
        sums += s + rows * m
        n += rows
    i, j = np.triu_indices(dims)
    values = [n, *sums, *cross[i, j]]
    yield pa.RecordBatch.from_arrays([
        pa.array([-1, *range(dims), *i], pa.int32()), pa.array([-1] * (dims + 1) + list(j), pa.int32()),
        pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))], ["i", "j", "v"])


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: tuple[int, ...]
    axes: np.ndarray       # components x dims, unit rows, by falling eigenvalue
    values: np.ndarray     # eigenvalues of the components
    explained: tuple[float | None, ...]

    @property
    def alive(self) -> np.ndarray:
        return self.values > NO_VARIANCE * max(float(self.values.max(initial=0.0)), 0.0)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: longs where they fit, else Python integers."""
        bound = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        if bound < 2 ** 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        scale = np.where(self.alive, 1 / np.sqrt(np.where(self.alive, self.values, 1.0)), np.nan)
        return (centred.astype(np.float64) / self.n) @ self.axes.T * scale


def fit(vectors: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening:
    """From a table of distinct integer vectors ``x`` of ``dims`` entries."""
    per_task = vectors.select("x").mapInArrow(functools.partial(_scatter, dims=dims), f"i int, j int, v {_EXACT}")
    total = {(r.i, r.j): int(r.v) for r in per_task.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
    n, sums = total[-1, -1], [total[i, -1] for i in range(dims)]
    v = np.zeros((dims, dims))
    for i in range(dims):
        for j in range(i, dims):
            v[i, j] = v[j, i] = (n * total[i, j] - sums[i] * sums[j]) / (n * n)
    trace = float(np.trace(v))
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    return Whitening(n, tuple(sums), np.ascontiguousarray(u.T), e.copy(),
                     tuple(float(max(x, 0.0)) / trace if trace > 0 else None for x in e))


def _second_moments(batches: Iterator[pa.RecordBatch], dims: int, model: Whitening) -> Iterator[pa.RecordBatch]:
    k = len(model.values)
    sums, cross = np.zeros(k), np.zeros((k, k))
    for _, x in _vectors(batches, dims):
        z = np.nan_to_num(model.whitened(model.centred(x)))
        sums += z.sum(axis=0)
        cross += z.T @ z
    i, j = np.triu_indices(k)
    yield pa.RecordBatch.from_arrays([pa.array([*range(k), *i], pa.int32()), pa.array([-1] * k + list(j), pa.int32()),
                                      pa.array([*sums, *cross[i, j]], pa.float64())], ["i", "j", "v"])


def identity_error(vectors: DataFrame, dims: int, model: Whitening) -> float | None:
    """Largest entry of |covariance of the whitened fit list - identity|, measured on all of the list."""
    per_task = vectors.select("x").mapInArrow(functools.partial(_second_moments, dims=dims, model=model),
                                              "i int, j int, v double")
    total = {(r.i, r.j): r.v for r in per_task.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
    live = np.flatnonzero(model.alive)
    off = [abs(total[i, j] / model.n - total[i, -1] / model.n * (total[j, -1] / model.n) - (i == j))
           for i in live for j in live if i <= j]
    return float(max(off)) if off else None


def _project(batches: Iterator[pa.RecordBatch], dims: int, model: Whitening) -> Iterator[pa.RecordBatch]:
    for batch, x in _vectors(batches, dims, 1):
        centred = model.centred(x)
        size = int(np.abs(centred).max(initial=0))
        wide = centred if size * size * dims < 2 ** 63 else centred.astype(object)
        deviation = [int(v) if v < 2 ** 63 else None for v in (wide * wide).sum(axis=1)]
        z = model.whitened(centred)
        flat = pa.array(z.ravel(), mask=np.isnan(z.ravel()))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * z.shape[1], pa.int32()), flat)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviation, pa.int64()), lists],
                                         ["vec_id", "deviation", "z"])


OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component."""
    spark, vector = df.sparkSession, F.col("v")
    rows = df.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").alias("v")).where(usable(vector))
    id_type = rows.schema["vec_id"].dataType.simpleString()
    dims = rows.agg(F.max(F.size("v"))).first()[0] or 0
    if dims > MAX_DIMS:
        raise ValueError(f"vectors of {dims} dimensions; MAX_DIMS is {MAX_DIMS}")
    if not dims:
        return spark.createDataFrame([], f"vec_id {id_type}, {OUT}")
    x = integers(vector)
    padded = F.when(F.size("v") < dims, F.concat(x, F.array_repeat(F.lit(SHIFT).cast("long"), dims - F.size("v"))))
    rows = rows.select("vec_id", F.coalesce(padded, x).alias("x"))
    distinct = stored(rows.select("x").distinct(), "distinct-vectors")
    model = fit(distinct, dims, components)
    error = identity_error(distinct, dims, model)
    out = rows.mapInArrow(functools.partial(_project, dims=dims, model=model),
                          f"vec_id {id_type}, deviation long, z array<double>")
    out = out.select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened"))
    explained = F.get(F.array(*[F.lit(e).cast("double") for e in model.explained]), F.col("at"))
    return out.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
                      "deviation", "whitened", explained.alias("explained"),
                      F.lit(error).cast("double").alias("identity_error"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))
