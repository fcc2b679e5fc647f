import math

import numpy as np
import pytest

from railyard.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, component int, whitened string, x string"


def table(spark, vectors, kind="float"):
    rows = [(i, v, 1, "a", "b") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA.replace("<float>", f"<{kind}>"))


def check(spark, vectors, got):
    """Against numpy over the usable vectors, padded to the longest."""
    live = {i: v for i, v in enumerate(vectors)
            if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    dims = max(map(len, live.values()))
    x = {i: np.array([math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] + [1_000_000] * (dims - len(v)), dtype=object)
         for i, v in live.items()}
    fit = np.array(sorted({tuple(v) for v in x.values()}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = ((n * fit - sums) / n).astype(float)
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:16], u[:, ::-1][:, :16]
    k = min(16, dims)
    rows = {}
    for r in got:
        rows.setdefault(r.vec_id, {})[r.component] = r
    assert set(rows) == set(live) and all(sorted(r) == list(range(1, k + 1)) for r in rows.values())
    z = np.array([[rows[i][c + 1].whitened for c in range(k)] for i in live], dtype=object)
    exact = np.array([(n * x[i] - sums).astype(float) / n for i in live])
    alive = [c for c in range(k) if e[c] > 1e-9 * max(e[0], 1e-300)]
    for c in range(k):
        if c not in alive:
            assert all(w is None for w in z[:, c])
    want = exact @ u[:, alive] / np.sqrt(e[alive])
    have = z[:, alive].astype(float)
    sign = np.sign((want * have).sum(axis=0))
    assert np.allclose(have * sign, want, atol=1e-6)
    for j, i in enumerate(live):
        for r in rows[i].values():
            assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(x[i], sums))
            assert alive == [] or (r.identity_error is not None and r.identity_error < 1e-4)
    if v.trace() > 0:
        for c in range(k):
            assert abs(rows[next(iter(live))][c + 1].explained - max(e[c], 0) / v.trace()) < 1e-9


def test_cross_products_are_exact():
    rng = np.random.default_rng(3)
    for high in (1, 2, 300, 2 ** 20, 2 ** 42):
        y = rng.integers(0, high, (513, 5))
        y[:, 2] = 0
        want = y.astype(object).T @ y.astype(object)
        assert (W.cross_products(y) == want).all()
    assert (W.cross_products(np.zeros((3, 2), np.int64)) == 0).all()
    big = np.full((W.ROWS, 2), 2 ** 52 - 1)
    assert (W.cross_products(big) == W.ROWS * (2 ** 52 - 1) ** 2).all()


def test_against_numpy(spark):
    rng = np.random.default_rng(4)
    vectors = (rng.normal(size=(700, 20)) @ rng.normal(size=(20, 20)) * 3).astype(np.float32).tolist()
    vectors += [vectors[0]] * 300 + [None, [None] * 20, [float("nan")] * 20, [float("inf")] + [0.0] * 19]
    df = table(spark, vectors).repartition(7)
    check(spark, vectors, W.whiten(df).collect())


def test_fewer_dimensions_than_components_and_unequal_lengths(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(50, 3)).astype(np.float32).tolist() + [[1.0], [], [2.0, 0.5]]
    check(spark, vectors, W.whiten(table(spark, vectors)).collect())


def test_components_without_variance(spark):
    rng = np.random.default_rng(6)
    vectors = [[a, a, 0.0, b] for a, b in rng.normal(size=(40, 2)).round(2).tolist()]
    got = W.whiten(table(spark, vectors)).collect()
    check(spark, vectors, got)
    same = W.whiten(table(spark, [[1.0, 2.0]] * 3)).collect()
    assert len(same) == 6 and all(r.whitened is None and r.identity_error is None and r.explained is None and r.n == 1
                                  and r.deviation == 0 for r in same)


def test_empty(spark):
    for vectors in ([], [None], [[]], [[None]]):
        got = W.whiten(table(spark, vectors))
        assert got.collect() == []
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_extreme_entries(spark):
    vectors = [[1e300, 0.0], [-1e300, 1.0], [3.0, 2.0], [0.0, -5.0]]
    got = W.whiten(table(spark, vectors, "double")).collect()
    assert len(got) == 8
    assert all((r.deviation is None) == (r.vec_id < 2) for r in got)  # beyond a long
    assert all(r.identity_error < 1e-4 for r in got)


def test_too_many_dimensions(spark, monkeypatch):
    monkeypatch.setattr(W, "MAX_DIMS", 3)
    with pytest.raises(ValueError, match="MAX_DIMS"):
        W.whiten(table(spark, [[1.0] * 4]))


def test_many_chunks(spark, monkeypatch):
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(200, 6)).astype(np.float32).tolist()
    monkeypatch.setattr(W, "ROWS", 16)
    x = np.array([[math.floor(64 * c) + W.SHIFT for c in v] for v in vectors])
    import pyarrow as pa
    lists = pa.ListArray.from_arrays(pa.array(np.arange(201) * 6, pa.int32()), pa.array(x.ravel()))
    out = next(W._scatter(iter([pa.RecordBatch.from_arrays([lists], ["x"])]), 6)).to_pydict()
    cross = {(i, j): int(v) for i, j, v in zip(out["i"], out["j"], out["v"])}
    assert cross[-1, -1] == 200
    assert all(cross[i, j] == int((x[:, i] * x[:, j]).sum()) for i in range(6) for j in range(i, 6))


def test_query_on_whole_table(spark, sf001):
    got = W.op13_whitening(spark, sf001).collect()
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf001}/embeddings.parquet").collect()}
    ids = sorted(vectors)
    assert ids == list(range(len(ids)))
    check(spark, [vectors[i] for i in ids], got)
