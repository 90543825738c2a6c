"""Whitening against numpy's eigendecomposition of the exact covariance."""

import math

import numpy as np
import pytest

from lamella.llm import queries, whitening


def covariance(x: list) -> tuple[np.ndarray, np.ndarray]:
    """(n * x - S, covariance) from whole numbers."""
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    centred = np.array([[n * v - s for v, s in zip(row, sums, strict=True)] for row in x], dtype=float) / n
    return centred, centred.T @ centred / n


@pytest.mark.parametrize(("dims", "rows", "kind"), [(1, 5, "plain"), (6, 300, "plain"), (8, 300, "flat"), (12, 7, "plain"), (20, 400, "ties")])
def test_updates_give_the_scatter(dims, rows, kind):
    rng = np.random.default_rng(dims)
    x = rng.normal(size=(rows, dims)) * 10.0 ** -rng.integers(0, 4, dims)
    if kind == "flat":
        x[:, 3] = x[:, 4] = 1.0
    if kind == "ties":
        x = np.concatenate([np.eye(dims)[rng.integers(0, dims, rows)], np.zeros((5, dims))]) * 8
    one, two, want = whitening.Spectrum.none(dims), whitening.Spectrum.none(dims), x - x.mean(axis=0)
    for i, row in enumerate(x):
        (one if i % 3 else two).add(row)
    one.merge(two)
    scatter = one.basis @ np.diag(one.values) @ one.basis.T
    assert np.allclose(scatter, want.T @ want, atol=1e-11 * max(1, np.abs(want.T @ want).max()))
    assert np.allclose(one.basis.T @ one.basis, np.eye(dims), atol=1e-11)
    assert one.n == len(x) and np.allclose(one.mean, x.mean(axis=0))


def test_roots_interlace():
    rng = np.random.default_rng(1)
    for k in (1, 2, 5, 40):
        d, z2 = np.sort(rng.normal(size=k)) * 10.0 ** rng.integers(-6, 6), 10.0 ** rng.uniform(-20, 3, k)
        origin, shift = whitening.secular_roots(d, z2)
        want = np.linalg.eigvalsh(np.diag(d) + np.outer(np.sqrt(z2), np.sqrt(z2)))
        assert np.allclose(d[origin] + shift, want, rtol=1e-12, atol=1e-12 * np.abs(want).max())


def test_query(spark, sf):
    rows = queries.op11_embedding_whitening(spark, sf).collect()
    vectors = {r.vec_id: [math.floor(64 * c) + 1_000_000 for c in r.embedding] for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    fit = [list(t) for t in dict.fromkeys(map(tuple, vectors.values()))]
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    _, cov = covariance(fit)
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1], basis[:, ::-1]
    assert len(rows) == 16 * len(vectors) and {r.component for r in rows} == set(range(1, 17))
    signs = {}
    for r in rows:
        k, gap = r.component - 1, np.array([n * v - s for v, s in zip(vectors[r.vec_id], sums, strict=True)])
        assert r.n == n and r.deviation == sum(int(g) ** 2 for g in gap)
        assert abs(r.explained / (values[k] / np.trace(cov)) - 1) < 1e-9 and r.identity_error < 1e-9
        want = gap / n @ basis[:, k] / np.sqrt(values[k])
        if abs(want) > 0.1:
            signs.setdefault(k, np.sign(want * r.whitened))
            assert abs(r.whitened - signs[k] * want) < 1e-7


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [0.5, 1.0, 2.0], "a"), (2, [0.5, 1.0, 2.0], "a"), (None, [1.5, -1.0, 0.0], "b"), (4, [0.0, 0.0, 3e38], None), (5, None, "c"),
            (6, [1.0, None, 2.0], "c"), (7, [1.0, inf, 2.0], "c"), (8, [1.0, nan, 2.0], "c"), (9, [], "c"), (10, [1.0, 2.0], "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, whitened string")
    kept = whitening.usable(df, "embedding").withColumn("x", whitening.grid("embedding"))
    assert sorted(r.vec_id or 0 for r in kept.collect()) == [0, 1, 2, 4]
    model = whitening.fit(kept, components=16)
    assert model.n == 3 and len(model.values) <= 2
    out = whitening.whiten(kept, model, "x")
    assert out.columns == [*kept.columns, "deviation", "whitened_"] and out.count() == 4
    assert whitening.fit(kept.limit(0)) is None
    single = whitening.fit(kept.where("vec_id < 3"))  # one distinct vector has no components
    assert single.n == 1 and len(single.values) == 0
    assert whitening.whiten(kept.where("vec_id < 3"), single, "x").first()["deviation"] == 0


def test_many_partitions(spark):
    """More partitions than are merged in one round."""
    rng = np.random.default_rng(3)
    x = rng.integers(-50, 50, (400, 5)) + 1_000_000
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id long, x array<long>").repartition(40)
    model = whitening.fit(df, components=5)
    values = np.linalg.eigvalsh(covariance(np.unique(x, axis=0).tolist())[1])[::-1]
    assert np.allclose(model.values, values, rtol=1e-12) and model.identity_error < 1e-12
