"""Whitening of embeddings by incremental eigendecomposition.

Every partition keeps the spectrum of the scatter it has seen: a mean, eigenvalues and an orthogonal basis. A row enters as
a centred rank-one update: its deviation from the running mean is written in the basis, components that need no work are
deflated (a reflection gathers equal eigenvalues, tiny weights stay as they are), and the rest solve a secular equation
whose roots interlace the old eigenvalues. Spectra of partitions are merged in rounds of sixteen by adding the directions
of one to the other, again rank one each, and the gap between their means. A last pass over all rows projects the
covariance on the merged basis (Rayleigh-Ritz), which gives the eigenvectors to double precision whatever rounding the
many updates left behind.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.llm.common import fresh, staged

#: Partial results that are merged at once.
FAN_IN = 16
_EPS = np.finfo(np.float64).eps


def secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(z2 / (d - x)) for ascending, distinct ``d`` and positive ``z2``.

    Returns (pole each root is measured from, distance to it): root j lies between d[j] and d[j + 1], the last one above
    d[-1] by at most sum(z2). All roots are sought together: two rational terms meet the left and right sum and their
    slopes at a point, their common root is the next point; where it leaves the bracket the middle is taken.
    """
    k = len(d)
    right = np.append(d[1:], d[-1] + z2.sum())
    gap = right - d
    with np.errstate(all="ignore"):
        middle = 1 + (z2 / (d[None, :] - (d + gap / 2)[:, None])).sum(axis=1)
    near_left = middle >= 0
    near_left[-1] = True
    origin = np.where(near_left, np.arange(k), np.minimum(np.arange(k) + 1, k - 1))
    delta = d[None, :] - d[origin][:, None]  # poles seen from the origin of each root
    lower, upper = np.where(near_left, 0.0, -gap / 2), np.where(near_left, gap / 2, 0.0)
    lower[-1], upper[-1] = (gap[-1] / 2, gap[-1]) if middle[-1] < 0 else (0.0, gap[-1] / 2)
    x = (lower + upper) / 2
    left = np.tri(k)
    inner_root = np.arange(k) < k - 1
    own, nxt = delta[np.arange(k), np.arange(k)], delta[np.arange(k), np.minimum(np.arange(k) + 1, k - 1)]
    with np.errstate(all="ignore"):
        for _ in range(60):
            away = delta - x[:, None]
            t = z2 / away
            s = t / away
            psi, dpsi = np.einsum("ij,ij->i", t, left), np.einsum("ij,ij->i", s, left)
            phi, dphi = t.sum(axis=1) - psi, s.sum(axis=1) - dpsi
            f = 1 + psi + phi
            lower, upper = np.where(f < 0, x, lower), np.where(f < 0, upper, x)
            a, b = own - x, nxt - x
            p, q = a * a * dpsi, b * b * dphi
            c = 1 + (psi - a * dpsi) + np.where(inner_root, phi - b * dphi, 0)
            # c + p / (a - h) + q / (b - h) = 0 for the step h
            half = (c * (a + b) + p + q) / 2
            inner = c * a * b + p * b + q * a
            root = np.sqrt(np.maximum(half * half - c * inner, 0))
            h = np.where(half > 0, inner / (half + root), (half - root) / c)
            h[-1] = a[-1] + p[-1] / c[-1]
            new = x + h
            wild = ~((new > lower) & (new < upper))
            new = np.where(wild, (lower + upper) / 2, new)
            exact = np.abs(f) <= 8 * k * _EPS * (1 + np.abs(psi) + np.abs(phi))
            done = exact | (np.abs(new - x) <= 2 * _EPS * np.abs(new))
            x = np.where(exact, x, new)
            if done.all():
                break
    return origin, x


@dataclass
class Spectrum:
    """Number of rows, their mean, and eigenvalues and eigenvectors (columns) of their scatter, eigenvalues ascending."""

    n: float
    mean: np.ndarray
    values: np.ndarray
    basis: np.ndarray

    @classmethod
    def none(cls, dims: int) -> Spectrum:
        return cls(0, np.zeros(dims), np.zeros(dims), np.eye(dims))

    def update(self, v: np.ndarray, weight: float) -> None:
        """Scatter plus ``weight`` times the outer product of ``v``."""
        z = self.basis.T @ v * np.sqrt(weight)
        size = float(z @ z)
        if size == 0:
            return
        scale = max(self.values[-1], size)
        tiny = 4 * _EPS * scale
        # equal eigenvalues: a reflection of their vectors leaves weight on the last of them only
        cuts = np.flatnonzero(np.diff(self.values) > tiny) + 1
        for a, b in zip(np.concatenate([[0], cuts]).tolist(), np.concatenate([cuts, [len(z)]]).tolist(), strict=True):
            if b - a > 1:
                part = z[a:b].copy()
                norm = np.sqrt(part @ part)
                mirror = part.copy()
                mirror[-1] += norm if part[-1] >= 0 else -norm
                length = mirror @ mirror
                if length > 0:
                    self.basis[:, a:b] -= np.outer(self.basis[:, a:b] @ mirror, mirror * (2 / length))
                    z[a:b] = 0
                    z[b - 1] = -norm if part[-1] >= 0 else norm
        active = np.flatnonzero(np.abs(z) * np.sqrt(size) > tiny)
        if not len(active):
            return
        d, w = self.values[active], z[active]
        origin, shift = secular_roots(d, w * w)
        roots = d[origin] + shift
        apart = (d[None, :] - d[origin][:, None]) - shift[:, None]  # pole i minus root j, without cancellation
        # weights for which the computed roots are exact keep the vectors orthogonal
        between = d[:, None] - d[None, :]
        np.fill_diagonal(between, 1.0)
        exact = np.sqrt(np.abs(np.prod(apart / between.T, axis=0))) * np.where(w < 0, -1, 1)
        turn = exact[:, None] / apart.T
        turn /= np.sqrt((turn * turn).sum(axis=0))
        self.basis[:, active] = self.basis[:, active] @ turn
        self.values[active] = roots
        order = np.argsort(self.values, kind="stable")
        self.values, self.basis = self.values[order], np.ascontiguousarray(self.basis[:, order])

    def add(self, row: np.ndarray) -> None:
        v = row - self.mean
        self.n += 1
        self.mean = self.mean + v / self.n
        if self.n > 1:
            self.update(v, (self.n - 1) / self.n)

    def merge(self, other: Spectrum) -> None:
        n = self.n + other.n
        gap = other.mean - self.mean
        for value, vector in zip(other.values, other.basis.T, strict=True):
            if value > 0:
                self.update(vector, value)
        self.update(gap, self.n * other.n / n)
        self.mean, self.n = self.mean + gap * (other.n / n), n


def _numbers(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _partials(rows: DataFrame, dims: int, start: Callable, step: Callable, finish: Callable, name: str) -> DataFrame:
    """(id, part): what ``finish`` makes of each partition's rows (column x), as one array of doubles; staged."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, seen = start(), False
        for batch in batches:
            if batch.num_rows:
                seen = True
                state = step(state, _numbers(batch.column(0), dims))
        if seen:
            part = pa.array([finish(state).tolist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), part], names=["id", "part"])

    return staged(rows.select("x").mapInArrow(work, "id long, part array<double>"), name)


def _merged(parts: DataFrame, merge: Callable[[list[np.ndarray]], np.ndarray], name: str) -> np.ndarray:
    """All parts as one, merged sixteen at a time in the order of their ids; each round is staged."""

    def group(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        return pd.DataFrame({"id": [int(rows["id"].iloc[0]) // FAN_IN], "part": [merge([np.asarray(p) for p in rows["part"]])]})

    while parts.count() > 1:
        parts = staged(parts.groupBy((F.col("id") / FAN_IN).cast("long").alias("g")).applyInPandas(group, "id long, part array<double>"), name)
    return np.asarray(parts.first().part)


def _pack(s: Spectrum) -> np.ndarray:
    return np.concatenate([[s.n], s.mean, s.values, s.basis.ravel()])


def _unpack(part: np.ndarray, dims: int) -> Spectrum:
    return Spectrum(part[0], part[1 : 1 + dims], part[1 + dims : 1 + 2 * dims].copy(), part[1 + 2 * dims :].reshape(dims, dims).copy())


def usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there, finite throughout and of the usual length (the most frequent one, of equals the longest)."""
    v = F.col(vector)
    good = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    kept = df.where(F.coalesce(good, F.lit(False)))
    usual = kept.groupBy(F.size(v).alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    return kept.where(F.size(v) == (usual.dims if usual else 0))


def grid(vector: str, scale: float = 64, offset: int = 1_000_000) -> Column:
    """Entries as whole numbers: floor(scale * entry) + offset, where scaled entries are held inside 2**62 either way."""
    bound = F.lit(2.0**62)
    return F.transform(vector, lambda c: F.floor(F.least(F.greatest(c.cast("double") * F.lit(float(scale)), -bound), bound)) + F.lit(offset).cast("long"))


@dataclass
class Whitening:
    """Rows and exact sums of the fit list, components (rows) with falling eigenvalues, and their share of the trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact; whole numbers of Python where 64 bits are not enough."""
        small = self.n * max(int(np.abs(x).max(initial=0)), 1) + max((abs(s) for s in self.sums), default=0) < 2**63
        return x * np.int64(self.n) - np.array(self.sums, np.int64) if small else x.astype(object) * self.n - np.array(self.sums, object)

    def project(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x).astype(np.float64) / self.n) @ (self.components / np.sqrt(self.values)[:, None]).T


def fit(x: DataFrame, components: int = 16) -> Whitening | None:
    """The whitening of the distinct vectors of column ``x`` (arrays of long, all of one length); None without rows.

    Components whose eigenvalue is nothing but rounding (below 1e-12 of the largest) are left out, so a single distinct
    vector has none. Copies of a vector are merged before they are shuffled, so a frequent one is no burden. A row costs a
    rank-one update: time in the cube of the dimensions. Spectra have dims * (dims + 2) numbers, and one travels a
    partition; the driver gets the last one.
    """
    rows = staged(x.select("x").distinct(), "whitening-vectors")
    first = rows.first()
    if first is None:
        return None
    dims = len(first.x)

    exact = rows.select("x").mapInArrow(_exact_sums(dims), "dim int, part decimal(38,0)").groupBy("dim").agg(F.sum("part").alias("part"))
    sums = {r.dim: int(r.part) for r in exact.collect()}
    n, total = sums[0], [(sums[1 + i] << 32) + sums[1 + dims + i] for i in range(dims)]
    near = np.array([round(t / n) for t in total], dtype=np.int64)

    def step(s: Spectrum, x: np.ndarray) -> Spectrum:
        for row in (x - near).astype(np.float64):
            s.add(row)
        return s

    def join(parts: list[np.ndarray]) -> np.ndarray:
        whole = _unpack(parts[0], dims)
        for p in parts[1:]:
            whole.merge(_unpack(p, dims))
        return _pack(whole)

    spectra = _partials(rows, dims, lambda: Spectrum.none(dims), step, _pack, "whitening-spectra")
    basis = np.linalg.qr(_unpack(_merged(spectra, join, "whitening-merge"), dims).basis)[0]

    def moments(project: Callable) -> np.ndarray:
        """Mean outer product of the projected rows, over all rows."""
        gram = lambda g, x: g + (lambda y: y.T @ y)(project(x))
        parts = _partials(rows, dims, lambda: 0.0, gram, np.ravel, "whitening-gram")
        whole = _merged(parts, lambda p: np.sum(p, axis=0), "whitening-grams")
        return whole.reshape(int(np.sqrt(len(whole))), -1) / n

    exact_model = Whitening(n, total, np.ones(dims), basis.T.copy(), 0.0, 0.0)
    values, turn = np.linalg.eigh(moments(exact_model.project))
    values, vectors = values[::-1], (basis @ turn)[:, ::-1]
    rank = int((values > 1e-12 * max(values[0], 0)).sum()) if values[0] > 0 else 0
    kept = min(components, rank)
    model = Whitening(n, total, values[:kept].copy(), vectors[:, :kept].T.copy(), float(values.sum()), 0.0)
    if kept:
        model.identity_error = float(np.abs(moments(model.project) - np.eye(kept)).max())
    return model


def _exact_sums(dims: int) -> Callable:
    """(dim, part): a partition's number of rows (0), and sums of the high and low 32 bits of each dimension."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = [0] * (1 + 2 * dims)
        for batch in batches:
            x = _numbers(batch.column(0), dims)
            halves = [len(x), *(x >> 32).sum(axis=0).tolist(), *(x & 0xFFFFFFFF).sum(axis=0).tolist()]
            state = [a + b for a, b in zip(state, halves, strict=True)]
        parts = pa.array([Decimal(s) for s in state], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(state)), pa.int32()), parts], names=["dim", "part"])

    return work


def whiten(df: DataFrame, model: Whitening, x: str) -> DataFrame:
    """``df`` with ``deviation``, the exact sum over dimensions of (n * x - S)**2 as decimal(38,0) (null beyond that),
    and ``whitened``, an array of one double a component. Clashing columns of ``df`` stay; names get underscores then.

    ``df`` holds vectors of the fitted length in column ``x``; a null vector gives nulls.
    """
    deviation, whitened = fresh(df, "deviation"), fresh(df, "whitened")
    dims = len(model.sums)

    @F.pandas_udf("struct<deviation: string, whitened: array<double>>")
    def apply(vectors: pd.Series) -> pd.DataFrame:
        there = vectors.notna().to_numpy()
        out = pd.DataFrame({"deviation": [None] * len(vectors), "whitened": [None] * len(vectors)}, dtype=object)
        if there.any():
            m = np.stack(vectors[there].to_numpy()).astype(np.int64, copy=False)
            c = model.centred(m)
            if c.dtype != object and float(np.abs(c).max()) ** 2 * dims >= 2.0**62:
                c = c.astype(object)
            squares = [str(int(s)) for s in (c * c).sum(axis=1)]
            out.loc[there, "deviation"] = squares
            out.loc[there, "whitened"] = pd.Series(list(model.project(m)), index=out.index[there])
        return out

    made = fresh(df, "made")
    return df.withColumn(made, apply(F.col(x))).withColumns({
        deviation: F.expr(f"try_cast({made}.deviation AS decimal(38,0))"), whitened: F.col(made)["whitened"]}).drop(made)
