"""Embedding whitening by a block Jacobi-Davidson method.

The covariance is never formed: a product with a block of vectors is one Spark job over the staged integer
rows, centred before they are multiplied, whose partial sums (dimensions x block, whatever the number of rows) are
added by Spark. Around it, on arrays of that size: Rayleigh-Ritz in a growing subspace, projected correction
equations for all open pairs at once by a few MINRES steps (each one product of the block), locking of the pairs whose
residual is at double precision, and restarts with the best Ritz vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.llm.common import column, stage

COMPONENTS, SCALE, OFFSET = 32, 64, 1_000_000
#: A pair is locked when its residual is below this share of the largest eigenvalue.
RESIDUAL = 2e-15
#: Ritz vectors beyond the wanted ones, MINRES steps of a correction and the drop that ends them, and outer steps.
SPARE, INNER, INNER_DROP, OUTER = 8, 12, 1e-2, 60
#: Eigenvalues up to this share of the trace are rounding: there is nothing to whiten.
NOTHING = 1e-12

Product = Callable[[np.ndarray], np.ndarray]


def _minres(product: Product, right: np.ndarray) -> np.ndarray:
    """Approximate solutions of ``product(x) = right`` for each column, all columns in step."""
    x, old, w, w_old = (np.zeros_like(right) for _ in range(4))
    gamma = np.linalg.norm(right, axis=0)
    eta, start = gamma.copy(), gamma.copy()
    v = right / np.where(gamma > 0, gamma, 1)
    c = c_old = np.ones(right.shape[1])
    s = s_old = np.zeros(right.shape[1])
    gamma = np.zeros(right.shape[1])
    for _ in range(INNER):
        p = product(v)
        delta = (v * p).sum(axis=0)
        p = p - delta * v - gamma * old
        ahead = np.linalg.norm(p, axis=0)
        a0 = c * delta - c_old * s * gamma
        a1 = np.hypot(a0, ahead)
        a2, a3 = s * delta + c_old * c * gamma, s_old * gamma
        ok = a1 > 1e-300
        a1 = np.where(ok, a1, 1)
        c_old, c, s_old, s = c, np.where(ok, a0 / a1, 1), s, np.where(ok, ahead / a1, 0)
        w_old, w = w, np.where(ok, (v - a3 * w_old - a2 * w) / a1, 0)
        x += c * eta * w
        eta = -s * eta
        gamma, old = ahead, v
        v = p / np.where(ahead > 0, ahead, 1)
        if (np.abs(eta) <= INNER_DROP * start).all():
            break
    return x


def _new_directions(t: np.ndarray, basis: np.ndarray, room: int) -> np.ndarray:
    """An orthonormal basis of what ``t`` adds to ``basis``, at most ``room`` vectors."""
    size = np.linalg.norm(t, axis=0)
    t = t[:, size > 0] / size[size > 0]
    for _ in range(3):
        t = t - basis @ (basis.T @ t)
        u, s, _ = np.linalg.svd(t, full_matrices=False)
        t = u[:, s > 1e-10][:, :room]
    return t


def jacobi_davidson(product: Product, dims: int, wanted: int, seed: int = 13) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvalues falling, vectors as columns, residual norms) of the ``wanted`` largest pairs of a symmetric product."""
    draw = np.random.default_rng(seed)
    wanted = min(wanted, dims)
    v = np.linalg.qr(draw.normal(size=(dims, min(dims, wanted + SPARE))))[0]
    av = product(v)
    locked, values, norms = np.zeros((dims, 0)), np.zeros(0), np.zeros(0)
    biggest = 0.0
    for step in range(OUTER):
        h = v.T @ av
        theta, s = np.linalg.eigh((h + h.T) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        v, av = v @ s, av @ s
        biggest = max(biggest, float(theta.max(initial=0)))
        left = wanted - len(values)
        r = av[:, :left] - v[:, :left] * theta[:left]
        r -= locked @ (locked.T @ r)
        size = np.linalg.norm(r, axis=0)
        whole = locked.shape[1] + v.shape[1] == dims
        done = size <= RESIDUAL * biggest * np.sqrt(dims)
        # In order of size; with the whole space spanned, Rayleigh-Ritz is exact to rounding.
        n = left if whole or step == OUTER - 1 else int(np.argmin(np.append(done, False)))
        locked, values, norms = np.hstack([locked, v[:, :n]]), np.append(values, theta[:n]), np.append(norms, size[:n])
        v, av, theta, r, size = v[:, n:], av[:, n:], theta[n:], r[:, n:], size[n:]
        if len(values) == wanted:
            break
        left = wanted - len(values)
        open_ = np.flatnonzero(size > RESIDUAL * biggest * np.sqrt(dims))
        out = np.hstack([locked, v[:, :left]])

        def projected(x: np.ndarray, out: np.ndarray = out, shift: np.ndarray = theta[:left][open_]) -> np.ndarray:
            y = product(x) - shift * x
            return y - out @ (out.T @ y)

        # A third of the room at most goes to one step, and none is kept beyond the best Ritz vectors.
        if v.shape[1] > 3 * (wanted + SPARE):
            v, av = v[:, : left + SPARE], av[:, : left + SPARE]
        room = dims - locked.shape[1] - v.shape[1]
        right = -(r[:, open_] - out @ (out.T @ r[:, open_]))
        t = _new_directions(_minres(projected, right), np.hstack([locked, v]), room)
        if not t.shape[1]:
            t = _new_directions(draw.normal(size=(dims, min(room, wanted))), np.hstack([locked, v]), room)
        v, av = np.hstack([v, t]), np.hstack([av, product(t)])
    order = np.argsort(-values, kind="stable")
    vectors = locked[:, order]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])] < 0, -1, 1)
    return values[order], vectors, norms[order]


def integer_rows(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x): the usable rows as integers. Null vectors, those with null or non-finite entries, and those
    whose length is not the most frequent one (of several such lengths the largest) are left out."""
    c = F.col("c").cast("array<double>")
    rows = embeddings.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("c")).filter(F.col("c").isNotNull()).select("vec_id", c.alias("c"))
    rows = rows.filter(F.forall("c", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))))
    made = stage(rows.select("vec_id", F.transform("c", lambda e: F.floor(e * SCALE).cast("long") + F.lit(OFFSET).cast("long")).alias("x")), "vectors")
    sizes = made.groupBy(F.size("x").alias("k")).count().orderBy(F.desc("count"), F.desc("k")).limit(1).collect()
    return made.filter(F.size("x") == (sizes[0]["k"] if sizes else 0)).filter(F.size("x") > 0)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    col = column(batch, "x")
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def _cells(rows: DataFrame, add: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum over all batches of ``add``'s arrays of ``size`` doubles: one set of cells a task, added by Spark."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            if b.num_rows:
                total += add(_matrix(b)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["cell", "value"])

    out = np.zeros(size)
    for r in rows.select("x").mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect():
        out[r["cell"]] = r["value"]
    return out


@dataclass
class Fit:
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    trace: float

    @property
    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean as integer part and fraction, so that integer rows lose nothing when it is taken off."""
        whole = [s // self.n for s in self.sums]
        return np.array(whole, np.int64), np.array([float(Fraction(s, self.n) - w) for s, w in zip(self.sums, whole, strict=True)])

    def whiten(self, x: np.ndarray) -> np.ndarray:
        whole, part = self.centre
        return (((x - whole).astype(float) - part) @ self.vectors) / np.sqrt(self.values)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Means and leading eigenpairs of the covariance (divisor n) of the rows of ``integer_rows``; None without rows."""

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, 0
        for b in batches:
            n += b.num_rows
            total = total + _matrix(b).sum(axis=0) if b.num_rows else total
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(total)), pa.int32()), pa.array([n, *total.tolist()], pa.int64())], ["dim", "s"])

    got = {r["dim"]: int(r["s"]) for r in rows.select("x").mapInArrow(sums, "dim int, s long").groupBy("dim").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}
    if not got:
        return None
    out = Fit(got[-1], [got[k] for k in range(len(got) - 1)], np.zeros(0), np.zeros((0, 0)), np.zeros(0), 0.0)
    (whole, part), dims, n = out.centre, len(got) - 1, out.n

    def product(block: np.ndarray) -> np.ndarray:
        def add(x: np.ndarray) -> np.ndarray:
            centred = (x - whole).astype(float) - part
            return centred.T @ (centred @ block)

        return _cells(rows, add, block.size).reshape(block.shape) / n

    out.trace = float(_cells(rows, lambda x: np.array([(((x - whole).astype(float) - part) ** 2).sum()]), 1)[0]) / n
    if out.trace > 0:
        values, vectors, residuals = jacobi_davidson(product, dims, components)
        keep = values > NOTHING * out.trace
        out.values, out.vectors, out.residuals = values[keep], vectors[:, keep], residuals[keep]
    return out


def whiten(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each usable row and component.

    Rows of ``integer_rows`` are used, repeated ones and those with a null id as they are; other columns are not read.
    There are as many components as the covariance has eigenvalues above rounding, at most ``components``: none for an empty
    table, one row, or rows that are all equal. A deviation that does not fit a long is null.
    """
    rows = integer_rows(embeddings, id_col, vector_col)
    schema = T.StructType([rows.schema["vec_id"], *(T.StructField(k, t) for k, t in (("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()), ("whitened", T.DoubleType()), ("explained", T.DoubleType()), ("identity_error", T.DoubleType())))])
    model = fit(rows, components)
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], schema)
    k, n = len(model.values), model.n

    def moments(x: np.ndarray) -> np.ndarray:
        w = model.whiten(x)
        return np.append(w.T @ w, w.sum(axis=0))

    seen = _cells(rows, moments, k * k + k) / n
    error = float(np.abs(seen[: k * k].reshape(k, k) - np.outer(seen[k * k :], seen[k * k :]) - np.eye(k)).max())
    explained = model.values / model.trace
    whole = model.centre[0]
    rest = np.array([s - n * int(w) for s, w in zip(model.sums, whole, strict=True)], np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b) if b.num_rows else np.zeros((0, len(whole)), np.int64)
            y = x - whole
            if (np.abs(y).max(initial=0) + 1.0) ** 2 * float(n) ** 2 * x.shape[1] < 2**62:
                deviation = pa.array(((n * y - rest) ** 2).sum(axis=1))
            else:
                exact = [sum((n * int(a) - int(r)) ** 2 for a, r in zip(row, rest, strict=True)) for row in y]
                deviation = pa.array([e if e < 2**63 else None for e in exact], pa.int64())
            m, at = len(x), np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [column(b, "vec_id").take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)), deviation.take(pa.array(at)),
                 pa.array(model.whiten(x).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                schema.names,
            )

    return rows.mapInArrow(run, schema)
