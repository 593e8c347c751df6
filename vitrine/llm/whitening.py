"""Embedding whitening with mixed-precision eigenvectors.

Entries are whole numbers (``vectors.quantised``). The fit list holds each
distinct vector once; its covariance V is gathered in two distributed passes:

1. n and the sums S of every dimension, exact.
2. Every task centres its rows at the whole number next to the mean and adds up
   their products exactly; the few task matrices meet in a tree of ``groupBy``
   sums by matrix entry, and the rest of the mean (less than 1 a dimension) is
   taken off as a rank-one term. V's entries are so rounded once.

Eigenvectors come from a float32 decomposition of V, corrected by
Ogita-Aishima steps: each takes R = I - X'X and S = X'VX, estimates the
eigenvalues and adds X E with E_ij = (S_ij + l_j R_ij) / (l_j - l_i). Each step
squares the error; the first ones run in double, the last ones in extended
precision. Eigenvalues closer than the step can tell apart (``delta``) form a
cluster: there E_ij = R_ij / 2 only keeps the vectors orthonormal, and a
sub-solve of the cluster's small block X_c'(V - m I)X_c, shifted by its mean m so
that its gaps show, turns them into eigenvectors.

Bounded: the driver holds matrices of dimension x dimension, never rows. Equal
vectors are reduced before the shuffle, so a vector of a third of all rows is no
hot key.

Defined cases: NULL vectors and those with a NULL, NaN or infinite entry are
dropped, empty ones and those of another length than most rows have as well; a
NULL id or a repeated row stays a row; components whose eigenvalue is not above
rounding of the largest do not exist, so fewer than four (for one distinct
vector: none, hence no row) may come back; equal eigenvalues give one orthonormal
basis of their space; a ``deviation`` beyond a long is NULL; an empty table gives
no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.common import stage
from vitrine.llm.vectors import matrix, of_common_length, peak, products, quantised, whole

COMPONENTS = 4
DOUBLE_STEPS, EXTENDED_STEPS = 6, 3
CHUNK = 4096
HALF = 10**18  # task sums travel in two parts, each far below 38 digits


def integer_vectors(df: DataFrame, ids: list[str], vector: str) -> DataFrame:
    """Ids and ``x`` of the rows that take part."""
    kept = df.where(whole(F.col(vector))).select(*ids, quantised(F.col(vector)).alias("x"))
    return of_common_length(kept, "x")


def count_and_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Rows of the fit list, and the exact sum of every dimension."""
    rows = (fit.select(F.posexplode("x").alias("i", "v")).groupBy("i")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s"))
            .orderBy("i").collect())
    return (rows[0]["n"], [int(r["s"]) for r in rows]) if rows else (0, [])


def scatter(fit: DataFrame, centre: list[int]) -> list[list[int]]:
    """Sum of (x - centre)(x - centre)' over the fit list, exact."""
    d = len(centre)

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = matrix(batch.column(0))
            for at in range(0, len(x), CHUNK):
                part = x[at:at + CHUNK]
                big = peak(part) + max(map(abs, centre)) >= 1 << 62
                z = part.astype(object) - np.array(centre, object) if big else part - np.array(centre, np.int64)
                one = products(z.T, z.T).astype(object)
                total = one if total is None else total + one
        if total is not None:
            upper = np.triu_indices(d)
            yield pa.record_batch([pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)),
                                   pa.array([str(v // HALF) for v in total[upper]]),
                                   pa.array([int(v % HALF) for v in total[upper]], pa.int64())],
                                  names=["i", "j", "high", "low"])

    sums = (fit.select("x").mapInArrow(gram, "i int, j int, high string, low long").groupBy("i", "j")
            .agg(F.sum(F.col("high").cast("decimal(38,0)")), F.sum(F.col("low").cast("decimal(38,0)"))).collect())
    out = [[0] * d for _ in range(d)]
    for i, j, high, low in sums:
        out[i][j] = out[j][i] = int(high) * HALF + int(low)
    return out


def covariance(scattered: list[list[int]], centre: list[int], n: int, sums: list[int]) -> np.ndarray:
    """V in extended precision; every entry is the exact quotient, rounded once."""
    off = [s - n * c for s, c in zip(sums, centre)]
    exact = lambda num, den: np.longdouble(num // den) + np.longdouble(float(Fraction(num % den, den)))
    d = len(sums)
    v = np.zeros((d, d), np.longdouble)
    for i in range(d):
        for j in range(i, d):
            v[i, j] = v[j, i] = exact(n * scattered[i][j] - off[i] * off[j], n * n)
    return v


def _clusters(values: np.ndarray, delta) -> list[np.ndarray]:
    """Neighbours in falling order that are within ``delta`` of each other."""
    order = np.argsort(-values, kind="stable")
    breaks = np.flatnonzero(values[order][:-1] - values[order][1:] > delta) + 1
    return np.split(order, breaks)


def refined(v: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One Ogita-Aishima step in the precision of ``v``, with sub-solves."""
    d = len(v)
    r = np.eye(d, dtype=v.dtype) - x.T @ x
    s = x.T @ (v @ x)
    s = (s + s.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(np.diag(s))
    delta = 2 * (np.sqrt((off * off).sum()) + np.abs(values).max() * np.sqrt((r * r).sum()))
    gap = values[None, :] - values[:, None]
    near = np.abs(gap) <= delta
    e = np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, gap))
    x = x + x @ e
    for group in _clusters(values, delta):
        if len(group) > 1:
            part = x[:, group]
            mean = values[group].mean()
            block = part.T @ (v @ part - mean * part)
            turn = np.linalg.eigh(((block + block.T) / 2).astype(np.float64))[1]
            x[:, group] = part @ turn.astype(v.dtype)
    return level(x), values


def level(x: np.ndarray) -> np.ndarray:
    """Orthonormal to the precision of ``x``, without a turn: small gaps magnify
    rounding, and a sub-solve is only as exact as double precision."""
    for _ in range(2):
        x = x + x @ ((np.eye(x.shape[1], dtype=x.dtype) - x.T @ x) / 2)
    return x


def eigenvectors(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, from float32 up."""
    scale = np.abs(v).max()
    if not scale:
        return np.zeros(len(v)), np.eye(len(v))
    v = v / scale
    x = np.linalg.eigh(v.astype(np.float32))[1].astype(np.float64)
    low = v.astype(np.float64)
    for _ in range(DOUBLE_STEPS):
        x, _ = refined(low, x)
    x = x.astype(np.longdouble)
    for _ in range(EXTENDED_STEPS):
        x, _ = refined(v, x)
    values = (x * (v @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return (values[order] * scale).astype(np.float64), x[:, order].astype(np.float64)


class Whitener:
    """What the fit list says: n, S, components with their eigenvalues."""

    def __init__(self, n: int, sums: list[int], v: np.ndarray, components: int):
        self.n, self.sums = n, sums
        values, vectors = eigenvectors(v)
        trace = float(np.trace(v))
        real = [i for i in range(min(components, len(values))) if values[i] > len(values) * 1e-15 * values[0]]
        self.values, self.vectors = values[real], vectors[:, real]
        self.explained = (self.values / trace).tolist() if trace else []
        self.centre = [round(Fraction(s, n)) for s in sums]
        self.rest = np.array([float(Fraction(s - n * c, n)) for s, c in zip(sums, self.centre)])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        most = (self.n * peak(x) + max(map(abs, self.sums))) ** 2 * x.shape[1]
        kind = np.int64 if most < 1 << 63 else object
        off = self.n * x.astype(kind) - np.array(self.sums, kind)
        return [int(v) if int(v) < 1 << 63 else None for v in (off * off).sum(axis=1)]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        big = peak(x) + max(map(abs, self.centre)) >= 1 << 62
        z = x.astype(object) - np.array(self.centre, object) if big else x - np.array(self.centre, np.int64)
        return ((z.astype(np.float64) - self.rest) @ self.vectors) / np.sqrt(self.values)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, Whitener | None]:
    """The written fit list, and its whitener (None without rows)."""
    distinct = stage(vectors.select("x").distinct(), "whiten-fit")
    n, sums = count_and_sums(distinct)
    if not n:
        return distinct, None
    centre = [round(Fraction(s, n)) for s in sums]
    return distinct, Whitener(n, sums, covariance(scatter(distinct, centre), centre, n, sums), components)


def identity_error(distinct: DataFrame, w: Whitener) -> float:
    """The largest entry of the whitened fit list's covariance less the identity."""
    k = len(w.values)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = w.whitened(matrix(batch.column(0)))
                yield pa.record_batch([pa.array(out[:, i]) for i in range(k)], names=[f"w{i}" for i in range(k)])

    white = distinct.select("x").mapInArrow(rows, ", ".join(f"w{i} double" for i in range(k)))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = white.agg(*[F.covar_pop(f"w{i}", f"w{j}") for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs))


def whiten(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """One row for each remaining row and component: the id, component, n,
    deviation, whitened, explained, identity_error."""
    vectors = integer_vectors(df, [id_col], vector)
    schema = T.StructType([df.schema[id_col], *T.StructType.fromDDL(
        "component int, n long, deviation long, whitened double, explained double, identity_error double")])
    distinct, w = fit(vectors, components)
    if w is None or not len(w.values):
        return df.sparkSession.createDataFrame([], schema)
    k, error = len(w.values), identity_error(distinct, w)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            x = matrix(batch.column(1))
            each = np.repeat(np.arange(size), k)
            yield pa.record_batch([
                batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                pa.array(np.full(size * k, w.n)), pa.array(w.deviations(x), pa.int64()).take(pa.array(each)),
                pa.array(w.whitened(x).ravel()), pa.array(np.tile(w.explained, size)),
                pa.array(np.full(size * k, error))], names=schema.names)

    return vectors.mapInArrow(rows, schema)
