"""Embedding whitening: principal components of all vectors by mixed-precision refinement.

Sums and the covariance are distributed: tasks multiply batches of centred whole numbers, whose
products are exact, and only the dim x dim matrix, which does not grow with the rows, reaches the
driver. Its eigenvectors are taken in float32 and corrected by Ogita-Aishima iterations, which
are matrix products in extended precision and double the correct digits each. Eigenvalues that
are too close for a correction form a cluster; its invariant subspace is solved by itself,
shifted to the cluster's mean, so the small differences keep their digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

SCALE, SHIFT = 1024, 100_000
TOP = 8
#: Entries from here on (after scaling) are refused: their products would not be exact.
LARGEST = 1 << 38
#: Rows multiplied at a time, and the size of entries up to which float64 products of them are exact.
CHUNK, EXACT = 4096, 1 << 20
_HALF = 32


@dataclass(frozen=True)
class Whitening:
    """What ``fit`` found. ``weights`` has a column per component, null (NaN) if it has no variance."""

    n: int
    sums: tuple[int, ...]
    values: tuple[float, ...]
    weights: np.ndarray
    explained: tuple[float, ...]
    identity_error: float | None


def _whole(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which rows remain, and their entries as whole numbers, one row each.

    A null vector and one with a null, infinite or NaN entry does not remain."""
    lens = pc.list_value_length(column).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.cast(column.flatten(), pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(lens)), np.maximum(lens, 0))
    fine = np.isfinite(flat)
    stays = lens >= 0
    stays[owner[~fine]] = False
    rows = np.flatnonzero(stays)
    if not len(rows):
        return rows, np.empty((0, 0), np.int64)
    if (lens[rows] != lens[rows[0]]).any():
        raise ValueError("whitening: the vectors have different lengths")
    scaled = np.floor(flat[stays[owner]] * SCALE)
    if len(scaled) and np.abs(scaled).max() >= LARGEST:
        raise ValueError(f"whitening: an entry of {LARGEST // SCALE} or more")
    return rows, (scaled.astype(np.int64) + SHIFT).reshape(len(rows), -1)


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, x = _whole(batch.column(0))
        if len(x):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(x.shape[1], dtype=np.int32)), pa.array(x.sum(0)),
                 pa.array(np.full(x.shape[1], len(x)))], names=["i", "s", "n"])


def _products(centre: np.ndarray):
    """Sums of products of the centred entries, in two halves of 32 bits: a row per (i, list over j)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((len(centre), len(centre)), object)
        small, room = np.zeros(held.shape, np.int64), 1 << 62
        for batch in batches:
            _, x = _whole(batch.column(0))
            for at in range(0, len(x), CHUNK):
                z = x[at:at + CHUNK] - centre
                most = int(np.abs(z).max(initial=0))
                if most < EXACT:
                    if room < len(z) * most * most:
                        held, small, room = held + small, np.zeros_like(small), 1 << 62
                    f = z.astype(np.float64)
                    small += (f.T @ f).astype(np.int64)
                    room -= len(z) * most * most
                else:
                    held = held + z.astype(object).T @ z.astype(object)
        held = held + small
        if held.any():
            low = (held & ((1 << _HALF) - 1)).astype(np.int64)
            high = (held >> _HALF).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(centre), dtype=np.int32)), pa.array(list(high), pa.list_(pa.int64())),
                 pa.array(list(low), pa.list_(pa.int64()))], names=["i", "high", "low"])
    return run


def _second_moments(weights: np.ndarray, centre: np.ndarray, rest: np.ndarray):
    """Sums of the whitened entries and of their products, a row per pair (j = -1: the sums)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = weights.shape[1]
        total = np.zeros((k, k + 1))
        for batch in batches:
            _, x = _whole(batch.column(0))
            if len(x):
                y = (x - centre - rest) @ weights
                total += y.T @ np.column_stack([np.ones(len(y)), y])
        i, j = np.indices(total.shape, np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel() - 1), pa.array(total.ravel())],
                                         names=["i", "j", "s"])
    return run


def _residuals(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, ...]:
    """I - X'X, X'AX, the eigenvalues, and the gap under which two of them cannot be told apart yet."""
    unit = np.eye(len(a), dtype=a.dtype)
    r, s = unit - x.T @ x, x.T @ (a @ x)
    s = (s + s.T) / 2  # or a small gap turns the last digits into a loss of orthogonality
    values = np.diag(s) / (1 - np.diag(r))
    away = s - np.diag(values)
    gap = 2 * (np.sqrt((away * away).sum()) + np.abs(values).max(initial=0) * np.sqrt((r * r).sum()))
    return r, s, values, gap


def refined_eigenvectors(a: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of the symmetric ``a``, in extended precision.

    Vectors of equal eigenvalues are any orthonormal basis of their space; each has its largest
    entry positive."""
    a = np.asarray(a, np.longdouble)
    size = len(a)
    scale = np.abs(a).max(initial=0)
    if not size or not scale:
        return np.zeros(size, np.longdouble), np.eye(size, dtype=np.longdouble)
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    small = size * np.finfo(np.longdouble).eps
    for _ in range(rounds):
        r, s, values, gap = _residuals(a, x)
        between = values[None, :] - values[:, None]
        apart = np.abs(between) > gap
        off = np.where(apart, s + values[None, :] * r, r / 2)
        x = x + x @ (off / np.where(apart, between, 1))
        change = np.abs(off).max()
        r, s, values, gap = _residuals(a, x)
        by = np.argsort(values)
        values, x, s = values[by], x[:, by], s[np.ix_(by, by)]
        cuts = np.flatnonzero(np.diff(values) > gap) + 1
        for j in np.split(np.arange(size), cuts):
            if len(j) > 1:  # a cluster: solved alone, relative to its mean and its own size
                block = s[np.ix_(j, j)] - np.eye(len(j), dtype=a.dtype) * values[j].mean()
                most = np.abs(block).max()
                if most > small:
                    own = np.linalg.eigh((block / most).astype(np.float64))[1].astype(np.longdouble)
                    x[:, j] = x[:, j] @ own
                    change = max(change, np.abs(own - np.diag(np.diag(own))).max() * min(1, most))
        if change < 4 * small:
            break
    for _ in range(2):  # what corrections across small gaps cost in orthogonality
        x = x + x @ _residuals(a, x)[0] / 2
    values = _residuals(a, x)[2]
    by = np.argsort(-values, kind="stable")
    values, x = values[by] * scale, x[:, by]
    return values, x * np.where(x[np.abs(x).argmax(0), np.arange(size)] < 0, -1, 1)


def _covariance(df: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    dim = len(sums)
    centre = np.array([s // n for s in sums], np.int64)
    over = [s - n * int(c) for s, c in zip(sums, centre)]
    rows = (df.mapInArrow(_products(centre), "i int, high array<long>, low array<long>")
            .select("i", F.posexplode(F.arrays_zip("high", "low")).alias("j", "v"))
            .groupBy("i", "j").agg(F.sum("v.high").alias("high"), F.sum("v.low").alias("low")).toArrow())
    out = np.zeros((dim, dim), np.longdouble)
    for i, j, high, low in zip(*(rows.column(k).to_pylist() for k in range(4))):
        out[i, j] = (n * ((high << _HALF) + low) - over[i] * over[j])
    for i in range(dim):  # a dimension that never varies around its centre gives no rows
        for j in range(dim):
            if not out[i, j]:
                out[i, j] = 0
    return out / np.longdouble(n) / np.longdouble(n)


def fit(df: DataFrame, vec_col: str = "embedding", top: int = TOP) -> Whitening | None:
    """The components of all vectors, or None if no vector remains or they have no entries.

    Vectors of different lengths raise. A component whose variance is only rounding (less than
    dim * 2**-52 of the largest, all of them for a single vector) has no weights and does not
    enter ``identity_error``, which is measured on all rows."""
    df = df.select(F.col(f"`{vec_col}`").alias("v"))
    found = (df.mapInArrow(_sum_rows, "i int, s long, n long").groupBy("i")
             .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).orderBy("i").collect())
    if not found:
        return None
    n, sums = found[0].n, [int(r.s) for r in found]
    if any(r.n != n for r in found):
        raise ValueError("whitening: the vectors have different lengths")
    cov = _covariance(df, n, sums)
    values, x = refined_eigenvectors(cov)
    trace = np.trace(cov)
    values, x = values[:top], x[:, :top]
    real = values > len(sums) * 2.0**-52 * values[0] if values[0] > 0 else np.zeros(len(values), bool)
    weights = np.full(x.shape, np.nan)
    weights[:, real] = (x[:, real] / np.sqrt(values[real])).astype(np.float64)
    error = None
    if real.any():
        centre = np.array([s // n for s in sums], np.int64)
        rest = np.array([(s - n * int(c)) / n for s, c in zip(sums, centre)])
        k = int(real.sum())
        own = weights[:, real]
        total = np.zeros((k, k + 1))
        for r in (df.mapInArrow(_second_moments(own, centre, rest), "i int, j int, s double")
                  .groupBy("i", "j").agg(F.sum("s").alias("s")).collect()):
            total[r.i, r.j + 1] = r.s / n
        error = float(np.abs(total[:, 1:] - np.outer(total[:, 0], total[:, 0]) - np.eye(k)).max())
    explained = tuple(float(v / trace) if trace > 0 else 0.0 for v in values)
    return Whitening(n, tuple(sums), tuple(map(float, values)), weights, explained, error)


def _project(model: Whitening):
    n, top = model.n, model.weights.shape[1]
    centre = np.array([s // n for s in model.sums], np.int64)
    over = [s - n * int(c) for s, c in zip(model.sums, centre)]
    rest = np.array([o / n for o in over])
    square = sum(o * o for o in over)
    dead = np.isnan(model.weights[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = _whole(batch.column(1))
            for at in range(0, len(rows), CHUNK):
                z = x[at:at + CHUNK] - centre
                if int(np.abs(z).max(initial=0)) < EXACT:
                    twice = (z * z).sum(1).tolist()
                else:
                    twice = (z.astype(object) ** 2).sum(1).tolist()
                cross = (z.astype(object) @ np.array(over, object)).tolist()
                far = [n * n * a - 2 * n * b + square for a, b in zip(twice, cross)]
                far = [v if v < 1 << 63 else None for v in far]
                y = (z - rest) @ np.nan_to_num(model.weights)
                m = len(z)
                yield pa.RecordBatch.from_arrays(
                    [pc.take(batch.column(0), pa.array(np.repeat(rows[at:at + CHUNK], top))),
                     pa.array(np.tile(np.arange(1, top + 1, dtype=np.int32), m)), pa.array(np.full(m * top, n)),
                     pc.take(pa.array(far, pa.int64()), pa.array(np.repeat(np.arange(m), top))),
                     pa.array(y.ravel(), mask=np.tile(dead, m)),
                     pa.array(np.tile(np.array(model.explained), m)),
                     pa.array([model.identity_error] * (m * top), pa.float64())],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whiten(df: DataFrame, model: Whitening | None, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """A row per remaining vector and component: ``id_col, component, n, deviation, whitened, explained,
    identity_error``.

    Ids may be null or repeated; every row counts and gets its own rows. ``deviation`` is exact,
    null where it does not fit a long; ``whitened`` is null for a component without variance.
    No model (an empty table) gives no rows. Other columns are not read."""
    kind = df.schema[id_col].dataType.simpleString()
    out = (f"id {kind}, component int, n long, deviation long, whitened double, explained double, "
           "identity_error double")
    if model is None:
        return df.sparkSession.createDataFrame([], out).withColumnRenamed("id", id_col)
    return (df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vec_col}`").alias("v"))
            .mapInArrow(_project(model), out).withColumnRenamed("id", id_col))


def q_whitening(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "embeddings")
    return whiten(docs, fit(docs))
