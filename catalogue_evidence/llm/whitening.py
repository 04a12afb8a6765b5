"""Whitening of embeddings by the leading components of their covariance, which contour integration finds.

Spark adds up sums and centred products over all different vectors; the covariance of a few columns is one matrix, whose
leading eigenvalues are enclosed by inertia counts and whose eigenvectors come out of shifted solves around them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue_evidence.llm.common import staged

NODES = 16  # of the quadrature on the upper half of a contour
SWEEPS = 12  # of filter and Rayleigh-Ritz, at most
WIDER = 8  # times that a contour is widened
ROWS = 4096  # vectors multiplied at a time


def inertia(a: np.ndarray) -> int:
    """How many eigenvalues of a symmetric matrix are positive: those of the blocks of its factorisation with whole
    pivoting, one or two rows a block, since congruence leaves signs alone."""
    a = a.copy()
    n = positive = 0
    while n < len(a):
        rest = a[n:, n:]
        p = int(np.abs(np.diag(rest)).argmax())
        r, c = np.unravel_index(np.abs(rest).argmax(), rest.shape)
        if rest[r, c] == 0:
            break
        two = abs(rest[p, p]) < (1 + math.sqrt(17)) / 8 * abs(rest[r, c])
        for to, was in enumerate((min(r, c), max(r, c)) if two else (p,)):
            rest[[to, was]] = rest[[was, to]]
            rest[:, [to, was]] = rest[:, [was, to]]
        k = 2 if two else 1
        block, below = rest[:k, :k].copy(), rest[k:, :k].copy()
        # A block of two is one of opposite signs, as its diagonal is the lesser part.
        positive += 1 if two else int(block[0, 0] > 0)
        rest[k:, k:] -= below @ np.linalg.solve(block, below.T)
        n += k
    return positive


def above(v: np.ndarray, x: float) -> int:
    return inertia(v - x * np.eye(len(v)))


def filtered(v: np.ndarray, y: np.ndarray, lo: float, hi: float) -> np.ndarray:
    """y projected towards the eigenvectors with values in [lo, hi]: the contour integral of (z - v)^-1 y around them, by
    Gauss-Legendre nodes on the upper half of the circle; the lower half gives the complex conjugate."""
    middle, radius = (lo + hi) / 2, (hi - lo) / 2
    out = np.zeros_like(y)
    for t, w in zip(*np.polynomial.legendre.leggauss(NODES)):
        turn = np.exp(1j * math.pi * (1 + t) / 2)
        solved = np.linalg.solve((middle + radius * turn) * np.eye(len(v)) - v, y.astype(complex))
        out += (w / 2 * radius * turn * solved).real
    return out


def eigenpairs(v: np.ndarray, lo: float, hi: float, count: int) -> np.ndarray | None:
    """Vectors of the `count` eigenvalues of v in (lo, hi], None if others than so many turn up: filter, then Rayleigh-Ritz in what it leaves, until
    residuals are rounding errors. A subspace somewhat larger than the count converges whatever lies next to lo."""
    size = min(len(v), count + max(4, count))
    basis = np.linalg.qr(np.random.default_rng(17).standard_normal((len(v), size)))[0]
    scale = np.abs(v).sum(axis=1).max()
    for _ in range(SWEEPS):
        basis = np.linalg.qr(filtered(v, basis, lo, hi))[0]
        values, turned = np.linalg.eigh(basis.T @ v @ basis)
        basis = basis @ turned
        inside = np.flatnonzero((values > lo) & (values <= hi))
        residual = np.linalg.norm(v @ basis[:, inside] - basis[:, inside] * values[inside], axis=0)
        if len(inside) == count and (residual <= 64 * np.finfo(float).eps * scale).all():
            break
    return basis[:, inside] if len(inside) == count else None


def leading(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to `most` largest eigenvalues of a covariance, falling, and their vectors as columns; those that are zero but
    for rounding are left out. Inertia counts bisect down to a bound that has enough of them above itself, and prove for
    each of the intervals in between that none was missed."""
    top = float(np.abs(v).sum(axis=1).max()) if len(v) else 0.0  # no eigenvalue is larger
    zero = top * len(v) * 4 * np.finfo(float).eps
    fine = top * 1e-9  # values closer than that are taken together
    if not top > 0:
        return np.zeros(0), np.zeros((len(v), 0))
    want = min(most, above(v, zero))
    hi, vectors, found = top * (1 + 1e-9), [], 0
    while found < want:
        # The highest interval below hi that holds an eigenvalue, halved from below until it holds few.
        lo, far = zero, hi
        n = above(v, lo) - found
        while n > max(2, want - found) and far - lo > fine:
            middle = (lo + far) / 2
            m = above(v, middle) - found
            if m:
                lo, n = middle, m
            else:
                far = middle
        # A tight contour with some room: its ends stay where the counts are those of lo and hi.
        highest, lowest = _edge(v, lo, hi, found, fine), _edge(v, lo, hi, found + n - 1, fine)
        room = max((highest[1] - lowest[0]) / 8, fine)
        upper, lower = min(hi, highest[1] + room), max(lo, lowest[0] - room)
        for _ in range(WIDER):
            n = above(v, lower) - found
            some = eigenpairs(v, lower, upper, n)
            if some is not None:
                break
            lower -= (upper - lower) / 2  # values that lie on the contour but for rounding: let it hold them
        else:
            raise ArithmeticError(f"no {n} eigenvalues in ({lower}, {upper}]")
        vectors.append(some)
        found, hi = found + n, lower
    # Vectors of values that nearly tie come out of contours of their own: once more Rayleigh-Ritz, in all of them.
    basis = np.linalg.qr(np.concatenate(vectors, axis=1))[0]
    values, turned = np.linalg.eigh(basis.T @ v @ basis)
    return values[::-1][:want], (basis @ turned)[:, ::-1][:, :want]


def _edge(v: np.ndarray, lo: float, hi: float, n: int, fine: float) -> tuple[float, float]:
    """A narrow interval within (lo, hi) with more than n eigenvalues above its lower end and n or fewer above its upper."""
    for _ in range(12):
        if hi - lo <= fine:
            break
        middle = (lo + hi) / 2
        if above(v, middle) > n:
            lo = middle
        else:
            hi = middle
    return lo, hi


def _whole(column: pa.Array, width: int) -> np.ndarray:
    """floor(256 c) of the lists in a column, as doubles; what is beyond 64 bits lies at their ends."""
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, width)
    return np.clip(np.floor(256.0 * flat), -(2.0**63), 2.0**63) + 0.0


def _longs(x: np.ndarray) -> np.ndarray:
    big = x >= 2.0**63
    return np.where(big, np.int64(2**63 - 1), np.where(big, 0, x).astype(np.int64))


def whole_vectors(rows: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """((vec_id, x), width): the scaled vectors of rows that take part, and their length."""
    values = F.col(vector).cast("array<double>")
    sound = F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(values, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    kept = rows.select(F.col(key).cast("long").alias("vec_id"), values.alias("c")).filter(F.coalesce(sound, F.lit(False)))
    widths = kept.groupBy(F.size("c").alias("width")).count().orderBy(F.desc("count"), "width").head(1)
    width = widths[0]["width"] if widths else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _longs(_whole(batch.column(1), width))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), width).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["vec_id", "x"])

    return kept.filter(F.size("c") == width).mapInArrow(run, "vec_id long, x array<long>"), width


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    """n and the exact sums of each place of the vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            x = _matrix(batch.column(0))
            part = [int(h) * 2**32 + int(m) for h, m in zip((x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0))]
            n, total = n + len(x), part if total is None else [a + b for a, b in zip(total, part)]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(-1, len(total)), pa.int32()), pa.array([str(n), *map(str, total)])], names=["place", "total"]
            )

    parts = fit.mapInArrow(run, "place int, total string").groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    got = {r["place"]: int(r["total"]) for r in parts.collect()}  # a row for each place
    return got.pop(-1, 0), [got[k] for k in sorted(got)]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _products(fit: DataFrame, mean: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Sum over fit of t t' with t = (x - mean) turn: one matrix a task, added up by rows of it."""
    width = turn.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for i in range(0, len(batch), ROWS):
                t = (_matrix(batch.column(0).slice(i, ROWS)) - mean) @ turn
                total += t.T @ t
        r, c = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(r, pa.int32()), pa.array(c, pa.int32()), pa.array(total[r, c])], names=["r", "c", "total"])

    added = fit.mapInArrow(run, "r int, c int, total double").groupBy("r", "c").agg(F.sum("total").alias("total"))
    out = np.zeros((width, width))
    for row in added.collect():  # width * (width + 1) / 2 rows
        out[row["r"], row["c"]] = out[row["c"], row["r"]] = row["total"]
    return out


def whiten(rows: DataFrame, components: int = 4, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row for each row that takes part and each
    of the leading components of the covariance.

    Rows whose vector is null or empty or has null or non-finite entries take no part, nor do those of another length
    than most (of equally many, the least length). An entry c becomes x = floor(256 c); beyond 64 bits it is the
    nearest 64-bit number. The covariance is over the different vectors x, each once. deviation is null where it
    exceeds 64 bits. A component of no variance has no whitened values and no rows, so equal vectors alone give none.
    Repeated rows and null keys stay as they come. Only key and vector are read. No rows give no rows.
    """
    spark = rows.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    made, width = whole_vectors(rows, key, vector)
    if not width:
        return spark.createDataFrame([], schema)
    x = staged(made, "whole-vectors")
    fit = staged(x.select("x").distinct(), "different-vectors")
    n, sums = _sums(fit)
    mean = np.array([s / n for s in sums])
    cov = _products(fit, mean, np.eye(width)) / n
    values, vectors = leading(cov, components)
    scaled = vectors / np.sqrt(values)
    off = _products(fit, mean, scaled) / n - np.eye(len(values)) if len(values) else np.zeros((1, 1))
    error, share = float(np.abs(off).max()), (values / np.trace(cov)).tolist() if len(values) else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(share)
        for batch in batches:
            for i in range(0, len(batch), ROWS):
                some = batch.slice(i, ROWS)
                whole = _matrix(some.column(1))
                white = (whole - mean) @ scaled
                yield pa.RecordBatch.from_arrays(
                    [
                        pc.take(some.column(0), pa.array(np.repeat(np.arange(len(some)), k))),
                        pa.array(np.tile(np.arange(1, k + 1), len(some)), pa.int32()),
                        pa.array(np.full(len(some) * k, n, np.int64)),
                        pc.take(pa.array(deviations(whole, n, sums), pa.int64()), pa.array(np.repeat(np.arange(len(some)), k))),
                        pa.array(white.ravel()),
                        pa.array(np.tile(share, len(some))),
                        pa.array(np.full(len(some) * k, error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return x.mapInArrow(run, schema) if len(values) else spark.createDataFrame([], schema)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over places of (n x - sum)^2 for each vector, exactly; None beyond 64 bits."""
    reach = n * int(np.abs(x.astype(float)).max(initial=0)) + max(map(abs, sums))
    if reach < 2**31 and x.shape[1] * reach**2 < 2**63:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    own = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist()]
    return [d if d < 2**63 else None for d in own]
