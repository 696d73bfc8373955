"""Whitening of embeddings; the components come from FEAST contour integration of their covariance.

Entries become whole numbers (see whole_numbers), so that sums are exact. Two passes over the distinct vectors make the sums
and then the covariance, from vectors centred before they are multiplied; each task adds up its own matrix, and its lines are
added by line. The matrix is of the vectors' dimension whatever the number of rows, and is all that the driver sees.

The spectrum is cut into intervals of few eigenvalues by inertia: the signs of a symmetric factorisation of V - s tell how many
eigenvalues lie above s. Each interval is a row of a Spark job of its own (solve_interval): a random block is filtered through the
quadrature of (z - V)^-1 around the interval, Rayleigh-Ritz on what is left gives values and vectors, and both steps repeat
until the residuals are rounding errors. The inertia count of the interval says how many there must be; if fewer are found the
block is widened, and a count that is never met is an error, so no component is missed unnoticed.

Vectors that are null, empty or hold a null or non-finite entry are dropped, and those of another length than most have (of equal
shares the longest). Rows with a null key or a repeated key remain. Components without variance can't be scaled and are left
out, so equal vectors alone give no rows, and neither does an empty table. Entries beyond the range of long / 64 are cut to it.
deviation is null where it passes the range of long. Only the key and vector columns are read, so other names can't clash.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from tidewire.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

COMPONENTS = 16
#: Whole numbers: floor(SCALE * entry) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Eigenvalues of an interval, unless they lie closer than TIED times the largest; points of the half circle.
MOST, TIED, NODES = 4, 1e-9, 8
#: Eigenvalues below this share of the largest count as zero.
ZERO = 1e-12
ROUNDS = 60


# Covariance ------------------------------------------------------------------------------------------------------------


def whole_numbers(vector: str) -> Column:
    """The vector's entries as whole numbers."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + OFFSET)


def usable(vector: str) -> Column:
    """Whether the vector has entries and all of them are finite."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    """One line per row of a column of lists of equal length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """(x - sums / n, and n * x - sums as whole numbers, or None where long is too small for them)."""
    if n * max(int(np.abs(x.astype(float)).max(initial=1)), 1) < 1 << 62:
        whole = n * x - sums
        return whole / n, whole
    return x - sums / n, None


def _parts(lines: np.ndarray) -> pa.RecordBatch:
    """A matrix as rows of (line, values)."""
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(lines), dtype=np.int32)), pa.array([np.ascontiguousarray(x).tobytes() for x in lines])], ["line", "cells"])


def _adder(kind: type) -> Callable:
    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for line, cells in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums[line] = sums.get(line, 0) + np.frombuffer(cells.as_buffer(), kind)
        rows = [{"line": k, "cells": v.tobytes()} for k, v in sums.items()]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("line", pa.int32()), ("cells", pa.binary())]))

    return add


def _added(rows: DataFrame, part: Callable, kind: type, lines: int) -> np.ndarray:
    """The sum of the matrices that part makes of each task's rows; its lines are added apart from each other."""
    cells = "line int, cells binary"
    found = rows.mapInArrow(part, cells).repartition("line").mapInArrow(_adder(kind), cells).toArrow()
    by_line = dict(zip(found.column("line").to_pylist(), found.column("cells").to_pylist()))
    return np.array([np.frombuffer(by_line[i], kind) for i in range(lines)]) if by_line else np.zeros((lines, 0), kind)


def _sum_part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One line: the number of rows, then the sums of the entries."""
    total = None
    for batch in batches:
        if batch.num_rows:
            found = np.concatenate(([batch.num_rows], _matrix(batch.column(0)).sum(axis=0)))
            total = found if total is None else total + found
    if total is not None:
        yield _parts(total[None])


def _product_part(projected: Callable) -> Callable:
    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                y = projected(_matrix(batch.column(0)))
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield _parts(total)

    return part


def covariance(fit: DataFrame, n: int, sums: np.ndarray, onto: np.ndarray | None = None) -> np.ndarray:
    """Covariance of the vectors (column x), or of what they are when projected onto the columns of a matrix."""
    def projected(x: np.ndarray) -> np.ndarray:
        y = centred(x, n, sums)[0]
        return y if onto is None else y @ onto

    found = _added(fit, _product_part(projected), float, len(sums) if onto is None else onto.shape[1]) / n
    return (found + found.T) / 2


# Eigenvalues -----------------------------------------------------------------------------------------------------------


def above(v: np.ndarray, shift: float) -> int:
    """Eigenvalues of the symmetric matrix above the shift: positive signs of its factorisation L D L' with pivots of one or two
    lines, the larger pivot in each step."""
    a, positive = v - shift * np.eye(len(v)), 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        p = int(diagonal.argmax())
        beside = np.abs(a - np.diag(np.diag(a)))
        r, c = np.unravel_index(beside.argmax(), beside.shape)
        if diagonal[p] >= 0.64 * beside[r, c]:
            if diagonal[p] == 0:
                return positive
            positive += a[p, p] > 0
            rest = np.delete(np.arange(len(a)), p)
            a = a[np.ix_(rest, rest)] - np.outer(a[rest, p], a[p, rest]) / a[p, p]
        else:
            two = [r, c]  # its determinant is negative: one eigenvalue of either sign
            positive += 1
            rest = np.delete(np.arange(len(a)), two)
            a = a[np.ix_(rest, rest)] - a[np.ix_(rest, two)] @ np.linalg.solve(a[np.ix_(two, two)], a[np.ix_(two, rest)])
    return int(positive)


def intervals(v: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """(from, to, eigenvalues) of disjoint intervals that hold at least the wanted largest eigenvalues above zero, the highest first."""
    top = float(np.abs(v).sum(axis=1).max(initial=0)) * (1 + 1e-9)
    if not top:
        return []
    found, held = [], 0
    low = ZERO * top
    waiting = [(low, top, above(v, low))]
    while waiting and held < wanted:
        start, stop, count = waiting.pop()
        if count <= MOST or stop - start <= TIED * top:
            if count:
                found.append((start, stop, count))
                held += count
            continue
        over = above(v, stop)
        for share in (0.5, 0.45, 0.55, 0.4, 0.6):  # not where an eigenvalue lies
            cut = start + share * (stop - start)
            edge = 1e-4 * (stop - start)
            upper = above(v, cut + edge) - over
            if upper == above(v, cut - edge) - over:
                break
        upper = above(v, cut) - over
        waiting += [(start, cut, count - upper), (cut, stop, upper)]
    return found


def solve_interval(v: np.ndarray, start: float, stop: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors) of the eigenvalues between start and stop, of which there are count by inertia."""
    d, scale = len(v), float(np.abs(v).sum(axis=1).max())
    points, weights = np.polynomial.legendre.leggauss(NODES)
    middle, radius = (start + stop) / 2, (stop - start) / 2
    turns = np.exp(-0.5j * np.pi * (points - 1))
    shifts = [(radius * w / 2 * e, (middle + radius * e) * np.eye(d) - v) for e, w in zip(turns, weights)]
    draw, best = np.random.default_rng(11), np.inf
    for width in (count + 4, 2 * count + 8, 4 * count + 16, d):
        block = draw.standard_normal((d, min(d, width)))
        last = np.inf
        for _ in range(ROUNDS):
            filtered = sum((factor * np.linalg.solve(shifted, block)).real for factor, shifted in shifts)
            basis = np.linalg.qr(filtered)[0]
            ritz, turned = np.linalg.eigh(basis.T @ v @ basis)
            block = basis @ turned
            # Rounding may move a value at the very edge, so those nearest to the interval count.
            beyond = np.maximum(np.maximum(start - ritz, ritz - stop), 0)
            own = np.sort(np.lexsort((np.abs(ritz - middle), beyond))[:count])
            residual = np.abs(v @ block[:, own] - block[:, own] * ritz[own]).max(initial=0) / scale
            settled = len(own) == count and beyond[own].max(initial=0) <= 1e-11 * scale
            if settled and residual <= 1e-14 or residual >= last and residual <= 1e-12:
                break
            last = residual
        best = min(best, residual)
        if settled and residual <= 1e-12 and (beyond <= 0).sum() <= count + 1:
            return ritz[own], block[:, own]
    raise ArithmeticError(f"between {start} and {stop} inertia counts {count} eigenvalues, which the contour does not give (residual {best:.1e})")


def components(spark, v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors as columns) of the largest eigenvalues above zero, falling. Each interval is solved in a task of its own."""
    parts = intervals(v, wanted)
    if not parts:
        return np.empty(0), np.empty((len(v), 0))

    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values, vectors = solve_interval(v, row["start"], row["stop"], row["count"])
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array([x.tobytes() for x in vectors.T])], ["value", "vector"])

    rows = spark.createDataFrame(parts, "start double, stop double, count int").repartition(len(parts), "start")
    found = rows.mapInArrow(solve, "value double, vector binary").toArrow().to_pylist()
    basis = np.linalg.qr(np.array([np.frombuffer(r["vector"]) for r in found]).T)[0]
    values, turned = np.linalg.eigh(basis.T @ v @ basis)  # neighbours from different intervals are made orthogonal, too
    vectors = (basis @ turned)[:, ::-1][:, :wanted]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values[::-1][:wanted], vectors * signs


# Rows ------------------------------------------------------------------------------------------------------------------


def _whitener(n: int, sums: np.ndarray, onto: np.ndarray) -> Callable:
    def whiten(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            y, whole = centred(_matrix(batch.column("x")), n, sums)
            near = (y * n).astype(float)
            fits = (near * near).sum(axis=1) < 2.0**62
            deviation = [None] * len(y) if whole is None else [int((w * w).sum()) if ok else _exact(w) for w, ok in zip(whole, fits)]
            values = (y @ onto).ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(values) + 1, onto.shape[1], dtype=np.int32)), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(deviation, pa.int64()), lists], ["key", "deviation", "whitened"])

    return whiten


def _exact(whole: np.ndarray) -> int | None:
    total = sum(int(w) ** 2 for w in whole)
    return total if total < 1 << 63 else None


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """One row per remaining row and component: the key, component, n, deviation, whitened, explained, identity_error."""
    spark, kind = rows.sparkSession, dict(rows.dtypes)[key]
    clean = rows.where(usable(vector)).select(F.col(key).alias("key"), whole_numbers(vector).alias("x"))
    most = clean.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    empty = spark.createDataFrame([], f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    if most is None:
        return empty
    clean = clean.where(F.size("x") == most["d"])
    fit = stored(clean.select("x").distinct(), "whitening-fit")
    line = _added(fit, _sum_part, np.int64, 1)[0]
    n, sums = int(line[0]), line[1:]
    v = covariance(fit, n, sums)
    values, vectors = components(spark, v, min(wanted, len(sums)))
    if not len(values):
        return empty
    onto = vectors / np.sqrt(values)
    error = float(np.abs(covariance(fit, n, sums, onto) - np.eye(len(values))).max())
    explained = F.array(*(F.lit(float(x)) for x in values / np.trace(v)))
    found = clean.mapInArrow(_whitener(n, sums, onto), f"key {kind}, deviation long, whitened array<double>")
    return found.select("key", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        F.col("key").alias(key), (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
