import math

import numpy as np
import pytest

from tests.conftest import SMALL
from tests.llm.helpers import frame, with_clashes
from tidewire.llm import registry, whitening

KINDS = "vec_id long, embedding array<float>"
CLASH = ("key", "x", "n", "deviation", "at", "whitened", "line", "cells", "label")


def brute(rows):
    """The contract with numpy's solver: ({(key, component): row}, values, trace, identity error of a perfect answer is 0)."""
    kept = [(k, [math.floor(64 * float(np.float32(c))) + 1000000 for c in v]) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}))
    n, sums = len(fit), fit.sum(axis=0)
    y = (n * fit - sums) / n
    v = y.T @ y / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = int((values[:16] > 1e-9 * values[0]).sum())
    return kept, n, sums, v, values[:count], vectors[:, :count]


def compare(result, rows):
    kept, n, sums, v, values, vectors = brute(rows)
    found = result.collect()
    assert len(found) == len(kept) * len(values)
    by = {}
    for r in found:
        by.setdefault(r.component, []).append(r)
    assert sorted(by) == list(range(1, len(values) + 1))
    spots = {k: x for k, x in kept}
    signs = {}
    for c, own in by.items():
        assert sorted(map(str, (r.vec_id for r in own))) == sorted(str(k) for k, _ in kept)
        for r in own:
            x = np.array(spots[r.vec_id])
            assert r.n == n and r.deviation == sum(int(d) ** 2 for d in n * x - sums)
            expected = ((n * x - sums) / n) @ vectors[:, c - 1] / math.sqrt(values[c - 1])
            if abs(expected) > 1e-3:
                signs.setdefault(c, np.sign(expected * r.whitened))
            assert r.whitened * signs.get(c, 1) == pytest.approx(expected, abs=1e-7)
            assert r.explained == pytest.approx(values[c - 1] / np.trace(v), rel=1e-9) and r.identity_error < 1e-8


def test_query_equals_a_dense_solver(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    compare(registry.QUERIES["op11_whitening"](spark, SMALL), rows)


def test_bad_vectors_go_and_repeats_count_once(spark):
    draw = np.random.default_rng(1)
    rows = [(i, [float(x) for x in draw.normal(0, 3, 5).astype(np.float32)]) for i in range(60)]
    rows += [(60, None), (61, [1.0, None, 1.0, 1.0, 1.0]), (62, [float("nan")] * 5), (63, [float("inf")] * 5), (64, rows[3][1]), (None, rows[4][1])]
    compare(whitening.whiten(with_clashes(frame(spark, rows, KINDS), *CLASH)), rows)
    # Those of another length, and empty ones, go too.
    other = rows + [(70, [1.0, 2.0]), (71, [])]
    compare(whitening.whiten(frame(spark, other, KINDS)), rows)


def test_fewer_directions_than_components(spark):
    draw = np.random.default_rng(2)
    flat = draw.integers(-9, 10, (40, 3)) @ draw.integers(-9, 10, (3, 20)) / 64
    rows = [(i, [float(x) for x in v.astype(np.float32)]) for i, v in enumerate(flat)]
    compare(whitening.whiten(frame(spark, rows, KINDS)), rows)
    line = [(i, [float(i), 5.0, float(-i)]) for i in range(9)]
    assert {r.component for r in whitening.whiten(frame(spark, line, KINDS)).collect()} == {1}


def test_no_rows_without_variance_or_vectors(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        result = whitening.whiten(frame(spark, rows, KINDS))
        assert result.collect() == [] and result.columns[0] == "vec_id" and len(result.columns) == 7


def test_deviation_beyond_long_is_null(spark):
    rows = [(i, [float(i % 7) * 1e9, float(i) * 1e8]) for i in range(20)]
    found = whitening.whiten(frame(spark, rows, "vec_id long, embedding array<double>")).collect()
    assert len(found) == 40 and all(r.deviation is None or r.deviation >= 0 for r in found) and any(r.deviation is None for r in found)


@pytest.mark.parametrize("values", [
    [5, 4, 3, 2, 1], [3] * 6 + [2] * 6 + [1] * 6, [1e8] + [1 + 1e-6 * i for i in range(19)], list(np.geomspace(1, 1e-6, 24)), [7], [2, 0, 0, 0]])
def test_contours_find_every_eigenvalue(values):
    draw = np.random.default_rng(3)
    q = np.linalg.qr(draw.normal(size=(len(values),) * 2))[0]
    v = q @ np.diag(np.array(values, float)) @ q.T
    v = (v + v.T) / 2
    wanted = min(16, sum(x > 0 for x in values))
    parts = whitening.intervals(v, wanted)
    solved = [whitening.solve_interval(v, *part) for part in parts]
    found = np.sort(np.concatenate([s[0] for s in solved]))[::-1][:wanted]
    assert found == pytest.approx(sorted(values, reverse=True)[:wanted], rel=1e-9, abs=1e-12 * max(values))
    basis = np.hstack([s[1] for s in solved])
    assert np.abs(basis.T @ basis - np.eye(basis.shape[1])).max() < 1e-6


def test_inertia_counts_match_a_dense_solver():
    draw = np.random.default_rng(4)
    for size in (1, 2, 7, 30):
        a = draw.normal(size=(size, size))
        a = a + a.T
        np.fill_diagonal(a, 0)  # forces pivots of two lines
        for shift in (0.0, -1.0, 0.5):
            assert whitening.above(a, shift) == (np.linalg.eigvalsh(a) > shift).sum()


def test_a_wrong_count_is_noticed():
    with pytest.raises(ArithmeticError):
        whitening.solve_interval(np.diag([1.0, 2.0, 3.0]), 1.5, 2.5, 2)
