import numpy as np
import pytest

from tidewire.operators import search

SCHEMA = "vec_id long, embedding array<float>"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in rows], SCHEMA)


def brute(rows, queries, k):
    unit = {i: np.float32(v).astype(float) / np.linalg.norm(np.float32(v).astype(float)) for i, v in [*rows, *queries] if v is not None and np.any(v)}
    found = set()
    for q, _ in queries:
        if q in unit:
            scores = sorted((-round(float(unit[q] @ unit[i]), search.PLACES), i) for i, _ in rows if i in unit)
            found |= {(q, i, place + 1) for place, (_, i) in enumerate(scores[:k])}
    return found


def answers(frame):
    return {(r.query_id, r.vec_id, r["rank"]) for r in frame.collect()}


@pytest.fixture
def rows():
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(6, 8)) * 3
    spread = [centres[i % 6] + draw.normal(size=8) for i in range(240)]
    hot = [centres[0]] * 120  # a third of all rows are one vector
    return [(i, list(v)) for i, v in enumerate([*spread, *hot])] + [(900, [0.0] * 8), (901, None), (902, [float("nan")] * 8)]


def test_exact_answers_are_those_of_all_pairs(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(search, "SHARD_ROWS", 16)
    monkeypatch.setattr(search, "BLOCK_ROWS", 4)
    index = search.build_index(table(spark, rows), str(tmp_path / "index"), cells=12)
    queries = [r for r in rows if r[0] % 7 == 0] + [(900, [0.0] * 8), (901, None)]
    clean = [r for r in rows if r[0] != 902]
    for k, probes in ((5, 1), (130, 2)):
        got = search.search_exact(index, table(spark, queries), k, probes, str(tmp_path / f"run{k}"))
        assert answers(got) == brute(clean, queries, k)
    assert index.rows.groupBy("cell", "shard").count().where("count > 120").count() == 0  # the hot vector's rows are spread
    assert index.rows.count() == 360


def test_the_stored_index_and_recall(spark, tmp_path, rows):
    search.build_index(table(spark, rows), str(tmp_path / "index"))
    index, queries = search.read_index(spark, str(tmp_path / "index")), table(spark, [r for r in rows if r[0] % 5 == 0 and r[0] < 240])
    exact = search.search_exact(index, queries, 10, 2, str(tmp_path / "run"))
    probes = search.probes_for(index, exact, queries, 0.9)
    found = search.recall(search.search(index, queries, 10, probes), exact).first()
    assert found.queries == 48 and found.neighbours == 480 and found.recall >= 0.9
    assert search.recall(search.search(index, queries, 10, 10_000), exact).first().recall == 1.0
    assert probes == 1 or search.recall(search.search(index, queries, 10, probes - 1), exact).first().recall < 0.9


def test_empty_sides(spark, tmp_path, rows):
    none = table(spark, [])
    index = search.build_index(table(spark, rows[:20]), str(tmp_path / "some"))
    assert search.search(index, none, 3, 2).count() == 0
    assert search.search_exact(index, none, 3, 2, str(tmp_path / "run")).count() == 0
    empty = search.build_index(none, str(tmp_path / "none"))
    assert search.search(empty, table(spark, rows[:5]), 3, 2).count() == 0
    assert search.search_exact(empty, table(spark, rows[:5]), 3, 2, str(tmp_path / "run2")).count() == 0
    one = search.build_index(table(spark, rows[:1]), str(tmp_path / "one"))
    assert answers(search.search(one, table(spark, rows[:2]), 3, 2)) == {(0, 0, 1), (1, 0, 1)}


def test_cells_of_a_batch_take_bounded_memory(spark):
    """10,000 queries and 2,000 cells: 160 MB for all their scores at once."""
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa

    draw = np.random.default_rng(3)
    centres = draw.normal(size=(2000, 16))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    vecs = draw.normal(size=(10_000, 16))
    index = SimpleNamespace(centres=lambda: (np.arange(2000, dtype=np.int32), centres, np.full(2000, 0.1)))
    batch = pa.array(list(vecs), pa.list_(pa.float64()))
    tracemalloc.start()
    near = search._nearest_cells(index, 4).func(batch)
    wide = search._cells_within(index).func(batch, pa.array(np.full(10_000, 0.7)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6
    unit = vecs / np.linalg.norm(vecs, axis=1, keepdims=True)
    for i in (0, 499, 500, 9999):
        scores = unit[i] @ centres.T
        assert near[i].as_py() == np.argsort(-scores, kind="stable")[:4].tolist()
        assert wide[i].as_py() == np.flatnonzero(np.arccos(scores) <= np.arccos(0.7) + 0.1 + 1e-6).tolist()


def test_assigning_cells_runs_one_python_step(spark, tmp_path, rows):
    """A filter on the cluster does not have the nearest centre worked out a second time, by a second Python worker a task."""
    from tidewire.operators.vectors import nearest_centroid

    centres = spark.createDataFrame([(0, [1.0] * 8), (1, [-1.0] * 8)], "label int, centroid array<double>")
    placed = nearest_centroid(table(spark, rows[:20]), centres).where("cluster IS NOT NULL")
    assert placed._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
