import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewire.operators import graph, linking, vectors


def frames(spark):
    papers = spark.createDataFrame(
        [
            (1, "http://x/abs/2401.1v1", "see https://github.com/Own/Repo.git."),
            (2, "http://x/abs/2401.2v3", "no link"),
            (3, "http://x/abs/2401.3v1", "first rank has no address"),
            (4, "http://x/abs/2401.4v1", "https://github.com/topics/a"),
            (5, "", "nothing"),
            (6, "http://x/abs/2401.2v1", ""),
        ],
        "doc_id int, paper_url string, search_text string",
    )
    links = spark.createDataFrame(
        [
            ("2401.2", 1, "https://github.com/own/two"), ("2401.2", 2, "https://github.com/own/other"),
            ("2401.3", 1, None), ("2401.3", 2, "https://github.com/own/three"),
            ("2401.4", 2, "https://github.com/own/late"), ("2401.4", 1, "https://github.com/own/four"), ("", 1, "https://github.com/a/b"),
        ],
        "arxiv_id string, rank int, repository_url string",
    )
    repos = spark.createDataFrame(
        [("own", "repo", 7), ("OWN", "Repo", 5), ("own", "two", 3)], "owner string, repo string, stars int"
    )
    return papers, links, repos


def test_link_repos(spark):
    got = linking.link_repos(*frames(spark))
    assert {r.doc_id: (r.github_url, r.github_stars) for r in got.collect()} == {
        1: ("https://github.com/Own/Repo", 7),
        2: ("https://github.com/own/two", 3),
        3: (None, 0),
        4: ("https://github.com/own/four", 0),
        5: (None, 0),
        6: ("https://github.com/own/two", 3),
    }


def test_search_repos(spark):
    repos = spark.createDataFrame([("a", "BERT-x", 3), ("b", "my-bert", 9), ("c", "bert", 9), ("d", "gpt", 99)], "owner string, repo string, stars int")
    assert [r.full_name for r in linking.search_repos(repos, "Bert", 2).collect()] == ["b/my-bert", "c/bert"]


def test_graph_edges_need_known_organizations(spark):
    orgs = spark.createDataFrame([("OpenAI",), ("Own",)], "org string")
    products = spark.createDataFrame([("u1", "openai"), ("u2", "Nobody")], "product_url string, org string")
    papers = spark.createDataFrame([("p1", "T", "https://github.com/OWN/r"), ("p2", "T", None)], "paper_url string, title string, github_url string")
    jobs = spark.createDataFrame([("own", "d", "Engineering")] * 2, "org string, date string, role_family string")
    news = spark.createDataFrame([("n1", "t"), ("n1", "s")], "url string, title string")
    nodes = graph.kg_nodes(orgs, products, papers, jobs, news).collect()
    assert len({(n.label, n.node_id) for n in nodes}) == len(nodes) == 2 + 2 + 2 + 1 + 1 + 1
    edges = graph.kg_edges(orgs, products, papers, jobs).collect()
    assert sorted(e.type for e in edges) == ["BUILT", "HAS_REPO", "OPENED", "PUBLISHED"]
    known = {n.node_id for n in nodes}
    assert all(e.src_id in known and e.dst_id in known for e in edges)


@pytest.fixture(scope="module")
def vecs(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 16))
    turned = base[:60] + rng.normal(scale=0.01, size=(60, 16))
    exact = base[:40]
    hot = np.repeat(base[:1], 200, axis=0)  # a third of the rows copy one vector
    rows = np.concatenate([base, turned, exact, hot])
    return spark.createDataFrame([(i, [float(x) for x in v], i % 5) for i, v in enumerate(rows)], "vec_id long, embedding array<float>, label int"), rows


def unit(m):
    return m / np.linalg.norm(m, axis=1, keepdims=True)


@pytest.mark.parametrize("block", [4096, 3])
def test_topk_equals_brute_force(spark, vecs, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
    frame, rows = vecs
    got = vectors.vector_topk(frame.where("vec_id >= 10").repartition(7), frame.where("vec_id < 10"), 6).collect()
    rows = unit(rows.astype(np.float32).astype(np.float64))
    for q in range(10):
        scores = rows[10:] @ rows[q]
        expected = sorted(((-round(s, 9), i + 10) for i, s in enumerate(scores)))[:6]
        mine = sorted((r.rank, -round(r.score, 9), r.vec_id) for r in got if r.query_id == q)
        assert [m[1] for m in mine] == pytest.approx([e[0] for e in expected])
        assert len(mine) == 6


def test_centroids(spark, vecs, monkeypatch):
    frame, rows = vecs
    rows = rows.astype(np.float32).astype(np.float64)
    centroids = {r.label: r.centroid for r in vectors.label_centroids(frame.repartition(5)).collect()}
    labels = np.arange(len(rows)) % 5
    for label in range(5):
        assert centroids[label] == pytest.approx(rows[labels == label].mean(axis=0))
    for block in (4096, 2):
        monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
        got = vectors.nearest_centroid(frame, vectors.label_centroids(frame)).collect()
        scores = unit(rows) @ unit(np.array([centroids[i] for i in range(5)])).T
        assert {r.vec_id: r.cluster for r in got} == dict(enumerate(scores.argmax(axis=1)))


def test_semantic_dedup_finds_all_copies_whatever_else_is_there(spark, vecs):
    frame, rows = vecs
    noise = np.random.default_rng(9).normal(size=(400, 16))
    more = spark.createDataFrame([(-1 - i, [float(x) for x in v]) for i, v in enumerate(noise)], "vec_id long, embedding array<float>")
    scores = unit(rows) @ unit(rows).T
    for given in (frame.select("vec_id", "embedding"), frame.select("vec_id", "embedding").unionByName(more)):
        got = {r.vec_id: r.copy_of for r in vectors.semantic_dedup(given, 16, 0.99).collect()}
        for i in range(len(rows)):
            earlier = np.flatnonzero(scores[i, :i] >= 0.99)
            assert got[i] == (earlier[0] if len(earlier) else None)


@pytest.mark.parametrize("spread", [0.0005, 0.06])
def test_semantic_dedup_of_a_large_group(spark, spread):
    """2,000 near-equal vectors, and a ball whose members are near to some of the others only: right answers, pairs by the members."""
    draw = np.random.default_rng(5)
    count = 2000 if spread < 0.01 else 300
    rows = (draw.normal(size=16) + draw.normal(size=(count, 16)) * spread).astype(np.float32)
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "vec_id long, embedding array<float>").repartition(8)
    scores = unit(rows.astype(np.float64)) @ unit(rows.astype(np.float64)).T
    threshold = 0.995
    got = {r.vec_id: r.copy_of for r in vectors.semantic_dedup(frame, 16, threshold).collect()}
    expected = {i: next((j for j in range(i) if scores[i, j] >= threshold), None) for i in range(count)}
    assert got == expected
    distinct = frame.withColumnRenamed("vec_id", "_first")
    cells = vectors._cells(distinct, "embedding", 16, 140, 24)
    found = vectors._nearest_earlier(vectors.lead_pairs(cells), distinct, "embedding", threshold)
    compared = vectors.lead_pairs(cells).count() + vectors.open_pairs(cells, found).count()
    assert compared < (3 * count if spread < 0.01 else count * count / 4)
