import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.helpers import DOCS, with_clashes
from tidewire.llm import language, mixing, near_dedup
from tests.llm.test_models import brute_classes


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """Documents with planted copies, and the result of every stage."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(80).collect()
    draw, rows = random.Random(8), [tuple(r) for r in docs]
    for number, base in enumerate(r for r in docs if len(r.text.split()) > 60):
        words = base.text.split()
        words[draw.randrange(len(words))] = "changed"
        rows += [(1000 + number, " ".join(words), base.lang, base.source, 1), (2000 + number, base.text, base.lang, "src0", 1)]
    rows += [(3000, None, "en", "src1", 0), (3001, "", None, None, 0), (3000, None, "en", "src1", 0)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    at, states = spark.read.parquet(f"{folder}/documents.parquet"), []
    states.append(at)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, at, folder).write.parquet(f"{folder}/{name}")
        at = spark.read.parquet(f"{folder}/{name}")
        states.append(at)
    return folder, states


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_are_the_dealt_ones_and_keep_the_columns(made):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "mixing", "pieces"]
    assert all(sorted(df.columns) == sorted(made[1][0].columns) for df in made[1][1:5])


def test_each_stage_against_its_brute_force(spark, made):
    start, told, exact, near, mixed, pieces = made[1]
    judged = language.identify(start, language.train(start)).collect()
    assert ids(told) == sorted(r.doc_id for r in judged if r.kept) and {3000, 3001}.isdisjoint(ids(told))
    last = {}
    for r in told.collect():
        last[r.text] = max(r.doc_id, last.get(r.text, -1))
    assert ids(exact) == sorted(last.values())
    rows = exact.orderBy("doc_id").collect()
    classes, _ = brute_classes([r.text for r in rows], near_dedup.idf_table(exact))
    assert ids(near) == sorted({c: r.doc_id for c, r in zip(classes, rows)}.values())
    assert ids(mixed) == ids(near)
    order = {r.doc_id: (r.slot, r.place) for r in mixing.mix(near).collect()}
    # Files in order of name hold the mix in order.
    stored = [i for path in sorted(Path(made[0], "mixing").glob("part-*")) for i in pq.read_table(path).column("doc_id").to_pylist()]
    assert stored == sorted(order, key=order.get)
    assert ids(pieces.where("sample = 0")) == ids(mixed) and pieces.where("not round_trip").count() == 0


def test_run_gives_the_last_stage(spark, made):
    assert corpus_pipeline.run(spark, made[0]).count() == made[1][-1].count()


def test_clashing_columns_and_an_empty_table(spark, made, tmp_path):
    docs = with_clashes(made[1][0], "mix_slot", "mix_place", "sample", "ids", "name", "slot", "content")
    docs.write.parquet(f"{tmp_path}/wide/documents.parquet")
    found = corpus_pipeline.run(spark, f"{tmp_path}/wide")
    assert ids(found) == ids(made[1][-1]) and found.columns == made[1][-1].columns
    made[1][0].limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_the_mix_can_be_read_from_the_written_result(spark, made, tmp_path):
    near = made[1][3]
    want = {r.doc_id: (r.slot, r.place) for r in mixing.mix(near).collect()}
    # Files of the mixed rows in an order that is not the mix's, as Spark may read them.
    made[1][4].repartition(5, "text").write.parquet(f"{tmp_path}/mixed")
    corpus_pipeline.encode_pieces(spark, spark.read.parquet(f"{tmp_path}/mixed"), made[0]).repartition(7, "doc_id").write.parquet(f"{tmp_path}/pieces")
    for pieces in (made[1][5], spark.read.parquet(f"{tmp_path}/pieces")):
        rows = pieces.orderBy("mix_slot", "mix_place", "sample").where("sample = 0").collect()
        assert [r.doc_id for r in rows] == sorted(want, key=want.get)
        assert all((r.mix_slot, r.mix_place) == want[r.doc_id] for r in rows)
