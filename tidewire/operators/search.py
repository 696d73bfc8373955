"""Nearest vectors by a stored inverted-file index.

Every row lies in the cell of its nearest centre, and the rows of a cell in shards of bounded size. Queries go as rows to the shards
of the cells they ask; a shard meets a block of queries in one matrix product. Neither queries nor rows pass the driver.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidewire.functions.once import compute_once
from tidewire.operators.vectors import _best_of, _chunks, _matrix, _unit, nearest_centroid

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Centres that every task holds, at most; and rows that they are fitted on, at most (every row is indexed).
MAX_CELLS, SAMPLE_ROWS = 4096, 200_000
#: Rows of a shard and queries of a block, on average: what one task holds at a time.
SHARD_ROWS, BLOCK_ROWS = 16_384, 4096
#: Scores are rounded to so many places, so that equal vectors tie wherever they lie.
PLACES = 9
_FOUND = "query_id bigint, vec_id bigint, score double"


@dataclass(frozen=True)
class Index:
    """rows (cell, shard, vec_id, vector); cells (cell, centre, shards, reach), reach being the least cosine of its rows to its centre."""

    rows: DataFrame
    cells: DataFrame

    def centres(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cells, unit centres, angles of reach): at most MAX_CELLS rows."""
        found = self.cells.select("cell", "centre", "reach").orderBy("cell").limit(MAX_CELLS).toArrow()
        numbers, reach = (found.column(x).to_numpy().copy() for x in ("cell", "reach"))
        return numbers, _unit(_matrix(found.column("centre"))) if len(numbers) else np.empty((0, 0)), np.arccos(np.clip(reach, -1, 1))


def fit_centres(vectors: DataFrame, cells: int, vector: str, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(label, centroid) of at most so many centres, fitted on the sample_rows vectors with the least hashes."""
    spark = vectors.sparkSession
    sample = vectors.orderBy(F.xxhash64(vector), vector).limit(sample_rows).select(array_to_vector(vector).alias("features"))
    centres = []
    if not sample.isEmpty():
        centres = KMeans(k=max(2, cells), seed=11, distanceMeasure="cosine", maxIter=8, initSteps=1).fit(sample).clusterCenters()
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(centres)], "label int, centroid array<double>")


def build_index(
    vectors: DataFrame, path: str, cells: int | None = None, sample_rows: int = SAMPLE_ROWS, id_col: str = "vec_id", vector: str = "embedding"
) -> Index:
    """Store the index of all vectors under path and return it. Without cells there are as many as the root of the number of rows.

    Null vectors and those without a direction (all zero, or not finite) have no cosine to anything and are left out. Of rows that
    repeat an id each counts. An empty table gives an index that finds nothing.
    """
    directed = F.aggregate(F.col(vector), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = vectors.where((directed > 0) & (directed < F.lit(math.inf))).select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector).alias("vector"))
    if cells is None:
        cells = round(math.sqrt(rows.count()))
    if cells > MAX_CELLS:
        cells = MAX_CELLS
    centres = fit_centres(rows, cells, "vector", sample_rows)
    placed = nearest_centroid(rows, centres, "vector").where("cluster IS NOT NULL").withColumnRenamed("cluster", "cell")
    spark = vectors.sparkSession
    placed.write.mode("overwrite").parquet(f"{path}/placed")
    placed = spark.read.schema(placed.schema).parquet(f"{path}/placed")
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / SHARD_ROWS).cast("int").alias("shards"), F.min("similarity").alias("reach"))
    table = sizes.join(centres.select(F.col("label").alias("cell"), F.col("centroid").alias("centre")), "cell")
    table.write.mode("overwrite").parquet(f"{path}/cells")
    return read_index(spark, path)


def read_index(spark: SparkSession, path: str) -> Index:
    cells = spark.read.parquet(f"{path}/cells")
    shard = F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int").alias("shard")
    return Index(spark.read.parquet(f"{path}/placed").join(cells.select("cell", "shards"), "cell").select("cell", shard, "vec_id", "vector"), cells)


def _asked(queries: DataFrame, id_col: str, vector: str) -> DataFrame:
    rows = queries.where(F.col(vector).isNotNull()).dropDuplicates([id_col])
    return rows.select(F.col(id_col).cast("bigint").alias("query_id"), F.col(vector).alias("query"))


def _nearest_cells(index: Index, probes: int):
    """Column -> Column: the cells whose centres are nearest."""
    numbers, centres, _ = index.centres()

    @F.arrow_udf("array<int>")
    def cells(vecs: pa.Array) -> pa.Array:
        if not len(numbers) or not len(vecs):
            return pa.array([[] for _ in range(len(vecs))], pa.list_(pa.int32()))
        nearest = []
        for _, units in _chunks(_unit(_matrix(vecs)), len(numbers)):
            scores = np.nan_to_num(units @ centres.T, nan=-2.0)
            nearest.extend(numbers[np.argsort(-scores, axis=1, kind="stable")[:, :probes]])
        return pa.array(nearest, pa.list_(pa.int32()))

    return cells


def _cells_within(index: Index):
    """(vector, score) -> the cells that may hold a vector of at least that cosine, by the angles to their centres and their reach."""
    numbers, centres, reach = index.centres()

    @F.arrow_udf("array<int>")
    def cells(vecs: pa.Array, least: pa.Array) -> pa.Array:
        if not len(numbers) or not len(vecs):
            return pa.array([[] for _ in range(len(vecs))], pa.list_(pa.int32()))
        found, least = [], least.to_numpy(zero_copy_only=False)
        for at, units in _chunks(_unit(_matrix(vecs)), len(numbers)):
            angles = np.arccos(np.clip(units @ centres.T, -1, 1))
            bound = np.cos(np.maximum(0, angles - reach)) + 1e-6
            found.extend(numbers[row] for row in bound >= least[at : at + len(units), None])
        return pa.array(found, pa.list_(pa.int32()))

    return cells


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _answers(index: Index, asked: DataFrame, k: int) -> DataFrame:
    """The k best of each query among the cells it asks: asked(query_id, query, cell).

    Blocks of queries and shards of rows meet by key (cell, shard, block), so a cell with a third of all rows, or of all queries,
    is spread over as many groups as it has shards and blocks. Cells that nobody asks are not moved.
    """
    blocks = asked.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    block = F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int").alias("block")
    left = asked.join(blocks, "cell").join(index.cells.select("cell", "shards"), "cell")
    left = left.select("cell", "query_id", "query", block, upto("shards").alias("shard"))
    right = index.rows.join(blocks, "cell").select("cell", "shard", "vec_id", "vector", upto("blocks").alias("block"))

    def best(ask: pa.Table, held: pa.Table) -> pa.Table:
        names, columns = ["query_id", "vec_id", "score"], ([], [], [])
        if ask.num_rows and held.num_rows:
            ids, query_ids = held.column("vec_id").to_numpy(), ask.column("query_id").to_numpy()
            rows, units = _unit(_matrix(held.column("vector"))), _unit(_matrix(ask.column("query")))
            kept = []
            for at, block in _chunks(units, len(rows)):
                scores = np.round(np.nan_to_num(block @ rows.T, nan=-np.inf), PLACES)
                cut = scores.shape[1] - min(k, scores.shape[1])
                q, row = np.nonzero((scores >= np.partition(scores, cut, axis=1)[:, cut][:, None]) & np.isfinite(scores))
                q, score, ident, _ = _best_of(q, scores[q, row], ids[row], k)
                kept.append((query_ids[at + q], ident, score))
            columns = [np.concatenate(x) for x in zip(*kept)]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds)], names=names)

    key = ["cell", "shard", "block"]
    return _ranked(left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(best, _FOUND), k)


def search(index: Index, queries: DataFrame, k: int, probes: int, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, vec_id, score, rank) of the k nearest rows by cosine in the probes nearest cells; ties go to the smaller id.

    No queries give no rows; a query without a direction finds nothing.
    """
    asked = compute_once(_asked(queries, id_col, vector), "cells", _nearest_cells(index, probes)(F.col("query")))
    return _answers(index, asked.select("query_id", "query", F.explode("cells").alias("cell")), k)


def search_exact(index: Index, queries: DataFrame, k: int, probes: int, path: str, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The same, and exact: after the nearest cells, a query goes to each other cell that may hold a better row than its k-th.

    The first answers are stored under path.
    """
    spark = queries.sparkSession
    first = _asked(queries, id_col, vector).withColumn("near", _nearest_cells(index, probes)(F.col("query")))
    first.write.mode("overwrite").parquet(f"{path}/asked")
    first = spark.read.schema(first.schema).parquet(f"{path}/asked")
    answers = _answers(index, first.select("query_id", "query", F.explode("near").alias("cell")), k)
    answers.write.mode("overwrite").parquet(f"{path}/first")
    answers = spark.read.schema(answers.schema).parquet(f"{path}/first")
    least = answers.where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    bound = first.join(least, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(-2.0)))
    wide = compute_once(bound, "wide", _cells_within(index)(F.col("query"), F.col("least")))
    rest = wide.select("query_id", "query", F.explode(F.array_except("wide", "near")).alias("cell"))
    return _ranked(answers.drop("rank").unionByName(_answers(index, rest, k).drop("rank")), k)


def probes_for(index: Index, exact: DataFrame, queries: DataFrame, target: float, id_col: str = "vec_id", vector: str = "embedding") -> int:
    """The least number of probes that finds the target share of these exact answers, by the place of each answer's cell in its query's
    order of cells. Meant for a bounded sample of queries; all cells where there are no answers."""
    total = max(1, index.cells.count())
    order = _asked(queries, id_col, vector).select("query_id", _nearest_cells(index, total)(F.col("query")).alias("order"))
    homes = index.rows.select("vec_id", "cell").join(exact.select("query_id", "vec_id"), "vec_id")
    places = homes.join(order, "query_id").groupBy(F.array_position("order", F.col("cell")).alias("place")).agg(F.count("*").alias("n"))
    counts, held = sorted((r.place, r.n) for r in places.collect()), 0  # one row a cell at most
    for place, n in counts:
        held += n
        if held >= target * sum(x for _, x in counts):
            return int(place)
    return total


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: queries, neighbours, recall (the share of the exact neighbours that found has)."""
    hits = exact.select("query_id", "vec_id").join(found.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left")
    return hits.agg(F.count_distinct("query_id").alias("queries"), F.count("*").alias("neighbours"), (F.count("hit") / F.count("*")).alias("recall"))
