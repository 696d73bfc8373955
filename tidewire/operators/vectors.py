"""Embedding search, clustering and near-copy removal.

Vectors travel as Arrow batches, and a batch meets all queries or planes in one matrix product.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewire.functions.once import compute_once
from tidewire.operators.bounds import rows_within
from tidewire.session import fresh_path

# Executors get these functions with the task: they need numpy and pyarrow, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Vectors held by every task at once: queries of a search, centroids of an assignment.
BLOCK_ROWS = 4096
_NEAREST = "struct<similarity:double,order:bigint>"
#: Scores of one matrix product at most: 8 MB, and as much again for each step that copies them.
_SCORES_AT_ONCE = 1_000_000


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of a list column as a float64 matrix."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1)


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.full_like(matrix, np.nan), where=norms > 0)


def _blocks(small: DataFrame, id_col: str, vector: str) -> Iterator[tuple[list, np.ndarray]]:
    """The small side in blocks of at most BLOCK_ROWS rows; one block when it fits, else split by a hash of the id."""
    chosen = small.select(id_col, vector).where(F.col(vector).isNotNull()).dropDuplicates([id_col])
    for rows in _split(chosen, id_col, 0):
        if rows:
            yield [r[0] for r in rows], _unit(np.array([r[1] for r in rows], dtype=np.float64))


def _split(rows: DataFrame, id_col: str, level: int) -> Iterator[list]:
    fetched = rows_within(rows, BLOCK_ROWS)
    if fetched is not None:
        yield fetched
        return
    count = 2 * -(-rows.count() // BLOCK_ROWS)
    bucket = F.pmod(F.xxhash64(id_col, F.lit(level)), F.lit(count))
    for number in range(count):
        yield from _split(rows.where(bucket == number), id_col, level + 1)


def _chunks(matrix: np.ndarray, others: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, rows) of pieces whose product with that many other vectors stays small."""
    size = max(1, _SCORES_AT_ONCE // max(1, others))
    return ((at, matrix[at : at + size]) for at in range(0, len(matrix), size))


def _best_of(q: np.ndarray, score: np.ndarray, ident: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best per query of flat candidates; equal scores go to the smaller id."""
    order = np.lexsort((ident, -score, q))
    q, score, ident = q[order], score[order], ident[order]
    place = np.arange(len(q)) - np.searchsorted(q, q, side="left")
    kept = place < k
    return q[kept], score[kept], ident[kept], place[kept]


def vector_topk(
    corpus: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, vec_id, score, rank) of the k nearest vectors by cosine per query; ties go to the smaller id.

    Every task keeps k rows per query while its vectors pass, so neither its memory nor what is shuffled grows with
    the corpus. More queries than one block holds take one pass over the corpus per block; none give no rows.
    """
    found = None
    for query_ids, matrix in _blocks(queries, id_col, vector):
        part = corpus.select(F.col(id_col).cast("bigint"), vector).where(F.col(vector).isNotNull())
        part = part.mapInArrow(_search(np.array(query_ids, dtype=np.int64), matrix, k), f"query_id bigint, {id_col} bigint, score double")
        found = part if found is None else found.unionByName(part)
    if found is None:  # no queries, no neighbours
        found = corpus.select(F.lit(0).cast("bigint").alias("query_id"), F.col(id_col).cast("bigint"), F.lit(0.0).alias("score")).limit(0)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), id_col))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _search(query_ids: np.ndarray, matrix: np.ndarray, k: int):
    def search(batches):
        q, score, ident = np.array([], np.int64), np.array([], np.float64), np.array([], np.int64)
        bar = np.full(len(query_ids), -np.inf)  # a query with k candidates takes nothing below its last one
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for at, rows in _chunks(_unit(_matrix(batch.column(1))), len(query_ids)):
                scores = np.nan_to_num(matrix @ rows.T, nan=-np.inf)
                cut = scores.shape[1] - min(k, scores.shape[1])
                low = np.maximum(bar, np.partition(scores, cut, axis=1)[:, cut])
                new_q, row = np.nonzero((scores >= low[:, None]) & np.isfinite(scores))
                q, score, ident, place = _best_of(
                    np.concatenate([q, new_q]), np.concatenate([score, scores[new_q, row]]), np.concatenate([ident, ids[at + row]]), k
                )
                bar[q[place == k - 1]] = score[place == k - 1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(query_ids[q]), pa.array(ident), pa.array(score)], names=["query_id", "id", "score"]
        )

    return search


def label_centroids(vectors: DataFrame, label: str = "label", vector: str = "embedding") -> DataFrame:
    """(label, centroid): mean vector per label. Each batch sends one sum per label."""

    def sums(batches):
        for batch in batches:
            labels = batch.column(0).to_numpy(zero_copy_only=False)
            matrix = _matrix(batch.column(1))
            names, where = np.unique(labels, return_inverse=True)
            totals = np.zeros((len(names), matrix.shape[1]))
            np.add.at(totals, where, matrix)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(np.bincount(where)), pa.array(list(totals), pa.list_(pa.float64()))],
                names=["label", "n", "total"],
            )

    rows = vectors.select(label, vector).where(F.col(label).isNotNull() & F.col(vector).isNotNull())
    label_type = vectors.schema[label].dataType.simpleString()
    partial = rows.mapInArrow(sums, f"label {label_type}, n bigint, total array<double>")
    spots = partial.select("label", "n", F.posexplode("total").alias("spot", "x"))
    means = spots.groupBy("label", "spot").agg((F.sum("x") / F.sum("n")).alias("x"))
    # one value per dimension is left of each label
    ordered = F.array_sort(F.collect_list(F.struct("spot", "x")))
    return means.groupBy("label").agg(F.transform(ordered, lambda s: s["x"]).alias("centroid"))


def nearest_centroid(vectors: DataFrame, centroids: DataFrame, vector: str = "embedding") -> DataFrame:
    """vectors + cluster, similarity: the label of the centroid nearest by cosine; ties go to the smaller label."""
    best = F.lit(None).cast(_NEAREST)
    for labels, matrix in _blocks(centroids, "label", "centroid"):
        best = F.greatest(best, _nearest_in(labels, matrix)(F.col(vector)))
    assigned = compute_once(vectors.where(F.col(vector).isNotNull()), "_best", best)
    cluster = (-F.col("_best.order")).cast(centroids.schema["label"].dataType)
    return assigned.withColumns({"cluster": cluster, "similarity": F.col("_best.similarity")}).drop("_best")


def _nearest_in(labels: list[int], matrix: np.ndarray):
    """Vector to (similarity, negated label) of the nearest of these centroids."""
    by_label = np.argsort(np.array(labels), kind="stable")
    ordered, units = np.array(labels, dtype=np.int64)[by_label], matrix[by_label]

    @F.arrow_udf(_NEAREST)
    def nearest(vecs: pa.Array) -> pa.Array:
        best, top = np.zeros(len(vecs), np.int64), np.zeros(len(vecs))
        for at, rows in _chunks(_unit(_matrix(vecs)), len(units)):
            scores = np.nan_to_num(rows @ units.T, nan=-np.inf)
            place = slice(at, at + len(rows))
            best[place], top[place] = scores.argmax(axis=1), scores.max(axis=1)
        return pa.StructArray.from_arrays([pa.array(top), pa.array(-ordered[best])], names=["similarity", "order"])

    return nearest


def plane_signs(planes: int, dims: int) -> np.ndarray:
    """planes x dims of +1 and -1 from a fixed rule, so every run cuts space the same way."""
    x = np.arange(1, planes * dims + 1, dtype=np.int64).reshape(planes, dims)
    return np.where((x * x * x * 7919 + x * 104729) % 1000003 % 2 == 0, 1.0, -1.0)


def band_keys(vector: Column, dims: int, bands: int, bits: int) -> Column:
    """array<bigint>: for each band the sides of its hyperplanes on which the vector lies."""
    signs = plane_signs(bands * bits, dims)
    weights = 1 << np.arange(bits, dtype=np.int64)

    @F.arrow_udf("array<bigint>")
    def keys(vecs: pa.Array) -> pa.Array:
        sides = (_matrix(vecs) @ signs.T >= 0).reshape(len(vecs), bands, bits)
        return pa.array(list((sides * weights).sum(axis=2)), pa.list_(pa.int64()))

    return keys(vector)


def cosine(left: Column, right: Column) -> Column:
    @F.arrow_udf("double")
    def pairwise(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array(np.einsum("ij,ij->i", _unit(_matrix(a)), _unit(_matrix(b))))

    return pairwise(left, right)


def _cells(distinct: DataFrame, vector: str, dims: int, bands: int, bits: int) -> DataFrame:
    """(_first, _place, _lead, _second): the cells of each vector that hold others, with the two smallest ids in each; stored, as
    every step starts from them."""
    keyed = compute_once(distinct, "_keys", band_keys(F.col(vector), dims, bands, bits))
    # a band's number goes into its key; ids alone travel until the candidate pairs are known
    placed = keyed.select("_first", F.posexplode("_keys").alias("_band", "_key")).select("_first", F.xxhash64("_band", "_key").alias("_place"))
    rank = F.row_number().over(Window.partitionBy("_place").orderBy("_first"))
    two = placed.withColumn("_rank", rank).where("_rank <= 2").groupBy("_place").agg(F.min("_first").alias("_lead"), F.max("_first").alias("_second"))
    members = placed.join(two.where("_lead <> _second"), "_place")
    path = fresh_path(distinct.sparkSession, "semantic-cells")
    members.write.parquet(path)
    return distinct.sparkSession.read.schema(members.schema).parquet(path)


def lead_pairs(cells: DataFrame) -> DataFrame:
    """(_first, _other_id): each vector with the smallest id of each of its cells."""
    return cells.where("_first <> _lead").select("_first", F.col("_lead").alias("_other_id")).distinct()


def open_pairs(cells: DataFrame, found: DataFrame) -> DataFrame:
    """(_first, _other_id): the pairs that can still name a smaller id than found (_first, _near) has.

    A vector within the threshold of the smallest id of a cell is done with the cell, and with all ids above the smallest that it
    has found anywhere; so a cell goes on only for vectors whose bound lies above its second id, and with ids below the bounds.
    """
    rest = cells.where("_first <> _lead")
    bounded = rest.join(found, "_first", "left").withColumn("_bound", F.coalesce("_near", "_first")).where("_second < _bound")
    most = bounded.groupBy("_place").agg(F.max("_bound").alias("_most"))
    others = rest.join(most, "_place").where("_first < _most").select("_place", F.col("_first").alias("_other_id"))
    return bounded.select("_first", "_place", "_bound").join(others, "_place").where("_other_id < _bound").select("_first", "_other_id").distinct()


def _nearest_earlier(pairs: DataFrame, distinct: DataFrame, vector: str, threshold: float) -> DataFrame:
    """(_first, _near): the smallest other id whose cosine reaches the threshold."""
    own = pairs.join(distinct.withColumnRenamed(vector, "_own"), "_first")
    both = own.join(distinct.select(F.col("_first").alias("_other_id"), F.col(vector).alias("_other")), "_other_id")
    scored = compute_once(both, "_cos", cosine(F.col("_own"), F.col("_other")))
    return scored.where(F.col("_cos") >= threshold).groupBy("_first").agg(F.min("_other_id").alias("_near"))


def semantic_dedup(
    vectors: DataFrame, dims: int, threshold: float = 0.95, bands: int = 140, bits: int = 24,
    id_col: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """vectors + copy_of: the earliest record that this one copies, NULL for records that stay.

    Exact copies point to their first record. Of the distinct vectors, each points to the smallest earlier id whose cosine
    reaches the threshold. Candidates are all pairs that lie on the same side of every hyperplane of a band; each that can be the
    answer is verified, so a vector's answer does not depend on which others are compared. First all meet the smallest ids of their
    cells, at most one a band, so a large group of near copies is settled by about as many pairs as it has members; then what is
    still open meets the rest of its cells. At a cosine of 0.95 a pair misses all of 140 bands of 24 planes with a chance of 1e-5,
    while of unrelated pairs one in 100,000 is a candidate. Both numbers are set by the caller, never by the size of the table.
    """
    rows = vectors.where(F.col(vector).isNotNull())
    distinct = rows.groupBy(vector).agg(F.min(id_col).alias("_first"))
    cells = _cells(distinct, vector, dims, bands, bits)
    path = fresh_path(vectors.sparkSession, "semantic-near")
    by_lead = _nearest_earlier(lead_pairs(cells), distinct, vector, threshold)
    by_lead.write.parquet(path)
    by_lead = vectors.sparkSession.read.schema(by_lead.schema).parquet(path)
    found = by_lead.unionByName(_nearest_earlier(open_pairs(cells, by_lead), distinct, vector, threshold))
    near = found.groupBy("_first").agg(F.min("_near").alias("_near"))
    firsts = distinct.join(near, "_first", "left")
    joined = rows.join(firsts, vector)
    copy = F.when(F.col(id_col) != F.col("_first"), F.coalesce("_near", "_first")).otherwise(F.col("_near"))
    return joined.withColumn("copy_of", copy).drop("_first", "_near")
