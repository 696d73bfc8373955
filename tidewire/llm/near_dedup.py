"""Near duplicates by improved consistent weighted sampling (ICWS) over TF-IDF shingles of five words.

A shingle weighs tf * idf. Its document frequency is counted over all documents in 2^DF_BITS hashed buckets, so that the
table has one size at any scale: a shingle of a share f of the documents counts as f plus the even load of a bucket, which
does not depend on the number of documents. idf runs from 1 to 1.5 only, so that the shingles that the copies of a large group
share still outweigh those that tell them apart. Weights are rounded to 1/32 powers of two; with so few different weights,
and ICWS's random numbers drawn from a pool of 65,536 by the shingle's hash, a sample is a table look-up.

Texts with an equal band of samples meet in a bucket. Buckets of up to SMALL_BUCKET texts compare all of them, by the exact
weighted Jaccard similarity; links of at least THRESHOLD join classes. The texts of larger buckets are joined in two steps.
First rounds that only save work: the texts meet again where two of their bands agree, and of what is still large each text picks
one bucket a round, so that those of a group mostly pick the same, and is compared with that bucket's lead if it lies in another
class; rounds go on while they pay, so a group takes about as many pairs as it has texts. Then an exact step for all texts that
lie in a large bucket: any two of different classes that can reach THRESHOLD by a prefix filter (see prefixes) are compared, or
ruled out by the triangle inequality, as the linked texts of a star (see pivots) are all near its pivot. No pair is lost. Pivots
meet first, so a text that shares a passage with a large group meets the group's few pivots and not its members. So a pair is
compared, ruled out or in one class already if it shares any band, whatever the sizes of its buckets; the large ones' texts are
even joined without a common band.

Equal texts are one node from the start and need no links. A text of fewer than five words is one shingle; null and empty
texts have none and are a class of their own. Rows without a key take part; a class of such rows alone has a null id. Of
rows that repeat key and text, one is kept. An empty table gives no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from tidewire.llm.arrow_slices import leaving_nothing, slices
from tidewire.llm.common import ROW, packed, row_name, stored, unpacked, whole_text, without
from tidewire.llm.keymap import key_map, maybe_in
from tidewire.session import fresh_path, text_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE, THRESHOLD = 5, 0.8
#: Samples in all and per band: a pair at the threshold misses all bands with a chance of 1e-5. That is the chance to miss a
#: pair at all, whatever the sizes of its buckets; two texts that both lie in large buckets are not missed even then.
SAMPLES, BAND = 48, 3
#: Texts of a bucket that are all compared with each other.
SMALL_BUCKET = 16
#: Distances of the two bands that make a refined bucket. They save comparisons; pairs without such bands meet in the exact step.
REFINED = (1, 3)
#: A round pays, and another one follows, if at least one in so many of its pairs is a link.
PAYING = 8
#: What sums of weights may differ by when added up in another order.
SLACK = 1e-6
#: Links that one task puts together at a time: some MB of Python objects.
EDGES_A_TASK = 1 << 14
DF_BITS = 18
#: Steps of weights per power of two, and steps in all: tf up to 2^31.
STEPS, LEVELS = 32, 1024
_POOL_BITS = 16
_BLOCK = 4096
_PIECE = 1 << 16


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well spread 64-bit hashes of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(sorted hashes, counts) of the different shingles of each text."""
    lists = pc.utf8_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    codes = coded.indices.to_numpy(zero_copy_only=False)
    blank = words.index("") if "" in words else -1
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)) if len(lists) else np.empty(0, int)
    flat = hashes[codes] if len(codes) else np.empty(0, np.uint64)
    start = 0
    for end in ends:
        own = flat[start:end]
        if blank >= 0:
            own = own[codes[start:end] != blank]
        start = end
        width = min(SHINGLE, len(own))
        if not width:
            yield np.empty(0, np.uint64), np.empty(0, np.int64)
            continue
        rolled = np.full(len(own) - width + 1, width, np.uint64)
        for i in range(width):
            rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + own[i : len(own) - width + 1 + i]
        rolled = np.sort(_mixed(rolled))
        first = np.flatnonzero(np.concatenate(([True], rolled[1:] != rolled[:-1])))
        yield rolled[first], np.diff(np.append(first, len(rolled)))


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - DF_BITS)).astype(np.int64)


def _frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one task: counts of the documents per bucket, in blocks; block -1 has their number."""
    counts, documents = np.zeros(1 << DF_BITS, np.int64), 0
    for batch in slices(batches):
        documents += batch.num_rows
        for hashes, _ in shingles(batch.column(0)):
            np.add.at(counts, _bucket(hashes), 1)
    blocks = [(-1, np.array([documents]))] + [(at // _BLOCK, counts[at : at + _BLOCK]) for at in range(0, len(counts), _BLOCK)]
    yield _count_rows((b, c) for b, c in blocks if c.any())


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = np.frombuffer(packed, np.int64)
            sums[block] = sums.get(block, 0) + found
    yield _count_rows(sums.items())


def _count_rows(blocks: Iterable[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    rows = [{"block": int(b), "counts": np.ascontiguousarray(c, np.int64).tobytes()} for b, c in blocks]
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([("block", pa.int32()), ("counts", pa.binary())]))


def idf_table(docs: DataFrame, text: str = "text") -> np.ndarray:
    """idf of each bucket: 1 + ln(1 + N / df) / (2 ln(1 + buckets)). The table is of fixed size, summed up on the executors."""
    parts = docs.select(whole_text(text).alias("text")).mapInArrow(leaving_nothing(_frequencies), "block int, counts binary")
    sums = parts.repartition("block").mapInArrow(leaving_nothing(_summed), "block int, counts binary").toArrow()
    counts, documents = np.zeros(1 << DF_BITS), 0
    for block, packed in zip(sums.column("block").to_pylist(), sums.column("counts").to_pylist()):
        found = np.frombuffer(packed, np.int64)
        if block < 0:
            documents = int(found[0])
        else:
            counts[block * _BLOCK : (block + 1) * _BLOCK] = found
    return (1 + np.log1p(documents / np.maximum(counts, 1)) / (2 * np.log1p(1 << DF_BITS))).astype(np.float32)


def levels_of(hashes: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weights tf * idf, as steps of powers of two."""
    return np.rint(STEPS * np.log2(counts * idf[_bucket(hashes)])).astype(np.int64)


def weights_of(levels: np.ndarray) -> np.ndarray:
    return np.exp2(levels / STEPS)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of (sorted hashes, weights); 0 if either is empty."""
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    both = np.flatnonzero(b[0][at] == a[0]) if len(b[0]) else []
    shared = np.minimum(a[1][both], b[1][at[both]]).sum() if len(both) else 0.0
    return float(shared / (a[1].sum() + b[1].sum() - shared)) if shared else 0.0


def prefixes(own: tuple[np.ndarray, np.ndarray], rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, rests) of the first shingles of (hashes, weights), by rarity and hash; a rest is the weight from there on.

    Two texts of similarity THRESHOLD t and total weights v, w share a weight of at least t / (1 + t) * (v + w), which is at
    least t * max(v, w). So the first shingle that they share has a rest of that much in both, and lies in both prefixes, those
    of rests of at least t times the total.
    """
    hashes, weights = own
    order = np.lexsort((hashes, -rarity[_bucket(hashes)]))
    rests = np.cumsum(weights[order][::-1])[::-1]
    held = rests >= THRESHOLD * weights.sum() - SLACK
    return hashes[order][held], rests[held]


class Sampler:
    """ICWS with pooled random numbers: ln a = ln c - r (t - beta) - r, t = floor(ln w / r + beta); the least a is sampled."""

    def __init__(self) -> None:
        draw = np.random.default_rng(20)
        n = 1 << _POOL_BITS
        self.r, self.c, self.beta = draw.gamma(2, 1, n), draw.gamma(2, 1, n), draw.random(n)
        self.odd = (draw.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
        self.rank = np.empty((LEVELS, n), np.float32)
        self.known = np.zeros(LEVELS, bool)

    def _steps(self, level: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.floor(level * (np.log(2) / STEPS) / self.r[at] + self.beta[at])

    def bands(self, hashes: list[np.ndarray], levels: list[np.ndarray]) -> np.ndarray:
        """Band keys of each text (none of them empty): one row of SAMPLES / BAND numbers."""
        sizes = np.array([len(h) for h in hashes])
        flat, level = np.concatenate(hashes), np.minimum(np.concatenate(levels), LEVELS - 1)
        for new in np.unique(level[~self.known[level]]):
            t = self._steps(np.full(1 << _POOL_BITS, new), np.arange(1 << _POOL_BITS))
            self.rank[new] = np.log(self.c) - self.r * (t - self.beta) - self.r
            self.known[new] = True
        starts, owner = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)
        base, ranks = level << _POOL_BITS, self.rank.ravel()
        samples = np.empty((SAMPLES, len(sizes)), np.uint64)
        for k in range(SAMPLES):
            at = ((flat * self.odd[k]) >> np.uint64(64 - _POOL_BITS)).astype(np.int64)
            a = ranks[base + at]
            least = np.flatnonzero(a == np.repeat(np.minimum.reduceat(a, starts), sizes))
            # Of equal ones the smallest hash counts, which is the first.
            won = least[np.concatenate(([True], owner[least[1:]] != owner[least[:-1]]))]
            t = self._steps(level[won], at[won]).astype(np.int64).astype(np.uint64)
            samples[k] = _mixed(flat[won] ^ _mixed(t + np.uint64(k)))
        keys = np.empty((len(sizes), SAMPLES // BAND), np.uint64)
        for band in range(SAMPLES // BAND):
            key = np.full(len(sizes), band, np.uint64)
            for k in range(band * BAND, (band + 1) * BAND):
                key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + samples[k])
            keys[:, band] = key
        return keys


def _signer(idf: np.ndarray) -> Callable:
    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        for batch in slices(batches):
            found: list = [[] for _ in range(batch.num_rows)]
            held: list = []

            def flush() -> None:
                if held:
                    keys = sampler.bands([h for _, h, _ in held], [x for _, _, x in held]).astype(np.int64)
                    for (row, _, _), own in zip(held, keys):
                        found[row] = own
                    held.clear()

            size = 0
            for row, (hashes, counts) in enumerate(shingles(batch.column("text"))):
                if len(hashes):
                    held.append((row, hashes, levels_of(hashes, counts, idf)))
                    size += len(hashes)
                if size >= _PIECE:
                    flush()
                    size = 0
            flush()
            names = [x for x in batch.schema.names if x != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(found, pa.list_(pa.int64()))], [*names, "bands"])

    return sign


def _verifier(idf: np.ndarray) -> Callable:
    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for batch in slices(batches, "b_text"):
            names, lead_texts = batch.column("a").to_pylist(), batch.column("a_text")
            similar = np.zeros(batch.num_rows)
            for row, (hashes, counts) in enumerate(shingles(batch.column("b_text"))):
                if last[0] != names[row]:  # rows come ordered by their leader
                    lead = next(shingles(lead_texts.slice(row, 1)))
                    last = (names[row], (lead[0], weights_of(levels_of(*lead, idf))))
                similar[row] = weighted_jaccard(last[1], (hashes, weights_of(levels_of(hashes, counts, idf))))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(similar)], ["a", "b", "similarity"])

    return verify


def _prefixer(idf: np.ndarray, rarity: np.ndarray) -> Callable:
    def prefix(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = []
            for hashes, counts in shingles(batch.column("text")):
                weights = weights_of(levels_of(hashes, counts, idf))
                found.append((*prefixes((hashes, weights), rarity), weights.sum()))
            sizes = [len(hashes) for hashes, _, _ in found]
            owners = batch.column("node").take(pa.array(np.repeat(np.arange(len(found)), sizes)))
            yield pa.RecordBatch.from_arrays(
                [owners, pa.array(np.concatenate([h for h, _, _ in found]).astype(np.int64)), pa.array(np.concatenate([r for _, r, _ in found])),
                 pa.array(np.repeat([w for _, _, w in found], sizes))], ["node", "shingle", "rest", "total"])

    return prefix


def pivots(links: DataFrame) -> DataFrame:
    """(node, pivot, far): for each text that has links (a, b, similarity), the one among its neighbours and itself with the most
    links, and the distance to it, 1 - similarity. Texts that share a pivot are its star; all lie within 1 - THRESHOLD of it.
    """
    ends = links.select("a", "b", "similarity").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "similarity")).distinct()
    degrees = ends.groupBy("a").agg(F.count(F.lit(1)).alias("degree"))
    beside = ends.join(degrees.select(F.col("a").alias("b"), "degree"), "b").select("a", "degree", F.col("b").alias("pivot"), (1 - F.col("similarity")).alias("far"))
    itself = degrees.select("a", "degree", F.col("a").alias("pivot"), F.lit(0.0).alias("far"))
    best = beside.unionByName(itself).groupBy(F.col("a").alias("node")).agg(F.max_by(F.struct("pivot", "far"), F.struct("degree", "pivot")).alias("best"))
    return best.select("node", "best.*")


def at_home(prefixed: DataFrame, roots: DataFrame, stars: DataFrame) -> DataFrame:
    """The prefix rows of texts with their class (root, members) and star (pivot, far); a text without links is its own."""
    homes = roots.join(stars, "node", "left")
    placed = prefixed.join(homes, "node", "left")
    own = {"root": F.col("node"), "members": F.lit(1), "pivot": F.col("node"), "far": F.lit(0.0)}
    return placed.select("shingle", "node", "rest", "total", *(F.coalesce(x, y).alias(x) for x, y in own.items()))


def _needed(a_total: str, b_total: str):
    return (F.col(a_total) + F.col(b_total)) * F.lit(THRESHOLD / (1 + THRESHOLD)) - F.lit(SLACK)


def star_pairs(placed: DataFrame) -> DataFrame:
    """(a, b): the pivots of all pairs of stars of different classes of which two texts may have a similarity of THRESHOLD.

    A star counts once for each shingle in the prefixes of its texts, with the largest rest and the smallest total, so a large
    group brings no more rows to a shingle than it has stars.
    """
    stars = placed.groupBy("shingle", "pivot").agg(
        F.max("rest").alias("rest"), F.min("total").alias("total"), F.first("root").alias("root"), F.first("members").alias("members"))
    # Of two classes one is not the shingle's main one, so stars of the main one need not meet each other.
    mains = stars.groupBy("shingle").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.max_by("root", F.struct("members", "root")).alias("main"))
    shared = stored(stars.join(mains.where("least < most").select("shingle", "main"), "shingle"), "near-shared")
    side = lambda x: shared.select("shingle", *(F.col(c).alias(f"{x}_{c}") for c in ("pivot", "rest", "total", "root", "main")))
    met = side("a").where("a_root <> a_main").join(side("b").drop("b_main"), "shingle").where(
        (F.col("a_root") != F.col("b_root")) & (F.least("a_rest", "b_rest") >= _needed("a_total", "b_total"))
        & ((F.col("b_root") == F.col("a_main")) | (F.col("a_pivot") < F.col("b_pivot"))))
    return met.select(F.least("a_pivot", "b_pivot").alias("a"), F.greatest("a_pivot", "b_pivot").alias("b")).distinct()


def open_pairs(placed: DataFrame, compared: DataFrame) -> DataFrame:
    """(a, b): the pairs of texts of different classes that may still have a similarity of THRESHOLD, once the pivots of their stars
    are compared: (a, b, similarity).

    1 - similarity is a metric, so texts x and y of the stars of p and q are apart by at least the distance of p and q less those of x
    to p and y to q. Only stars with a pair that this leaves open go on; of such two the smaller one looks for partners in the other.
    """
    stars = placed.groupBy("pivot").agg(F.first("root").alias("root"), F.max("far").alias("far"), F.count(F.lit(1)).alias("rows"))
    both = compared.select("a", "b", (1 - F.col("similarity") - F.lit(1 - THRESHOLD + SLACK)).alias("gap"))
    for x in ("a", "b"):
        both = both.join(stars.select(F.col("pivot").alias(x), *(F.col(c).alias(f"{x}_{c}") for c in ("root", "far", "rows"))), x)
    wide = both.where("a_root <> b_root and gap <= a_far + b_far and a_far + b_far > 0")
    swap = F.col("a_rows") > F.col("b_rows")
    wide = stored(wide.select(
        F.when(swap, F.col("b")).otherwise(F.col("a")).alias("p"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("q"),
        F.when(swap, F.col("a_far")).otherwise(F.col("b_far")).alias("q_far"), "gap"), "near-wide")
    few = placed.select(F.col("pivot").alias("p"), "shingle", *(F.col(c).alias(f"x_{c}") for c in ("node", "rest", "total", "far")))
    many = placed.select(F.col("pivot").alias("q"), "shingle", *(F.col(c).alias(f"y_{c}") for c in ("node", "rest", "total", "far")))
    met = wide.join(few, "p").where("gap <= x_far + q_far").join(many, ["q", "shingle"]).where(
        (F.col("gap") <= F.col("x_far") + F.col("y_far")) & (F.least("x_rest", "y_rest") >= _needed("x_total", "y_total")))
    return met.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()


def _contractor(edges_a_task: int) -> Callable:
    def contract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Edges (u, v) as (node, least node that they connect it with), put together up to so many edges at a time."""
        above: dict[str, str] = {}
        taken = 0

        def top(x: str) -> str:
            while (y := above.get(x, x)) != x:
                above[x] = x = above.get(y, y)
            return x

        def flush() -> pa.RecordBatch:
            hung = [(x, y) for x in above if (y := top(x)) != x]
            above.clear()
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in hung], pa.string()) for i in (0, 1)], ["u", "v"])

        for batch in batches:
            for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
                u, v = sorted((top(u), top(v)))
                above[v] = above[u] = u
                taken += 1
                if taken == edges_a_task:
                    yield flush()
                    taken = 0
        yield flush()

    return contract


def components(links: DataFrame, edges_a_task: int = EDGES_A_TASK) -> DataFrame:
    """(node, root) of all nodes of the links (a, b): each task puts together what its own edges connect, then large and small stars
    alternate once, and so on until nothing changes. Edges that are no more than a task's share need no stars."""
    def summary(edges):
        return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 31))).first()

    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    before = None
    while (now := summary(edges)) != before:
        before = now
        tasks = -(-now[0] // edges_a_task)
        if not tasks:
            break
        edges = stored(edges.coalesce(tasks).mapInArrow(leaving_nothing(_contractor(edges_a_task)), edges.schema), "edges")
        if tasks == 1:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = stored(hung.unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def _with_sizes(placed: DataFrame) -> DataFrame:
    """Rows of buckets that hold more than one text, with the bucket's size."""
    sizes = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return placed.join(sizes, "bucket")


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, class_id (largest key of the class), class_size, n_links, kept, name (see row_name).

    n_links counts the verified links of the row's text with other texts.
    """
    text_batches(docs.sparkSession)
    idf = idf_table(docs, text)
    body = whole_text(text)
    node = F.substring(F.sha2(body, 256), 1, 32)
    signed = f"doc_id {dict(docs.dtypes)[key]}, name string, node string, bands array<long>"
    rows = stored(docs.select(F.col(key).alias("doc_id"), row_name(key, text).alias("name"), node.alias("node"), body.alias("text")).mapInArrow(leaving_nothing(_signer(idf)), signed), "near-signed")
    nodes = rows.groupBy("node").agg(F.first("bands").alias("bands"))
    placed = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    coarse = stored(_with_sizes(placed), "near-coarse")
    bands = SAMPLES // BAND
    own = coarse.where(f"size > {SMALL_BUCKET}").groupBy("node").agg(F.collect_list(F.struct("band", "bucket")).alias("own"))
    beside = lambda x: F.filter("own", lambda y: F.pmod(y["band"] - x["band"], F.lit(bands)).isin(*REFINED))
    twos = F.flatten(F.transform("own", lambda x: F.transform(beside(x), lambda y: F.xxhash64(x["bucket"], y["bucket"]))))
    fine = _with_sizes(own.select("node", F.explode(twos).alias("bucket")))
    met = stored(coarse.where(f"size <= {SMALL_BUCKET}").select("node", "bucket", "size").unionByName(fine), "near-met")
    chosen = coarse.select("node").distinct()
    likely = maybe_in(key_map(chosen), F.col("node"))
    texts = stored(docs.select(node.alias("node"), body.alias("text")).where(likely).join(chosen, "node", "left_semi").dropDuplicates(["node"]), "near-texts")

    spark = docs.sparkSession
    verified = fresh_path(spark, "llm/near-verified")
    roots, number, kinds = spark.createDataFrame([], "node string, root string, members long"), 0, "a string, b string, similarity double"

    def verify(pairs: DataFrame) -> DataFrame:
        """The links among the pairs that no round has compared yet, in the same direction."""
        pairs = pairs.distinct()
        if number:
            pairs = pairs.join(spark.read.schema(kinds).parquet(verified), ["a", "b"], "left_anti")
        both = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b").join(
            texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a")
        both.select("a", "b", "a_text", "b_text").mapInArrow(leaving_nothing(_verifier(idf)), kinds).write.parquet(f"{verified}/round={number}")
        return spark.read.schema(kinds).parquet(f"{verified}/round={number}").where(F.col("similarity") >= THRESHOLD)

    def joined(fresh: DataFrame) -> DataFrame:
        """Classes with the fresh links. Only the classes that these touch are put together, each as one node."""
        ends = fresh.select("a", "b")
        for x in ("a", "b"):
            classed = roots.select(F.col("node").alias(x), F.col("root").alias(f"{x}_root"))
            ends = ends.join(classed, x, "left").withColumn(f"{x}_root", F.coalesce(f"{x}_root", x))
        ends = stored(ends, "near-ends")
        moved = components(ends.select(F.col("a_root").alias("a"), F.col("b_root").alias("b")))
        linked = ends.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(roots, "node", "left_anti")
        placed = roots.select("node", "root").unionByName(linked.select("node", F.col("node").alias("root")))
        placed = placed.join(moved.select(F.col("node").alias("root"), F.col("root").alias("onward")), "root", "left")
        found = stored(placed.select("node", F.coalesce("onward", "root").alias("root")), "near-placed")
        return stored(found.join(found.groupBy("root").agg(F.count(F.lit(1)).alias("members")), "root"), "near-roots")

    crowded = met.where(f"size > {SMALL_BUCKET}").select("bucket", "node")
    while True:
        leads = crowded.groupBy("bucket").agg(F.min_by("node", F.xxhash64("node", "bucket", F.lit(number))).alias("a"))
        picks = crowded.groupBy("node").agg(F.min_by("bucket", F.xxhash64("bucket", F.lit(number))).alias("bucket"))
        drawn = picks.join(leads, "bucket").select("a", F.col("node").alias("b")).where("a <> b")
        sides = drawn
        for x in ("a", "b"):
            classed = roots.select(F.col("node").alias(x), F.col("root").alias(f"{x}_root"), F.col("members").alias(f"{x}_members"))
            sides = sides.join(classed, x, "left").withColumn(f"{x}_root", F.coalesce(f"{x}_root", x)).fillna(1, [f"{x}_members"])
        # The members of a large class need not meet each small one: the small one's meet some of theirs, and the exact step all.
        pairs = sides.where("a_root <> b_root and b_members <= a_members").select("a", "b")
        if number == 0:
            few = met.where(f"size <= {SMALL_BUCKET}").select("bucket", "node")
            pairs = pairs.unionByName(few.withColumnRenamed("node", "a").join(few.withColumnRenamed("node", "b"), "bucket").where("a < b").select("a", "b"))
        fresh = verify(pairs)
        found, compared = fresh.count(), spark.read.schema(kinds).parquet(f"{verified}/round={number}").count()
        if found:
            roots = joined(fresh)
        if number and found * PAYING < compared or not compared:
            break
        number += 1
    number += 1
    large = texts.join(own.select("node"), "node", "left_semi")
    prefixed = stored(large.mapInArrow(leaving_nothing(_prefixer(idf, idf_table(large))), "node string, shingle long, rest double, total double"), "near-prefixes")
    stars = stored(pivots(spark.read.schema(kinds).parquet(verified).where(F.col("similarity") >= THRESHOLD)), "near-stars")
    between = stored(star_pairs(at_home(prefixed, roots, stars)), "near-between")
    fresh = verify(between)
    if not fresh.isEmpty():
        roots = joined(fresh)
    number += 1
    # A pair of pivots may have been compared by a round, in either direction.
    told = spark.read.schema(kinds).parquet(verified).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "similarity")
    fresh = verify(open_pairs(at_home(prefixed, roots, stars), told.join(between, ["a", "b"], "left_semi").groupBy("a", "b").agg(F.max("similarity").alias("similarity"))))
    if not fresh.isEmpty():
        roots = joined(fresh)
    links = spark.read.schema(kinds).parquet(verified).where(F.col("similarity") >= THRESHOLD)

    ends = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    linked = ends.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    known = roots.join(linked, "node")
    classed = stored(
        rows.join(known, "node", "left").select(
            "doc_id", "name", F.coalesce("root", "node").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.monotonically_increasing_id().alias("row")),
        "near-classes",
    )
    lowest = F.lit(-(2**63)) if dict(rows.dtypes)["doc_id"] == "bigint" else F.lit("")
    classes = classed.groupBy("root").agg(
        F.max("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"), F.max_by("row", F.coalesce("doc_id", lowest)).alias("keeper"))
    return classed.join(classes, "root").select("doc_id", "class_id", "class_size", "n_links", (F.col("row") == F.col("keeper")).alias("kept"), "name")


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one row of each class, the one with the largest key. Repeats of a row (equal key and text) leave one."""
    judged = near_groups(docs, key, text)
    kept = stored(judged.select("name", "kept").groupBy("name").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("times")), "near-kept")
    rest = without(docs, kept.where("not kept or times > 1"), key, text)
    repeats = kept.where("kept and times > 1").select("name")
    rows = packed(docs, name=row_name(key, text)).where(maybe_in(key_map(repeats), F.col("name"))).join(repeats, "name", "left_semi")
    return rest.unionByName(unpacked(rows.groupBy("name").agg(F.first(ROW).alias(ROW))))
