"""Language of documents by Bayesian fusion of evidence.

log P(language | all) is, up to a constant, the sum of
  - TEXT_WEIGHT times the log likelihood of the text's hashed character n-grams (UTF-8, lower case),
  - log P(declared language | language), from the declarations of all documents,
  - log P(address suffix | language), from the addresses of all documents,
  - log P(language | host), smoothed from host to registered domain to the whole corpus.
The n-gram model is fitted on at most LANGUAGE_ROWS rows of each declared language. The MAX_LANGUAGES languages that most rows
declare have a class of their own; those beyond share the class "mis", in which a row's language is the one that it declares, so
that whatever stands in the declarations, the model is bounded and no declared language is lost. All other counts are grouped
sums of the text posteriors of every document. "und" stands against the languages with evenly likely n-grams, so noise and unknown scripts go to it.

A null or empty text has no n-grams and is "und", not kept. Missing declarations, addresses and hosts add nothing but the
corpus prior. Repeated rows are judged alike. An empty table gives no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewire.functions.once import bind
from tidewire.llm.arrow_slices import leaving_nothing, slices
from tidewire.llm.common import row_name, stored, without
from tidewire.session import text_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of each declared language that the n-gram model is fitted on at most, those with the smallest hashed keys.
LANGUAGE_ROWS = 1000
#: Classes of declared languages, apart from the shared one. With GRAM_BITS it bounds the model: 0.5 MB a class on the driver.
MAX_LANGUAGES = 250
#: Rows that are looked at for each that is chosen for the n-gram model.
SPARE = 4
#: Buckets of hashed n-grams of GRAM bytes.
GRAM_BITS, GRAM = 16, 4
#: Count that a slot has without any n-gram.
UNSEEN = 0.01
#: Weight of the text's likelihood, as neighbouring n-grams are not independent.
TEXT_WEIGHT = 0.25
#: Pseudo-counts of a level's parent, and of a declaration or suffix.
SMOOTHING = 5.0
#: Posterior that an accepted language has at least.
MIN_POSTERIOR = 0.5
UNKNOWN = "und"
#: Class of the languages beyond MAX_LANGUAGES.
OTHER = "mis"


@dataclass(frozen=True)
class Columns:
    """Where a table has its evidence; None where it has none. Suffix and host are read from an address if there is one."""

    key: str = "doc_id"
    text: str = "text"
    declared: str | None = "lang"
    host: str | None = "source"
    address: str | None = None


def gram_slots(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(slots of all n-grams, number of them per text). A text is taken with a space around it; one without letters has none."""
    parts = [f" {t.lower()} ".encode() if t and not t.isspace() else b"" for t in texts]
    data = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint32)
    sizes = np.array([len(p) for p in parts], np.int64)
    if len(data) < GRAM:
        return np.empty(0, np.uint32), np.zeros(len(parts), np.int64)
    code = data[: len(data) - GRAM + 1].copy()
    for i in range(1, GRAM):
        code = (code << np.uint32(8)) | data[i : len(data) - GRAM + 1 + i]
    slots = (code * np.uint32(2654435769)) >> np.uint32(32 - GRAM_BITS)
    counts = np.maximum(sizes - GRAM + 1, 0)
    # n-grams across two texts are left out.
    ends = np.cumsum(sizes)
    inside = np.ones(len(code), bool)
    for back in range(1, GRAM):
        at = ends - back
        inside[at[(at >= 0) & (at < len(code))]] = False
    # Texts shorter than an n-gram mark places of their neighbours' too, but those are out for the same reason.
    return slots[inside], counts


def _gram_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        langs = np.array(batch.column(0).to_pylist(), object)
        texts = batch.column(1).to_pylist()
        for lang in sorted(set(langs)):
            slots, _ = gram_slots([t for t, own in zip(texts, langs) if own == lang])
            found, counts = np.unique(slots, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found.astype(np.int32)), pa.array(counts.astype(np.int64))], ["lang", "slot", "n"])


def _classes(texts: DataFrame) -> dict[str, int]:
    """Rows of each class: the MAX_LANGUAGES commonest languages, and OTHER where there are more."""
    sizes = texts.groupBy("own_lang").agg(F.count("*").alias("n"))
    common = sizes.where(F.col("own_lang") != OTHER).orderBy(F.desc("n"), "own_lang").limit(MAX_LANGUAGES).collect()
    classes = {r["own_lang"]: r["n"] for r in common}
    beyond = sizes.where(~F.col("own_lang").isin(list(classes))).agg(F.sum("n").alias("n")).first()["n"]
    return classes | ({OTHER: beyond} if beyond else {})


def train(docs: DataFrame, columns: Columns = Columns()) -> tuple[list[str], np.ndarray]:
    """(classes, log probabilities of the slots by class) from at most LANGUAGE_ROWS rows of each declared language.

    A language of which no row has a text is not in the model.
    """
    texts = docs.select(F.col(columns.key).alias("own"), _primary(columns.declared).alias("own_lang"), F.col(columns.text).alias("text")).where("own_lang is not null and text <> ''")
    classes = _classes(texts)
    langs = sorted(classes)
    table = np.full((1 << GRAM_BITS, len(langs)), UNSEEN)
    if langs:
        one = F.when(F.col("own_lang").isin(langs), F.col("own_lang")).otherwise(OTHER)
        texts = texts.withColumn("own_lang", one)
        labelled = texts.select(F.col("own").alias("id"), F.col("own_lang").alias("lang"), F.xxhash64("own", "own_lang").alias("draw"))
        # A class of n rows sends on those whose draw is among some SPARE * LANGUAGE_ROWS in n, however many tasks read it.
        limits = F.create_map(*(F.lit(x) for lang, n in classes.items() for x in (lang, _draws(SPARE * LANGUAGE_ROWS / n))))
        rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "id"))
        few = labelled.where(F.col("draw") <= limits[F.col("lang")]).distinct()
        chosen = few.withColumn("rank", rank).where(F.col("rank") <= LANGUAGE_ROWS).select("id", "lang")
        # At most LANGUAGE_ROWS ids of each class are sent to the texts.
        sample = texts.join(F.broadcast(chosen), F.col("own").eqNullSafe(F.col("id")) & (F.col("own_lang") == F.col("lang"))).select("lang", "text")
        counts = sample.mapInArrow(leaving_nothing(_gram_counts), "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
        places = F.create_map(*(F.lit(x) for i, lang in enumerate(langs) for x in (lang, i)))
        rows = counts.select(places[F.col("lang")].alias("place"), "slot", "n").toArrow()  # at most 2^GRAM_BITS a class
        np.add.at(table, (rows.column("slot").to_numpy(), rows.column("place").to_numpy()), rows.column("n").to_numpy())
    table /= table.sum(axis=0)
    return langs, np.log(table, out=table)


def _draws(share: float) -> int:
    """The largest of the smallest 64-bit numbers that make up the share."""
    return min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63)) if share < 1 else (1 << 63) - 1


def _scorer(table: np.ndarray) -> Callable:
    small = table.astype(np.float32)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            slots, counts = gram_slots(batch.column("text").to_pylist())
            likelihood = np.zeros((len(counts), small.shape[1]))
            ends = np.cumsum(counts)
            for i in np.flatnonzero(counts):  # a text at a time, in pieces that stay in the cache
                own = slots[ends[i] - counts[i] : ends[i]]
                for at in range(0, len(own), 1 << 16):
                    likelihood[i] += small[own[at : at + (1 << 16)]].sum(axis=0, dtype=np.float64)
            values = pa.FixedSizeListArray.from_arrays(pa.array(likelihood.ravel()), small.shape[1]).cast(pa.list_(pa.float64()))
            kept = [batch.column(j) for j, name in enumerate(batch.schema.names) if name != "text"]
            names = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays([*kept, values, pa.array(counts)], [*names, "likelihood", "n_grams"])

    return score


def _primary(declared: str | None) -> Column:
    """The language of a tag such as "en-GB"."""
    if declared is None:
        return F.lit(None).cast("string")
    tag = F.lower(F.regexp_extract(F.col(declared).cast("string"), r"^\s*([A-Za-z]{2,8})", 1))
    return F.when(tag != "", tag)


def _host(columns: Columns) -> Column:
    if columns.address:
        name = F.lower(F.regexp_extract(F.col(columns.address), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
        return F.when(name != "", name)
    return F.col(columns.host).cast("string") if columns.host else F.lit(None).cast("string")


def _normal(logs: Column) -> Column:
    """Probabilities from log weights."""
    raised = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, b: a + b))


def _plus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], columns: Columns = Columns()) -> DataFrame:
    """One row per input row: doc_id, language, posterior, text_language, declared, kept, name (of the row, see row_name)."""
    known, table = model
    langs = [*known, UNKNOWN]
    n = len(langs)
    parts = docs.select(
        F.col(columns.key).alias("doc_id"), row_name(columns.key, columns.text).alias("name"), _primary(columns.declared).alias("stated"),
        _host(columns).alias("host"), F.col(columns.text).alias("text"))
    kinds = "doc_id " + dict(parts.dtypes)["doc_id"] + ", name string, stated string, host string, likelihood array<double>, n_grams long"
    text_batches(docs.sparkSession)
    scored = parts.mapInArrow(leaving_nothing(_scorer(table)), kinds)
    noise = F.array(F.col("n_grams") * F.lit(-float(np.log(1 << GRAM_BITS))))
    text_logs = F.transform(F.concat("likelihood", noise), lambda x: x * TEXT_WEIGHT)
    declared = F.when(F.col("stated").isin(known), F.col("stated")).otherwise(F.when(F.col("stated").isNotNull(), OTHER if OTHER in known else UNKNOWN))
    address = F.split("host", r"\.")
    rows = stored(
        scored.withColumn("logs", text_logs).select(
            "doc_id", "name", "host", "stated", "logs", "n_grams", declared.alias("declared"),
            F.when(F.size(address) > 1, F.element_at(address, -1)).alias("suffix"),
            F.array_join(F.slice(address, F.greatest(F.size(address) - 1, F.lit(1)), 2), ".").alias("domain"),
            _normal(F.col("logs")).alias("p")),
        "language-text",
    )

    sums = F.array(*(F.sum(F.get("p", i)) for i in range(n)))
    told = rows.where("n_grams > 0")
    total = told.agg(F.coalesce(sums, F.array(*[F.lit(0.0)] * n)).alias("s")).first()["s"]
    total = [x or 0.0 for x in total]
    prior = [(x + SMOOTHING / n) / (sum(total) + SMOOTHING) for x in total]
    corpus = F.array(*map(F.lit, prior))

    def given_language(column: str) -> DataFrame:
        """log P(value | language) for each value of a column."""
        found = told.where(F.col(column).isNotNull()).groupBy(column).agg(sums.alias("s"))
        share = F.transform("s", lambda x, i: F.ln((x + SMOOTHING / n) / (F.get(F.array(*map(F.lit, total)), i) + SMOOTHING)))
        return found.select(column, share.alias(f"{column}_logs"))

    domains = told.where("domain is not null").groupBy("domain").agg(sums.alias("ds"))
    hosts = told.where("host is not null").groupBy("host", "domain").agg(sums.alias("hs"))
    weigh = lambda s, parent: F.transform(
        F.zip_with(s, parent, lambda x, q: F.struct(x.alias("x"), q.alias("q"))),
        lambda v: (v["x"] + SMOOTHING * v["q"]) / (F.aggregate(s, F.lit(0.0), lambda a, b: a + b) + SMOOTHING))
    by_domain = domains.select("domain", weigh(F.col("ds"), corpus).alias("dp"))
    by_host = hosts.join(by_domain, "domain").select("host", F.transform(weigh(F.col("hs"), F.col("dp")), lambda x: F.ln(x)).alias("host_logs"))

    none = F.array(*[F.lit(0.0)] * n)
    # A missing value matches nothing, so it gets one of its own that spreads it.
    spread = lambda column: F.coalesce(F.col(column), F.concat(F.lit("\u0000"), F.col("name")))
    joined = rows.drop("p")
    for column, side in (("declared", given_language("declared")), ("suffix", given_language("suffix")), ("host", by_host)):
        joined = joined.withColumn("at", spread(column)).join(side.withColumnRenamed(column, "at"), "at", "left").drop("at")
    host_logs = F.coalesce("host_logs", F.transform(corpus, lambda x: F.ln(x)))
    logs = _plus(_plus(F.col("logs"), F.coalesce("declared_logs", none)), _plus(F.coalesce("suffix_logs", none), host_logs))
    fused = joined.withColumn("posteriors", _normal(logs))
    names = F.array(*map(F.lit, langs))
    likeliest = lambda xs: F.get(names, F.array_position(xs, F.array_max(xs)).cast("int") - 1)
    stands_for = F.when(F.col("declared") == OTHER, F.col("stated")).otherwise(OTHER)
    best = lambda xs: bind(likeliest(xs), lambda lang: F.when(lang == OTHER, stands_for).otherwise(lang))
    empty = F.col("n_grams") == 0
    judged = fused.select(
        "doc_id", F.when(empty, UNKNOWN).otherwise(best(F.col("posteriors"))).alias("language"),
        F.round(F.array_max("posteriors"), 6).alias("posterior"), F.when(empty, UNKNOWN).otherwise(best(F.col("logs"))).alias("text_language"),
        "declared", "name")
    kept = (F.col("language") != UNKNOWN) & (F.col("posterior") >= MIN_POSTERIOR)
    return judged.select("doc_id", "language", "posterior", "text_language", "declared", kept.alias("kept"), "name")


def keep_identified(docs: DataFrame, columns: Columns = Columns()) -> DataFrame:
    """docs without the rows whose language is unknown or too uncertain."""
    judged = identify(docs, train(docs, columns), columns)
    rejected = stored(judged.where("not kept").select("name").distinct(), "language-rejected")
    return without(docs, rejected, columns.key, columns.text)
