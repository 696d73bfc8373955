"""Quality rules and a hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Words and pairs of neighbouring words (lower case) are hashed into a fixed number of buckets. Two multinomials over the
buckets, one counted over all documents and one over trusted ones, give each bucket a log ratio; a document's score is the
mean ratio of its n-grams, and the same threshold decides for every document. The table of ratios has a fixed size and
reaches the tasks as one array, so scoring moves no rows at all.

Null texts have no words. Such and other short texts fail the base rules and are never kept. Without trusted documents every
ratio is 0 up to smoothing. Repeated rows are scored alike; repeated labels count once.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from tidewire.functions.once import bind, compute_once
from tidewire.llm.common import whole_text

#: White space between words: space, and tab to carriage return.
SPACE = r"\x20\x09-\x0D"
SYMBOLS = r"#*$%&|<>"
#: Words of the windows whose repetition counts, least words, and the share of repeated words beyond which a text fails.
WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 8, 20, 30
#: Buckets of the hashed n-grams, and what is added to each count.
BUCKETS, SMOOTHING = 1 << 14, 1.0
#: Trusted documents that are taken at most, those with the smallest hashed keys: it bounds the ids that are broadcast.
MAX_TRUSTED = 50_000
#: Mean log ratio that a kept document has at least.
THRESHOLD = -0.1


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")


def _repeated_words(words: Column) -> Column:
    """Words in windows that occur twice or more, the first occurrence included; words are compared by 64-bit hashes."""
    return bind(F.transform(words, lambda w: F.xxhash64(w)), _repeated_hashes)


def _repeated_hashes(words: Column) -> Column:
    hashes = lambda i: [F.get(words, i + k) for k in range(WINDOW)]
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*hashes(i)))

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, i: F.least(F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def repeated(found: Column) -> Column:
        same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
        pairs = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = bind(pairs, lambda s: F.filter(s, lambda x, i: same(x, F.get(s, i + 1)) | ((i > 0) & same(x, F.get(s, i - 1)))))
        return bind(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

    counted = bind(windows, lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), repeated(w)).otherwise(0))
    return F.when(F.size(words) >= WINDOW, counted).otherwise(0)


def _duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    return bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def _buckets(words: Column) -> Column:
    """Buckets of the words and of the pairs of neighbours."""
    def grams(single: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(1), F.size(single) - 1), lambda i: F.xxhash64(F.get(single, i - 1), F.get(single, i)))
        return F.concat(single, F.when(F.size(single) > 1, pairs).otherwise(F.array().cast("array<bigint>")))

    all_grams = bind(F.transform(words, lambda w: F.xxhash64(F.lower(w))), grams)
    return F.transform(all_grams, lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))


def trusted_ids(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """At most MAX_TRUSTED keys of documents labelled as good and not toxic."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0").select(F.col(key).alias("trusted_id")).where("trusted_id is not null")
    return good.distinct().orderBy(F.xxhash64("trusted_id"), "trusted_id").limit(MAX_TRUSTED)


def log_ratios(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text") -> Column:
    """log(P(bucket | trusted) / P(bucket | corpus)) of each bucket, as a constant array; counts cover every document.

    The BUCKETS numbers come to the driver, as lambdas take no subqueries.
    """
    rows = docs.select(F.col(key).alias("doc_id"), whole_text(text).alias("text"))
    flagged = rows.join(F.broadcast(trusted), F.col("doc_id") == F.col("trusted_id"), "left")
    grams = flagged.select(F.col("trusted_id").isNotNull().cast("long").alias("good"), F.explode(_buckets(words_of(F.col("text")))).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("good").alias("good"))
    dense = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left").fillna(0)
    table = dense.agg(F.sort_array(F.collect_list(F.struct("bucket", "raw", "good"))).alias("t"), F.sum("raw").alias("raws"), F.sum("good").alias("goods"))
    share = lambda n, total: F.ln((n + SMOOTHING) / (F.col(total) + SMOOTHING * BUCKETS))
    ratios = table.select(F.transform("t", lambda x: share(x["good"], "goods") - share(x["raw"], "raws"))).first()[0]
    return F.from_json(F.lit(json.dumps(ratios)), "array<double>")


def assess(docs: DataFrame, ratios: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept.

    The score is null for a text without words.
    """
    body = F.col("text")
    rows = compute_once(docs.select(F.col(key).alias("doc_id"), whole_text(text).alias("text")), "words", words_of(body))
    total = F.aggregate(_buckets(F.col("words")), F.lit(0.0), lambda a, b: a + F.get(ratios, b))
    counted = rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + F.char_length(w)).alias("word_chars"),
        F.char_length(F.regexp_replace(body, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        _duplicate_lines(body).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.when(F.size("words") > 0, total / (2 * F.size("words") - 1)).alias("score"))
    once = counted.select("*", F.explode(F.array(F.lit(0))).alias("one")).drop("one")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return once.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.coalesce("score", F.lit(0.0)) >= THRESHOLD))
