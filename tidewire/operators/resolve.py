"""Name resolution against an ordered dictionary in four tiers.

Exact and cleaned-exact tiers are equi-joins. The fuzzy tier finds the best-scoring entry:
- a dictionary of at most INLINE_LIMIT names (checked) becomes an array literal that each row scans behind a
  length and edit-distance filter, so the tier needs no join and no shuffle;
- a larger one is joined on rare grams (prefix filter): a pair that reaches the threshold shares a known number of grams, so one
  of the rarest of either. The equi-join on these loses no pair, at any threshold.
Both give the same rows.
"""

from __future__ import annotations

import json
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewire import fixed_values as fixed
from tidewire.functions.links import spread_missing
from tidewire.functions.names import clean_name, is_blank
from tidewire.functions.once import bind, compute_once
from tidewire.functions.similarity import (
    SET_BITS,
    WORD_BITS,
    character_set,
    characters,
    edit_budget,
    indel_score,
    lcs_length,
    position_masks,
    token_sort,
)
from tidewire.functions.text import non_empty, strip_ws
from tidewire.operators.bounds import rows_within

INLINE_LIMIT = 2000
#: Rare grams that a candidate pair must share, where its lengths ask for so many: one more makes prefixes longer by one and pairs fewer.
COMMON_GRAMS = 4
_ENTRY = "array<struct<pos:int,canonical:string,sorted:string,n:int,low:int,high:int,chars:bigint,masks:map<string,array<bigint>>>>"

_BEST = "struct<score:double,order:int,canonical:string>"


def dictionary_frame(spark: SparkSession, names: list[str] | None = None) -> DataFrame:
    """(pos, canonical) of an ordered name list; the fixed one by default."""
    names = fixed.CANONICAL_NAMES if names is None else names
    return spark.createDataFrame(pa.table({"pos": pa.array(range(len(names)), pa.int32()), "canonical": names}))


def distinct_names(*sources: DataFrame) -> DataFrame:
    """Set union of one-column name tables without NULL and blank names, as raw_name."""
    named = [s.toDF("raw_name") for s in sources]
    union = named[0]
    for other in named[1:]:
        union = union.unionByName(other)
    return union.where(~is_blank(F.col("raw_name"))).distinct()


def _entry(row, threshold: float) -> dict:
    """A dictionary row as the literal holds it: the same sorted form, character set and masks that columns get,
    and the shortest and longest name that can reach the threshold."""
    text = " ".join(sorted(row["form"].split()))
    masks: dict[str, list[int]] = {}
    for place, char in enumerate(text):
        words = masks.setdefault(char, [0] * -(-len(text) // WORD_BITS))
        words[place // WORD_BITS] |= 1 << place % WORD_BITS
    return {
        "pos": row["pos"], "canonical": row["canonical"], "sorted": text, "n": len(text),
        "low": math.ceil(len(text) * threshold / (200.0 - threshold) - 1e-9),
        "high": math.floor(len(text) * (200.0 - threshold) / threshold + 1e-9) if threshold > 0 else 2**31 - 1,
        "chars": sum(1 << bit for bit in {ord(char) % SET_BITS for char in text}), "masks": masks,
    }


class Dictionary:
    """A dictionary prepared for lookups: checked for size once, its rows at hand when it is small."""

    def __init__(self, entries: DataFrame, inline_limit: int = INLINE_LIMIT, processor: str | None = None):
        self.processor = processor
        named = entries.select(F.col("pos").cast("int"), "canonical").where("canonical IS NOT NULL").withColumn("key", F.lower("canonical"))
        named = named.withColumn("form", self.processed(F.col("canonical")))
        self.rows = rows_within(named, inline_limit)
        if self.rows is None:
            self.entries = (
                named.withColumn("sorted", token_sort(F.col("form")))
                .drop("form")
                .withColumn("n", F.length("sorted"))
                .withColumn("masks", position_masks(F.col("sorted")))
            )
        else:
            found = {r["key"]: r["canonical"] for r in sorted(self.rows, key=lambda r: r["pos"])}
            keys = pa.table({"key": pa.array(found.keys(), pa.string()), "found": pa.array(found.values(), pa.string())})
            self.small = F.broadcast(entries.sparkSession.createDataFrame(keys))

    def processed(self, name: Column) -> Column:
        """The form that the fuzzy tier compares."""
        return F.lower(name) if self.processor == "lower" else name

    def lookup(self) -> DataFrame:
        """One canonical name per lower-cased key; the later position wins."""
        return self._latest() if self.rows is None else self.small

    def literal(self, threshold: float) -> Column:
        """All entries as one constant array."""
        entries = [_entry(row, threshold) for row in self.rows]
        return F.from_json(F.lit(json.dumps(entries, ensure_ascii=False)), _ENTRY)

    def budgets(self, threshold: float) -> Column:
        """Edits allowed by the sum of two lengths, for all sums that can reach the threshold; NULL beyond."""
        longest = max((len(row["form"]) for row in self.rows), default=0)
        sums = math.floor(longest * 200.0 / threshold + 1e-9) if threshold > 0 else 0
        return F.lit([math.floor(total * (100.0 - threshold) / 100.0 + 1e-9) for total in range(sums + 1)])

    def _latest(self) -> DataFrame:
        return self.entries.groupBy("key").agg(F.max_by("canonical", "pos").alias("found"))


def add_exact(names: DataFrame, dictionary: Dictionary) -> DataFrame:
    """+ stripped, exact_name."""
    keyed = names.withColumn("stripped", strip_ws(F.col("raw_name"))).withColumn("k", F.lower("stripped"))
    found = dictionary.lookup().select(F.col("key").alias("k"), F.col("found").alias("exact_name"))
    return keyed.join(found, "k", "left").drop("k")


def add_cleaned_exact(names: DataFrame, dictionary: Dictionary) -> DataFrame:
    """+ cleaned, cleaned_name; only names without exact_name are looked up."""
    cleaned = names.withColumn("cleaned", clean_name(F.col("stripped")))
    wanted = F.when(F.col("exact_name").isNull(), F.lower("cleaned"))
    keyed = cleaned.withColumn("k", spread_missing(wanted, F.col("raw_name")))
    found = dictionary.lookup().select(F.col("key").alias("k"), F.col("found").alias("cleaned_name"))
    return keyed.join(found, "k", "left").drop("k")


def _close_enough(target: dict[str, Column], entry: dict[str, Column], edits: Column) -> Column:
    """No pair within the edits fails: neither its character sets nor its strings differ by more than its insertions
    and deletions. The cheap test goes first."""
    sets_differ_by = F.bit_count(target["set"].bitwiseXOR(entry["set"]))
    return (sets_differ_by <= edits) & (F.call_function("levenshtein", target["text"], entry["text"], edits) >= 0)


def _best_inline(t: Column, dictionary: Dictionary, threshold: float) -> Column:
    """struct<score,order,canonical> of the best entry at or above the threshold, NULL without one."""
    size, budgets = t["size"], dictionary.budgets(threshold)

    def near(d: Column) -> Column:
        edits = F.get(budgets, size + d["n"]) if threshold > 0 else size + d["n"]
        close = _close_enough({"text": t["text"], "set": t["set"]}, {"text": d["sorted"], "set": d["chars"]}, edits)
        return (size >= d["low"]) & (size <= d["high"]) & close

    def scored(d: Column) -> Column:
        score = indel_score(lcs_length(t["chars"], d["masks"], d["n"]), size, d["n"])
        return F.struct(score.alias("score"), (-d["pos"]).alias("order"), d["canonical"].alias("canonical"))

    found = F.transform(F.filter(dictionary.literal(threshold), near), scored)
    return F.array_max(F.filter(found, lambda s: s["score"] >= threshold))


def _checked(threshold: float) -> None:
    if not 0 <= threshold <= 100:
        raise ValueError("a threshold lies between 0 and 100")


def best_matches(targets: DataFrame, dictionary: Dictionary, threshold: float) -> DataFrame:
    """Best entry at or above the threshold (0 to 100) for each distinct target: (target, best)."""
    _checked(threshold)
    sized = targets.select("target").distinct()
    if dictionary.rows is not None:
        best = _with_best(sized, dictionary, threshold).select("target", "best")
    else:
        best = _best_by_grams(sized.withColumn("m", F.length("target")), dictionary.entries, threshold)
    return best.where(F.col("best.score") >= threshold)


def _with_best(df: DataFrame, dictionary: Dictionary, threshold: float) -> DataFrame:
    """df(target) + best, by the literal dictionary; NULL targets stay without one."""
    text = F.col("target")
    parts = bind(
        characters(text),
        lambda chars: F.struct(
            text.alias("text"), F.length(text).alias("size"), chars.alias("chars"), character_set(chars).alias("set")
        ),
    )
    # split once per target, not once per entry
    split = compute_once(df, "_t", F.when(text.isNotNull(), parts))
    best = _best_inline(F.col("_t"), dictionary, threshold)
    return compute_once(split, "best", F.when(text.isNotNull(), best)).drop("_t")


def _needed(m: Column, n: Column, threshold: float) -> Column:
    """Characters that strings of lengths m and n must have in common, in order, to reach the threshold."""
    return F.ceil((m + n) * F.lit(threshold / 200.0) - F.lit(1e-9)).cast("int")


def _gram_size(threshold: float) -> int:
    """Pairs of characters tell more than single ones, but only above two thirds must similar strings share any."""
    return 2 if threshold > 67.0 else 1


def _shared_grams(m: Column, n: Column, threshold: float) -> Column:
    """Grams that strings of lengths m and n share at least if they reach the threshold.

    Single characters: those they must have in common. Pairs, with a mark at either end: of m + 1 pairs each of the m - needed
    characters that only the one string has breaks two, and each of the n - needed of the other breaks one.
    """
    needed = _needed(m, n, threshold)
    return F.greatest(F.lit(1), needed if _gram_size(threshold) == 1 else 3 * needed - m - n + 1)


def _shortest(m: Column, threshold: float) -> Column:
    """The least length of a string that can reach the threshold with one of length m."""
    return F.ceil(m * F.lit(threshold / (200.0 - threshold)) - F.lit(1e-9)).cast("int")


def _grams(text: Column, threshold: float) -> Column:
    """array<string>: the grams of a text, equal ones told apart by a number, so that common grams count as often as they occur."""
    def pieces(chars: Column) -> Column:
        if _gram_size(threshold) == 1:
            return chars
        marked = F.concat(F.array(F.lit("")), chars, F.array(F.lit("")))
        return F.transform(F.sequence(F.lit(1), F.size(chars) + 1), lambda i: F.concat_ws("\x1f", F.get(marked, i - 1), F.get(marked, i)))

    def numbered(grams: Column) -> Column:
        before = lambda g, i: F.size(F.filter(F.slice(grams, F.lit(1), i), lambda other: other == g))
        return F.transform(grams, lambda g, i: F.concat_ws("\x1e", g, before(g, i).cast("string")))

    return bind(bind(characters(text), pieces), numbered)


def _rare_grams(strings: DataFrame, text: str, length: str, counts: DataFrame, threshold: float) -> DataFrame:
    """(text, length, gram, at): the first grams of each string, rarest first, as many as it takes to meet all similar strings."""
    c = F.col
    spread = strings.select(text, length, F.explode(_grams(c(text), threshold)).alias("gram"))
    ranked = spread.join(counts, "gram", "left").select(text, length, F.struct(F.coalesce("times", F.lit(0)).alias("times"), "gram").alias("g"))
    lists = ranked.groupBy(text, length).agg(F.sort_array(F.collect_list("g")).alias("all"))
    kept = F.size("all") - _shared_grams(c(length), _shortest(c(length), threshold), threshold) + COMMON_GRAMS
    first = lists.select(text, length, F.posexplode(F.slice("all", F.lit(1), F.greatest(F.lit(0), kept))).alias("at", "g"))
    return first.where("g.times > 0").select(text, length, c("g.gram").alias("gram"), "at")


def _gram_counts(entries: DataFrame, threshold: float) -> DataFrame:
    return entries.select(F.explode(_grams(F.col("sorted"), threshold)).alias("gram")).groupBy("gram").agg(F.count("*").alias("times"))


def candidate_pairs(targets: DataFrame, entries: DataFrame, threshold: float) -> DataFrame:
    """(target, m, sorted, n): pairs of different strings that share some of their rarest grams and may reach the threshold.

    Of two strings that share k grams, the j-th that they share, rarest first, lies among the first size - k + j of either
    (Bayardo, Ma, Srikant, 2007; Wang, Li, Feng, 2012), so their prefixes have COMMON_GRAMS in common, or k if that is less. Behind the
    first of them either has room for the other k - 1, else the pair is out.
    """
    c = F.col
    counts = _gram_counts(entries, threshold)
    left = _rare_grams(targets.select("target", "m"), "target", "m", counts, threshold).withColumnRenamed("at", "at_m")
    right = _rare_grams(entries.select("sorted", "n").distinct(), "sorted", "n", counts, threshold).withColumnRenamed("at", "at_n")
    more = 0 if _gram_size(threshold) == 1 else 1
    fits = F.least("m", "n") >= _needed(c("m"), c("n"), threshold)
    met = left.join(right, "gram").where(fits).groupBy("target", "m", "sorted", "n").agg(
        F.count("*").alias("common"), F.min("at_m").alias("at_m"), F.min("at_n").alias("at_n"))
    room = F.least(c("m") + more - c("at_m"), c("n") + more - c("at_n"))
    shared = _shared_grams(c("m"), c("n"), threshold)
    return met.where((c("common") >= F.least(F.lit(COMMON_GRAMS), shared)) & (room >= shared)).select("target", "m", "sorted", "n")


def _best_by_grams(targets: DataFrame, entries: DataFrame, threshold: float) -> DataFrame:
    """(target, best) by an equi-join on rare grams; at threshold 0 the first entry is best for names that share no character with any."""
    c = F.col
    worded = targets.where("m > 0")
    pairs = candidate_pairs(worded, entries.where("n > 0"), threshold)
    both = compute_once(pairs, "sets", F.struct(character_set(characters(c("target"))).alias("t"), character_set(characters(c("sorted"))).alias("d")))
    edits = edit_budget(c("m"), c("n"), threshold)
    near = _close_enough({"text": c("target"), "set": c("sets.t")}, {"text": c("sorted"), "set": c("sets.d")}, edits)
    # the masks join in when few pairs are left
    scored = both.where(near).select("target", "m", "sorted").join(entries, "sorted")
    score = indel_score(lcs_length(characters(c("target")), c("masks"), c("n")), c("m"), c("n"))
    rows = scored.select("target", score.alias("score"), "pos", "canonical")
    empty = targets.where("m = 0").select("target").join(entries.where("n = 0"), c("target") == c("sorted"))
    rows = rows.unionByName(empty.select("target", F.lit(100.0).alias("score"), "pos", "canonical"))
    if threshold == 0:
        first = entries.agg(F.min(F.struct("pos", "canonical")).alias("first")).select("first.*").first()
        rows = rows.unionByName(targets.select("target", F.lit(0.0).alias("score"), F.lit(first["pos"]).alias("pos"), F.lit(first["canonical"]).alias("canonical")))
    best = F.max(F.struct("score", (-c("pos")).alias("order"), "canonical"))
    return rows.where(c("pos").isNotNull()).groupBy("target").agg(best.alias("best"))


def add_fuzzy(names: DataFrame, dictionary: Dictionary, threshold: float) -> DataFrame:
    """+ best (struct score, order, canonical) for names that no equi tier resolved."""
    text = dictionary.processed(F.coalesce(non_empty(F.col("cleaned")), F.col("stripped")))
    missed = F.col("exact_name").isNull() & F.col("cleaned_name").isNull()
    targeted = names.withColumn("target", F.when(missed, token_sort(text)))
    if dictionary.rows is not None:
        return _with_best(targeted, dictionary, threshold).drop("target")
    wanted = targeted.where(F.col("target").isNotNull())
    best = best_matches(wanted, dictionary, threshold).select(F.col("target").alias("k"), "best")
    keyed = targeted.withColumn("k", spread_missing(F.col("target"), F.col("raw_name")))
    return keyed.join(best, "k", "left").drop("k", "target")


def resolve_entities(
    names: DataFrame,
    dictionary: DataFrame,
    threshold: float = fixed.FUZZY_THRESHOLD,
    inline_limit: int = INLINE_LIMIT,
    processor: str | None = None,
) -> DataFrame:
    """(raw_name, canonical_name, match_type, score) for each row of names(raw_name).

    processor='lower' compares lower-cased names in the fuzzy tier; the default is case-sensitive.
    """
    _checked(threshold)
    table = Dictionary(dictionary, inline_limit, processor)
    tiers = add_fuzzy(add_cleaned_exact(add_exact(names, table), table), table, threshold)
    exact, cleaned = F.col("exact_name").isNotNull(), F.col("cleaned_name").isNotNull()
    fuzzy = F.col("best").isNotNull()
    fallback_name = F.coalesce(non_empty(F.col("cleaned")), F.col("stripped"))
    return tiers.select(
        "raw_name",
        F.when(exact, F.col("exact_name"))
        .when(cleaned, F.col("cleaned_name"))
        .when(fuzzy, F.col("best.canonical"))
        .otherwise(fallback_name)
        .alias("canonical_name"),
        F.when(exact, "EXACT").when(cleaned, "CLEANED_EXACT").when(fuzzy, "FUZZY").otherwise("FALLBACK").alias("match_type"),
        F.when(exact | cleaned, F.lit(100.0)).when(fuzzy, F.bround(F.col("best.score"), 2)).alias("score"),
    )


def matched(mapping: DataFrame) -> DataFrame:
    return mapping.where(F.col("match_type").isin(*fixed.MATCHED_TYPES))


def match_type_summary(mapping: DataFrame) -> DataFrame:
    return mapping.groupBy("match_type").agg(
        F.count("*").alias("names"),
        F.round(F.avg("score"), 2).alias("avg_score"),
        F.min("score").alias("min_score"),
    )
