"""Spelling variants: words one edit apart, found by asymmetric q-chunks, and the form that a rare spelling stands for.

Of two words one edit apart let s be the shorter (of equal length: either), of L letters, and t the other. s contributes two
disjoint chunks of q = L // 2 letters, t its positional grams of that length. One edit touches one chunk at most: if it lies
behind the first chunk, that one stands at its place in t; else the second one does, moved by the difference of the lengths,
which is the shift of at most one. What is left beside the chunk that was kept holds the edit, so it is cut by the same rule
again, and words meet only where a chunk and a chunk of the rest agree. Candidates are verified by their edit distance in the
condition of the join, each pair at its first shared key only; no pair is lost, and none is made twice.

A key holds about three quarters of a word, so the words that share one are few unless made by hundreds from one word. What is
still hot is the join's affair: adaptive skew joins split either side. Words are counted map-side before anything moves.

Null texts have no words; a null key counts as the empty text before the colon. An empty table gives no rows. Repeated rows
count each time. Only the key and text columns are read, so that other columns can't clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tidewire.llm.common import stored

#: Maximal runs of letters of the shortest length that counts.
MIN_LETTERS, MIN_COUNT = 7, 2
RUN = f"[A-Za-z\\u00C0-\\u00FF]{{{MIN_LETTERS},}}"
#: One run in so many loses a letter, chosen by its hash.
SLIP = 31
#: A word stands for its near word if that one is so many times as frequent.
FORM_FACTOR = 10
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def slipped(key: Column, run: Column) -> Column:
    """The run, without one letter if 31 divides the hash of key and run."""
    hashed = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), run))
    at = F.pmod(hashed, F.char_length(run)).cast("int")
    return F.when(hashed % SLIP == 0, F.concat(F.substring(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all words of at least MIN_LETTERS letters and MIN_COUNT occurrences; only A to Z are lower-cased."""
    runs = docs.select(F.col(key).alias("key"), F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"))
    plain = runs.select("key", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", _UPPER, _LOWER)).otherwise(F.col("run")).alias("run"))
    words = plain.select(slipped(F.col("key"), F.col("run")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return words.where((F.char_length("word") >= MIN_LETTERS) & (F.col("n") >= MIN_COUNT))


def _part(word: Column, start: Column, size: Column) -> Column:
    """size letters from start, counted from 0."""
    return F.substr(word, start + 1, size)


def _cuts(size: Column, shift: Column) -> list[tuple[Column, Column, Column, Column]]:
    """For either chunk of a word of so many letters: (start, length, start and length of the rest that holds the edit), where the
    chunk and rest are looked for in a word longer by shift."""
    q = F.floor(size / 2).cast("int")
    zero = F.lit(0)
    return [(zero, q, q, size - q), (q + shift, q, zero, q)]


def _keys(word: Column, size: Column, shift: Column) -> list[Column]:
    """The four keys under which a word meets those that differ from it in one edit: size is the shorter word's length, shift what
    this word is longer. The rest's first chunk stands where it stood, its second is moved by shift."""
    keys = []
    for i, (start, q, rest, left) in enumerate(_cuts(size, shift)):
        for j, (inner, r, _, _) in enumerate(_cuts(left, shift)):
            keys.append(F.struct(F.lit(2 * i + j).alias("way"), F.xxhash64(
                size, F.lit(2 * i + j), _part(word, start, q), _part(word, rest + inner, r)).alias("key")))
    return keys


def near_pairs(words: DataFrame) -> DataFrame:
    """(s, s_n, t, t_n): all pairs of words (word, n) that differ by exactly one inserted, deleted or replaced letter, each once;
    s is the shorter, or the first in order of code points."""
    word, size = F.col("word"), F.char_length("word")
    chunks = words.select(F.col("word").alias("s"), F.col("n").alias("s_n"), F.inline(F.array(*_keys(word, size, F.lit(0)))))
    grams = words.select(F.col("word").alias("t"), F.col("n").alias("t_n"), F.inline(F.array(
        *_keys(word, size, F.lit(0)), *_keys(word, size - 1, F.lit(1)))))
    s, t = F.col("s"), F.col("t")
    s_size = F.char_length(s)
    shift = F.char_length(t) - s_size
    mine, its = _cuts(s_size, F.lit(0)), _cuts(s_size, shift)
    kept = lambda a, b: _part(s, a[0], a[1]) == _part(t, b[0], b[1])
    # The second chunk counts only where the first one is not kept, on both levels.
    first_outer = ~kept(mine[0], its[0])
    first_inner = [
        ~(_part(s, a[2] + x[0], x[1]) == _part(t, b[2] + y[0], y[1]))
        for a, b in zip(mine, its) for x, y in [(_cuts(a[3], F.lit(0))[0], _cuts(b[3], shift)[0])]]
    way = F.col("way")
    once = (
        F.when(way == 0, F.lit(True)).when(way == 1, first_inner[0]).when(way == 2, first_outer).otherwise(first_outer & first_inner[1]))
    met = chunks.join(grams, ["key", "way"]).where(
        ((shift == 1) | (s < t)) & once & (F.levenshtein(s, t, 1) == 1))
    return met.select("s", "s_n", "t", "t_n")


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """(word, root) by following forms to the last. A form is FORM_FACTOR times as frequent as its word, which bounds the steps by
    the logarithm of the largest count; each round doubles the steps followed."""
    steps = int(math.log(max(most, 1), FORM_FACTOR)) + 1
    roots = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        roots = stored(roots.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root")), "spelling-roots")
    return roots


def variant_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per word: word, form (the near word it stands for, or null), root, n, n_near, form_n."""
    words = stored(vocabulary(docs, key, text), "spelling-words")
    pairs = near_pairs(words)
    ends = pairs.select(F.inline(F.array(
        F.struct(F.col("s").alias("word"), F.col("t").alias("other"), F.col("t_n").alias("other_n")),
        F.struct(F.col("t").alias("word"), F.col("s").alias("other"), F.col("s_n").alias("other_n")))))
    # Strings compare by their bytes in UTF-8, which is the order of code points.
    best = ends.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    stands = -F.col("best.less") >= FORM_FACTOR * F.col("n")
    judged = stored(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(stands, F.col("best.other")).alias("form"), F.when(stands, -F.col("best.less")).alias("form_n")),
        "spelling-forms")
    most = words.agg(F.max("n")).first()[0] or 0
    roots = _roots(judged.where("form is not null"), most)
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
