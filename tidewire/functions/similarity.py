"""Token-sort similarity.

score = 100 * 2 * LCS / (m + n) on names whose words were sorted. The length of the longest common
subsequence comes from the bit-parallel recurrence of Hyyro (2004): one pass over the characters of one
string, with a bit mask of positions in the other string for each character.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidewire.functions.once import bind
from tidewire.functions.text import collapse_ws

WORD_BITS = 61  # S + u stays below 2^62, so additions never overflow a bigint
SET_BITS = 62
_FULL = (1 << WORD_BITS) - 1


def characters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)(.)"), F.lit(1))


def token_sort(text: Column) -> Column:
    """The words of the text in code-point order, joined by blanks."""
    return F.array_join(F.array_sort(F.split(collapse_ws(text), " ")), " ")


def position_masks(text: Column) -> Column:
    """map<character, array<bigint>>: the character's positions as bits, 61 to a word."""
    return bind(characters(text), _masks_of)


def _masks_of(chars: Column) -> Column:
    words = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(chars) - 1) / WORD_BITS).cast("int")))

    def mask(char: Column, word: Column) -> Column:
        part = F.slice(chars, word * WORD_BITS + 1, WORD_BITS)
        bits = F.transform(part, lambda c, i: F.when(c == char, _power_of_two(i)).otherwise(F.lit(0).cast("bigint")))
        return F.aggregate(bits, F.lit(0).cast("bigint"), lambda acc, bit: acc.bitwiseOR(bit))

    return F.map_from_entries(
        F.transform(
            F.array_distinct(chars),
            lambda c: F.struct(c.alias("key"), F.transform(words, lambda w: mask(c, w)).alias("value")),
        )
    )


def character_set(chars: Column) -> Column:
    """The characters as bits of a bigint. One insertion or deletion changes at most one bit."""
    bit = lambda c: _power_of_two(F.ascii(c) % SET_BITS)
    return F.aggregate(chars, F.lit(0).cast("bigint"), lambda acc, c: acc.bitwiseOR(bit(c)))


def _power_of_two(exponent: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), exponent)


def lcs_length(chars: Column, masks: Column, length: Column) -> Column:
    """Longest common subsequence of a character array and a string given by its masks and length."""
    full = F.lit(_FULL).cast("bigint")
    hits = bind(masks, lambda bound: F.transform(chars, lambda c: F.try_element_at(bound, c)))
    # bits at and above the length never get cleared, so the zeros are the matches
    matched_in = lambda state: F.lit(WORD_BITS) - F.bit_count(state)
    one_word = F.aggregate(
        F.transform(hits, lambda h: F.coalesce(F.get(h, F.lit(0)), F.lit(0).cast("bigint"))),
        full,
        lambda state, mask: (state + state.bitwiseAND(mask)).bitwiseOR(state.bitwiseAND(F.bitwise_not(mask))).bitwiseAND(full),
    )
    words = F.floor((length + WORD_BITS - 1) / WORD_BITS).cast("int")
    many_words = F.aggregate(
        F.aggregate(hits, F.array_repeat(full, words), _wide_step), F.lit(0), lambda total, word: total + matched_in(word)
    )
    return F.when(length <= WORD_BITS, matched_in(one_word)).otherwise(many_words)


def _wide_step(state: Column, mask: Column) -> Column:
    """The same step over several words, with the carry of the addition handed upwards."""
    zero = F.lit(0).cast("bigint")
    seed = F.struct(zero.alias("carry"), F.array().cast("array<bigint>").alias("words"))

    def word_step(acc: Column, pair: Column) -> Column:
        hit = pair["state"].bitwiseAND(pair["mask"])
        total = pair["state"] + hit + acc["carry"]
        kept = total.bitwiseAND(F.lit(_FULL).cast("bigint")).bitwiseOR(pair["state"] - hit)
        carry = F.call_function("shiftright", total, F.lit(WORD_BITS))
        return F.struct(carry.alias("carry"), F.array_append(acc["words"], kept).alias("words"))

    pairs = F.zip_with(state, mask, lambda s, m: F.struct(s.alias("state"), F.coalesce(m, zero).alias("mask")))
    return F.when(mask.isNull(), state).otherwise(F.aggregate(pairs, seed, word_step, lambda acc: acc["words"]))


def indel_score(lcs: Column, m: Column, n: Column) -> Column:
    return F.when(m + n == 0, F.lit(100.0)).otherwise(F.lit(200.0) * lcs / (m + n))


def edit_budget(m: Column, n: Column, threshold: float) -> Column:
    """Most insertions and deletions that a pair of lengths m, n may need and still reach the threshold."""
    return F.floor((m + n) * F.lit(100.0 - threshold) / F.lit(100.0) + F.lit(1e-9)).cast("int")


def token_sort_ratio(left: Column, right: Column) -> Column:
    """0..100 similarity of two names, insensitive to word order, sensitive to case."""

    def score(pair: Column) -> Column:
        a, b = pair["a"], pair["b"]
        return indel_score(lcs_length(characters(a), position_masks(b), F.length(b)), F.length(a), F.length(b))

    return bind(F.struct(token_sort(left).alias("a"), token_sort(right).alias("b")), score)
