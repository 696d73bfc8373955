"""Text cleaning and chunking."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidewire import fixed_values as fixed
from tidewire.functions.once import bind

_SPACES = f"[{fixed.WHITESPACE}]+"


def collapse_ws(text: Column) -> Column:
    """Every run of Unicode white space becomes one blank; none at the ends."""
    return F.trim(F.regexp_replace(text, _SPACES, " "))


def strip_ws(text: Column) -> Column:
    """Unicode white space removed at both ends only."""
    return F.regexp_replace(text, rf"\A{_SPACES}|{_SPACES}\z", "")


def non_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def fallback(*choices: Column) -> Column:
    """First choice that is neither NULL nor empty."""
    return F.coalesce(*[non_empty(c) for c in choices])


def clean_html(raw: Column) -> Column:
    """Visible text of a page: script-like blocks, inline images and tags go, entities stay as written."""
    text = F.regexp_replace(raw, fixed.HTML_BLOCK_PATTERN, " ")
    text = F.regexp_replace(text, fixed.HTML_IMAGE_PATTERN, "")
    return collapse_ws(F.regexp_replace(text, fixed.HTML_TAG_PATTERN, " "))


def chunk_payload(text: Column, max_chars: Column | int = fixed.CHUNK_CHARS) -> Column:
    """At most max_chars characters, ending at the last full stop where the cut text has one."""
    limit = F.lit(max_chars) if isinstance(max_chars, int) else max_chars
    return F.when(F.length(text) <= limit, text).otherwise(_to_last_stop(F.substring(text, F.lit(1), limit)))


def _to_last_stop(head: Column) -> Column:
    after_stop = F.instr(F.reverse(head), ".") - 1  # characters behind the last full stop, -1 without one
    return F.when(after_stop >= 0, F.substring(head, F.lit(1), F.length(head) - after_stop)).otherwise(head)


def shrink_ladder(text: Column, max_chars: int = fixed.CHUNK_CHARS, steps: Column | int = 3) -> Column:
    """array<struct<step,text,length>>: the first chunk, then each rung cut to half of the one before. NULL steps give NULL."""
    count = F.lit(steps) if isinstance(steps, int) else steps

    def rung(step: Column, body: Column) -> Column:
        return F.struct(step.alias("step"), body.alias("text"), F.length(body).alias("length"))

    def halved(last: Column, step: Column) -> Column:
        half = F.floor(last["length"] / 2).cast("int")
        cut = bind(F.substring(last["text"], F.lit(1), half), _to_last_stop)
        return bind(F.when(last["length"] <= half, last["text"]).otherwise(cut), lambda body: rung(step, body))

    def longer(done: Column, step: Column) -> Column:
        return F.concat(done, F.array(bind(F.element_at(done, -1), lambda last: halved(last, step))))

    first = bind(chunk_payload(text, max_chars), lambda body: rung(F.lit(0), body))
    numbers = F.when(count > 0, F.sequence(F.lit(1), F.greatest(F.lit(1), count))).when(count.isNotNull(), F.array().cast("array<int>"))
    return F.aggregate(numbers, F.array(first), longer)


def fit_to_budget(ladder: Column, budget: int) -> Column:
    """First rung within the budget, else the last rung."""
    fits = F.filter(ladder, lambda rung: rung["length"] <= budget)
    return F.coalesce(F.try_element_at(fits, F.lit(1)), F.element_at(ladder, -1))
