"""Publication dates."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, functions as F

from tidewire import fixed_values as fixed
from tidewire.functions.once import bind
from tidewire.functions.text import collapse_ws, non_empty

# day, month, year, hour, minute, second, zone of a mail date; the weekday is ignored
_MAIL_DATE = (
    r"(?i)\A(?:[a-z]{3,9}\.?,?\s+)?(\d{1,2})[\s-]+([a-z]{3})[a-z]*[\s-]+(\d{4}|\d{2})"
    r"(?:,?\s+(\d{1,2})[:.](\d{2})(?:[:.](\d{2})(?:\.\d+)?)?)?(?:\s*([+-]\d{2}:?\d{2}|[a-z]{1,5}))?(?:\s*\([^)]*\))?\z"
)
_ISO_DATE = r"\A\d{4}-\d{2}-\d{2}"
# year; month and day, apart or run together; hour, minute, second, fraction, zone
_ISO_FORMS = (
    r"(?i)\A(\d{4})(?:-(\d{2})-(\d{2})|(\d{2})(\d{2}))"
    r"(?:[t ](\d{2}):?(\d{2})(?::?(\d{2})(?:[.,](\d{1,9}))?)?\s*(z|[+-]\d{2}(?::?\d{2})?)?)?\z"
)
_ISO_WEEK = r"(?i)\A(\d{4})-?w(\d{2})(?:-?([1-7]))?\z"
# a number of units before or after now, with a second unit at times
_UNITS = r"(?:second|sec|minute|min|hour|day|week|month|year)"
_AGO = rf"(?i)\A(in )?(an?|\d{{1,6}})\s+({_UNITS})s?(?:,?\s+(?:and\s+)?(an?|\d{{1,6}})\s+({_UNITS})s?)?( ago)?\z"
_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2}))?\s*(am|pm|a\.m\.|p\.m\.)?"
_ZONE = r"([+-]\d{2}:?\d{2}|[a-z]{1,5})"
# month name, day, year and an optional clock and zone; the same with the year last; and with slashes
_LONG_DATE = rf"(?i)\A(?:[a-z]{{3,9}}\.?,?\s+)?([a-z]{{3}})[a-z]*\.?\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})(?:,?\s+(?:at\s+)?{_CLOCK}(?:\s*{_ZONE})?)?\z"
_YEAR_LAST = rf"(?i)\A(?:[a-z]{{3,9}}\.?,?\s+)?([a-z]{{3}})[a-z]*\.?\s+(\d{{1,2}})\s+{_CLOCK}\s+(?:{_ZONE}\s+)?(\d{{4}})\z"
_SLASHES = rf"(?i)\A(?:(\d{{4}})/(\d{{1,2}})/(\d{{1,2}})|(\d{{1,2}})/(\d{{1,2}})/(\d{{4}}))(?:,?\s+{_CLOCK}(?:\s*{_ZONE})?)?\z"
_UNIT_SECONDS = {"second": 1, "sec": 1, "minute": 60, "min": 60, "hour": 3600, "day": 86400, "week": 604800}


def now_literal(now: datetime | str | Column) -> Column:
    if isinstance(now, Column):
        return now
    text = now.strftime("%Y-%m-%d %H:%M:%S") if isinstance(now, datetime) else now
    return F.lit(text).cast("timestamp")


def _with_groups(text: Column, pattern: str, count: int, build: Callable[..., Column]) -> Column:
    """build(group 1, ..., group count) in a single pass of the pattern; absent groups are empty, no match gives NULL.

    The patterns match whole texts and none of them takes a bar, so a text that matched is never left as it was.
    """
    marks = "|".join(f"${i}" for i in range(1, count + 1))

    def parts(marked: Column) -> Column:
        return bind(F.split(marked, r"\|", -1), lambda p: build(*[F.get(p, F.lit(i)) for i in range(count)]))

    return bind(F.regexp_replace(text, pattern, marks), lambda marked: F.when(marked != text, parts(marked)))


def _month_number(name: Column) -> Column:
    table = F.array(*[F.lit(m) for m in fixed.MONTHS])
    return F.array_position(table, F.lower(name))


def _clock_cast(year, month, day, hour, minute, second, offset: Column) -> Column:
    two = lambda c: F.lpad(F.coalesce(non_empty(c), F.lit("0")), 2, "0")
    return F.concat(
        year, F.lit("-"), F.lpad(month.cast("string"), 2, "0"), F.lit("-"), two(day), F.lit(" "),
        two(hour), F.lit(":"), two(minute), F.lit(":"), two(second), offset,
    ).try_cast("timestamp")


def _offset(zone: Column) -> Column:
    """+hh:mm of a numeric zone or of a known zone name; UTC for others and for none."""
    names = F.create_map(*[F.lit(x) for pair in fixed.ZONE_OFFSETS.items() for x in pair])
    digits = F.rpad(F.regexp_replace(zone, ":", ""), 5, "0")
    numeric = F.concat(F.substring(digits, 1, 3), F.lit(":"), F.substring(digits, 4, 2))
    named = F.coalesce(F.try_element_at(names, F.upper(zone)), F.lit("+00:00"))
    return F.when(zone.rlike(r"\A[+-]"), numeric).otherwise(named)


def _day_hour(hour: Column, half: Column) -> Column:
    """The hour of a clock with or without AM and PM."""
    number = hour.try_cast("int")
    afternoon = F.lower(F.substring(half, 1, 1)) == "p"
    return F.when(half == "", hour).when((number < 1) | (number > 12), "99").otherwise(
        (number % 12 + F.when(afternoon, 12).otherwise(0)).cast("string"))


def _mail_date(text: Column) -> Column:
    def build(day, month, year, hour, minute, second, zone):
        century = F.when(F.length(year) == 4, F.lit("")).when(year > "68", F.lit("19")).otherwise(F.lit("20"))
        return _clock_cast(F.concat(century, year), _month_number(month), day, hour, minute, second, _offset(zone))

    return _with_groups(text, _MAIL_DATE, 7, build)


def _iso_date(text: Column) -> Column:
    """What a cast reads, which is most; then the compact, comma and week forms."""
    def build(year, month, day, month_, day_, hour, minute, second, fraction, zone):
        whole = F.concat(F.lpad(F.coalesce(non_empty(second), F.lit("0")), 2, "0"), F.when(fraction != "", F.concat(F.lit("."), F.substring(fraction, 1, 6))).otherwise(""))
        date = F.concat_ws("-", year, F.concat(month, month_), F.concat(day, day_))
        clock = F.concat_ws(":", F.coalesce(non_empty(hour), F.lit("00")), F.coalesce(non_empty(minute), F.lit("00")), whole)
        return F.concat(date, F.lit(" "), clock, F.when(F.lower(zone) == "z", "+00:00").otherwise(_offset(zone))).try_cast("timestamp")

    def week(year, number, day):
        fourth = F.concat(year, F.lit("-01-04")).cast("date")
        monday = F.date_sub(fourth, F.weekday(fourth))
        past = (number.cast("int") - 1) * 7 + F.coalesce(non_empty(day).cast("int"), F.lit(1)) - 1
        return F.when(number.cast("int").between(1, 53), F.date_add(monday, past).cast("timestamp"))

    digits = text.rlike(r"\A\d{4}[-\dwW]")
    plain = F.when(text.rlike(_ISO_DATE), text.try_cast("timestamp"))
    return F.when(digits, F.coalesce(plain, _with_groups(text, _ISO_FORMS, 10, build), _with_groups(text, _ISO_WEEK, 3, week)))


def _spoken_date(text: Column, now: Column) -> Column:
    units = F.create_map(*[F.lit(x) for pair in _UNIT_SECONDS.items() for x in pair])
    months = F.create_map(F.lit("month"), F.lit(1), F.lit("year"), F.lit(12))

    def ago(ahead, amount, unit, amount_, unit_, back):
        def number(x):
            return F.when(x.isin("a", "an"), F.lit(1)).otherwise(F.coalesce(x.try_cast("int"), F.lit(0)))
        sign = F.when(ahead != "", F.lit(1)).otherwise(F.lit(-1))
        total = lambda table: sum(number(n) * F.coalesce(F.try_element_at(table, u), F.lit(0)) for n, u in ((amount, unit), (amount_, unit_)))
        moved = now + F.make_ym_interval(F.lit(0), sign * total(months))
        return F.when((ahead != "") != (back != ""), F.timestamp_seconds(F.unix_timestamp(moved) + sign * total(units)))

    def long_date(month, day, year, hour, minute, second, half, zone):
        return _clock_cast(year, _month_number(month), day, _day_hour(hour, half), minute, second, _offset(zone))

    def year_last(month, day, hour, minute, second, half, zone, year):
        return long_date(month, day, year, hour, minute, second, half, zone)

    def slashes(year, month, day, month_, day_, year_, hour, minute, second, half, zone):
        number = F.coalesce(non_empty(month), month_).try_cast("int")
        return _clock_cast(F.concat(year, year_), number, F.concat(day, day_), _day_hour(hour, half), minute, second, _offset(zone))

    lowered = F.lower(text)
    return F.coalesce(
        F.when(lowered.isin("now", "today"), now).when(lowered == "yesterday", now - F.expr("INTERVAL 1 DAY")),
        _with_groups(lowered, _AGO, 6, ago),
        _with_groups(text, _LONG_DATE, 8, long_date),
        _with_groups(text, _YEAR_LAST, 8, year_last),
        F.when(text.contains("/"), _with_groups(text, _SLASHES, 11, slashes)),
    )


def parse_date(text: Column, now: datetime | str | Column) -> Column:
    """UTC timestamp of an ISO date, a mail date or a bounded set of spoken dates; NULL when none fits.

    ISO: also compact, by week, with commas. Spoken: now, today, yesterday, 'N units [M units] ago', 'in N units',
    'Month d, yyyy [clock [zone]]', 'Month d clock [zone] yyyy', 'm/d/yyyy' and 'yyyy/m/d' with clocks, AM and PM.
    """
    moment = now_literal(now)
    return bind(collapse_ws(text), lambda flat: F.coalesce(_iso_date(flat), _mail_date(flat), _spoken_date(flat, moment)))


def fmt_iso(moment: Column) -> Column:
    return F.date_format(moment, fixed.ISO_FORMAT)


def is_fresh(moment: Column, now: datetime | str | Column, hours: int = fixed.FRESH_HOURS) -> Column:
    """True within the last hours, both ends included; NULL moments are not fresh."""
    current = now_literal(now)
    return moment.between(current - F.expr(f"INTERVAL {hours} HOURS"), current)
