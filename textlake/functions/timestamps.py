"""Mixed-format timestamp parsing.

A text is taken apart into date, time of day and zone by its shape, and the parts are put
together as a UTC instant. Nothing depends on the zone of the session.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names by their first three letters, in order.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
MONTH_NAME = (
    "(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|"
    "sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)")
WEEKDAY = r"(?i)^(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?\.?,?\s+"

# Time of day at the end of a text: hour, minute, second, fraction, half of the day, zone.
CLOCK = (r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?\s*([ap]\.?m\.?)?"
         r"\s*(z|utc|gmt|[+-]\d{2}(?::?\d{2})?)?")
TIMED = r"(?i)^(.*?\d.*?)(?:t|,?\s+|:)\s*(?:at\s+)?(?:" + CLOCK + r")$"
COMPACT = r"^(\d{4})(\d{2})(\d{2})(?:[Tt]?(\d{2})(\d{2})(\d{2})?([Zz])?)?$"

ORDINAL = r"(?:st|nd|rd|th)?"
# Shapes of a date and the places of year, month and day in them.
DATES = [
    (r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})$", (1, 2, 3)),
    (rf"(?i)^({MONTH_NAME})\.?[\s-]+(\d{{1,2}}){ORDINAL},?[\s-]+(\d{{4}}|\d{{2}})$", (3, 1, 2)),
    (rf"(?i)^(\d{{1,2}}){ORDINAL}(?:\s+of)?[\s-]+({MONTH_NAME})\.?,?[\s-]+(\d{{4}}|\d{{2}})$", (3, 2, 1)),
    (rf"(?i)^(\d{{4}})[\s-]+({MONTH_NAME})\.?[\s-]+(\d{{1,2}})$", (1, 2, 3)),
    (rf"(?i)^({MONTH_NAME})\.?,?\s+(\d{{4}})()$", (2, 1, 3)),
    (r"^(\d{4})-(\d{1,2})()$", (1, 2, 3)),
    (r"^(\d{4})()()$", (1, 2, 3)),
]
NUMERIC = r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4}|\d{2})$"


# ISO dates, with hyphens or slashes, alone or with a time of day in UTC
PLAIN = r"^\d{4}(?:-\d\d-|/\d\d/)\d\d(?:[T ]\d\d:[0-5]\d(?::[0-5]\d(?:\.\d{1,6})?)?Z?)?$"


def _number(text: Column) -> Column:
    return F.nullif(text, F.lit("")).cast("int")


def _year(text: Column) -> Column:
    """Two digits from 69 on are of the last century, below that of this one."""
    year = _number(text)
    return F.when(F.length(text) == 2, year + F.when(year >= 69, 1900).otherwise(2000)).otherwise(year)


def _month(text: Column) -> Column:
    names = F.array(*[F.lit(name) for name in MONTHS])
    named = F.array_position(names, F.lower(F.substring(text, 1, 3))).cast("int")
    return F.when(text.rlike(r"^\d+$"), _number(text)).when(named > 0, named)


def _parts(text: Column, pattern: str, places: Sequence[int]) -> list[Column]:
    return [F.regexp_extract(text, pattern, place) for place in places]


def _date(text: Column, day_first: bool) -> Column:
    """Struct of year, month and day; a missing month or day is the first."""
    found = None
    for pattern, places in DATES:
        year, month, day = _parts(text, pattern, places)
        value = F.struct(
            _year(year).alias("y"),
            F.when(month == "", 1).otherwise(_month(month)).alias("m"),
            F.when(day == "", 1).otherwise(_number(day)).alias("d"))
        test = text.rlike(pattern)
        found = F.when(test, value) if found is None else found.when(test, value)
    first, second, year = _parts(text, NUMERIC, (1, 2, 3))
    a, b = _number(first), _number(second)
    swapped = (b <= 12) if day_first else (a > 12)
    return found.when(text.rlike(NUMERIC), F.struct(
        _year(year).alias("y"), F.when(swapped, b).otherwise(a).alias("m"),
        F.when(swapped, a).otherwise(b).alias("d")))


def _offset_seconds(zone: Column) -> Column:
    """Seconds east of UTC; texts without a zone are UTC."""
    digits = F.regexp_replace(zone, "[^0-9]", "")
    minutes = F.coalesce(_number(F.substring(digits, 1, 2)), F.lit(0)) * 60 + F.coalesce(
        _number(F.substring(digits, 3, 2)), F.lit(0))
    return F.when(zone.startswith("-"), -minutes).otherwise(minutes) * 60


def parse_mixed(raw: Column, day_first: bool = False) -> Column:
    """UTC instant of a string in any supported form, null when there is none.

    Dates may be ISO or written with slashes, dots or month names, with or without weekday; years
    may have two digits. A time of day may follow, in 24 hours or with AM and PM, with up to nine
    digits of a second (cut to six) and ``Z``, ``UTC``, ``GMT`` or an offset. Texts without a zone
    are UTC, in any session zone. In ``1/2/2018`` the month comes first, unless it can't or
    ``day_first`` is set; dots and hyphens are read alike.
    """
    text = F.trim(raw.cast("string"))
    plain = F.try_to_timestamp(F.concat(
        F.translate(text, "/Z", "-"),
        F.when(text.rlike(r":\d\d:|^[^:]+$"), "").otherwise(":00"),
        F.when(text.contains(":"), "Z").otherwise("T00:00:00Z")))
    other = _once(F.regexp_replace(text, WEEKDAY, ""), lambda t: F.when(
        t.rlike(COMPACT), _packed(t)).otherwise(
            _once(_split(t), lambda parts: _instant(parts, day_first))))
    # the commonest forms are cast; what has no digit is no date
    return F.when(text.rlike(PLAIN), plain).when(text.rlike("[0-9]"), other)


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _packed(text: Column) -> Column:
    """Instant of eight digits of a date, with up to six of a time."""
    zero = F.lit(0)
    year, month, day, *clock = (_number(x) for x in _parts(text, COMPACT, range(1, 7)))
    hour, minute, second = (F.coalesce(x, zero) for x in clock)
    return F.try_make_timestamp(
        year, month, day, hour, minute, second.cast("decimal(16,6)"), F.lit("UTC"))


def _split(text: Column) -> Column:
    """Date text and the parts of the time of day, null where there is none."""
    timed = text.rlike(TIMED)
    names = ("hour", "minute", "second", "fraction", "half", "zone")
    date = F.when(timed, F.regexp_extract(text, TIMED, 1)).otherwise(text)
    return F.struct(
        F.rtrim(F.regexp_replace(date, r",\s*$", "")).alias("date"),
        *[F.when(timed, F.regexp_extract(text, TIMED, i)).alias(name)
          for i, name in enumerate(names, 2)])


def _instant(parts: Column, day_first: bool) -> Column:
    zero = F.lit(0)
    hour = _number(parts["hour"])
    half = F.lower(F.substring(parts["half"], 1, 1))
    twelve = F.when((hour >= 1) & (hour <= 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    seconds = F.concat(
        F.when(parts["second"] == "", "0").otherwise(parts["second"]), F.lit("."),
        F.substring(F.rpad(parts["fraction"], 6, "0"), 1, 6)).cast("decimal(16,6)")
    at = F.when(parts["hour"].isNull(), zero).when(half == "", hour).otherwise(twelve)
    local = _once(_date(parts["date"], day_first), lambda date: F.try_make_timestamp(
        date["y"], date["m"], date["d"], at,
        F.coalesce(_number(parts["minute"]), zero),
        F.coalesce(seconds, zero.cast("decimal(16,6)")), F.lit("UTC")))
    east = F.coalesce(_offset_seconds(parts["zone"]), zero).cast("long")
    return F.timestamp_micros(F.unix_micros(local) - east * F.lit(1_000_000))
