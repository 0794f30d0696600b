"""Date and elapsed-time functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docmill.functions.text import strip

# Any one character may stand between date and time; an offset is below 24 hours.
_TIME = (
    r"(?s:.)(?:[01]\d|2[0-3])(?::?[0-5]\d(?::?[0-5]\d(?:[.,]\d+)?)?)?"
    r"(?:Z|[+-](?:[01]\d|2[0-3]):?[0-5]\d(?::?[0-5]\d)?)?"
)
_EXTENDED = rf"\A\d{{4}}-\d{{2}}-\d{{2}}(?:{_TIME})?\z"
_COMPACT = rf"\A\d{{8}}(?:{_TIME})?\z"
# Without a weekday a week means its Monday.
_WEEK = rf"\A\d{{4}}(?:-W\d{{2}}(?:-[1-7])?|W\d{{2}}[1-7]?)(?:{_TIME})?\z"


def _valid_date(year: Column, month: Column, day: Column) -> Column:
    return F.concat_ws("-", year, month, day).try_cast("date")


def parse_iso_date(c: Column) -> Column:
    """Date as written in an ISO date or date-time (no zone shift); anything else is NULL."""
    s = strip(c)
    extended = F.when(s.rlike(_EXTENDED), F.substring(s, 1, 10).try_cast("date"))
    compact = F.when(
        s.rlike(_COMPACT),
        _valid_date(F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2)),
    )
    digits = F.regexp_replace(F.substring(s, 1, 10), "[-W]", "")
    year = F.substring(digits, 1, 4).try_cast("int")
    week = F.substring(digits, 5, 2).try_cast("int")
    weekday = F.coalesce(F.nullif(F.regexp_extract(s, r"\A\d{4}-?W\d{2}-?([1-7])(?:\z|(?s:.)\d{2})", 1), F.lit("")).try_cast("int"), F.lit(1))
    january_4 = F.make_date(year, F.lit(1), F.lit(4))
    monday = F.date_sub(january_4, F.weekday(january_4))
    day = F.date_add(monday, (week - 1) * 7 + weekday - 1)
    # The week must belong to the year it names: its Thursday decides.
    thursday = F.date_add(monday, (week - 1) * 7 + 3)
    iso_week = F.when(
        s.rlike(_WEEK) & year.between(1, 9999) & (week >= 1) & (F.year(thursday) == year), day
    )
    found = F.coalesce(extended, compact, iso_week)
    return F.when(F.year(found) >= 1, found)


def elapsed_seconds(end: Column, start: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000)


def elapsed_hours(end: Column, start: Column) -> Column:
    return elapsed_seconds(end, start) / F.lit(3600)


def number_year(c: Column, pivot: int = 87) -> Column:
    """Year named by the first two digits: pivot and above are 19xx, below are 20xx."""
    two = F.substring(c, 1, 2).try_cast("int")
    return two + F.when(two >= pivot, 1900).otherwise(2000)


# Month names of the citation format, independent of any locale.
FRENCH_MONTHS = (
    "janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août",
    "septembre", "octobre", "novembre", "décembre",
)


def french_date(c: Column) -> Column:
    """16 septembre 2026; the first of a month is written 1er."""
    day = F.when(F.day(c) == 1, F.lit("1er")).otherwise(F.day(c).cast("string"))
    month = F.element_at(F.array(*[F.lit(m) for m in FRENCH_MONTHS]), F.month(c))
    return F.concat_ws(" ", day, month, F.year(c).cast("string"))
