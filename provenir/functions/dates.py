"""Instants from texts of mixed formats, in tiers: common shapes by built-in functions, the rest by a parser in Python."""

from __future__ import annotations

from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_MONTH = r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\.?"
_DAY = r"(?:(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?\.?,? +)?"
_TIME = r"(?:(?:t| +|, *)(\d{1,2}):(\d{2})(?::(\d{2})(?:\.(\d{1,6}))?)?)? *(z|utc|gmt|[+-]\d{2}:?\d{2})?"
#: Shapes of whole dates, with the places of year, month and day among the groups; hour, minute, second, fraction and zone follow.
_SHAPES = (
    (r"(\d{4})-(\d{2})-(\d{2})", 1, 2, 3), (r"(\d{4})/(\d{1,2})/(\d{1,2})", 1, 2, 3), (r"(\d{1,2})/(\d{1,2})/(\d{4})", 3, 1, 2),
    (rf"{_DAY}(\d{{1,2}})[ -]+{_MONTH},?[ -]+(\d{{4}})", 3, 2, 1), (rf"{_DAY}{_MONTH} +(\d{{1,2}})(?:st|nd|rd|th)?,? +(\d{{4}})", 3, 1, 2),
)
#: Two dates that differ in every field: what a text leaves open follows them.
_FIRST, _SECOND = datetime(2000, 1, 1), datetime(2001, 2, 2)


def read_date(text: str) -> datetime | None:
    """The instant of a text with a year and a month at least (the day is 1 if it has none); None for any other."""
    from dateutil import parser

    try:
        one, two = (parser.parse(text, default=d) for d in (_FIRST, _SECOND))
    except (ValueError, TypeError, OverflowError):
        return None
    if (one.year, one.month) != (two.year, two.month):
        return None
    return one.astimezone(UTC) if one.tzinfo else one.replace(tzinfo=UTC)


@F.pandas_udf(T.TimestampType())
def _parsed(text: pd.Series) -> pd.Series:
    known = {t: read_date(t) for t in text.dropna().unique()}
    return pd.Series(pd.to_datetime([known.get(t) for t in text], utc=True, errors="coerce"), index=text.index)


def _shaped(low: Column, shape: tuple[str, int, int, int]) -> Column:
    """The instant of a text of one shape; null for texts of others and for dates that do not exist."""
    date, year, month, day = shape
    part = lambda k: F.nullif(F.regexp_extract(low, rf"^\s*{date}{_TIME}\s*$", k), F.lit(""))
    y, m, d = part(year), part(month), part(day)
    if "jan" in date:
        m = F.array_position(F.array(*map(F.lit, _MONTHS)), F.substring(m, 1, 3)).cast("string")
    elif date.startswith(r"(\d{1,2})/"):  # month first, unless it can only be a day
        late = m.cast("int") > 12
        m, d = F.when(late, d).otherwise(m), F.when(late, m).otherwise(d)
    two = lambda c: F.lpad(c, 2, "0")
    zone = F.when(part(8).isin("z", "utc", "gmt") | part(8).isNull(), "Z").otherwise(F.concat(F.substring(part(8), 1, 3), F.lit(":"), F.substring(part(8), -2, 2)))
    clock = F.concat(two(F.coalesce(part(4), F.lit("0"))), F.lit(":"), F.coalesce(part(5), F.lit("00")), F.lit(":"), F.coalesce(part(6), F.lit("00")), F.lit("."), F.coalesce(part(7), F.lit("0")))
    return F.when(low.rlike(rf"^\s*{date}{_TIME}\s*$"), F.concat(y, F.lit("-"), two(m), F.lit("-"), two(d), F.lit("T"), clock, zone).try_cast("timestamp"))


def parse_datetime(text: Column) -> Column:
    """An instant, UTC where no zone is given; null for nothing, for what no format fits, for numbers of up to seven digits
    or ten, and for texts without a year and month. No result depends on the day it is computed.

    Whole dates in the usual shapes (ISO, slashes, month names, with or without time and zone) are read by built-in functions;
    only what is left goes to Python, each distinct text of a batch once.
    """
    low = F.lower(text)
    quick = F.coalesce(*(_shaped(low, s) for s in _SHAPES))
    number = low.rlike(r"^\s*(\d{1,7}|\d{9,11}|\d{13}|\d{15,})\s*$")
    rest = F.when(quick.isNull() & ~number & (F.length(text) <= 200), text)
    return F.coalesce(quick, _parsed(rest))
