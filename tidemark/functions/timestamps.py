"""Safe ISO-8601 timestamp parsing (P4) and date guards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted grammar (the ISO forms an ISO-8601 parser takes):
#   date   YYYY-MM-DD | YYYYMMDD | YYYY-Www[-D] | YYYYWww[D]
#   time   any one character, then hh[[:]mm[[:]ss[(.|,)fraction]]]
#   offset Z | (+|-)hh[[:]mm[[:]ss]]        (only after a time)
# Anything else (year only, year-month, unpadded fields, bare times, named
# zones, surrounding blanks) is NULL. Range errors (hour 24, Feb 30, week 53 of
# a year without one) are NULL through ``try_cast``.
_ISO = (
    r"(?s)^(?:(\d{4})(-?)(\d{2})\2(\d{2})|(\d{4})(-?)W(\d{2})(?:\6([1-7]))?)"
    r"(?:.(\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?"
    r"(Z|[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?)?)?\z"
)
_DATE = r"^\d{4}-\d{1,2}-\d{1,2}\z"
# Common shape Spark's own cast reads exactly as intended: one regex, then cast.
_PLAIN = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:\d{2})?)?\z"


def _g(s: Column, i: int) -> Column:
    return F.regexp_extract(s, _ISO, i)


def _or(c: Column, default: str) -> Column:
    return F.when(c == "", F.lit(default)).otherwise(c)


def safe_timestamp(col: Column | str) -> Column:
    """STRING → TIMESTAMP (UTC); NULL for NULL, '', malformed or out of range.

    Naive values are taken as UTC, offsets are converted to UTC. Stays a
    pure Catalyst expression (regex + ``try_cast``), so it is codegen'd.
    """
    s = F.col(col) if isinstance(col, str) else col
    frac = _g(s, 12)
    digits = F.regexp_replace(F.substring(_g(s, 13), 2, 8), ":", "")
    off_norm = (
        F.when(digits == "", _g(s, 13))  # none, or Z
        .otherwise(F.concat(
            F.substring(_g(s, 13), 1, 1), F.substring(digits, 1, 2), F.lit(":"), _or(F.substring(digits, 3, 2), "00"),
            F.when(F.length(digits) > 4, F.concat(F.lit(":"), F.substring(digits, 5, 2))).otherwise(F.lit(""))))
    )
    # the week that holds 4 January is the first; its days count from Monday
    fourth = F.concat(_or(_g(s, 5), "2000"), F.lit("-01-04")).try_cast("date")
    week = _or(_g(s, 7), "01").cast("int")
    in_week = F.date_add(F.date_sub(fourth, F.weekday(fourth)), 7 * (week - 1) + _or(_g(s, 8), "1").cast("int") - 1)
    week_day = F.when(F.weekofyear(in_week) == week, F.date_format(in_week, "yyyy-MM-dd"))
    day = F.when(_g(s, 7) != "", week_day).otherwise(
        F.concat(_g(s, 1), F.lit("-"), _g(s, 3), F.lit("-"), _g(s, 4)))
    canon = F.concat(
        day, F.lit(" "),
        _or(_g(s, 9), "00"), F.lit(":"), _or(_g(s, 10), "00"), F.lit(":"),
        _or(_g(s, 11), "00"),
        F.when(frac == "", F.lit("")).otherwise(F.concat(F.lit("."), frac)),
        off_norm,
    )
    return (F.when(s.rlike(_PLAIN), s.try_cast("timestamp"))
            .when(s.rlike(_ISO), canon.try_cast("timestamp")))


def safe_date(col: Column | str) -> Column:
    """STRING → DATE for ``YYYY-M-D`` text only; NULL otherwise."""
    s = F.col(col) if isinstance(col, str) else col
    return F.when(s.rlike(_DATE), s.try_cast("date"))


def is_blank(col: Column | str) -> Column:
    s = F.col(col) if isinstance(col, str) else col
    return s.isNull() | (s == "")
