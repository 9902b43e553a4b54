"""Date and timestamp parsing (FN4-FN10, ROW7).

Parsing uses ``try_to_timestamp`` so a bad value becomes NULL under ANSI
mode instead of failing the stage. Patterns are Spark datetime patterns;
one-letter fields (``M``, ``d``) accept one or two digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from donorlake.functions._util import as_col

# Fixed layouts seen in the landing files (Spark pattern syntax).
MDY = "M/d/yyyy"
YMD = "yyyy-M-d"
ISO_T = "yyyy-M-d'T'H:m:s"
YYYYMMDD = "yyyyMMdd"
MDY_AMPM = "M/d/yyyy h:mm:ss a"
YMD_HMS = "yyyy-MM-dd HH:mm:ss"

RE_MDY = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"
RE_YMD = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
RE_ISO_T_PREFIX = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}T[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}"


def _ts(c: Column, fmt: str) -> Column:
    return F.try_to_timestamp(c, F.lit(fmt))


def parse_flexible_date(c) -> Column:
    """FN4: ``M/D/YYYY``, ``YYYY-M-D`` or ISO ``YYYY-M-DTH:M:S…`` (anything
    after the seconds is ignored); any other text → NULL."""
    c = as_col(c)
    return (
        F.when(c.rlike(RE_MDY), _ts(c, MDY))
        .when(c.rlike(RE_YMD), _ts(c, YMD))
        .when(c.rlike(RE_ISO_T_PREFIX), _ts(F.regexp_extract(c, RE_ISO_T_PREFIX, 0), ISO_T))
    )


def safe_parse_date(c) -> Column:
    """FN5: a real calendar ``M/D/YYYY`` date (leap years honoured), else
    NULL. ``try_to_timestamp`` already rejects Feb 30 and month 13."""
    c = as_col(c)
    return F.when(c.rlike(RE_MDY), _ts(c, MDY))


def parse_ts(c, fmt: str) -> Column:
    """FN6: one explicit layout, e.g. ``YYYYMMDD`` or ``MDY_AMPM``."""
    return _ts(F.trim(as_col(c)), fmt)


def parse_day_month(c, year) -> Column:
    """FN6 ``DD-Mon`` plus a report year column (``3-Jan`` + 2024)."""
    text = F.concat_ws("-", F.trim(as_col(c)), as_col(year).cast("string"))
    return _ts(text, "d-MMM-yyyy")


def excel_serial(c) -> Column:
    """FN7: serial day n → 1900-01-01 + n days (two days later than the
    spreadsheet calendar, kept as the source computes it)."""
    n = as_col(c).try_cast("int")
    return F.date_add(F.lit("1900-01-01").cast("date"), n).cast("timestamp")


def date_or_year(parsed, year=None, fallback=None) -> Column:
    """FN8: the parsed date, else another date column, else Jan 1 of year."""
    cols = [as_col(parsed)]
    if fallback is not None:
        cols.append(as_col(fallback))
    if year is not None:
        y = as_col(year).try_cast("int")
        cols.append(F.make_date(y, F.lit(1), F.lit(1)).cast("timestamp"))
    return F.coalesce(*cols)


def to_ts(c) -> Column:
    """FN9: text → timestamp by cast rules, NULL when unreadable."""
    return F.trim(as_col(c)).try_cast("timestamp")


def year_of(c) -> Column:
    """FN10."""
    return F.year(as_col(c))


def month_of(c) -> Column:
    """FN10."""
    return F.month(as_col(c))


def repair_date(c, year: int) -> Column:
    """ROW7: keep a valid ``M/D/YYYY`` text date; blank, malformed or
    impossible ones become ``01/01/{year}``. A year outside 1900-2100 is
    replaced by 2020 first."""
    if not isinstance(year, int) or year < 1900 or year > 2100:
        year = 2020
    c = F.trim(as_col(c))
    ok = c.rlike(RE_MDY) & _ts(c, MDY).isNotNull()
    return F.when(ok, c).otherwise(F.lit(f"01/01/{year}"))


def load_time() -> Column:
    """FN29: load timestamp (UTC session). Never part of compared output."""
    return F.current_timestamp()
