"""Identity keys (FN11, FN12, PRJ6, PRJ10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from donorlake.functions._util import as_col

# The public surrogate-key convention the conformed ids follow
# (md5 over the text of each column joined by '-', NULL written as a token).
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"


def surrogate_key(*cols) -> Column:
    """FN11: md5 over ``'-'``-joined column text, NULL → fixed token."""
    parts = [
        F.coalesce(as_col(c).cast("string"), F.lit(SURROGATE_NULL_TOKEN)) for c in cols
    ]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))


def committee_id(prefix: str, name) -> Column:
    """FN12: source prefix + surrogate key of the committee name."""
    return F.concat(F.lit(prefix), surrogate_key(name))


def key_if(cond: Column, prefix: str, id_col) -> Column:
    """PRJ6: ``prefix || id`` only where ``cond`` holds, else NULL."""
    return F.when(cond, F.concat(F.lit(prefix), as_col(id_col).cast("string")))


def name_concat(name, zip_code) -> Column:
    """PRJ10: ``UPPER(first token | last token | zip5)``; tokens are split on
    single spaces, so a NULL name gives NULL, as in the master model."""
    n = as_col(name)
    return F.upper(
        F.concat(
            F.split_part(n, F.lit(" "), F.lit(1)),
            F.lit("|"),
            F.split_part(n, F.lit(" "), F.lit(-1)),
            F.lit("|"),
            F.left(F.coalesce(as_col(zip_code), F.lit("")), F.lit(5)),
        )
    )


def name_concat_parts(first, last, zip_code) -> Column:
    """Ground-truth form of the key: ``UPPER(fname | lname | zip5)``."""
    return F.upper(
        F.concat(
            as_col(first),
            F.lit("|"),
            as_col(last),
            F.lit("|"),
            F.left(F.coalesce(as_col(zip_code), F.lit("")), F.lit(5)),
        )
    )
