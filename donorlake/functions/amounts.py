"""Money parsing (FN1-FN3, FN27, FN28).

Every function maps a text Column to a Column and stays inside Catalyst
(no Python UDF). Text that cannot be read becomes NULL instead of failing
the job; ``operators.quality.parse_failures`` counts those NULLs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from donorlake.functions._util import as_col

AMOUNT_TYPE = "decimal(38,2)"


def to_amount(c) -> Column:
    """Text → decimal(38,2), NULL when it is not a number."""
    return as_col(c).try_cast(AMOUNT_TYPE)


def clean_amount(c) -> Column:
    """FN1: ``$1,200.50`` → 1200.50, ``($300)`` → -300, else NULL. The sign
    comes from the parentheses, the size from what is left without marks."""
    c = as_col(c)
    negative = c.startswith("(") & c.endswith(")")
    size = to_amount(F.translate(c, "$,()", ""))
    return F.when(negative, -size).otherwise(to_amount(F.translate(c, "$,", ""))).cast(AMOUNT_TYPE)


def signed_amount(c) -> Column:
    """FN2: trailing minus (``12.5-``) means negative; commas dropped."""
    c = F.trim(as_col(c))
    digits = F.regexp_replace(c, r"[,-]", "")
    text = F.when(c.endswith("-"), F.concat(F.lit("-"), digits)).otherwise(
        F.regexp_replace(c, ",", "")
    )
    return to_amount(text)


def digits_amount(c) -> Column:
    """FN3: keep digits and dots only (the sign is lost, as in the source)."""
    return to_amount(F.regexp_replace(as_col(c), r"[^0-9.]", ""))


def to_int_rounded(c) -> Column:
    """FN27: numeric → int rounding half away from zero (a plain Spark
    int cast would truncate)."""
    return F.round(as_col(c), 0).cast("int")


def add_components(amount, *parts) -> Column:
    """FN28: amount plus component totals where blank counts as 0."""
    total = F.coalesce(as_col(amount).cast(AMOUNT_TYPE), F.lit(0).cast(AMOUNT_TYPE))
    for p in parts:
        total = total + F.coalesce(
            F.nullif(F.trim(as_col(p)), F.lit("")).try_cast(AMOUNT_TYPE),
            F.lit(0).cast(AMOUNT_TYPE),
        )
    return total.cast(AMOUNT_TYPE)
