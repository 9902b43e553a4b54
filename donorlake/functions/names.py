"""Person and committee names (FN13-FN15, FN27 cut)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from donorlake.functions._util import as_col


def flip_name(c, fallback: Column | None = None) -> Column:
    """FN13: ``LAST, FIRST`` → ``FIRST LAST``. Only the first two comma
    parts are used (a third part such as ``JR`` is dropped, as in the
    source). Text without a comma is kept, or ``fallback`` is used."""
    c = as_col(c)
    flipped = F.concat(
        F.trim(F.split_part(c, F.lit(","), F.lit(2))),
        F.lit(" "),
        F.trim(F.split_part(c, F.lit(","), F.lit(1))),
    )
    other = c if fallback is None else fallback
    return F.when(c.isNotNull() & c.contains(","), flipped).otherwise(other)


def join_name(*parts, mode: str = "skip_blank", sep: str = " ") -> Column:
    """FN14: join name parts.

    ``skip_blank``: NULL or '' parts are skipped, result trimmed.
    ``ws``: NULL parts skipped, '' kept (``concat_ws``).
    ``concat``: NULL treated as '' (the database ``concat(a, ' ', b)``;
    Spark's ``concat`` would return NULL).
    ``strict``: NULL if any part is NULL (the ``||`` operator).
    """
    cols = [as_col(p) for p in parts]
    if mode == "skip_blank":
        return F.trim(F.concat_ws(sep, *[F.nullif(c, F.lit("")) for c in cols]))
    if mode == "ws":
        return F.concat_ws(sep, *cols)
    if mode in ("concat", "strict"):
        out = []
        for i, c in enumerate(cols):
            if i and sep:
                out.append(F.lit(sep))
            out.append(F.coalesce(c, F.lit("")) if mode == "concat" else c)
        return F.concat(*out)
    raise ValueError(f"unknown join_name mode {mode!r}")


def title(c) -> Column:
    """FN15: upper-case the first letter of every alphanumeric run and
    lower-case the rest (``o'neil`` → ``O'Neil``, ``smith-jones`` →
    ``Smith-Jones``). Spark's ``initcap`` only breaks on spaces."""
    c = as_col(c)
    chars = F.split(F.lower(c), "")
    # previous character of position i (0-based) is substring(c, i, 1)
    return F.array_join(
        F.transform(
            chars,
            lambda ch, i: F.when(
                (i == 0) | ~F.substring(c, i, 1).rlike(r"[\p{L}\p{N}]"), F.upper(ch)
            ).otherwise(ch),
        ),
        "",
    )


def cut(c, n: int) -> Column:
    """FN27: keep the first n characters (a VARCHAR(n) cast truncates in the
    source database; Spark's varchar cast does not)."""
    return F.left(as_col(c), F.lit(n))
