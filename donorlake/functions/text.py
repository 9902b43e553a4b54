"""Text helpers used by the conforming jobs (FN16-FN26, PRJ5, PRJ7)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from donorlake.functions._util import as_col

# Fixed value: committee ids quoted in earmark memo text.
EARMARK_ID_PATTERN = r"C[0-9]{8}"


def blank_to_null(c) -> Column:
    """FN16: trim, and '' → NULL."""
    return F.nullif(F.trim(as_col(c)), F.lit(""))


def part(c, sep: str, i: int) -> Column:
    """FN17: 1-based field of a split (negative counts from the end);
    out of range gives ''."""
    return F.split_part(as_col(c), F.lit(sep), F.lit(i))


def last_part(c, sep: str) -> Column:
    """FN18: last element of the split list (NULL for NULL input)."""
    return F.split_part(as_col(c), F.lit(sep), F.lit(-1))


def first_match(c, regex: str, group: int = 0) -> Column:
    """FN19: first regex match (or capture group) or NULL if none."""
    c = as_col(c)
    if group == 0:
        return F.regexp_substr(c, F.lit(regex))
    return F.when(c.rlike(regex), F.regexp_extract(c, regex, group))


def replace_all(c, regex: str, replacement: str) -> Column:
    """FN21, global flag."""
    return F.regexp_replace(as_col(c), regex, replacement)


def replace_first(c, regex: str, replacement: str) -> Column:
    """FN21 without the global flag: only the leftmost match is replaced."""
    repl = replacement.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(as_col(c), f"^((?s).*?)(?:{regex})", "$1" + repl)


def zip5(c, default: str | None = None) -> Column:
    """FN23: first five characters of a zip, optional default for blank."""
    z = F.left(blank_to_null(c), F.lit(5))
    return z if default is None else F.coalesce(z, F.lit(default))


def earmark_committee(memo, filer) -> Column:
    """FN24: the committee id quoted in the memo (``C`` + 8 digits) wins
    over the filing committee."""
    return F.coalesce(F.regexp_substr(as_col(memo), F.lit(EARMARK_ID_PATTERN)), as_col(filer))


def split_pair(c, sep: str) -> tuple[Column, Column]:
    """FN25: ``employer/occupation`` → (employer, occupation)."""
    return (
        F.trim(F.split_part(as_col(c), F.lit(sep), F.lit(1))),
        F.trim(F.split_part(as_col(c), F.lit(sep), F.lit(2))),
    )


def strip_parens(c) -> Column:
    """FN26: drop parenthesised text."""
    return F.trim(F.regexp_replace(as_col(c), r"\s*\([^)]*\)", ""))


def letters_only(c) -> Column:
    """FN26: keep ASCII letters (and spaces) only."""
    return F.regexp_replace(as_col(c), r"[^A-Za-z ]", "")


def map_codes(c, mapping: Mapping[str, str], default: str | None = None,
              keep_unmapped: bool = False) -> Column:
    """PRJ5: value → code through a literal map (codegen'd lookup, no join).

    Unmapped values get ``default``; with ``keep_unmapped`` they pass
    through unchanged."""
    c = as_col(c)
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    hit = F.try_element_at(lookup, c)
    if keep_unmapped:
        return F.coalesce(hit, c)
    if default is not None:
        return F.coalesce(hit, F.lit(default))
    return hit


def first_present(*cols) -> Column:
    """PRJ7: first column that is neither NULL nor blank."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def pad_left(c, width: int, fill: str = "0") -> Column:
    """Pad a number or text to ``width``; what is longer stays whole (a plain
    ``lpad`` would cut it)."""
    text = as_col(c).cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, fill)).otherwise(text)
