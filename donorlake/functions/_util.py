from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def regex_quote(s: str) -> str:
    """Escape a literal for use inside a Java regex."""
    return "".join("\\" + ch if ch in r"\^$.|?*+()[]{}" else ch for ch in s)
