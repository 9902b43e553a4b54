"""One-field address parsing (FN22).

One parser reads every layout from the right: an optional zip word, an
optional two-letter state, the city, and whatever stands before it as the
street. Words are told apart by their shape (letters become ``A``, digits
``9``), so layouts differ only in where the commas are.

    CITY, ST 12345          STREET, CITY, ST 12345-6789
    CITY, ST                STREET, CITY, ST, 12345
    CITY ST 12345           CITY 12345

A zip is five digits, nine (with or without a dash) or five and a dash.
Without a comma, a run of words that begins with a digit is street and city
together; which words are the city is not to be seen from the text: they all
stand in the street and the city is NULL (``operators.addresses`` tells them
apart by the zip's cities).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from donorlake.functions._util import as_col

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = "0123456789"


ZIP_SHAPES = ("99999", "99999-9999", "999999999", "99999-")


def word_shape(word: Column) -> Column:
    return F.translate(F.upper(word), _LETTERS + _DIGITS, "A" * 26 + "9" * 10)


def _last(words: Column) -> Column:
    return F.try_element_at(words, F.lit(-1))


def _but_last(words: Column) -> Column:
    return F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0)))


def _let(value: Column, use) -> Column:
    """``use`` of a value that is evaluated, and planned, once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def parse_address(c) -> Column:
    """struct<street, city, state, zip_code>; all NULL where neither a zip
    nor a state (which needs a zip behind it or a comma before it) is found."""
    parts = F.filter(F.transform(F.split(F.trim(as_col(c)), ","), lambda s: F.trim(s)), lambda s: s != "")
    return _let(parts, lambda p: _let(F.split(_last(p), " +"), lambda tail: _from_tail(p, tail)))


def _from_tail(parts: Column, tail: Column) -> Column:
    """Take the zip off: what is left of the parts, the words that end in the
    state, and the zip."""
    has_zip = F.coalesce(word_shape(_last(tail)).isin(*ZIP_SHAPES), F.lit(False))
    # "…, ST, 12345": the zip has a part of its own
    alone = has_zip & (F.size(tail) == 1) & (F.size(parts) > 1)
    zip_code = F.regexp_replace(F.regexp_replace(_last(tail), "-$", ""), "^([0-9]{5})([0-9]{4})$", "$1-$2")
    left = F.struct(
        F.when(alone, _but_last(parts)).otherwise(parts).alias("parts"),
        F.when(alone, F.split(_last(_but_last(parts)), " +")).when(has_zip, _but_last(tail)).otherwise(tail).alias("words"),
        F.when(has_zip, zip_code).alias("zip_code"))
    return _let(left, lambda x: _from_words(x["parts"], x["words"], x["zip_code"]))


def _from_words(parts: Column, words: Column, zip_code: Column) -> Column:
    """Take the state off, then tell the city from the street."""
    alone = (F.size(words) == 1) & (F.size(parts) > 1)
    has_state = F.coalesce((word_shape(_last(words)) == "AA") & (zip_code.isNotNull() | alone), F.lit(False))
    left = F.struct(F.when(has_state, _but_last(words)).otherwise(words).alias("city_words"), _but_last(parts).alias("before"),
                    F.when(has_state, F.upper(_last(words))).alias("state"))

    def placed(x: Column) -> Column:
        city_words, before, state = x["city_words"], x["before"], x["state"]
        known = zip_code.isNotNull() | state.isNotNull()
        beside = F.size(city_words) > 0  # the city shares its part with the state or zip
        together = (F.size(before) == 0) & F.coalesce(F.try_element_at(city_words, F.lit(1)).rlike("^[0-9]"), F.lit(False))
        city = F.when(together, F.lit(None)).when(beside, F.array_join(city_words, " ")).otherwise(_last(before))
        street = F.when(together, F.array_join(city_words, " ")).otherwise(
            F.array_join(F.when(beside, before).otherwise(_but_last(before)), ", "))
        return F.struct(F.when(known, F.nullif(street, F.lit(""))).alias("street"), F.when(known, city).alias("city"),
                        state.alias("state"), zip_code.alias("zip_code"))

    return _let(left, placed)
