"""Addresses without commas (FN22): the city is told from the street by the
cities that the zip code has.

``123 ELM ST SALEM OR 97301`` has its words in one run. Every end of that run
is a candidate for the city; candidates meet a table of (zip, city) by an equi
join on both, and the longest one wins. Distinct addresses are parsed once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorlake.functions.address import parse_address

#: Words of a city name.
CITY_WORDS = 5


def place_addresses(df: DataFrame, col: str, cities: DataFrame, prefix: str = "") -> DataFrame:
    """``df`` with street, city, state and zip_code (names behind ``prefix``)
    of the address in ``col``. ``cities`` has (zip_code, city); the first five
    digits of a zip count and case does not. Where the commas tell the city it
    is taken as it stands; a run of words that ends in no city of its zip
    keeps them all in the street, and the city is NULL."""
    parsed = df.select(F.col(col).alias("_a")).distinct().select("_a", parse_address("_a").alias("p")).select("_a", "p.*")
    words = F.split(F.col("street"), " +")
    open_ = F.col("city").isNull() & F.col("street").isNotNull() & F.col("zip_code").isNotNull()
    ends = F.transform(F.sequence(F.lit(1), F.least(F.size(words), F.lit(CITY_WORDS))),
                       lambda n: F.struct(n.alias("n"), F.array_join(F.slice(words, F.size(words) - n + 1, n), " ").alias("end")))
    tries = (parsed.filter(open_).select("_a", F.left("zip_code", F.lit(5)).alias("_zip"), F.explode(ends).alias("e"))
             .select("_a", "_zip", F.col("e.n").alias("_n"), F.upper("e.end").alias("_end")))
    known = cities.select(F.left("zip_code", F.lit(5)).alias("_zip"), F.upper(F.trim("city")).alias("_end")).distinct()
    longest = tries.join(known, ["_zip", "_end"]).groupBy("_a").agg(F.max("_n").alias("_n"))
    hit = F.col("_n").isNotNull()
    placed = parsed.join(longest, "_a", "left").select(
        "_a",
        F.when(hit, F.nullif(F.array_join(F.slice(words, 1, F.size(words) - F.col("_n")), " "), F.lit("")))
        .otherwise(F.col("street")).alias(f"{prefix}street"),
        F.when(hit, F.array_join(F.slice(words, F.size(words) - F.col("_n") + 1, F.col("_n")), " "))
        .otherwise(F.col("city")).alias(f"{prefix}city"),
        F.col("state").alias(f"{prefix}state"), F.col("zip_code").alias(f"{prefix}zip_code"))
    return df.join(placed, df[col].eqNullSafe(placed["_a"]), "left").drop("_a")
