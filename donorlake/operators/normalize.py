"""Profiling and geographic normalisation (NRM1-NRM15, FN22 helpers).

Text normalisers run on the *distinct* raw values and are joined back, so
the per-value work is proportional to the vocabulary, not the row count.
Clustering (NRM13) groups by a key column (fingerprint / 1-gram) and picks
the most common spelling per key with plain aggregations; there is no
all-pairs comparison. Edit distance (NRM12) is only computed between a
value and the single expected city of its (state, zip).
"""

from __future__ import annotations

from functools import reduce
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from donorlake.operators.dedup import asc, best_per_key
from donorlake.operators.ranks import values_at_ranks

# USPS street suffix and directional abbreviations (common subset
# of the postal standard), state names → codes, city-name abbreviation
# expansions and placeholder city values treated as missing.
STREET_ABBREVIATIONS = {
    "STREET": "ST", "AVENUE": "AVE", "ROAD": "RD", "DRIVE": "DR", "LANE": "LN", "COURT": "CT",
    "CIRCLE": "CIR", "BOULEVARD": "BLVD", "PLACE": "PL", "PARKWAY": "PKWY", "HIGHWAY": "HWY",
    "TERRACE": "TER", "TRAIL": "TRL", "SQUARE": "SQ", "APARTMENT": "APT", "SUITE": "STE",
    "NORTH": "N", "SOUTH": "S", "EAST": "E", "WEST": "W",
}
US_STATES = {
    "AL": "ALABAMA", "AK": "ALASKA", "AZ": "ARIZONA", "AR": "ARKANSAS", "CA": "CALIFORNIA",
    "CO": "COLORADO", "CT": "CONNECTICUT", "DE": "DELAWARE", "DC": "DISTRICT OF COLUMBIA",
    "FL": "FLORIDA", "GA": "GEORGIA", "HI": "HAWAII", "ID": "IDAHO", "IL": "ILLINOIS", "IN": "INDIANA",
    "IA": "IOWA", "KS": "KANSAS", "KY": "KENTUCKY", "LA": "LOUISIANA", "ME": "MAINE", "MD": "MARYLAND",
    "MA": "MASSACHUSETTS", "MI": "MICHIGAN", "MN": "MINNESOTA", "MS": "MISSISSIPPI", "MO": "MISSOURI",
    "MT": "MONTANA", "NE": "NEBRASKA", "NV": "NEVADA", "NH": "NEW HAMPSHIRE", "NJ": "NEW JERSEY",
    "NM": "NEW MEXICO", "NY": "NEW YORK", "NC": "NORTH CAROLINA", "ND": "NORTH DAKOTA", "OH": "OHIO",
    "OK": "OKLAHOMA", "OR": "OREGON", "PA": "PENNSYLVANIA", "RI": "RHODE ISLAND", "SC": "SOUTH CAROLINA",
    "SD": "SOUTH DAKOTA", "TN": "TENNESSEE", "TX": "TEXAS", "UT": "UTAH", "VT": "VERMONT",
    "VA": "VIRGINIA", "WA": "WASHINGTON", "WV": "WEST VIRGINIA", "WI": "WISCONSIN", "WY": "WYOMING",
}
CITY_ABBREVIATIONS = {
    "ST": "SAINT", "MT": "MOUNT", "FT": "FORT", "PT": "POINT", "N": "NORTH", "S": "SOUTH",
    "E": "EAST", "W": "WEST", "HTS": "HEIGHTS", "SPGS": "SPRINGS", "BCH": "BEACH", "CTR": "CENTER",
}
INVALID_CITIES = ["UNKNOWN", "NONE", "NA", "N A", "REQUESTED", "TBD", "NOT GIVEN", "UNK", "XXX"]
# zips made of one repeated digit are placeholders
PLACEHOLDER_ZIPS = [str(d) * 5 for d in range(10)]


def _lit_map(m: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in m.items() for x in kv])


def _squash(c: Column) -> Column:
    """Punctuation and non-ASCII → space, upper case, single spaces,
    trimmed. Characters are dropped before upper-casing, so locale-specific
    case mappings (``ß`` → ``SS``) cannot change a key."""
    s = F.upper(F.regexp_replace(c, r"[^A-Za-z0-9 ]", " "))
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def _map_tokens(c: Column, m: Mapping[str, str]) -> Column:
    lookup = _lit_map(m)
    return F.array_join(F.transform(F.split(c, " "), lambda t: F.coalesce(F.try_element_at(lookup, t), t)), " ")


def address_expr(c: Column) -> Column:
    s = _squash(c)
    return F.nullif(_map_tokens(s, STREET_ABBREVIATIONS), F.lit(""))


def zip_expr(c: Column) -> Column:
    digits = F.regexp_replace(c, r"[^0-9]", "")
    z = F.lpad(F.left(digits, F.lit(5)), 5, "0")
    z = F.when(F.length(digits) > 0, z)
    return F.when(~z.isin(PLACEHOLDER_ZIPS), z)


def state_expr(c: Column, valid: Sequence[str] = tuple(US_STATES)) -> Column:
    s = F.trim(F.regexp_replace(F.upper(c), r"[^A-Z ]", ""))
    s = F.regexp_replace(s, r"\s+", " ")
    by_name = _lit_map({v: k for k, v in US_STATES.items()})
    code = F.coalesce(F.try_element_at(by_name, s), s)
    return F.when(code.isin(list(valid)), code)


def city_expr(c: Column) -> Column:
    s = _map_tokens(_squash(c), CITY_ABBREVIATIONS)
    s = F.nullif(s, F.lit(""))
    return F.when(~s.isin(INVALID_CITIES), s)


def normal_address(df: DataFrame, col: str, out: str = "address_norm") -> DataFrame:
    """NRM8: upper case, no punctuation, USPS suffix abbreviations. The
    expression is cheap and addresses are nearly unique, so it runs per row
    (no distinct + join-back shuffle)."""
    return df.withColumn(out, address_expr(F.col(col)))


def normal_zip(df: DataFrame, col: str, out: str = "zip_norm") -> DataFrame:
    """NRM9: five digits (ZIP+4 cut, leading zeros restored), placeholder
    zips such as 00000 / 99999 → NULL."""
    return df.withColumn(out, zip_expr(F.col(col)))


def normal_state(df: DataFrame, col: str, out: str = "state_norm",
                 valid: Sequence[str] = tuple(US_STATES)) -> DataFrame:
    """NRM10: two-letter code (full names abbreviated), NULL when not valid."""
    return df.withColumn(out, state_expr(F.col(col), valid))


def normal_city(df: DataFrame, col: str, out: str = "city_norm") -> DataFrame:
    """NRM11: upper case, no punctuation, abbreviations expanded,
    placeholder values → NULL (per row, like NRM8)."""
    return df.withColumn(out, city_expr(F.col(col)))


def is_abbrev(abb: Column, full: Column) -> Column:
    """True when ``abb`` is shorter, starts like ``full`` and its letters
    occur in ``full`` in order."""
    letters = F.split(F.regexp_replace(abb, r"[^A-Z]", ""), "")
    pattern = F.concat(F.lit("^"), F.array_join(letters, ".*"))
    return ((F.length(abb) < F.length(full)) & (F.left(abb, F.lit(1)) == F.left(full, F.lit(1)))
            & F.regexp_like(full, pattern))


def swap_city(df: DataFrame, zips: DataFrame, city: str = "city_norm", state: str = "state_norm",
              zip_col: str = "zip_norm", out: str = "city_swap") -> DataFrame:
    """NRM12: replace the city by the expected city of its (state, zip) when
    it is an abbreviation of it or one edit away. ``zips`` holds (state,
    zip, city); it is reduced to one expected city per (state, zip)."""
    expected = best_per_key(
        zips.select(F.col("state").alias(state), F.col("zip").alias(zip_col), F.col("city").alias("_expect")),
        [state, zip_col], [asc("_expect")])
    vocab = df.select(city, state, zip_col).distinct().join(expected, [state, zip_col], "left")
    dist = F.levenshtein(F.col(city), F.col("_expect"))
    hit = F.col("_expect").isNotNull() & (is_abbrev(F.col(city), F.col("_expect")) | (dist == 1))
    vocab = vocab.select(
        F.col(city).alias("_k0"), F.col(state).alias("_k1"), F.col(zip_col).alias("_k2"),
        F.when(F.coalesce(hit, F.lit(False)), F.col("_expect")).otherwise(F.col(city)).alias(out))
    # keys may be NULL (an unreadable state or zip), so the join is null-safe
    cond = (F.col(city).eqNullSafe(F.col("_k0")) & F.col(state).eqNullSafe(F.col("_k1"))
            & F.col(zip_col).eqNullSafe(F.col("_k2")))
    return df.join(vocab, cond, "left").drop("_k0", "_k1", "_k2")


def _folds() -> tuple[str, str]:
    """Characters that a key folds and what they become: Latin letters lose
    their accents, a-z become A-Z. Built from the character database."""
    import unicodedata

    src, dst = [], []
    for code in (*range(0x61, 0x7B), *range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        c = chr(code)
        base = unicodedata.normalize("NFD", c)[0]
        if base.isascii() and base.isalpha():
            src.append(c)
            dst.append(base.upper())
    # Latin letters that have no accent to lose.
    for c, base in {"ß": "S", "ø": "O", "æ": "A", "œ": "O", "ł": "L", "đ": "D", "ð": "D", "þ": "T"}.items():
        src += dict.fromkeys([c, c.upper() if len(c.upper()) == 1 else c])
        dst += [base] * len(dict.fromkeys([c, c.upper() if len(c.upper()) == 1 else c]))
    return "".join(src), "".join(dst)


KEY_FOLDS = _folds()
#: Most edits between a value and the spelling it is merged into: one for
#: every four characters, two at the most.
EDITS_EVERY, MAX_EDITS = 4, 2


def key_text(c: Column) -> Column:
    """Letters and digits of any script, Latin ones folded; single spaces."""
    s = F.regexp_replace(F.translate(c, *KEY_FOLDS), r"[^\p{L}\p{N} ]", " ")
    return F.trim(F.regexp_replace(s, " +", " "))


def fingerprint(c: Column) -> Column:
    """Key collision: folded, punctuation removed, unique sorted tokens."""
    toks = F.array_distinct(F.split(key_text(c), " "))
    return F.array_join(F.array_sort(toks), " ")


def one_gram(c: Column) -> Column:
    """1-gram key: unique sorted characters, spaces dropped."""
    chars = F.array_distinct(F.split(F.regexp_replace(key_text(c), " ", ""), ""))
    return F.array_join(F.array_sort(chars), "")


def _merge_by_key(df: DataFrame, col: str, key_fn, out: str, weight: str | None = None,
                  near: bool = False) -> DataFrame:
    """Replace each value by the most common value sharing its key (ties:
    lowest value); a value with an empty key stays, and with ``near`` so does
    one that is too many edits away. Counts are aggregated before the
    shuffle; ``weight`` names a row-count column when ``df`` is already a
    vocabulary."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    counts = (df.where(F.col(col).isNotNull()).groupBy(col).agg(n.alias("_n"))
                .withColumn("_k", key_fn(F.col(col))).filter(F.length("_k") > 0))
    best = best_per_key(counts.select("_k", F.col(col).alias("_best"), "_n"), ["_k"],
                        [asc(-F.col("_n")), asc("_best")]).select("_k", "_best")
    vocab = counts.join(best, "_k")
    if near:
        edits = F.least(F.lit(MAX_EDITS), F.floor(F.length("_best") / EDITS_EVERY).cast("int"))
        vocab = vocab.filter(F.levenshtein(key_text(F.col(col)), key_text(F.col("_best"))) <= edits)
    vocab = vocab.select(col, F.col("_best").alias(out))
    return df.join(vocab, col, "left").withColumn(out, F.coalesce(out, col))


def cluster_merge(df: DataFrame, col: str, out: str, weight: str | None = None) -> DataFrame:
    """NRM13 without the validity check: key-collision merge, then 1-gram
    merge within a few edits; each value becomes the most common spelling of
    its cluster. ``df`` and the first merge are written to the shared folder:
    each is read several times, and would be made anew each time."""
    step1 = _written(_merge_by_key(_written(df, "values"), col, fingerprint, "_r1", weight), "merged")
    return _merge_by_key(step1, "_r1", one_gram, out, weight, near=True).drop("_r1")


def _written(df: DataFrame, name: str) -> DataFrame:
    from donorlake.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def refine_city(df: DataFrame, zips: DataFrame, city: str = "city_swap", state: str = "state_norm",
                zip_col: str = "zip_norm", out: str = "city_refine", weight: str | None = None) -> DataFrame:
    """NRM13: key-collision then 1-gram merge; a refined value is kept only
    when (city, state, zip) is a valid combination and the original does not
    start with a compass word; otherwise the input value stays."""
    step1 = _merge_by_key(df, city, fingerprint, "_r1", weight)
    step2 = _merge_by_key(step1, "_r1", one_gram, "_r2", weight, near=True)
    valid = zips.select(F.col("city").alias("_r2"), F.col("state").alias(state), F.col("zip").alias(zip_col)) \
        .distinct().withColumn("_ok", F.lit(True))
    j = step2.join(valid, ["_r2", state, zip_col], "left")
    keep = (F.coalesce(F.col("_ok"), F.lit(False)) & (F.col("_r2") != F.col(city))
            & ~F.col(city).rlike("^(NORTH|SOUTH|EAST|WEST)"))
    return j.withColumn(out, F.when(keep, F.col("_r2")).otherwise(F.col(city))).drop("_r1", "_r2", "_ok")


def normalize_places(df: DataFrame, zips: DataFrame, city: str = "city_raw", state: str = "state_raw",
                     zip_col: str = "zip_raw", address: str | None = "address_raw") -> DataFrame:
    """NRM8-NRM13 as one job: per-row normalisers (no shuffle), then one
    aggregation to the weighted vocabulary of (city, state, zip), written to
    the shared checkpoint folder; swap and refine run on that vocabulary
    (small), and the result joins back to the rows once."""
    from donorlake.session import checkpoint_root

    checkpoint_root(df.sparkSession)
    if address:
        df = normal_address(df, address)
    df = normal_city(normal_state(normal_zip(df, zip_col), state), city)
    keys = ["city_norm", "state_norm", "zip_norm"]
    vocab = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).checkpoint()
    vocab = swap_city(vocab, zips).checkpoint()
    vocab = refine_city(vocab, zips, weight="_rows")
    v = vocab.select(*[F.col(k).alias(f"_v_{k}") for k in keys], "city_swap", "city_refine")
    cond = None
    for k in keys:
        e = F.col(k).eqNullSafe(F.col(f"_v_{k}"))
        cond = e if cond is None else cond & e
    return df.join(v, cond, "left").drop(*[f"_v_{k}" for k in keys])


# --- profiles --------------------------------------------------------------------


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NRM1: NULL count and share per column (one pass)."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(cols))
    out = wide.selectExpr("_rows", f"stack({len(cols)}, {stack}) AS (column, n_null)")
    return out.select("column", "n_null", F.round(F.col("n_null") / F.nullif(F.col("_rows"), F.lit(0)), 6)
                      .alias("p_null"))


def flag_missing(df: DataFrame, keys: Sequence[str], out: str = "na_flag") -> DataFrame:
    """NRM2."""
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return df.withColumn(out, cond)


def flag_duplicates(df: DataFrame, ignore: Sequence[str], out: str = "dupe_flag") -> DataFrame:
    """NRM3: rows whose other columns repeat. Rows are counted by a 128-bit
    hash of those columns (NULLs included), combined map-side; only the
    hashes that repeat are joined back."""
    cols = [c for c in df.columns if c not in ignore]
    parts = [x for c in cols for x in (F.col(c), F.col(c).isNull())]
    hashed = df.withColumns({"_h1": F.xxhash64(*parts), "_h2": F.xxhash64(F.lit("second"), *parts)})
    repeated = (hashed.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
                .select("_h1", "_h2", F.lit(True).alias("_twice")))
    return hashed.join(repeated, ["_h1", "_h2"], "left").select(
        *df.columns, F.coalesce("_twice", F.lit(False)).alias(out))


def distinct_profile(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """NRM4: distinct count and share per column. Exact by default: each
    column is grouped on its own (values combine map-side); ``approx`` uses
    HyperLogLog in one pass."""
    cols = list(cols or df.columns)
    total = df.agg(F.count(F.lit(1)).alias("_rows"))
    if approx:
        wide = df.agg(*[F.approx_count_distinct(c).alias(f"_d{i}") for i, c in enumerate(cols)])
        stack = ", ".join(f"'{c}', _d{i}" for i, c in enumerate(cols))
        counts = wide.selectExpr(f"stack({len(cols)}, {stack}) AS (column, n_distinct)")
    else:
        counts = reduce(DataFrame.unionByName, [
            df.select(c).distinct().agg(F.count(c).alias("n_distinct")).select(F.lit(c).alias("column"), "n_distinct")
            for c in cols])
    return counts.crossJoin(total).select(
        "column", "n_distinct", F.round(F.col("n_distinct") / F.nullif(F.col("_rows"), F.lit(0)), 6).alias("p_distinct"))


def exact_quantiles(df: DataFrame, x: Column, shares: Sequence[float]) -> list[float | None]:
    """Quantiles with linear interpolation, without sorting: all ranks in two
    scans (``ranks.values_at_ranks``)."""
    n = df.agg(F.count(x.cast("double"))).first()[0]
    if not n:
        return [None for _ in shares]
    at = [(n - 1) * s for s in shares]
    ends = [r for p in at for r in (int(p), min(int(p) + 1, n - 1))]
    v = values_at_ranks(df, x, ends, n)
    return [v[2 * i] + (v[2 * i + 1] - v[2 * i]) * (p - int(p)) for i, p in enumerate(at)]


def amount_summary(df: DataFrame, col: str, exact: bool = True, digits: int | None = None) -> DataFrame:
    """NRM5: min, quartiles, mean, max and share ≤ 0. Exact quartiles come
    from a sketch and one exact pass; ``exact=False`` uses the
    bounded-memory approximate percentile."""
    x = F.col(col).cast("double")
    names = {"q25": 0.25, "median": 0.5, "q75": 0.75}
    if exact:
        q = [F.lit(v).cast("double").alias(n) for n, v in zip(names, exact_quantiles(df, x, list(names.values())))]
    else:
        q = [F.percentile_approx(x, p, 10000).alias(n) for n, p in names.items()]
    out = df.agg(F.min(x).alias("min"), *([] if exact else q), F.avg(x).alias("mean"), F.max(x).alias("max"),
                 (F.count_if(x <= 0) / F.count(x)).alias("p_nonpositive"))
    out = out.select("min", *(q if exact else names), "mean", "max", "p_nonpositive")
    if digits is not None:  # report precision; summation order differs between engines
        out = out.select(*[F.round(c, digits).alias(c) for c in out.columns])
    return out


def date_profile(df: DataFrame, col: str, lo: str, hi: str) -> DataFrame:
    """NRM6: rows per year, with the number outside [lo, hi]."""
    c = F.col(col)
    return df.groupBy(F.year(c).alias("year")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if((c < F.lit(lo).cast("timestamp")) | (c > F.lit(hi).cast("timestamp"))).alias("n_out_of_range"),
        F.min(c).alias("first"), F.max(c).alias("last"))


def tidy_text(df: DataFrame, date_cols: Mapping[str, str] | None = None) -> DataFrame:
    """NRM7: trim every text column, '' → NULL; parse listed date columns
    with the given pattern."""
    out = {f.name: F.nullif(F.trim(F.col(f.name)), F.lit(""))
           for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    df = df.withColumns(out)
    for c, fmt in (date_cols or {}).items():
        df = df.withColumn(c, F.try_to_timestamp(F.col(c), F.lit(fmt)))
    return df


def progress_table(df: DataFrame, stages: Sequence[str], valid: DataFrame) -> DataFrame:
    """NRM14: per stage column: share of non-NULL values in the valid set,
    distinct values, share NULL, values out of the set, distinct out. The
    rows are reduced once to the vocabulary of the stage columns with their
    counts (checkpointed); each stage groups that."""
    from donorlake.session import checkpoint_root

    checkpoint_root(df.sparkSession)
    vcol = valid.columns[0]
    vals = valid.select(F.col(vcol).alias("_x")).filter("_x IS NOT NULL").distinct().withColumn("_ok", F.lit(True))
    vocab = df.groupBy(*stages).agg(F.count(F.lit(1)).alias("_n")).checkpoint()
    parts = []
    for s in stages:
        words = vocab.groupBy(F.col(s).cast("string").alias("_x")).agg(F.sum("_n").alias("_n")).join(vals, "_x", "left")
        present, inside = F.col("_x").isNotNull(), F.col("_ok").isNotNull()
        rows = lambda c: F.coalesce(F.sum(F.when(c, F.col("_n"))), F.lit(0))
        parts.append(words.agg(
            F.round(rows(present & inside) / F.nullif(rows(present), F.lit(0)), 6).alias("prop_in"),
            F.count("_x").alias("n_distinct"),
            F.round(rows(~present) / F.nullif(rows(F.lit(True)), F.lit(0)), 6).alias("prop_na"),
            rows(present & ~inside).alias("n_out"),
            F.count_if(present & ~inside).alias("n_diff"),
        ).select(F.lit(s).alias("stage"), "prop_in", "n_distinct", "prop_na", "n_out", "n_diff"))
    return reduce(DataFrame.unionByName, parts)


def changes(df: DataFrame, before: str, after: str) -> DataFrame:
    """NRM15: (before, after) pairs that differ, with counts."""
    return (df.filter(~F.col(before).eqNullSafe(F.col(after)))
              .groupBy(before, after).agg(F.count(F.lit(1)).alias("n")))
