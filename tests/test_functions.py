"""Column functions against value tables, including the traps where Spark
and the source database differ."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from donorlake import functions as fn


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("text,expected", [
    ("$1,200.50", Decimal("1200.50")), ("(300)", Decimal("-300.00")), ("($45.10)", Decimal("-45.10")),
    ("-7", Decimal("-7.00")), ("", None), ("abc", None), (None, None),
])
def test_clean_amount(spark, text, expected):
    assert one(spark, fn.clean_amount, text) == expected


@pytest.mark.parametrize("text,expected", [
    ("12.5-", Decimal("-12.50")), ("1,250.00", Decimal("1250.00")), ("3", Decimal("3.00")), ("x-", None),
])
def test_signed_amount(spark, text, expected):
    assert one(spark, fn.signed_amount, text) == expected


def test_digits_amount_drops_sign(spark):
    assert one(spark, fn.digits_amount, "-$12.00") == Decimal("12.00")


@pytest.mark.parametrize("text,expected", [
    ("2/3/2024", dt.datetime(2024, 2, 3)), ("02/03/2024", dt.datetime(2024, 2, 3)),
    ("2024-2-3", dt.datetime(2024, 2, 3)), ("2024-02-03T10:11:12.5Z", dt.datetime(2024, 2, 3, 10, 11, 12)),
    ("02/30/2024", None), ("20240203", None), ("", None), (None, None),
])
def test_parse_flexible_date(spark, text, expected):
    assert one(spark, fn.parse_flexible_date, text) == expected


@pytest.mark.parametrize("text,ok", [("2/29/2024", True), ("2/29/2023", False), ("2/29/1900", False),
                                     ("2/29/2000", True), ("4/31/2024", False), ("13/1/2024", False)])
def test_safe_parse_date_calendar(spark, text, ok):
    assert (one(spark, fn.safe_parse_date, text) is not None) == ok


def test_parse_ts_layouts(spark):
    from donorlake.functions import dates

    assert one(spark, lambda c: fn.parse_ts(c, dates.YYYYMMDD), "20240203") == dt.datetime(2024, 2, 3)
    assert one(spark, lambda c: fn.parse_ts(c, dates.MDY_AMPM), "2/3/2024 1:05:00 PM") == dt.datetime(2024, 2, 3, 13, 5)
    df = spark.createDataFrame([("3-Jan", 2024)], "d string, y int")
    assert df.select(fn.parse_day_month("d", "y")).first()[0] == dt.datetime(2024, 1, 3)


def test_excel_serial(spark):
    # kept two days later than the spreadsheet calendar, as the source does
    assert one(spark, fn.excel_serial, "43831") == dt.datetime(2020, 1, 3)


def test_repair_date(spark):
    assert one(spark, lambda c: fn.repair_date(c, 2021), "6/31/2021") == "01/01/2021"
    assert one(spark, lambda c: fn.repair_date(c, 3000), "") == "01/01/2020"
    assert one(spark, lambda c: fn.repair_date(c, 2021), "6/30/2021") == "6/30/2021"


def test_surrogate_key_null_token(spark):
    df = spark.createDataFrame([("a", None)], "a string, b string")
    got = df.select(fn.surrogate_key("a", "b")).first()[0]
    import hashlib

    assert got == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest()


@pytest.mark.parametrize("text,expected", [
    ("DOE, JANE", "JANE DOE"), ("DOE, JANE, JR", "JANE DOE"), ("Jane Q Doe", "Jane Q Doe"), (None, None),
])
def test_flip_name(spark, text, expected):
    assert one(spark, fn.flip_name, text) == expected


def test_join_name_modes(spark):
    df = spark.createDataFrame([("Jane", None, "Doe"), ("Jane", "", "Doe")], "f string, m string, l string")
    rows = df.select(*[fn.join_name("f", "m", "l", mode=m).alias(m) for m in
                       ("skip_blank", "ws", "concat", "strict")]).collect()
    assert rows[0]["skip_blank"] == "Jane Doe" and rows[0]["ws"] == "Jane Doe"
    assert rows[0]["concat"] == "Jane  Doe" and rows[0]["strict"] is None
    assert rows[1]["ws"] == "Jane  Doe" and rows[1]["strict"] == "Jane  Doe"


@pytest.mark.parametrize("text,expected", [("o'neil", "O'Neil"), ("SMITH-JONES", "Smith-Jones"),
                                           ("mary  ann", "Mary  Ann"), ("", "")])
def test_title_breaks_on_non_alnum(spark, text, expected):
    assert one(spark, fn.title, text) == expected


def test_name_concat_and_cut(spark):
    df = spark.createDataFrame([("Jane Q Doe", "12345-6789", "A very long employer name")], "n string, z string, e string")
    r = df.select(fn.name_concat("n", "z").alias("k"), fn.cut("e", 20).alias("e")).first()
    assert r["k"] == "JANE|DOE|12345" and r["e"] == "A very long employer"


def test_to_int_rounded_half_away_from_zero(spark):
    df = spark.createDataFrame([(Decimal("2.50"),), (Decimal("-2.50"),), (Decimal("2.49"),)], "x decimal(38,2)")
    assert [r[0] for r in df.select(fn.to_int_rounded("x")).collect()] == [3, -3, 2]


def test_regex_helpers(spark):
    assert one(spark, lambda c: fn.first_match(c, "C[0-9]{8}"), "EARMARKED C12345678 x") == "C12345678"
    assert one(spark, lambda c: fn.first_match(c, "C[0-9]{8}"), "none") is None
    assert one(spark, lambda c: fn.replace_first(c, "a", "$1"), "banana") == "b$1nana"
    assert one(spark, lambda c: fn.replace_all(c, "a", "o"), "banana") == "bonono"
    assert one(spark, lambda c: fn.part(c, " ", 5), "a b") == ""
    assert one(spark, lambda c: fn.last_part(c, ","), "a,b,c") == "c"
    df = spark.createDataFrame([("EARMARKED C00401224", "C99999999"), ("none", "C99999999")], "m string, f string")
    assert [r[0] for r in df.select(fn.earmark_committee("m", "f")).collect()] == ["C00401224", "C99999999"]


def test_parse_address_layouts(spark):
    want = {
        "12 Main St, Salem, OR 97301-1234": ("12 Main St", "Salem", "OR", "97301-1234"),
        "Greenville, SC 29601": (None, "Greenville", "SC", "29601"),
        "1 A St, Apt 2, Sun City,az,85351": ("1 A St, Apt 2", "Sun City", "AZ", "85351"),
        "9 Elm St, Casper, WY": ("9 Elm St", "Casper", "WY", None),
        "Nashville TN  37201": (None, "Nashville", "TN", "37201"),
        "Montgomery 36104": (None, "Montgomery", None, "36104"),
        "12 Main St": (None, None, None, None),
        "no zip here": (None, None, None, None),
        "": (None, None, None, None),
    }
    df = spark.createDataFrame([(a,) for a in want] + [(None,)], "a string")
    got = {r["a"]: tuple(r["p"]) for r in df.select("a", fn.parse_address("a").alias("p")).collect()}
    assert got == want | {None: (None,) * 4}


def test_pad_left_keeps_long_values(spark):
    df = spark.createDataFrame([(7,), (12345,), (123456,)], "n long")
    assert [r[0] for r in df.select(fn.pad_left("n", 5)).collect()] == ["00007", "12345", "123456"]


def test_map_codes_and_first_present(spark):
    df = spark.createDataFrame([("x", " ", None, "z"), ("q", "b", "c", None)], "k string, a string, b string, c string")
    got = df.select(fn.map_codes("k", {"x": "X"}, "U").alias("m"), fn.first_present("a", "b", "c").alias("p")).collect()
    assert [(r["m"], r["p"]) for r in got] == [("X", "z"), ("U", "b")]


def test_add_components_blank_is_zero(spark):
    df = spark.createDataFrame([(Decimal("10.00"), "", "2.5")], "a decimal(38,2), b string, c string")
    assert df.select(fn.add_components("a", "b", "c")).first()[0] == Decimal("12.50")


def test_addresses_without_commas(spark):
    from donorlake.operators.addresses import place_addresses

    cities = spark.createDataFrame([("97301", "SALEM"), ("97301-2222", "West Salem"), ("21201", "Baltimore"), ("60601", "X")],
                                   "zip_code string, city string")
    given = ["123 ELM ST SALEM OR 97301", "9 Oak Ave West Salem OR 97301-1111", "1 A ST UNKNOWN OR 97301", "5 Pratt St Baltimore MD 21201",
             "CHICAGO, IL 606011234", "Boise, ID 83702-", "12 Main St, Salem, OR 97301", "SALEM OR 97301", "nothing here", None,
             "77 SALEM SALEM OR 97301", "44 Elm St OR"]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(given)] + [(99, given[0])], "i int, a string")
    got = {r["i"]: tuple(r)[2:] for r in place_addresses(df, "a", cities).collect()}
    assert got[0] == got[99] == ("123 ELM ST", "SALEM", "OR", "97301")
    assert got[1] == ("9 Oak Ave", "West Salem", "OR", "97301-1111")
    assert got[2] == ("1 A ST UNKNOWN", None, "OR", "97301")
    assert got[3] == ("5 Pratt St", "Baltimore", "MD", "21201")
    assert got[4] == (None, "CHICAGO", "IL", "60601-1234")
    assert got[5] == (None, "Boise", "ID", "83702")
    assert got[6] == ("12 Main St", "Salem", "OR", "97301")
    assert got[7] == (None, "SALEM", "OR", "97301")
    assert got[8] == got[9] == got[11] == (None, None, None, None)
    assert got[10] == ("77 SALEM", "SALEM", "OR", "97301")
