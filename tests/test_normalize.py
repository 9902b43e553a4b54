"""Normalisers and clustering on small value tables."""

from pyspark.sql import functions as F

from donorlake.operators import normalize as nz


def test_zip_state_city_address(spark):
    df = spark.createDataFrame([
        ("29407-6256", " sc ", "st. louis", "518 Ralph Hood Road"),
        ("2940", "South Carolina", "Unknown", "141 clearview circle"),
        ("00000", "ZZ", "N Charleston", "PO Box 619"),
    ], "z string, s string, c string, a string")
    out = df.select(nz.zip_expr(F.col("z")), nz.state_expr(F.col("s")), nz.city_expr(F.col("c")),
                    nz.address_expr(F.col("a"))).collect()
    assert [tuple(r) for r in out] == [
        ("29407", "SC", "SAINT LOUIS", "518 RALPH HOOD RD"),
        ("02940", "SC", None, "141 CLEARVIEW CIR"),
        (None, None, "NORTH CHARLESTON", "PO BOX 619"),
    ]


def test_swap_and_refine(spark):
    zips = spark.createDataFrame([("SC", "29401", "CHARLESTON"), ("SC", "29601", "GREENVILLE")],
                                 "state string, zip string, city string")
    df = spark.createDataFrame([
        (1, "CHARLESTN", "SC", "29401"), (2, "CHRLSTN", "SC", "29401"), (3, "GREENVILLE", "SC", "29601"),
        (4, "GREENVILLE", "SC", "29601"), (5, "GREENVILEL", "SC", "29601"), (6, None, None, None),
    ], "id int, city_norm string, state_norm string, zip_norm string")
    sw = {r.id: r.city_swap for r in nz.swap_city(df, zips).collect()}
    assert sw[1] == "CHARLESTON" and sw[2] == "CHARLESTON" and sw[5] == "GREENVILEL" and sw[6] is None
    ref = {r.id: r.city_refine for r in nz.refine_city(nz.swap_city(df, zips), zips).collect()}
    # the transposed spelling shares the 1-gram key with the common one
    assert ref[5] == "GREENVILLE" and ref[3] == "GREENVILLE"


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (2, "a")], "x int, y string")
    nulls = {r.column: r.n_null for r in nz.null_profile(df).collect()}
    assert nulls == {"x": 0, "y": 1}
    dups = [r.dupe_flag for r in nz.flag_duplicates(df.withColumn("id", F.monotonically_increasing_id()),
                                                   ["id"]).orderBy("x").collect()]
    assert dups == [False, True, True]
    ch = nz.changes(spark.createDataFrame([("sc", "SC"), ("SC", "SC"), ("sc", "SC")], "a string, b string"), "a", "b")
    assert [tuple(r) for r in ch.collect()] == [("sc", "SC", 2)]


def test_clusters_have_a_distance_bound(spark):
    words = [("listen", 9), ("silent", 5), ("re", 9), ("er", 3), ("北京", 2), ("Москва", 3), ("---", 9), ("ü", 1),
             ("GREENVILLE", 8), ("GREENVILEL", 1), ("Málaga", 1), ("malaga", 4), ("Main St.", 1), ("st main", 5), ("|", 2)]
    df = spark.createDataFrame(words, "w string, n long")
    got = {r.w: r.o for r in nz.cluster_merge(df, "w", "o", weight="n").collect()}
    moved = {"GREENVILEL": "GREENVILLE", "Málaga": "malaga", "Main St.": "st main"}
    assert got == {w: moved.get(w, w) for w, _ in words}


def test_exact_quantiles_without_sorting(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    x = np.concatenate([np.round(rng.normal(0, 1e4, 3000), 2), np.full(2000, 7.25), [1e12]])
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(5)
    got = nz.exact_quantiles(df, F.col("x"), [0, 0.25, 0.5, 0.75, 1])
    assert np.allclose(got, np.quantile(x, [0, 0.25, 0.5, 0.75, 1]), rtol=1e-12)
    assert nz.exact_quantiles(df.limit(0), F.col("x"), [0.5]) == [None]


def test_cluster_merge_reads_its_input_once(spark):
    """The vocabulary and the first merge are cut off from what they are made of."""
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    rows = [("Smith", 5), ("SMITH", 2), ("smith!", 1), ("Jones", 3), (None, 1)]
    df = spark.createDataFrame(rows, "w string, n long").mapInArrow(seen, "w string, n long")
    got = {r.w: r.o for r in nz.cluster_merge(df, "w", "o", weight="n").collect()}
    assert got == {"Smith": "Smith", "SMITH": "Smith", "smith!": "Smith", "Jones": "Jones", None: None}
    assert made.value == len(rows)
