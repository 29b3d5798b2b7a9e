from pyspark.sql import functions as F

from contrail.functions import has_letter, hhmm_to_minutes, null_if_token, tolerant_int, valid_clock


def test_hhmm_to_minutes_probes(spark):
    df = spark.createDataFrame([(0,), (741,), (2359,), (1275,), (-5,), (None,)], "h int")
    got = [r[0] for r in df.select(hhmm_to_minutes("h")).collect()]
    assert got == [0, 461, 1439, 795, 35, None]


def expected_minutes(h):
    # each full hundred counts 60 instead of 100
    return h - 40 * (h // 100)


def test_hhmm_matches_reference_arithmetic(spark):
    values = list(range(-250, 2600, 7))
    df = spark.createDataFrame([(v,) for v in values], "h int")
    got = [r[0] for r in df.select(hhmm_to_minutes("h")).collect()]
    assert got == [expected_minutes(v) for v in values]


def test_valid_clock_three_valued(spark):
    df = spark.createDataFrame([(2359,), (2400,), (1275,), (None,), (-5,)], "h int")
    kept = [r[0] for r in df.filter(valid_clock("h")).collect()]
    assert kept == [2359, 1275, -5]   # 2400 and NULL removed; 1275 and -5 pass
    strict = [r[0] for r in df.filter(valid_clock("h", strict=True)).collect()]
    assert strict == [2359]


def test_tolerant_int_edges(spark):
    vals = ["32.89", "-97.9", "N7", "99999999999", "00", "0.0", "2147483647", "-2147483648.9",
            "2147483648", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(tolerant_int("s")).collect()]
    assert got == [32, -97, None, None, 0, 0, 2147483647, -2147483648, None, None]


def test_null_token_exact(spark):
    df = spark.createDataFrame([("NA",), ("na",), (" NA",), (None,), ("x",)], "s string")
    got = [r[0] for r in df.select(null_if_token("s")).collect()]
    assert got == [None, "na", " NA", None, "x"]


def test_has_letter_unicode(spark):
    df = spark.createDataFrame([("123",), ("N7",), ("é",), ("-1.5",)], "s string")
    assert [r[0] for r in df.select(has_letter(F.col("s"))).collect()] == [False, True, True, False]


def test_tolerant_int_takes_plain_decimals_like_a_non_ansi_cast(spark):
    texts = ["5D", "7f", "1e3", "0x1p3", "0.4", ".5", "12", " 12 ", "-3.9", "+4", "1.", "", "a",
             "2147483647", "2147483648", "-2147483648", "99999999999", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    was = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        want = [r[0] for r in df.selectExpr("cast(t as int)").collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", was)
    assert [r[0] for r in df.select(tolerant_int("t")).collect()] == want
