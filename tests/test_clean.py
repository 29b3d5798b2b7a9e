from contrail.operators.clean import (
    cast_numeric,
    constant_columns,
    dedupe,
    drop_columns,
    drop_null_rows,
    filter_valid_times,
    replace_null_tokens,
    sparse_columns,
    times_to_minutes,
)


def test_replace_tokens_only_text_columns(spark):
    df = spark.createDataFrame([("NA", 1), ("x", 2)], "s string, n int")
    out = replace_null_tokens(df)
    assert [tuple(r) for r in out.collect()] == [(None, 1), ("x", 2)]
    assert out.columns == ["s", "n"]


def test_drop_columns_ignores_missing(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert drop_columns(df, ["b", "zz"]).columns == ["a"]


def test_sparse_threshold_is_strict(spark):
    # a: exactly 25 % NULL (kept); b: 50 % NULL (dropped)
    rows = [(None, None), (1, None), (2, 3), (3, 4)]
    df = spark.createDataFrame(rows, "a int, b int")
    assert sparse_columns(df) == ["b"]


def test_constant_rule_keeps_all_null(spark):
    df = spark.createDataFrame([("K", None, 1), ("K", None, 2), (None, None, 3)],
                               "c string, n string, v int")
    assert constant_columns(df) == ["c"]


def test_dropna_and_dedupe(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "x int, y string")
    assert drop_null_rows(df).count() == 2
    assert dedupe(drop_null_rows(df)).count() == 1


def test_cast_numeric_keeps_categoricals(spark):
    df = spark.createDataFrame([("32.89", "AA", "k1")], "d string, c string, key string")
    out = cast_numeric(df, ["c"], keep=["key"])
    assert out.dtypes == [("d", "int"), ("c", "string"), ("key", "string")]
    assert tuple(out.first()) == (32, "AA", "k1")


def test_times_pipeline(spark):
    df = spark.createDataFrame([(741, 0), (2400, 5), (None, 5), (1275, 2359)], "a int, b int")
    out = times_to_minutes(filter_valid_times(df, ["a", "b", "not_there"]), ["a", "b"])
    assert [tuple(r) for r in out.collect()] == [(461, 0), (795, 1439)]
