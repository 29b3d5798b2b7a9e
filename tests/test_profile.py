import pytest
from pyspark.sql import functions as F

from contrail.operators.profile import (
    categorical_profile,
    detect_categorical,
    distinct_profile,
    duplicate_count,
    null_profile,
    profile_columns,
    zero_count,
)


def test_null_profile_values(spark):
    df = spark.createDataFrame([(None, "a"), (1, None), (2, None), (3, "b")], "x int, y string")
    rows = {r.column_name: r for r in null_profile(df).collect()}
    assert rows["x"].n_null == 1 and rows["x"].pct_null == 25.0
    assert rows["y"].n_null == 2 and rows["y"].pct_null == 50.0
    assert rows["x"].n_rows == 4


def test_null_profile_empty_input_gives_null_pct(spark):
    df = spark.createDataFrame([], "x int")
    r = null_profile(df).first()
    assert r.n_rows == 0 and r.pct_null is None


def test_profile_is_one_job(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("a"), F.col("id").cast("string").alias("b"))
    prof = profile_columns(df, ("n_null", "pct_null", "is_constant", "has_letters"))
    plan = prof._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") <= 1
    assert "BatchEvalPython" not in plan


def test_distinct_exact_and_approx(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("k"))
    assert distinct_profile(df).first().n_distinct == 10
    assert abs(distinct_profile(df, exact=False).first().n_distinct - 10) <= 1


def test_zero_count_text_forms(spark):
    df = spark.createDataFrame([("0",), ("00",), ("0.0",), ("5",), ("x",), (None,)], "t string")
    r = zero_count(df, "t").first()
    assert (r.n_zero, r.n_rows) == (3, 6)


def test_duplicate_count(spark):
    df = spark.createDataFrame([(1, "a")] * 5 + [(2, "b"), (3, None), (3, None)], "x int, y string")
    r = duplicate_count(df).first()
    assert (r.n_rows, r.n_distinct, r.n_duplicates) == (8, 3, 5)


def test_categorical_whole_column_rule(spark):
    # first row has no letter, a later one does: still categorical
    df = spark.createDataFrame([("123", "1"), ("N7", "2")], "tail string, n string")
    assert detect_categorical(df) == ["tail"]
    assert detect_categorical(df, exclude=["tail"]) == []
    flags = {r.column_name: r.is_categorical for r in categorical_profile(df).collect()}
    assert flags == {"tail": True, "n": False}


@pytest.mark.parametrize("stat", ["bogus"])
def test_unknown_stat(spark, stat):
    with pytest.raises(ValueError):
        profile_columns(spark.range(1), (stat,))


def test_first_rows_settle_only_what_they_prove(spark):
    """Constancy and letters are those of all rows, whatever the first rows show."""
    from contrail.operators.profile import constant_and_letters, profile_columns
    rows = [(str(i % 3), "K", "K" if i < 500 else "L", "7" if i != 900 else "x",
             None if i < 800 else "1", None, i % 2 if i > 600 else 1) for i in range(1000)]
    df = spark.createDataFrame(rows, "many string, one string, late string, letter string, "
                                     "nulls string, none string, n int").repartition(1)
    want = profile_columns(df, ("is_constant", "has_letters")).collect()
    for few in (1, 10, 1000, 5000):
        got = constant_and_letters(df, few)
        assert [r.asDict() for r in got] == [r.asDict() for r in want]
    assert {r.column_name for r in want if r.is_constant} == {"one", "nulls"}
    assert {r.column_name for r in want if r.has_letters} == {"one", "late", "letter"}
    empty = constant_and_letters(df.filter("n > 5"))
    assert [r.asDict() for r in empty] == [
        r.asDict() for r in profile_columns(df.filter("n > 5"),
                                            ("is_constant", "has_letters")).collect()]


def test_settled_columns_are_not_read_again(spark, monkeypatch):
    from contrail.operators import profile
    asked = []
    real = profile._stat_exprs
    monkeypatch.setattr(profile, "_stat_exprs",
                        lambda name, field, stat: asked.append((name, stat)) or real(name, field, stat))
    df = spark.createDataFrame([("a", "1"), ("b", "2")], "letters string, digits string")
    profile.constant_and_letters(df)
    assert asked[6:] == [("digits", "has_letters")]
