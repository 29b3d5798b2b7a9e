import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from contrail.operators.features import (
    check_cardinality,
    encode_categoricals,
    index_labels,
    min_max_scale,
    string_index,
)


def test_index_frequency_then_alphabetical(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "a", "c", "c", "b", "a", "c"]], "k string")
    out, model = string_index(df, ["k"])
    assert index_labels(model) == {"k": ["c", "a", "b"]}  # a and b tie: alphabetical
    assert {r.k: r.k_Index for r in out.distinct().collect()} == {"c": 0.0, "a": 1.0, "b": 2.0}


def test_one_hot_drop_last_and_rename(spark):
    df = spark.createDataFrame([("x", 1), ("y", 2), ("y", 3), ("z", 4)], "k string, v int")
    out, _, labels = encode_categoricals(df, ["k"])
    assert out.columns == ["v", "k"]
    arrs = {r.v: r.a for r in out.select("v", vector_to_array("k").alias("a")).collect()}
    assert all(len(a) == 2 and sum(a) <= 1 for a in arrs.values())
    assert arrs[2] == [1.0, 0.0] and arrs[1] == [0.0, 1.0] and arrs[4] == [0.0, 0.0]


def test_single_category_clear_error(spark):
    df = spark.createDataFrame([("x",), ("x",)], "only string")
    with pytest.raises(ValueError, match="only"):
        encode_categoricals(df, ["only"])


def test_cardinality_guard(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("k"))
    with pytest.raises(ValueError, match="too many categories"):
        check_cardinality(df, ["k"], max_categories=100)


def test_min_max_scale(spark):
    df = spark.createDataFrame([(1, 7), (3, 7), (5, 7)], "a int, c int")
    out, bounds = min_max_scale(df, ["a", "c"])
    assert bounds == {"a": (1.0, 5.0), "c": (7.0, 7.0)}
    got = [(r.a_Scaled, r.c_Scaled) for r in out.collect()]
    assert got == [(0.0, 0.5), (0.5, 0.5), (1.0, 0.5)]


def test_min_max_matches_spark_scaler(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import MinMaxScaler, VectorAssembler
    df = spark.createDataFrame([(float(i * i % 17),) for i in range(30)], "x double")
    ours = [r[0] for r in min_max_scale(df, ["x"])[0].collect()]
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="v"),
                            MinMaxScaler(inputCol="v", outputCol="s")]).fit(df)
    theirs = [r[0] for r in pipe.transform(df).select(vector_to_array("s")[0]).collect()]
    assert all(abs(a - b) < 1e-12 for a, b in zip(ours, theirs))


def test_model_pipeline_fits_and_replays(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.regression import LinearRegression

    from contrail.operators.features import model_pipeline
    rows = [(["a", "b", "c"][i % 3], float(i % 11), 2.0 * (i % 11) + (i % 3)) for i in range(90)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    pipe = model_pipeline(["k"], ["x"], LinearRegression(labelCol="y"))
    model = pipe.fit(df)
    path = str(tmp_path / "model")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    a = [r.prediction for r in model.transform(df).collect()]
    b = [r.prediction for r in again.transform(df).collect()]
    assert a == b
    assert max(abs(p - r.y) for p, r in zip(a, df.collect())) < 1e-6


def test_keep_invalid_encoding_is_full_rank(spark):
    from pyspark.ml.functions import vector_to_array as v2a
    train = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "k string")
    test = spark.createDataFrame([("a",), ("c",), ("zzz",)], "k string")
    _, model, labels = encode_categoricals(train, ["k"], handle_invalid="keep")
    assert labels == {"k": ["a", "b", "c"]}
    out = model.transform(test).select("k", v2a("k_OneHot").alias("v")).collect()
    got = {r.k: r.v for r in out}
    assert got == {"a": [1.0, 0.0], "c": [0.0, 0.0], "zzz": [0.0, 0.0]}  # size k-1
    assert "k_OneHotFull" not in model.transform(test).columns
