import random

import pytest
from pyspark.sql import functions as F

from contrail.operators import ranking
from contrail.operators.features import index_labels, string_index
from contrail.operators.ranking import category_ranks, string_index_table


def rows_of(spark, n=3000, seed=5):
    rnd = random.Random(seed)
    data = [("hot" if rnd.random() < 0.4 else f"v{rnd.randint(0, 900)}",
             rnd.choice(["é", "z", "Z", "", "a b"]), i) for i in range(n)]
    return spark.createDataFrame(data, "k string, small string, id int").repartition(7)


def test_ranks_equal_the_fitted_labels(spark):
    df = rows_of(spark)
    _, model = string_index(df, ["k", "small"])
    ranks = {}
    for r in category_ranks(df, ["k", "small"]).collect():
        ranks.setdefault(r["column_name"], {})[r["idx"]] = r["value"]
    assert {c: [v[i] for i in range(len(v))] for c, v in ranks.items()} == index_labels(model)


@pytest.mark.parametrize("bound", [1 << 20, 0])
def test_table_equals_the_indexer_broadcast_or_salted(spark, bound):
    df = rows_of(spark)
    by_model, _ = string_index(df, ["k", "small"])
    by_table, _ = string_index_table(df, ["k", "small"], broadcast_max_bytes=bound)
    assert by_table.columns == by_model.columns
    assert sorted(by_table.collect()) == sorted(by_model.collect())


def test_no_labels_reach_the_driver(spark, monkeypatch):
    """Only the sizes' aggregate may be collected, and the join carries no literal labels."""
    df = rows_of(spark)
    taken = []
    real = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: taken.append(real(self)) or taken[-1])
    out, _ = string_index_table(df, ["k"], handle_invalid="keep", broadcast_max_bytes=0)
    assert sum(map(len, taken)) <= 1
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "v17" not in plan and "LocalRelation" not in plan
    executed = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in executed and "_salt" in executed


def test_unseen_and_null_values(spark):
    fit = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    new = spark.createDataFrame([("a",), ("zz",), (None,)], "k string")
    keep, _ = string_index_table(new, ["k"], fit_df=fit, handle_invalid="keep")
    assert {r["k"]: r["k_Index"] for r in keep.collect()} == {"a": 0.0, "zz": 2.0, None: 2.0}
    skip, _ = string_index_table(new, ["k"], fit_df=fit, handle_invalid="skip")
    assert [tuple(r) for r in skip.collect()] == [("a", 0.0)]
    bad, _ = string_index_table(new, ["k"], fit_df=fit)
    with pytest.raises(Exception, match="no index in column k"):
        bad.collect()
    with pytest.raises(ValueError):
        string_index_table(new, ["k"], handle_invalid="other")


def test_empty_and_many_partitions(spark):
    empty = spark.createDataFrame([], "k string")
    out, ranks = string_index_table(empty, ["k"])
    assert out.count() == 0 and ranks.count() == 0
    ids = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    got = ranking.category_ranks(ids, ["k"]).orderBy("idx").select("value", "idx").collect()
    assert [r["value"] for r in got] == sorted(str(i) for i in range(20_000))
    assert [r["idx"] for r in got] == list(range(20_000))


def test_a_large_side_is_joined_once_a_value_and_a_small_one_broadcast(spark, monkeypatch):
    """Ranks are not copied a salt, and a small column is not shuffled for a large one's sake."""
    monkeypatch.setattr(ranking, "HOT_VALUES", 3)
    df = rows_of(spark)
    by_model, _ = string_index(df, ["k", "small"])
    out, _ = string_index_table(df, ["k", "small"], broadcast_max_bytes=2000)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("strategy=merge") == 1
    assert sorted(out.collect()) == sorted(by_model.collect())


def test_frequent_values_that_the_fit_lacks(spark, monkeypatch):
    monkeypatch.setattr(ranking, "HOT_VALUES", 2)
    fit = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "k string")
    new = spark.createDataFrame([("zz",)] * 5 + [("c",)] * 3 + [("a",), ("b",), (None,)], "k string")
    keep, _ = string_index_table(new, ["k"], fit_df=fit, handle_invalid="keep",
                                 broadcast_max_bytes=0)
    got = sorted((r["k"] or "", r["k_Index"]) for r in keep.collect())
    assert got == sorted([("zz", 3.0)] * 5 + [("c", 2.0)] * 3 + [("a", 0.0), ("b", 1.0), ("", 3.0)])
