from pyspark.sql import functions as F

from contrail.operators.split import fold_column, hash_split, random_split


def test_hash_split_disjoint_complete_and_stable(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("key"))
    train, test = hash_split(df, ["key"])
    a = {r.key for r in train.collect()}
    b = {r.key for r in test.collect()}
    assert not (a & b) and len(a | b) == 5000
    assert 0.75 < len(a) / 5000 < 0.85
    train2, _ = hash_split(df.repartition(7), ["key"])
    assert {r.key for r in train2.collect()} == a


def test_fold_column_range(spark):
    df = spark.range(300).select(F.col("id").cast("string").alias("key"))
    folds = {r.f for r in df.select(fold_column(["key"], 3).alias("f")).collect()}
    assert folds == {0, 1, 2}


def test_random_split_complete(spark):
    df = spark.range(1000)
    parts = random_split(df)
    assert sum(p.count() for p in parts) == 1000


def test_null_keys_and_small_sides(spark):
    df = spark.range(200_000).withColumn("k", F.when(F.col("id") % 4 > 0, F.col("id")))
    parts = hash_split(df, ["k"], (1 - 1e-4, 1e-4))
    assert sum(p.count() for p in parts) == 200_000 and parts[1].filter("k is not null").count() > 0
    sides = [p.filter("k is null").count() for p in hash_split(df, ["k"], (0.5, 0.5))]
    assert sorted(sides) == [0, 50_000]  # one key, one side, by its hash
    assert df.filter(fold_column(["k"], 3).isNull()).count() == 0
