import random
import re

import pytest

from contrail.operators import dedupe
from contrail.operators.dedupe import dedupe_by_hash


def frame(spark, n=4000, seed=4):
    rnd = random.Random(seed)
    rows = [(rnd.choice([None, "a", "b"]), rnd.choice([None, "a", "b"]), rnd.choice([0.0, -0.0, 1.5]),
             rnd.randint(0, 300)) for _ in range(n)]
    rows += [("hot", None, float("nan"), 1)] * 2000
    return spark.createDataFrame(rows, "x string, y string, f double, i int").repartition(9)


def keys(df):
    return sorted(str((r["x"], r["y"], r["f"] + 0.0, r["i"])) for r in df.collect())


def test_same_rows_as_drop_duplicates(spark):
    df = frame(spark)
    got = dedupe_by_hash(df)
    assert got.columns == df.columns
    assert keys(got) == keys(df.dropDuplicates())


def test_beyond_the_bitmap_bound(spark):
    df = frame(spark)
    assert keys(dedupe_by_hash(df, bitmap_bytes=0)) == keys(df.dropDuplicates())


def test_colliding_hashes_are_compared_in_full(spark, monkeypatch):
    real = dedupe.row_hashes

    def weak(df):
        hashes = real(df)
        return {**hashes, "_k1": hashes["_k1"] % 3, "_k2": hashes["_k2"] % 2}

    monkeypatch.setattr(dedupe, "row_hashes", weak)
    df = frame(spark)
    assert keys(dedupe_by_hash(df)) == keys(df.dropDuplicates())


def test_empty_table(spark):
    empty = spark.createDataFrame([], "x string, y string")
    assert dedupe_by_hash(empty).count() == 0


def test_shuffle_carries_no_column_of_the_rows(spark, monkeypatch):
    """What is grouped are hashes and places; the result itself reads files without a shuffle."""
    plans = []
    real = dedupe.materialize
    monkeypatch.setattr(dedupe, "materialize", lambda df, label: plans.append(
        (label, df._jdf.queryExecution().executedPlan().toString())) or real(df, label))
    out = dedupe_by_hash(frame(spark))
    groups = dict(plans)["dedupe-groups"]
    partial = next(x for x in groups.splitlines() if "functions=[partial_" in x)
    assert "hashpartitioning(_k1" in groups and "keys=[_k1" in partial
    assert not re.search(r"(?<!\w)[xyfi]#", partial)
    assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [1, 70_000])
def test_bitmaps_hold_many_buckets(spark, n):
    ids = spark.range(n).selectExpr("id % 40000 AS k").repartition(2)
    assert dedupe_by_hash(ids).count() == min(n, 40_000)
