from pyspark.sql import functions as F

from contrail.operators.profile import null_profile
from contrail.operators.profile_state import (
    SKETCH_ERROR,
    load_states,
    merge_states,
    outside_error,
    profile_state,
    store_state,
)


def part(spark, low, high):
    return spark.range(low, high).select(
        F.col("id").cast("string").alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias(
            "v"), F.lit(None).cast("string").alias("none"))


def test_merged_states_are_the_profile_of_the_union(spark, tmp_path):
    path, parts = str(tmp_path / "states"), [part(spark, 0, 9000), part(spark, 6000, 20000)]
    for name, df in zip(("a", "b"), parts):
        store_state(profile_state(df, name), path)
    merged = {r["column_name"]: r for r in merge_states(load_states(spark, path)).collect()}
    for r in null_profile(parts[0].unionAll(parts[1])).collect():
        m = merged[r["column_name"]]
        assert (m["position"], m["n_rows"], m["n_null"]) == (r["position"], r["n_rows"], r["n_null"])
        assert abs(m["pct_null"] - r["pct_null"]) < 1e-9
    assert (merged["k"]["low"], merged["k"]["high"]) == ("0", "9999")
    assert abs(merged["k"]["n_distinct"] - 20_000) <= 20_000 * SKETCH_ERROR
    assert merged["v"]["n_distinct"] == 50 and merged["none"]["n_distinct"] == 0


def test_an_input_delivered_again_replaces_its_state(spark, tmp_path):
    path = str(tmp_path / "states")
    store_state(profile_state(part(spark, 0, 10), "a"), path)
    store_state(profile_state(part(spark, 0, 5), "b"), path)
    store_state(profile_state(part(spark, 0, 30), "a"), path)
    merged = merge_states(load_states(spark, path)).filter("column_name = 'k'").first()
    assert merged["n_rows"] == 35


def test_states_of_empty_and_unlike_inputs(spark):
    states = profile_state(part(spark, 0, 0), "empty").unionByName(
        profile_state(part(spark, 0, 4).drop("v"), "narrow"))
    merged = {r["column_name"]: r for r in merge_states(states).collect()}
    assert merged["k"]["n_rows"] == 4 and merged["v"]["n_rows"] == 0
    assert merged["v"]["pct_null"] is None and merged["v"]["low"] is None


def test_outside_error(spark):
    rows = spark.createDataFrame([(100, 100), (104, 100), (106, 100), (2, 1), (0, 0)], "e long, x long")
    got = [r[0] for r in rows.select(outside_error(F.col("e"), F.col("x"))).collect()]
    assert got == [False, False, True, False, False]
