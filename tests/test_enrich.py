import pytest

from contrail.operators.enrich import missing_key_count, missing_keys, role_join


@pytest.fixture()
def facts(spark):
    return spark.createDataFrame(
        [("f1", "ORD", "DFW"), ("f2", "DFW", "XYZ"), ("f3", "ATL", "ORD"), ("f4", "ORD", "ORD")],
        "id string, Origin string, Dest string")


@pytest.fixture()
def airports(spark):
    return spark.createDataFrame(
        [("ORD", 41.98, -87.9), ("DFW", 32.89, -97.04), ("ATL", 33.64, -84.43)],
        "iata string, lat double, long double")


ROLES = {"Origin": "Origin", "Dest": "Dest"}
ATTRS = {"lat": "Lat", "long": "Long"}


def test_role_join_inner(facts, airports):
    out = role_join(facts, airports, "iata", ROLES, ATTRS)
    assert out.columns == ["id", "OriginLat", "OriginLong", "DestLat", "DestLong"]
    got = {r.id: (r.OriginLat, r.DestLong) for r in out.collect()}
    assert got == {"f1": (41.98, -97.04), "f3": (33.64, -87.9), "f4": (41.98, -87.9)}


def test_role_join_broadcasts_checked_dim(spark, facts, airports, tmp_path):
    airports.write.parquet(str(tmp_path / "dim"))
    airports = spark.read.parquet(str(tmp_path / "dim"))
    out = role_join(facts, airports, "iata", ROLES, ATTRS)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_role_join_above_bound_no_hint(facts, airports):
    out = role_join(facts, airports, "iata", ROLES, ATTRS, broadcast_max_bytes=1)
    assert out.count() == 3  # same answer whatever the strategy


def test_duplicate_dimension_rows(spark, facts, airports):
    dup = airports.union(spark.createDataFrame([("ORD", 0.0, 0.0)], airports.schema))
    assert role_join(facts, dup, "iata", ROLES, ATTRS).count() == 2 + 2 + 4  # f1 x2, f3 x2, f4 x4
    with pytest.raises(ValueError, match="not unique"):
        role_join(facts, dup, "iata", ROLES, ATTRS, unique_keys="error")


def test_left_join_keeps_unmatched(facts, airports):
    out = role_join(facts, airports, "iata", ROLES, ATTRS, how="left")
    assert out.count() == 4


def test_missing_keys(facts, airports):
    assert [r.iata for r in missing_keys(facts, airports, "iata", ["Origin", "Dest"]).collect()] == ["XYZ"]
    assert missing_key_count(facts, airports, "iata", ["Origin", "Dest"]).first().n_missing == 1


def test_salted_shuffle_join_same_answer(spark, facts, airports):
    plain = role_join(facts, airports, "iata", ROLES, ATTRS)
    salted = role_join(facts, airports, "iata", ROLES, ATTRS, broadcast_max_bytes=1,
                       salt_buckets=4)
    assert salted.columns == plain.columns
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, plain.collect()))
    left = role_join(facts, airports, "iata", ROLES, ATTRS, how="left", broadcast_max_bytes=1,
                     salt_buckets=3)
    assert left.count() == 4


def test_hot_key_spread_over_salts(spark, airports):
    # one origin holds every row: salting spreads it over the join tasks
    facts = spark.range(3000).selectExpr("cast(id as string) as id", "'ORD' as Origin",
                                         "'DFW' as Dest")
    out = role_join(facts, airports, "iata", ROLES, ATTRS, broadcast_max_bytes=1, salt_buckets=8)
    assert out.count() == 3000
    from pyspark.sql import functions as F
    salts = facts.select(F.pmod(F.xxhash64(*facts.columns), F.lit(8)).alias("s")).distinct().count()
    assert salts == 8
