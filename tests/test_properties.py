import re
"""Property tests (hypothesis) for the per-row expressions and set operators."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from contrail.functions import hhmm_to_minutes, tolerant_int
from contrail.operators.clean import dedupe
from contrail.operators.features import min_max_scale
from contrail.operators.split import hash_split

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def py_minutes(h):
    return h - 40 * (h // 100)  # each full hundred counts 60 instead of 100


def py_tolerant_int(text):
    """Plain decimal text only, truncated, in the range of an int."""
    if not re.fullmatch(r"\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)\s*", text):
        return None
    n = int(float(text))
    return n if -2**31 <= n < 2**31 else None


@SETTINGS
@given(st.lists(st.integers(-100_000, 100_000), min_size=1, max_size=50))
def test_minutes_equal_reference_arithmetic(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "h int")
    got = [r[0] for r in df.select(hhmm_to_minutes("h")).collect()]
    assert got == [py_minutes(v) for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.floats(allow_nan=False, allow_infinity=False, width=32),
                          st.integers(-3_000_000_000, 3_000_000_000)), min_size=1, max_size=40))
def test_tolerant_int_matches_model(spark, values):
    texts = [repr(v) if isinstance(v, float) else str(v) for v in values]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(tolerant_int("s")).collect()]
    assert got == [py_tolerant_int(t) for t in texts]


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None])), max_size=40))
def test_dedupe_idempotent_and_exact(spark, rows):
    df = spark.createDataFrame(rows, "x int, y string")
    once = dedupe(df)
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(set(rows), key=repr)
    assert once.count() == dedupe(once).count()


@SETTINGS
@given(st.lists(st.integers(-1000, 1000), min_size=1, max_size=40))
def test_scaled_in_unit_interval(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    out, _ = min_max_scale(df, ["x"])
    got = [r.x_Scaled for r in out.collect()]
    assert all(0.0 <= g <= 1.0 for g in got)
    if len(set(values)) == 1:
        assert set(got) == {0.5}


@SETTINGS
@given(st.lists(st.text(min_size=1, max_size=8), min_size=1, max_size=60, unique=True),
       st.integers(0, 10_000))
def test_hash_split_partition_of_rows(spark, keys, seed):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    parts = hash_split(df, ["k"], (0.7, 0.2, 0.1), seed=seed)
    seen = [sorted(r.k for r in p.collect()) for p in parts]
    flat = [k for s in seen for k in s]
    assert sorted(flat) == sorted(keys)  # disjoint and complete
    again = [sorted(r.k for r in p.collect()) for p in hash_split(df.repartition(3), ["k"],
                                                                 (0.7, 0.2, 0.1), seed=seed)]
    assert again == seen
