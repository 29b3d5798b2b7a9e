from contrail.plans.config import PipelineConfig
from contrail.plans.flows import run_categorical, run_numeric
from contrail.sources import scan_csv
from tests.conftest import FLIGHT_HEADER, flight_rows, write_csv


def test_categorical_pipeline_on_flights(spark, flights_csv):
    raw = scan_csv(spark, flights_csv)
    res = run_categorical(raw, PipelineConfig(split_key=("Month", "DepTime", "Distance")))
    rep = res.report
    assert rep["n_rows"] == 400
    assert "TaxiIn" in rep["forbidden_dropped"]
    assert set(rep["constant_dropped"]) == {"Year", "Cancelled"}
    assert rep["categorical"] == ["UniqueCarrier", "TailNum", "Origin", "Dest"]
    assert rep["correlated_dropped"] == ["CRSElapsedTime", "CRSDepTime"]
    assert ("CRSElapsedTime", "Distance") in {(a, b) for a, b, _ in rep["high_corr_before"]} or \
        ("Distance", "CRSElapsedTime") in {(a, b) for a, b, _ in rep["high_corr_before"]}
    m = res.metrics.first()
    assert m.model == "linear" and res.metrics.count() == 2 and m.n > 0 and m.r2 > 0.5
    assert [r.Month for r in res.trend.collect()] == sorted(r.Month for r in res.trend.collect())
    plan = res.encoded._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_numeric_pipeline_with_airports(spark, flights_csv, airports_csv):
    raw = scan_csv(spark, flights_csv)
    airports = scan_csv(spark, airports_csv)
    cfg = PipelineConfig(categorical=("UniqueCarrier",), models=("linear", "forest"),
                         forest_trees=5)
    res = run_numeric(raw, airports, cfg)
    rep = res.report
    assert rep["n_missing_keys"] == 1 and [r[0] for r in rep["missing_keys"].collect()] == ["XYZ"]
    assert rep["rows_without_lookup"] > 0
    assert "OriginLat" in res.clean.columns and dict(res.clean.dtypes)["OriginLat"] == "double"
    assert {r.model for r in res.metrics.collect()} == {"linear", "forest"}
    # the TailNum text column is not in the categorical list: the cast empties it, so it goes
    assert rep["unencoded_dropped"] == ["TailNum"]


def test_reference_parity_options(spark, flights_csv, airports_csv):
    raw = scan_csv(spark, flights_csv)
    cfg = PipelineConfig(categorical=("UniqueCarrier",), coordinate_kind="int", fit_on="all")
    res = run_numeric(raw, scan_csv(spark, airports_csv), cfg)
    assert dict(res.clean.dtypes)["OriginLat"] == "int"
    assert res.metrics.count() == 2


def test_partial_aggregate_before_the_only_exchange(spark, flights_csv):
    from contrail.plans.flows import _prepare
    deduped, _, _ = _prepare(scan_csv(spark, flights_csv), PipelineConfig(materialize=False), {})
    plan = deduped._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.split("Exchange hashpartitioning")[1].count("HashAggregate") == 1
    assert deduped.count() == 400


def test_unencoded_text_column_goes_whole(spark, flights_csv, tmp_path):
    rows = [r[:] for r in flight_rows()]
    for i, r in enumerate(rows):
        r[7] = "5500D" if i % 5 == 0 else f"N{100 + i % 9}"
    raw = scan_csv(spark, write_csv(str(tmp_path / "tails.csv"), FLIGHT_HEADER, rows))
    res = run_categorical(raw, PipelineConfig(categorical=("UniqueCarrier", "Origin", "Dest"),
                                              models=("linear",)))
    assert res.report["unencoded_dropped"] == ["TailNum"]
    assert res.report["rows_dropped_by_cast"] == 0
    assert res.clean.count() == res.report["n_rows_after_dedupe"] - res.report["invalid_time_rows"]


def test_repeated_dimension_keys_keep_counts_right(spark, flights_csv, airports_csv):
    dim = scan_csv(spark, airports_csv)
    res = run_numeric(scan_csv(spark, flights_csv), dim.unionAll(dim.filter("iata = 'ORD'")),
                      PipelineConfig(categorical=("UniqueCarrier",), models=("linear",)))
    assert res.report["n_rows_after_dedupe"] == 400 and res.report["duplicates"] == 0


def test_staged_paths_reported(spark, flights_csv):
    raw = scan_csv(spark, flights_csv)
    res = run_categorical(raw, PipelineConfig(split_key=("Month", "DepTime", "Distance")))
    paths = res.report["staged_paths"]
    assert len(paths) == 2 and all("contrail-" in p for p in paths)


def test_empty_file_profiles_and_clear_flow_error(spark, tmp_path):
    import pytest

    from contrail.operators.profile import null_profile
    from tests.conftest import FLIGHT_HEADER, write_csv
    path = write_csv(str(tmp_path / "empty.csv"), FLIGHT_HEADER, [])
    raw = scan_csv(spark, path, columns=FLIGHT_HEADER)
    prof = null_profile(raw).collect()
    assert all(r.n_rows == 0 and r.pct_null is None for r in prof)
    with pytest.raises(ValueError, match="no rows left"):
        run_categorical(raw, PipelineConfig())
