import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from contrail.plans.queries import QUERIES
from contrail.sources.tables import TABLES
from tests.conftest import SF_SMALL

NO_ORACLE = {"random_split", "rf_predict", "cv_grid", "ml_stages", "categorical_flow",
             "numeric_flow"}


def test_contract_keys():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) - set(oracle_sql()) == NO_ORACLE


def test_entry_runs(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) >= 1 and "rmse" in df.columns


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        v = "nan" if v != v else round(v, 6)
    return repr(v)


@pytest.mark.parametrize("name", ["null_profile", "distinct_profile", "role_join", "corr_matrix",
                                  "string_index", "one_hot", "hash_split", "lr_coefficients",
                                  "regression_metrics", "tolerant_int", "hhmm_to_minutes",
                                  "duplicate_count", "missing_keys", "row_counts",
                                  "dimension_scan", "corr_matrix_nulls", "random_split_check",
                                  "rf_bounds", "cv_ridge", "categorical_flow_report",
                                  "numeric_flow_report", "string_index_table", "rf_stump",
                                  "cv_certificate", "model_round_trip", "corr_wide",
                                  "preview_first", "csv_rejects", "sink_round_trip",
                                  "dedupe_by_hash", "profile_merge", "distinct_sketch"])
def test_oracle_agrees_small(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    res = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = sorted(tuple(_norm(r[i]) for i in idx) for r in res.fetchall())
    assert got == want
