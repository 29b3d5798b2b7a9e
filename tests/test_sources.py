import pytest

from contrail.sources import merge_inputs, scan_csv, scan_dimension
from contrail.sources.files import scan_inputs
from tests.conftest import write_csv


def test_scan_csv_all_text_and_empty_fields(spark, tmp_path):
    p = write_csv(str(tmp_path / "a.csv"), ["x", "y"], [["1", "NA"], ["", "2.5"]])
    df = scan_csv(spark, p)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["string", "string"]
    assert [tuple(r) for r in df.collect()] == [("1", "NA"), (None, "2.5")]


def test_scan_csv_explicit_columns_and_null_value(spark, tmp_path):
    p = write_csv(str(tmp_path / "a.csv"), ["x", "y"], [["1", "NA"]])
    df = scan_csv(spark, p, columns=["x", "y"], null_value="NA")
    assert [tuple(r) for r in df.collect()] == [("1", None)]


def test_scan_dimension_projects(spark, airports_csv):
    df = scan_dimension(spark, airports_csv, ["iata", "lat", "long"])
    assert df.columns == ["iata", "lat", "long"]
    assert "airport" not in df._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_merge_by_name_and_positional(spark, tmp_path):
    a = write_csv(str(tmp_path / "a.csv"), ["x", "y"], [["1", "a"]])
    b = write_csv(str(tmp_path / "b.csv"), ["y", "x"], [["b", "2"]])
    by_name = scan_inputs(spark, [a, b])
    assert sorted(tuple(r) for r in by_name.collect()) == [("1", "a"), ("2", "b")]
    positional = merge_inputs([scan_csv(spark, a), scan_csv(spark, b)], positional=True)
    assert sorted(tuple(r) for r in positional.collect()) == [("1", "a"), ("b", "2")]


def test_merge_empty_list_errors(spark):
    with pytest.raises(ValueError):
        merge_inputs([])
    with pytest.raises(ValueError):
        scan_csv(spark, [])


def test_several_paths_align_by_header(spark, tmp_path):
    for name, body in (("a.csv", "x,y\n1,a\n"), ("b.csv", "y,x\nb,2\n")):
        (tmp_path / name).write_text(body)
    df = scan_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert sorted((r.x, r.y) for r in df.collect()) == [("1", "a"), ("2", "b")]


def test_trips_plan_follows_its_files(spark, tmp_path):
    """The plan is kept while the files stay as they are, and made anew when they change."""
    import shutil

    import pyarrow.parquet as pq

    from contrail.sources.tables import table_files, trips
    from tests.conftest import SF_SMALL

    for name in ("nation", "customer", "supplier", "orders", "lineitem"):
        shutil.copy(f"{SF_SMALL}/{name}.parquet", tmp_path)
    first = trips(spark, str(tmp_path))
    assert trips(spark, str(tmp_path)) is first
    n = first.count()
    few = pq.read_table(f"{tmp_path}/lineitem.parquet").slice(0, 100)
    before = table_files(spark, f"{tmp_path}/lineitem.parquet")
    pq.write_table(few, f"{tmp_path}/lineitem.parquet")
    assert table_files(spark, f"{tmp_path}/lineitem.parquet") != before
    again = trips(spark, str(tmp_path))
    assert again is not first and again.count() == 100 != n


def test_scan_partitions_is_what_spark_plans(spark):
    from contrail.operators.sizing import scan_partitions
    from contrail.sources.tables import load_files, table_files
    from tests.conftest import SF_SMALL

    for name in ("nation", "lineitem", "documents"):
        files = table_files(spark, f"{SF_SMALL}/{name}.parquet")
        assert files.n_files == 1
        assert scan_partitions(spark, files.n_bytes, 1) == load_files(
            spark, files).rdd.getNumPartitions()
