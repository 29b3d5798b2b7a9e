
from contrail.operators.clean import cast_columns, filter_valid_times, replace_null_tokens, times_to_minutes
from contrail.sources.files import all_string_schema


def test_stateless_cleaning_runs_on_a_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text("DepTime,ArrDelay\n741,NA\n2400,5\n1275,3\n")
    stream = (spark.readStream.option("header", True)
              .schema(all_string_schema(["DepTime", "ArrDelay"])).csv(str(src)))
    out = times_to_minutes(filter_valid_times(
        cast_columns(replace_null_tokens(stream), ["DepTime", "ArrDelay"], "int"), ["DepTime"]),
        ["DepTime"])
    q = out.writeStream.format("memory").queryName("cleaned").outputMode("append").start()
    try:
        q.processAllAvailable()
        rows = sorted(tuple(r) for r in spark.table("cleaned").collect())
    finally:
        q.stop()
    assert rows == [(461, None), (795, 3)]
