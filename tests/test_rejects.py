import pytest

from contrail.sources import preview, write_parquet
from contrail.sources.rejects import scan_csv_checked

COLS = ["a", "b", "c"]
LINES = ["a,b,c", "1,x,2", "short,row", "one,too,many,fields", '4,"open,5', '5,"a, b",6',
         '6,"say ""hi"", twice",7', "8,,9", "", ",,", 'x,y,"', '7,in"ner,8', "9,é,end"]


@pytest.fixture()
def path(tmp_path):
    (tmp_path / "one.csv").write_text("\n".join(LINES) + "\n")
    (tmp_path / "two.csv").write_text("a,b,c\r\n10,z,11\r\nbad\r\n")
    return str(tmp_path)


def test_every_record_is_kept_or_rejected(spark, path):
    rows, rejects = scan_csv_checked(spark, path, COLS)
    assert sorted(map(tuple, rows.collect()), key=str) == sorted([
        ("1", "x", "2"), ("5", "a, b", "6"), ("6", 'say "hi", twice', "7"), ("8", None, "9"),
        (None, None, None), ("9", "é", "end"), ("10", "z", "11")], key=str)
    found = {(r["file"].rsplit("/", 1)[1], r["record"]): r["reason"] for r in rejects.collect()}
    assert found == {("one.csv", "short,row"): "short",
                     ("one.csv", "one,too,many,fields"): "long",
                     ("one.csv", '4,"open,5'): "quote", ("one.csv", 'x,y,"'): "quote",
                     ("one.csv", '7,in"ner,8'): "quote", ("two.csv", "bad"): "short"}


def test_other_separators_and_bad_settings(spark, tmp_path):
    (tmp_path / "p.csv").write_text('1|"a|b"|2\n1|2\n')
    rows, rejects = scan_csv_checked(spark, str(tmp_path), COLS, sep="|", header=False)
    assert [tuple(r) for r in rows.collect()] == [("1", "a|b", "2")]
    assert [r["reason"] for r in rejects.collect()] == ["short"]
    with pytest.raises(ValueError):
        scan_csv_checked(spark, str(tmp_path), COLS, sep='"')


def test_preview_in_order(spark):
    df = spark.range(1000).repartition(7)
    assert [r["id"] for r in preview(df, 4, by=["id"]).collect()] == [0, 1, 2, 3]
    assert preview(df, 4).count() == 4


def test_dynamic_overwrite_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).selectExpr("id", "id % 4 AS p")
    write_parquet(df, path, partition_by=["p"])
    write_parquet(df.filter("p = 2").selectExpr("id + 1000 AS id", "p"), path, partition_by=["p"],
                  dynamic=True)
    got = {r["p"]: (r["n"], r["least"]) for r in spark.read.parquet(path).groupBy("p").agg(
        {"id": "count"}).withColumnRenamed("count(id)", "n").join(
        spark.read.parquet(path).groupBy("p").agg({"id": "min"}).withColumnRenamed(
            "min(id)", "least"), "p").collect()}
    assert got == {0: (25, 0), 1: (25, 1), 2: (25, 1002), 3: (25, 3)}
    with pytest.raises(ValueError):
        write_parquet(df, path, dynamic=True)
