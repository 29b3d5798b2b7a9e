"""The driver's Parquet tables and the ``trips`` view built from them.

``trips`` gives the TPC-H-like tables the shape of the flight records the
toolkit was designed for (see FIXTURES.md §3): one row per line item, with
a categorical "carrier" holding some ``NA`` tokens, origin/destination
place names, two clock times as text, a sparse and a constant column,
two strongly correlated predictors and a delay target.
"""

from __future__ import annotations

import os
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from contrail.operators.sizing import DEFAULT_BROADCAST_BYTES, scan_partitions, spread

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

TRIPS_COLUMNS = ("yr", "mo", "row_key", "carrier", "origin", "dest", "dep_hhmm",
                 "arr_hhmm", "sparse_col", "const_col", "distance", "elapsed", "delay")

#: Tables and trips plans that are remembered; the oldest goes first.
REMEMBERED = 64


class TableFiles(NamedTuple):
    """What a table's files say without being read: ``state`` changes when they do."""

    path: str
    state: tuple
    n_bytes: int
    n_files: int


_SCHEMAS: dict[tuple, StructType] = {}
_TRIPS: dict[tuple, DataFrame] = {}


def _remember(kept: dict, key: tuple, value):
    while len(kept) >= REMEMBERED:
        kept.pop(next(iter(kept)))
    kept[key] = value
    return value


def table_files(spark: SparkSession, path: str) -> TableFiles:
    """The files of a Parquet file or folder, from its file system's listing (no job)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    found, todo = [], [f for f in target.getFileSystem(conf).globStatus(target) or []]
    while todo:
        status = todo.pop()
        name = status.getPath().getName()
        if status.isDirectory():
            todo += list(status.getPath().getFileSystem(conf).listStatus(status.getPath()))
        elif not name.startswith(("_", ".")):
            found.append((status.getPath().toString(), status.getModificationTime(),
                          status.getLen()))
    return TableFiles(path, (spark.sparkContext.applicationId, path, *sorted(found)),
                      sum(f[2] for f in found), len(found))


def load_files(spark: SparkSession, files: TableFiles) -> DataFrame:
    """The table; its schema is inferred once while the files stay as they are."""
    schema = _SCHEMAS.get(files.state)
    if schema is None:
        schema = _remember(_SCHEMAS, files.state, spark.read.parquet(files.path).schema)
    return spark.read.schema(schema).parquet(files.path)


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str]) -> DataFrame:
    """Columns of a table, spread over the cores where its files are few."""
    files = table_files(spark, os.path.join(sf_dir, f"{name}.parquet"))
    return spread(load_files(spark, files).select(*columns),
                  have=scan_partitions(spark, files.n_bytes, files.n_files))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed ``trips`` rows (ints stay ints, clock times are text).

    Join order is chosen for scale: orders meet customer (+ place name)
    before the line-item join, so only the orders side is shuffled by
    customer key. A dimension side is broadcast only while its scan is within
    a bound in bytes; above it (as at 100 TB for orders/customer/supplier) Spark plans
    sort-merge joins, the line items being shuffled once by order key and
    once by supplier key, with AQE splitting skewed keys. The line items
    are never the broadcast side.
    """
    files = {name: table_files(spark, os.path.join(sf_dir, f"{name}.parquet"))
             for name in ("nation", "customer", "supplier", "orders", "lineitem")}
    key = (id(spark._jsparkSession), *(f.state for f in files.values()))
    if key in _TRIPS:  # a plan, no data: the same files give the same plan
        return _TRIPS[key]
    t = lambda name: load_files(spark, files[name])

    # Sizes are those of the bare base tables (their files, no job); the join keys (customer, supplier, order keys) are
    # primary keys, so a joined side is no larger than its driving table.
    small = lambda name: files[name].n_bytes <= DEFAULT_BROADCAST_BYTES
    hint = lambda df, name: F.broadcast(df) if small(name) else df
    places = hint(t("nation").select("n_nationkey", "n_name"), "nation")
    cust = (t("customer").select("c_custkey", "c_nationkey")
            .join(places.withColumnRenamed("n_name", "origin"),
                  F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", "origin"))
    orders = (t("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
              .join(hint(cust, "customer"), F.col("o_custkey") == F.col("c_custkey"))
              .select("o_orderkey", "o_orderdate", "o_orderpriority", "origin"))
    supp = (t("supplier").select("s_suppkey", "s_nationkey")
            .join(places.withColumnRenamed("n_name", "dest"),
                  F.col("s_nationkey") == F.col("n_nationkey"))
            .select("s_suppkey", "dest"))
    li = spread(t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                     "l_quantity"),
                have=scan_partitions(spark, files["lineitem"].n_bytes, files["lineitem"].n_files))
    joined = (li.join(hint(orders, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
              .join(hint(supp, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")))

    ok, pk, sk, ln, qty = (F.col(c) for c in
                           ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"))
    qty_int = qty.cast("int")
    return _remember(_TRIPS, key, joined.select(
        F.year("o_orderdate").cast("int").alias("yr"),
        F.month("o_orderdate").cast("int").alias("mo"),
        F.concat_ws("-", *(c.cast("string") for c in (ok, pk, sk, ln))).alias("row_key"),
        F.when((ln == 7) & (qty > 40), F.lit("NA"))
         .otherwise(F.col("o_orderpriority")).alias("carrier"),
        F.col("origin"),
        F.col("dest"),
        ((ok * 37 + pk * 11) % 2500).cast("string").alias("dep_hhmm"),
        ((sk * 53 + ok * 17) % 2400).cast("string").alias("arr_hhmm"),
        F.when(ln <= 3, F.lit("NA")).otherwise(qty_int.cast("string")).alias("sparse_col"),
        F.lit("K").alias("const_col"),
        qty_int.alias("distance"),
        (qty_int * 2 + ln).alias("elapsed"),
        (((ok * 7 + pk * 3) % 61).cast("int") - 10 + qty_int).alias("delay"),
    ))


def trips_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``trips`` with every column as text: the shape of a header CSV scan."""
    df = trips(spark, sf_dir)
    return df.select(*(F.col(c).cast("string").alias(c) for c in df.columns))
