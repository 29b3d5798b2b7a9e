"""Size checks that gate broadcast hints, and scan-parallelism repair.

A broadcast is hinted only for a side whose size in bytes, by the statistics of
its optimized plan (file sizes for a scan; no job), is within a bound. Above it
no hint is given and Spark plans a shuffle join; AQE may still broadcast by
measured sizes, and splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_BYTES = 32 << 20


def fits_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when the plan's own estimate of ``df`` is within ``max_bytes``."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    except AttributeError:  # no JVM plan (Spark Connect): leave the choice to Spark
        return False
    return int(str(size)) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


def _bytes(text: str) -> int:
    """A size setting such as ``128MB``, ``16m`` or ``134217728b`` in bytes."""
    number = text.strip().lower().rstrip("b")
    unit = {"k": 10, "m": 20, "g": 30, "t": 40}.get(number[-1:], 0)
    return int(number[:-1] if unit else number) << unit


def scan_partitions(spark, n_bytes: int, n_files: int) -> int:
    """How many partitions Spark's file scan deals such files into, without planning it."""
    conf = spark.conf.get
    most = _bytes(conf("spark.sql.files.maxPartitionBytes", "128m"))
    opened = _bytes(conf("spark.sql.files.openCostInBytes", "4m"))
    cores = int(conf("spark.sql.files.minPartitionNum", None)
                or spark.sparkContext.defaultParallelism)
    split = max(1, min(most, max(opened, (n_bytes + n_files * opened) // max(1, cores))))
    pieces = max(n_files, -(-n_bytes // split))
    return max(1, min(pieces, -(-(n_bytes + pieces * opened) // split)))


def partition_rows(df: DataFrame) -> tuple[int, int]:
    """Rows in all, and rows of the largest partition."""
    parts = df.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    total, most = parts.agg(F.sum("n"), F.max("n")).first()
    return total or 0, most or 0


def at_most_rows(df: DataFrame, rows: int, counted: tuple[int, int] | None = None) -> DataFrame:
    """``df`` dealt evenly to tasks if any of its partitions holds more than ``rows`` rows (counted,
    or by ``counted``), else as it is."""
    total, most = counted or partition_rows(df)
    if most <= rows:
        return df
    return df.repartition(max(-(-total // rows), df.sparkSession.sparkContext.defaultParallelism))


def spread(df: DataFrame, min_partitions: int | None = None, have: int | None = None) -> DataFrame:
    """Re-distribute a scan that arrives in fewer partitions than the cluster
    has cores (e.g. one large single-row-group file); a no-op for wide
    inputs, so at scale it adds no shuffle.

    Rows are hash-partitioned on ALL their columns: deterministic on task
    retry (unlike an unsorted round-robin), no sort (unlike Spark's
    round-robin), and a single hot key value does not land in one partition.
    ``have`` is the number of partitions, where the caller knows it: else the plan is asked.
    """
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions() if have is None else have
    except Exception:  # noqa: BLE001 - no RDD view (e.g. Spark Connect): leave as is
        return df
    if have < want:
        return df.repartition(want, *[F.col(f"`{c}`") for c in df.columns])
    return df
