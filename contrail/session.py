"""Session helpers: a tuned builder for tests/bench and the shared staging folder.

Library functions never build their own session; they take the caller's
DataFrames. These helpers exist for tests, ``bench.py`` and the pipelines'
materialisation points.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

#: Rows of a staged file of wide rows: by Spark's defaults (128 MB a task, 4 MB a file) a task
#: then reads 32 files at most, 1.6 million rows.
ROWS_PER_FILE = 50_000


def build_session(master: str = "local[*]", app: str = "contrail",
                  shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """Session with AQE (coalescing + skew join), UTC and sane local sizing."""
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def staging_root(spark: SparkSession) -> str:
    """The shared folder that the session names in ``spark.checkpoint.dir``.

    Nothing is set here: a machine-local default would be unreadable to the
    other executors, and the setting is fixed once the application runs. A
    folder given to ``SparkContext.setCheckpointDir`` is honoured as well.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - no SparkContext (e.g. Spark Connect)
            root = None
    if not root:
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set: name a folder that the driver and all "
            "executors share when the session is built")
    return root.rstrip("/")


_TRACKED: list[list[str]] = []


@contextmanager
def staged_paths() -> Iterator[list[str]]:
    """Lists the folders that are staged inside the ``with`` block, whoever stages them, so that the
    caller can hand them to ``remove_staged`` once no result reads them::

        with staged_paths() as paths:
            result.write.parquet(...)
        remove_staged(spark, *paths)
    """
    paths: list[str] = []
    _TRACKED.append(paths)
    try:
        yield paths
    finally:
        _TRACKED[:] = [p for p in _TRACKED if p is not paths]


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique sub-folder of the shared staging root."""
    path = f"{staging_root(spark)}/contrail-{label}-{uuid.uuid4().hex[:12]}"
    for paths in _TRACKED:
        paths.append(path)
    return path


def materialize(df: DataFrame, label: str = "stage", rows_per_file: int = 0) -> DataFrame:
    return materialize_at(df, label, rows_per_file)[0]


def materialize_at(df: DataFrame, label: str = "stage",
                   rows_per_file: int = 0) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in the shared staging folder and read it back.

    This cuts the lineage at reuse points (a lost executor re-reads files
    instead of re-running the upstream shuffle) and keeps the data columnar
    for later column pruning / filter pushdown. The caller owns the returned
    path and removes it with ``remove_staged`` once nothing reads it.

    ``rows_per_file`` bounds the rows of a file (0: no bound). A scan deals files to tasks by
    their bytes and a fixed cost for each, so repetitive rows, which Parquet packs to a few
    bytes, otherwise meet one task by the million.
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove_staged(spark: SparkSession, *paths: str) -> None:
    """Delete staged folders through Spark's own file-system layer (any store)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
