"""Result sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def preview(df: DataFrame, n: int = 5, by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows as a DataFrame (the caller may ``show`` it): any rows, or with ``by`` the
    first in its order, of which each task passes on ``n`` at most."""
    return (df.orderBy(*by) if by else df).limit(n)


def write_parquet(df: DataFrame, path: str, *, mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None, dynamic: bool = False) -> None:
    """Durable columnar output, optionally partitioned (e.g. by year). With ``dynamic`` an overwrite
    replaces the partitions that ``df`` has rows of, and leaves the others."""
    if dynamic and not partition_by:
        raise ValueError("dynamic needs partition_by")
    writer = df.write.mode(mode)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
