"""Delimited-text scans and the multi-input merge."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def all_string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def scan_csv(spark: SparkSession, paths: str | Sequence[str], *, sep: str = ",",
             header: bool = True, columns: Sequence[str] | None = None,
             null_value: str | None = None) -> DataFrame:
    """Header CSV scan where every column is text (no inference pass).

    ``columns`` gives the all-string schema up front, which skips the
    header-sniffing job; otherwise Spark reads the header of the first file.
    ``null_value`` lets the reader itself turn a token into NULL. Empty
    fields are read as NULL either way.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        raise ValueError("scan_csv: no input paths given")
    if len(paths) > 1 and header and columns is None:
        # each file's own header: one reader would take the first file's for all
        return scan_inputs(spark, paths, sep=sep, null_value=null_value)
    reader = spark.read.option("header", header).option("sep", sep)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if columns is not None:
        reader = reader.schema(all_string_schema(columns))
    return reader.csv(paths)


def scan_dimension(spark: SparkSession, path: str | Sequence[str],
                   columns: Sequence[str], **kwargs) -> DataFrame:
    """A lookup table scan projected to the needed columns (pruned at scan)."""
    return scan_csv(spark, path, **kwargs).select(*columns)


def merge_inputs(frames: Sequence[DataFrame], *, positional: bool = False,
                 allow_missing: bool = False) -> DataFrame:
    """Bag union of any number of inputs.

    Default aligns columns by name (inputs may list columns in any order).
    ``positional=True`` is the reference's ``union``: columns are matched by
    position and a differing order silently misaligns.
    """
    frames = list(frames)
    if not frames:
        raise ValueError("merge_inputs: no inputs given")
    if positional:
        return reduce(lambda a, b: a.union(b), frames)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def scan_inputs(spark: SparkSession, paths: Sequence[str], **kwargs) -> DataFrame:
    """Scan each file on its own (own header) and merge by name."""
    positional = kwargs.pop("positional", False)
    allow_missing = kwargs.pop("allow_missing", False)
    if not paths:
        raise ValueError("scan_inputs: no input paths given")
    frames = [scan_csv(spark, p, **kwargs) for p in paths]
    return merge_inputs(frames, positional=positional, allow_missing=allow_missing)
