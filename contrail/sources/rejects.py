"""CSV scan that sets malformed records apart instead of filling them with NULLs.

Records are lines. A line is rejected with a reason: ``quote`` (a quote is not closed),
``short`` or ``long`` (fewer or more fields than the header). Fields in quotes may hold
separators and doubled quotes, but no line ends: the parts of such a record are
rejected as ``quote``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.sources.files import all_string_schema

#: A field in quotes: after the line's beginning or a separator, doubled quotes inside.
QUOTED = '"(?:[^"]|"")*+"'


def scan_lines(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], *,
               sep: str = ",", header: bool = True) -> DataFrame:
    """``(file, record, reason)``: every line but headers and empty ones, reason NULL where it is
    well formed."""
    if len(sep) != 1 or sep == '"':
        raise ValueError("sep must be one character, not a quote")
    lines = spark.read.text([paths] if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("file"),
        F.regexp_replace("value", r"\r$", "").alias("record")).filter(F.col("record") != "")
    if header:
        lines = lines.filter(F.col("record") != sep.join(columns))
    bare = F.regexp_replace("record", QUOTED, "")
    fields = F.regexp_count(bare, F.lit(re.escape(sep))) + 1
    reason = (F.when(F.contains(bare, F.lit('"')), "quote")
              .when(fields < len(columns), "short").when(fields > len(columns), "long"))
    return lines.withColumn("reason", reason)


def scan_csv_checked(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], *,
                     sep: str = ",", header: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)``: the well-formed records as text columns, empty fields as NULL, and
    ``(file, record, reason)`` of the others. Every record is in one of them."""
    lines = scan_lines(spark, paths, columns, sep=sep, header=header)
    schema = ", ".join(f"`{c}` string" for c in all_string_schema(columns).names)
    parsed = F.from_csv("record", schema, {"sep": sep, "escape": '"', "mode": "PERMISSIVE"})
    rows = lines.filter(F.col("reason").isNull()).select(parsed.alias("r")).select("r.*")
    return rows, lines.filter(F.col("reason").isNotNull())
