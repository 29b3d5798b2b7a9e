"""Single-pass column profiles.

Every profile is ONE global aggregate over the input (partial aggregation on
each task, a one-row final merge), unpivoted into a long table with one row
per column: ``(column_name, position, n_rows, <stats>)``. The result size is
bounded by the schema width, so collecting it to take a decision is safe.
The reference instead ran a job per column for each decision.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.casts import tolerant_int

from contrail.functions.text import has_letter

STATS = ("n_null", "pct_null", "n_distinct", "approx_distinct", "is_constant", "has_letters")

#: Rows that settle most of ``constant_and_letters``.
SETTLE_ROWS = 1_000

_NON_ORDERABLE = (T.MapType, T.UserDefinedType, T.VariantType)


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, _NON_ORDERABLE):
        return False
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    return True


def _stat_exprs(name: str, field: T.StructField, stat: str) -> Column:
    c = F.col(f"`{name}`")
    if stat == "n_null":
        return F.count_if(c.isNull())
    if stat == "n_distinct":
        return F.count_distinct(c)
    if stat == "approx_distinct":
        return F.approx_count_distinct(c)
    if stat == "is_constant":
        # distinct non-null count == 1  <=>  min == max (NULL when all NULL)
        if not _orderable(field.dataType):
            return F.lit(None).cast("boolean")
        return F.coalesce(F.min(c) == F.max(c), F.lit(False))
    if stat == "has_letters":
        if not isinstance(field.dataType, T.StringType):
            return F.lit(False)
        return F.coalesce(F.bool_or(has_letter(c)), F.lit(False))
    raise ValueError(f"unknown stat {stat!r}")


def profile_columns(df: DataFrame, stats: Sequence[str] = ("n_null", "pct_null"),
                    columns: Sequence[str] | None = None,
                    extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Long profile ``(column_name, position, n_rows, *stats)`` from one aggregate.

    ``extra`` adds named whole-table aggregates to the same pass; their
    values repeat on every row of the result.
    """
    stats = list(stats)
    for s in stats:
        if s not in STATS:
            raise ValueError(f"unknown stat {s!r}; choose from {STATS}")
    fields = {f.name: f for f in df.schema.fields}
    names = list(columns) if columns is not None else df.columns
    agg_stats = [s for s in stats if s != "pct_null"]
    if "pct_null" in stats and "n_null" not in agg_stats:
        agg_stats.insert(0, "n_null")
    extra = dict(extra or {})
    aggs = [F.count(F.lit(1)).alias("n_rows")] + [e.alias(k) for k, e in extra.items()]
    for i, name in enumerate(names):
        for s in agg_stats:
            aggs.append(_stat_exprs(name, fields[name], s).alias(f"{s}__{i}"))
    wide = df.agg(*aggs)

    entries = []
    for i, name in enumerate(names):
        position = df.columns.index(name)
        parts = [F.lit(name).alias("column_name"), F.lit(position).alias("position")]
        parts += [F.col(f"{s}__{i}").alias(s) for s in agg_stats]
        entries.append(F.struct(*parts))
    long = wide.select("n_rows", *extra.keys(), F.inline(F.array(*entries)))
    out = ["column_name", "position", "n_rows"]
    for s in stats:
        if s == "pct_null":
            long = long.withColumn(
                "pct_null", F.try_divide(F.col("n_null").cast("double"), F.col("n_rows")) * 100)
        out.append(s)
    return long.select(*out, *extra.keys())


def constant_and_letters(df: DataFrame, rows: int = SETTLE_ROWS) -> list[Row]:
    """Rows ``(column_name, position, n_rows, is_constant, has_letters)`` as of ``profile_columns``.

    The first ``rows`` rows settle most of it: a column that has two values there is not constant,
    one that has a letter there has letters. Only what they leave open is asked of all rows.
    """
    some = profile_columns(df.limit(rows), ("n_null", "is_constant", "has_letters")).collect()
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    fields = {f.name: f for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for r in some:
        if r.is_constant or r.n_null == r.n_rows:
            aggs.append(_stat_exprs(r.column_name, fields[r.column_name], "is_constant")
                        .alias(f"is_constant__{r.position}"))
        if r.column_name in text and not r.has_letters:
            aggs.append(_stat_exprs(r.column_name, fields[r.column_name], "has_letters")
                        .alias(f"has_letters__{r.position}"))
    found = df.agg(*aggs).first().asDict()
    return [Row(column_name=r.column_name, position=r.position, n_rows=found["n_rows"],
                **{s: found.get(f"{s}__{r.position}", r[s])
                   for s in ("is_constant", "has_letters")}) for r in some]


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: rows, NULL count and NULL percentage (NULL for an empty input)."""
    return profile_columns(df, ("n_null", "pct_null"))


def distinct_profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """Per column distinct non-null count; ``exact=False`` uses HyperLogLog++."""
    stat = "n_distinct" if exact else "approx_distinct"
    return profile_columns(df, (stat,)).withColumnRenamed(stat, "n_distinct")


def categorical_profile(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Per column: is it categorical (any value holds a letter), minus ``exclude``.

    The reference sniffed only the first row, whose identity is arbitrary
    after a shuffle; this looks at the whole column in the same single pass.
    """
    exclude = set(exclude)
    prof = profile_columns(df, ("has_letters",))
    return prof.select(
        "column_name", "position",
        (F.col("has_letters") & ~F.col("column_name").isin(list(exclude) or [""]))
        .alias("is_categorical"))


def detect_categorical(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    rows = categorical_profile(df, exclude).filter("is_categorical").collect()
    return [r.column_name for r in sorted(rows, key=lambda r: r.position)]


def zero_count(df: DataFrame, target: str) -> DataFrame:
    """Rows whose target is zero as an int ("0", "00", "0.0", "0.4"), with the total.

    Non-numeric text never counts (the raw string-vs-int comparison raises
    under ANSI, so the text goes through a tolerant cast first).
    """
    t = F.col(target)
    num = tolerant_int(t) if isinstance(df.schema[target].dataType, T.StringType) else t
    return df.agg(F.count_if(num == 0).alias("n_zero"), F.count(F.lit(1)).alias("n_rows"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """``n_rows``, ``n_distinct`` (full rows) and ``n_duplicates`` in one shuffle.

    The grouping aggregates partially per task first, so a row repeated
    millions of times (a hot group) collapses before the exchange.
    """
    groups = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
    ).withColumn("n_duplicates", F.col("n_rows") - F.col("n_distinct"))


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of categories per categorical column (exact distinct count)."""
    return profile_columns(df, ("n_distinct",), columns=columns).select(
        "column_name", "position", F.col("n_distinct").alias("n_categories"))

