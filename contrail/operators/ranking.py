"""Category indexes as a table: frequency ranks without labels on the driver.

``features.string_index`` keeps each column's labels as model state, which suits
columns with thousands of categories. For columns with very many, ``category_ranks``
numbers the categories of all columns by a distributed sort (most frequent
first, ties by value) and ``string_index_table`` joins the numbers back.

The global rank is a range sort by column, count and value: each partition numbers
its own rows, and a table of one row a partition and column gives the ranks
that stand before them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.operators.features import INDEX_SUFFIX
from contrail.operators.sizing import DEFAULT_BROADCAST_BYTES
from contrail.session import materialize

#: Tasks that the rows of a hot value, or of NULL, are dealt to in a join that is not broadcast.
SALTS = 16
#: Values of a column, the most frequent ones, whose ranks are broadcast in such a join: any other
#: value holds less than this share of the rows.
HOT_VALUES = 1000
#: Bytes of a broadcast rank beside its value's.
RANK_BYTES = 48
HANDLE_INVALID = ("error", "keep", "skip")


def category_counts_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, value, n_rows)`` of the non-NULL values, counted in partial aggregates
    before the shuffle, so a value's share of the rows does not matter."""
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value"))
             for c in columns]
    return (df.select(F.inline(F.array(*pairs))).filter(F.col("value").isNotNull())
            .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n_rows")))


def numbered(df: DataFrame, by: Sequence[str], order: Sequence) -> DataFrame:
    """``df`` with ``rank`` (from 0 within each combination of ``by``, in ``order``) by a range
    sort; no group is brought into one task. ``order`` must not tie."""
    keys = [*by, *order]
    placed = materialize(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(
        "_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", 33)  # the id holds the partition above the row's place in it
    totals = placed.groupBy(*by, part.alias("_part")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_from"))
    before = F.sum("_n").over(Window.partitionBy(*by).orderBy("_part")) - F.col("_n")
    offsets = materialize(totals.select(*by, "_part", (before - F.col("_from")).alias("_shift")),
                          "offsets")
    return (placed.withColumn("_part", part).join(F.broadcast(offsets), [*by, "_part"])
            .withColumn("rank", F.col("_at") + F.col("_shift"))
            .drop("_at", "_part", "_shift"))


def category_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, value, n_rows, idx)``: idx 0 is the most frequent value of its column,
    ties by value (UTF-8 order). A staged table and its staged offsets, joined where it is read."""
    counts = category_counts_long(df, columns)
    ranks = numbered(counts, ["column_name"], [F.col("n_rows").desc(), F.col("value")])
    return ranks.withColumnRenamed("rank", "idx")


def _hot_ranks(df: DataFrame, side: DataFrame, column: str, fitted_here: bool) -> DataFrame:
    """``(_value, _hot, _hot_idx)`` of the most frequent values of ``df``, with or without a rank."""
    if fitted_here:  # the ranks are in that order
        hot = side.filter(F.col("_idx") < HOT_VALUES)
    else:
        counts = category_counts_long(df, [column]).orderBy(F.col("n_rows").desc(), "value")
        hot = materialize(counts.limit(HOT_VALUES).select(F.col("value").alias("_value")).join(
            side, "_value", "left"), "hot-ranks")
    return hot.select("_value", F.lit(True).alias("_hot"), F.col("_idx").alias("_hot_idx"))


def string_index_table(df: DataFrame, columns: Sequence[str], *, fit_df: DataFrame | None = None,
                       suffix: str = INDEX_SUFFIX, handle_invalid: str = "error",
                       broadcast_max_bytes: int = DEFAULT_BROADCAST_BYTES,
                       salts: int = SALTS) -> tuple[DataFrame, DataFrame]:
    """Add ``<c>_Index`` (double) for each column; returns ``(frame, ranks)``.

    The same numbers as ``features.string_index``. A value that ``fit_df`` lacks, or NULL,
    raises (``error``), gets the number of categories (``keep``) or goes with its row
    (``skip``). A column's ranks are broadcast while their counted size is within the bound.
    Beyond it rows and ranks are shuffled once by the value; the ranks of the ``HOT_VALUES`` most
    frequent values are broadcast, and their rows (and NULLs) dealt to ``salts`` tasks.
    """
    if handle_invalid not in HANDLE_INVALID:
        raise ValueError(f"handle_invalid must be one of {HANDLE_INVALID}")
    ranks = category_ranks(df if fit_df is None else fit_df, columns)
    sizes = {r["column_name"]: (r["k"], r["b"]) for r in ranks.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("k"),
        F.sum(F.octet_length("value") + RANK_BYTES).alias("b")).collect()}
    out = df
    # the largest first: the rows are shuffled before they grow by the other indexes
    for c in sorted(columns, key=lambda c: -sizes.get(c, (0, 0))[1]):
        n_values, n_bytes = sizes.get(c, (0, 0))
        side = ranks.filter(F.col("column_name") == c).select(
            F.col("value").alias("_value"), F.col("idx").cast("double").alias("_idx"))
        out = out.withColumn("_value", F.col(f"`{c}`").cast("string"))
        if n_bytes <= broadcast_max_bytes:
            out = out.join(F.broadcast(side), "_value", "left")
        else:
            hot = _hot_ranks(df, side, c, fit_df is None)
            dealt = F.pmod(F.xxhash64(*[F.col(f"`{x}`") for x in df.columns],
                                      F.spark_partition_id()), F.lit(salts)) + 1
            alone = F.col("_value").isNotNull() & F.col("_hot").isNull()
            out = (out.join(F.broadcast(hot), "_value", "left")
                   .withColumn("_salt", F.when(alone, 0).otherwise(dealt).cast("int"))
                   .join(side.withColumn("_salt", F.lit(0)).hint("merge"), ["_value", "_salt"],
                         "left")
                   .withColumn("_idx", F.coalesce("_hot_idx", "_idx"))
                   .drop("_salt", "_hot", "_hot_idx"))
        idx = F.col("_idx")
        if handle_invalid == "error":
            idx = F.coalesce(idx, F.raise_error(F.concat(
                F.lit(f"no index in column {c} for "), F.coalesce("_value", F.lit("NULL")))).cast(
                "double"))
        elif handle_invalid == "keep":
            idx = F.coalesce(idx, F.lit(float(n_values)))
        else:
            out = out.filter(F.col("_idx").isNotNull())
        out = out.withColumn(c + suffix, idx).drop("_value", "_idx")
    return out.select(*[F.col(f"`{c}`") for c in df.columns],
                      *[F.col(f"`{c}{suffix}`") for c in columns]), ranks
