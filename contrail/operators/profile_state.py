"""Column profiles as stored states: a new input costs one pass over that input.

A state is one row a column: row and NULL counts, least and greatest value, and a
HyperLogLog sketch of the distinct values. States of inputs are stored in a folder an input
(writing an input again replaces its state) and merged without reading the data.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Registers of a sketch as a power of two, and the relative error that three deviations allow.
LG_REGISTERS = 12
SKETCH_ERROR = 3 * 1.04 / math.sqrt(1 << LG_REGISTERS)


def profile_state(df: DataFrame, input_name: str, lg: int = LG_REGISTERS) -> DataFrame:
    """``(input, column_name, position, n_rows, n_null, low, high, sketch)`` of one input, from one
    aggregate; values count as text."""
    text = [F.col(f"`{c}`").cast("string") for c in df.columns]
    stats = {"n_null": F.count_if, "low": F.min, "high": F.max}
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(text):
        aggs += [f(c.isNull() if s == "n_null" else c).alias(f"{s}{i}") for s, f in stats.items()]
        aggs.append(F.hll_sketch_agg(c, lg).alias(f"sketch{i}"))
    entries = [F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("position"), "n_rows",
                        *[F.col(f"{s}{i}").alias(s) for s in (*stats, "sketch")])
               for i, c in enumerate(df.columns)]
    return df.agg(*aggs).select(F.lit(input_name).alias("input"), F.inline(F.array(*entries)))


def store_state(state: DataFrame, path: str) -> None:
    """Add the states under ``path``; an input that is there already is replaced."""
    (state.repartition(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("input").parquet(path))


def load_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def merge_states(states: DataFrame) -> DataFrame:
    """``(column_name, position, n_rows, n_null, pct_null, low, high, n_distinct)`` over all inputs;
    n_distinct is the estimate of the united sketches. A column that an input lacks counts
    only where it is."""
    merged = states.groupBy("column_name").agg(
        F.min("position").alias("position"), F.sum("n_rows").alias("n_rows"),
        F.sum("n_null").alias("n_null"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))
    share = F.try_divide(F.col("n_null").cast("double"), F.col("n_rows")) * 100
    return merged.select("column_name", "position", "n_rows", "n_null", share.alias("pct_null"),
                         "low", "high", "n_distinct")


def outside_error(estimate, exact, error: float = SKETCH_ERROR):
    """Whether an estimate misses the exact count by more than the sketch allows."""
    return F.abs(estimate - exact) > F.greatest(exact * error, F.lit(1.0))
