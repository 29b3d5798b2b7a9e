"""Pearson correlation of wide tables by block Gramians.

``stats.corr_matrix`` states one expression a column pair: 20,100 of them at 200 columns.
Here a row is one array of doubles, tasks multiply blocks of rows into d x d matrices (one
matrix product each instead of d(d+1)/2 expressions), and the matrices are added in
two levels, so that no task adds those of all others. One pass over the rows.

Values are shifted by the means of a bounded sample first. The shift cancels out of every
result; it only keeps the sums from losing digits where means are far from zero. Columns
with NULLs (or NaNs) are correlated pairwise: counts, sums and squares over the rows where
both are present are matrix products as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows whose means serve as shift; any shift gives the same correlations.
SHIFT_ROWS = 1_000
#: Rows multiplied at once: d * 8 bytes each.
BLOCK_ROWS = 4_096
#: Branches of the first level of additions.
FAN = 64
#: What is summed of each pair (i, j) over the rows where both are present.
SUMS = ("n", "x", "y", "xx", "yy", "xy")


def _gramians(shift: list[float]):
    """Partial sums of one task, a row for each column i: arrays over the columns j."""

    def partial(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        d, centre = len(shift), np.array(shift)
        n, x, xx, xy = (np.zeros((d, d)) for _ in range(4))
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS).column(0)
                rows = part.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)
                there = np.isfinite(rows)
                rows = np.where(there, rows - centre, 0.0)
                there = there.astype(float)
                n += there.T @ there
                x += rows.T @ there
                xx += (rows * rows).T @ there
                xy += rows.T @ rows
        if not n.any():
            return
        arrays = {"n": n, "x": x, "y": x.T, "xx": xx, "yy": xx.T, "xy": xy}
        made = [pa.array([TaskContext.get().partitionId() % FAN] * d, pa.int32()),
                pa.array(range(d), pa.int32()),
                *(pa.array(list(arrays[s]), pa.list_(pa.float64())) for s in SUMS)]
        yield pa.RecordBatch.from_arrays(made, names=["fan", "pos_a", *SUMS])

    return partial


def _added(level: list[str]):
    def add(table):
        import numpy as np
        import pyarrow as pa

        keys = {k: [table[k][0].as_py()] for k in level}
        sums = {s: [np.sum(np.stack(table[s].to_numpy()), axis=0)] for s in SUMS}
        return pa.table({**{k: pa.array(v, pa.int32()) for k, v in keys.items()},
                         **{s: pa.array(v, pa.list_(pa.float64())) for s, v in sums.items()}})

    return add


def pair_sums(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(pos_a, n, x, y, xx, yy, xy)``: arrays over the second column of the pair."""
    cols = [F.col(f"`{c}`").cast("double") for c in columns]
    named = df.select(*[c.alias(f"c{i}") for i, c in enumerate(cols)])
    row = named.limit(SHIFT_ROWS).agg(*[F.avg(F.when(
        F.abs(F.col(c)) < float("inf"), F.col(c))).alias(c) for c in named.columns]).first()
    shift = [float(v or 0.0) for v in row]
    sums = ", ".join(f"{s} array<double>" for s in SUMS)
    partial = named.select(F.array(*[F.coalesce(F.col(c), F.lit(float("nan")))
                                     for c in named.columns]).alias("v")).mapInArrow(
        _gramians(shift), f"fan int, pos_a int, {sums}")
    first = partial.groupBy("fan", "pos_a").applyInArrow(
        _added(["fan", "pos_a"]), f"fan int, pos_a int, {sums}")
    return first.groupBy("pos_a").applyInArrow(_added(["pos_a"]), f"pos_a int, {sums}")


def corr_wide(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Full Pearson matrix in long form ``(var_a, pos_a, var_b, pos_b, corr)``, as
    ``stats.corr_matrix``: pairwise deletion of NULLs (NaNs and infinities count as NULL here), 1.0
    on the diagonal, NaN where a column is constant, NULL where no row has both."""
    names = F.array(*[F.lit(c) for c in columns])
    met = pair_sums(df, columns).select("pos_a", F.posexplode(F.arrays_zip(*SUMS)).alias(
        "pos_b", "s"))
    n, x, y, xx, yy, xy = (F.col(f"s.{s}") for s in SUMS)
    var_a, var_b = xx / n - (x / n) * (x / n), yy / n - (y / n) * (y / n)
    cov = xy / n - (x / n) * (y / n)
    # A constant's variance is what rounding leaves of its squares.
    flat = (var_a <= 1e-12 * (xx / n)) | (var_b <= 1e-12 * (yy / n)) | (xx == 0) | (yy == 0)
    corr = (F.when(F.col("pos_a") == F.col("pos_b"), F.lit(1.0)).when(n == 0, F.lit(None))
            .when(flat, F.lit(float("nan"))).otherwise(cov / F.sqrt(var_a * var_b)))
    return met.select(F.get(names, F.col("pos_a")).alias("var_a"), "pos_a",
                      F.get(names, F.col("pos_b")).alias("var_b"), "pos_b",
                      corr.cast("double").alias("corr"))
