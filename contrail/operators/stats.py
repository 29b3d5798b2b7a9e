"""Trend table, Pearson correlation matrix, high-correlation detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HIGH_CORR_THRESHOLD = 0.9


def trend(df: DataFrame, target: str, by: Sequence[str] = ("Year", "Month")) -> DataFrame:
    """Mean target per value of the first ``by`` column present, ordered by it.

    Grouping keys here are low-cardinality (years, months): partial
    aggregation leaves a handful of rows per task to shuffle.
    """
    key = next((c for c in by if c in df.columns), None)
    if key is None:
        raise ValueError(f"trend: none of {list(by)} is a column")
    return (df.groupBy(key)
            .agg(F.avg(target).alias("avg"), F.count(F.lit(1)).alias("n_rows"))
            .orderBy(key))


def pair_moments(df: DataFrame, columns: Sequence[str],
                 bounds_where: Column | None = None) -> DataFrame:
    """Co-moments of every column pair: ``(pos_a, pos_b, cov, var_a, var_b)``
    for ``pos_a < pos_b`` (population moments), plus, with ``bounds_where``,
    rows ``pos_a == pos_b`` carrying ``min_a``/``max_a`` of the column over
    the rows where the condition holds.

    Pass 1 is one narrow aggregate: per column the non-NULL count and the
    mean (and the bounds). Pass 2 sums the products of CENTRED values for
    every pair in one aggregate of plain sums: the stable two-pass method,
    codegen friendly, no row explosion (sf0.1, 11 columns: 1.2 s against
    13.8 s for an unpivoted form). A pair with NULLs (pairwise deletion)
    also sums count, x, y, xx and yy over the rows where both are present,
    and is shifted from the column means to its own.
    """
    cols = list(columns)
    spark = df.sparkSession
    d = len(cols)
    schema = "pos_a int, pos_b int, cov double, var_a double, var_b double"
    if bounds_where is not None:
        schema += ", min_a double, max_a double"
    if d == 0:
        return spark.createDataFrame([], schema)
    x = [F.col(f"`{c}`").cast("double") for c in cols]
    first = [F.count(F.lit(1)).alias("n")]
    first += [F.count(c).alias(f"k{i}") for i, c in enumerate(x)]
    first += [F.avg(c).alias(f"m{i}") for i, c in enumerate(x)]
    if bounds_where is not None:
        first += [F.min(F.when(bounds_where, c)).alias(f"lo{i}") for i, c in enumerate(x)]
        first += [F.max(F.when(bounds_where, c)).alias(f"hi{i}") for i, c in enumerate(x)]
    r1 = df.agg(*first).first()
    n = r1["n"]
    rows = []
    if bounds_where is not None:
        rows += [(i, i, None, None, None, r1[f"lo{i}"], r1[f"hi{i}"]) for i in range(d)]
    pad = (None, None) if bounds_where is not None else ()
    pairs = [(i, j) for i in range(d) for j in range(i + 1, d)]
    if n == 0 or d < 2:
        return spark.createDataFrame(rows + [(i, j, None, None, None, *pad) for i, j in pairs],
                                     schema)
    whole = [r1[f"k{i}"] == n for i in range(d)]
    cen = [c - F.lit(float(r1[f"m{i}"] or 0.0)) for i, c in enumerate(x)]
    second = [F.sum(cen[i] * cen[j]).alias(f"s{i}_{j}") for i in range(d) for j in range(i, d)]
    for i, j in pairs:
        if not (whole[i] and whole[j]):
            both = x[i].isNotNull() & x[j].isNotNull()
            sums = {"x": cen[i], "y": cen[j], "xx": cen[i] * cen[i], "yy": cen[j] * cen[j]}
            second.append(F.count_if(both).alias(f"n{i}_{j}"))
            second += [F.sum(F.when(both, v)).alias(f"{k}{i}_{j}") for k, v in sums.items()]
    r2 = df.agg(*second).first()
    for i, j in pairs:
        if whole[i] and whole[j]:
            row = (r2[f"s{i}_{j}"] / n, r2[f"s{i}_{i}"] / n, r2[f"s{j}_{j}"] / n)
        elif not (m := r2[f"n{i}_{j}"]):
            row = (None, None, None)
        else:
            mx, my = r2[f"x{i}_{j}"] / m, r2[f"y{i}_{j}"] / m
            row = (r2[f"s{i}_{j}"] / m - mx * my, max(r2[f"xx{i}_{j}"] / m - mx * mx, 0.0),
                   max(r2[f"yy{i}_{j}"] / m - my * my, 0.0))
        rows.append((i, j, *row, *pad))
    return spark.createDataFrame(rows, schema)


def pearson(cov: Column, var_a: Column, var_b: Column) -> Column:
    """r = cov / sqrt(var_a var_b); NaN when a variance is 0 (no ANSI error)."""
    denom = F.sqrt(var_a * var_b)
    return F.when(denom == 0, F.lit(float("nan"))).otherwise(cov / denom)


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Full Pearson matrix in long form ``(var_a, pos_a, var_b, pos_b, corr)``.

    Two narrow passes (see ``pair_moments``); both triangles and the unit
    diagonal are emitted from the d(d-1)/2 computed pairs. A constant column gives
    NaN off the diagonal, as the reference's matrix did; ``F.corr`` would
    raise a division by zero under ANSI instead.
    """
    cols = list(columns)
    spark = df.sparkSession
    names = spark.createDataFrame([(i, c) for i, c in enumerate(cols)], "pos int, name string")
    moments = pair_moments(df, cols).select(
        "pos_a", "pos_b", pearson(F.col("cov"), F.col("var_a"), F.col("var_b")).alias("corr"))
    upper = moments.select("pos_a", "pos_b", "corr")
    lower = moments.select(F.col("pos_b").alias("pos_a"), F.col("pos_a").alias("pos_b"), "corr")
    diag = names.select(F.col("pos").alias("pos_a"), F.col("pos").alias("pos_b"),
                        F.lit(1.0).alias("corr"))
    full = upper.unionByName(lower).unionByName(diag)
    na = F.broadcast(names.select(F.col("pos").alias("pos_a"), F.col("name").alias("var_a")))
    nb = F.broadcast(names.select(F.col("pos").alias("pos_b"), F.col("name").alias("var_b")))
    return (full.join(na, "pos_a").join(nb, "pos_b")
            .select("var_a", "pos_a", "var_b", "pos_b", F.col("corr").cast("double")))


def high_corr_pairs(corr_long: DataFrame, threshold: float = HIGH_CORR_THRESHOLD) -> DataFrame:
    """Off-diagonal pairs (each once, ``pos_a < pos_b``) with ``|r| > threshold``.

    NaN is excluded explicitly: Spark orders NaN above every number, so
    ``NaN > 0.9`` is true, while the reference's pandas test was false.
    """
    r = F.col("corr")
    return corr_long.filter((F.col("pos_a") < F.col("pos_b")) & r.isNotNull()
                            & ~F.isnan(r) & (F.abs(r) > threshold))


def high_corr_columns(corr_long: DataFrame, threshold: float = HIGH_CORR_THRESHOLD) -> DataFrame:
    """Columns taking part in at least one high-correlation pair."""
    pairs = high_corr_pairs(corr_long, threshold)
    return (pairs.select(F.col("var_a").alias("column_name"), F.col("pos_a").alias("position"))
            .union(pairs.select(F.col("var_b"), F.col("pos_b")))
            .distinct())


def correlated_to_drop(df: DataFrame, columns: Sequence[str],
                       threshold: float = HIGH_CORR_THRESHOLD,
                       keep: Sequence[str] = ()) -> list[str]:
    """Greedy choice: for each high pair in column order, drop the later column
    unless the earlier one is already dropped (or the later one is in ``keep``)."""
    pairs = high_corr_pairs(corr_matrix(df, columns), threshold).collect()
    dropped: list[str] = []
    for p in sorted(pairs, key=lambda r: (r.pos_a, r.pos_b)):
        if p.var_a in dropped or p.var_b in dropped:
            continue
        victim = p.var_a if p.var_b in keep else p.var_b
        if victim not in keep:
            dropped.append(victim)
    return dropped


def drop_correlated(df: DataFrame, columns: Sequence[str] | None = None, *,
                    auto: bool = False, candidates: Sequence[str] | None = None,
                    threshold: float = HIGH_CORR_THRESHOLD, keep: Sequence[str] = ()) -> DataFrame:
    """Drop a fixed list (the reference's way), and/or detected ones with ``auto``."""
    to_drop = list(columns or [])
    if auto:
        cands = [c for c in (candidates or df.columns) if c not in to_drop]
        to_drop += correlated_to_drop(df, cands, threshold, keep)
    return df.drop(*to_drop)
