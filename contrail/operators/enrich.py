"""Role-based lookup joins against one dimension, and missing-key reports.

The same dimension (e.g. airports) is joined once per role (origin,
destination): its key is renamed to the role column and its attributes get
a role prefix before the join, so no ambiguous columns arise. The dimension
is broadcast only when a row-count check proves it small; above the bound
Spark plans a shuffle join and AQE splits skewed fact partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.operators.sizing import DEFAULT_BROADCAST_BYTES, fits_broadcast


SALT = "_salt"


def duplicate_keys(dim: DataFrame, key: str) -> DataFrame:
    """Dimension keys listed more than once, with their multiplicity."""
    return (dim.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def role_join(df: DataFrame, dim: DataFrame, key: str, roles: Mapping[str, str],
              attrs: Mapping[str, str], *, how: str = "inner", keep_role_columns: bool = False,
              unique_keys: str = "ignore",
              broadcast_max_bytes: int = DEFAULT_BROADCAST_BYTES,
              salt_buckets: int = 1) -> DataFrame:
    """Join ``dim`` once per role.

    ``roles`` maps a fact column to its output prefix, e.g.
    ``{"Origin": "Origin", "Dest": "Dest"}``; ``attrs`` maps a dimension
    column to an output suffix, e.g. ``{"lat": "Lat", "long": "Long"}``,
    giving ``OriginLat, OriginLong, DestLat, DestLong``. With ``inner``
    (the reference's join) facts without a match vanish and duplicate
    dimension keys multiply rows; ``unique_keys="error"`` refuses such a
    dimension instead. The role columns are dropped unless
    ``keep_role_columns``.

    ``salt_buckets > 1`` only matters when the dimension is too large to
    broadcast: each fact row gets a deterministic salt (a hash of the whole
    row, stable under task retry) and the dimension is replicated once per
    salt, so a hot key (one airport holding a third of all flights) is
    spread over ``salt_buckets`` join tasks instead of one. AQE's skew-join
    split does the same at run time when enabled.
    """
    if unique_keys not in ("ignore", "error"):
        raise ValueError("unique_keys must be 'ignore' or 'error'")
    slim = dim.select(key, *attrs.keys())
    if unique_keys == "error":
        dups = duplicate_keys(slim, key).limit(5).collect()
        if dups:
            raise ValueError(f"dimension key {key!r} is not unique: "
                             + ", ".join(f"{r[key]!r} x{r['n']}" for r in dups))
    small = fits_broadcast(slim, broadcast_max_bytes)
    salted = salt_buckets > 1 and not small
    out = df
    if salted:
        out = out.withColumn(SALT, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]),
                                          F.lit(salt_buckets)).cast("int"))
    for role_col, prefix in roles.items():
        side = slim.select(F.col(key).alias(role_col),
                           *[F.col(a).alias(f"{prefix}{suffix}") for a, suffix in attrs.items()])
        if small:
            side = F.broadcast(side)
        elif salted:
            side = side.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
        out = out.join(side, on=[role_col, SALT] if salted else role_col, how=how)
    if salted:
        out = out.drop(SALT)
    if not keep_role_columns:
        out = out.drop(*roles.keys())
    # a USING join puts the key first; restore the fact column order
    fact_cols = [c for c in df.columns if keep_role_columns or c not in roles]
    added = [f"{p}{s}" for p in roles.values() for s in attrs.values()]
    return out.select(*fact_cols, *added)


def missing_keys(df: DataFrame, dim: DataFrame, key: str, columns: Sequence[str],
                 broadcast_max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Distinct non-null values of ``columns`` (together) that ``dim`` lacks.

    One scan of the facts: the role columns are exploded into one key
    column and de-duplicated (partial aggregation per task, so hot keys
    collapse before the shuffle), then anti-joined to the dimension keys.
    """
    keys = (df.select(F.explode(F.array(*[F.col(c) for c in columns])).alias(key))
            .filter(F.col(key).isNotNull())
            .distinct())
    dim_keys = dim.select(key)
    # bound checked on the raw rows (no job); distinct keys are no more
    small = fits_broadcast(dim_keys, broadcast_max_bytes)
    dim_keys = dim_keys.distinct()
    if small:
        dim_keys = F.broadcast(dim_keys)
    return keys.join(dim_keys, on=key, how="left_anti")


def missing_key_count(df: DataFrame, dim: DataFrame, key: str,
                      columns: Sequence[str]) -> DataFrame:
    return missing_keys(df, dim, key, columns).agg(F.count(F.lit(1)).alias("n_missing"))
