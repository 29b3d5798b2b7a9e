"""Full-row de-duplication that shuffles hashes instead of rows.

``clean.dedupe`` sends every row through the shuffle. Here a row is a pair of 64-bit
hashes and its place in the staged table: the shuffle groups the hashes, and each
group's first place is kept. The places come back as bitmaps (a bit a row of the table, a few
kilobytes a partition), broadcast while their counted size is within the bound; beyond it
rows go through ``dropDuplicates`` as before. Groups whose rows differ in a second pair of
hashes are collisions: their rows, and only these, are compared in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.operators.sizing import DEFAULT_BROADCAST_BYTES, broadcast_if_small
from contrail.session import materialize

BITMAP_BYTES = 4096
KEYS, CHECKS = ("_k1", "_k2"), ("_c1", "_c2")


def row_hashes(df: DataFrame) -> dict[str, Column]:
    """Four hashes of a row. NULLs leave a hash as it is, so their places are hashed as well."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    nulls = F.concat(F.lit(""), *[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    order = {"_k1": cols, "_k2": cols, "_c1": cols[::-1], "_c2": cols[::-1]}
    return {name: F.xxhash64(F.lit(seed), nulls, *part)
            for seed, (name, part) in enumerate(order.items())}


def _bit(bitmap: Column, place: Column) -> Column:
    """The bit of ``place`` in the bitmap of its bucket."""
    at = F.call_function("bitmap_bit_position", place)
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.call_function("getbit", byte.cast("int"), (at % 8).cast("int"))


def dedupe_by_hash(df: DataFrame, bitmap_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``df`` with each distinct row once; the same rows as ``dropDuplicates``."""
    staged = materialize(df.withColumn("_place", F.monotonically_increasing_id() + 1), "dedupe")
    hashed = staged.select("_place", *[h.alias(n) for n, h in row_hashes(df).items()])
    groups = materialize(hashed.groupBy(*KEYS).agg(
        F.min("_place").alias("_place"),
        *[f(c).alias(f"{c}_{f.__name__}") for c in CHECKS for f in (F.min, F.max)]), "dedupe-groups")
    same = (F.col("_c1_min") == F.col("_c1_max")) & (F.col("_c2_min") == F.col("_c2_max"))
    bucket = F.call_function("bitmap_bucket_number", F.col("_place"))
    maps = materialize(groups.filter(same).groupBy(bucket.alias("_bucket")).agg(F.call_function(
        "bitmap_construct_agg", F.call_function("bitmap_bit_position", F.col("_place"))).alias(
        "_bits")), "dedupe-places")
    if maps.count() * BITMAP_BYTES > bitmap_bytes:
        return staged.select(*df.columns).dropDuplicates()
    met = staged.withColumn("_bucket", bucket).join(F.broadcast(maps), "_bucket")
    kept = met.filter(_bit(F.col("_bits"), F.col("_place")) == 1).select(
        *[F.col(f"`{c}`") for c in df.columns])
    collided = groups.filter(~same).select(*KEYS)
    if collided.isEmpty():
        return kept
    unlike = staged.withColumns(row_hashes(df)).join(
        broadcast_if_small(collided), list(KEYS), "left_semi")
    return kept.unionByName(unlike.select(*[F.col(f"`{c}`") for c in df.columns]).dropDuplicates())
