"""Helpers that several operators share: reading, folds, staging, salted joins."""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SALTS = 16
#: A side of at most so many counted rows, of a few numbers or words each, is broadcast.
BROADCAST_ROWS = 200_000


def by_value(module: str) -> None:
    """Ship a module's functions inside the tasks, so executors need no copy of it."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold4(key: Column) -> Column:
    """crc32 of the key's text, modulo 4 (NULL for a NULL key)."""
    return F.crc32(key.cast("string")) % 4


def held_out(key: Column) -> Column:
    """Rows that no model may learn from; a NULL key is not one of them."""
    return F.coalesce(fold4(key) == 2, F.lit(False))


def learnable(key: Column) -> Column:
    """Rows that a model may learn from: a NULL key belongs to no fold."""
    return F.coalesce(fold4(key) != 2, F.lit(False))


def text_hash(text: Column) -> Column:
    return F.xxhash64(text)


def hash_below(bound: int, total: int, *cols: Column, seed: int = 7) -> Column:
    """A repeatable sample of about ``bound`` of ``total`` rows, by a hash of ``cols``."""
    if bound >= total:
        return F.lit(True)
    # The whole hash is compared, so a small share of a very large table is not rounded to none.
    return F.xxhash64(F.lit(seed), *cols).bitwiseAND(F.lit((1 << 63) - 1)) < F.lit(
        (1 << 63) * bound // total)


def digest_of_spans(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the order of the array."""
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                     s["end"].cast("string"))), ",")


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], spread_by: list[str],
                how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Join on ``keys`` where one key may hold a large share of ``big``'s rows.

    Each row of ``small`` (unique on ``keys`` in a left join) is repeated once a
    salt, ``big``'s rows take the salt of a hash of ``spread_by``, so that a
    hot key is dealt to ``salts`` tasks. Inner and left joins only. The merge hint
    keeps Spark from broadcasting ``small`` by an estimate that ignores the salts.
    """
    salt = "__salt"
    left = big.withColumn(salt, F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    right = small.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right.hint("merge"), [*keys, salt], how).drop(salt)


def checked(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows are within ``BROADCAST_ROWS``. ``df``
    comes from a staged table, so the count reads narrow files."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= BROADCAST_ROWS else df


def checked_join(big: DataFrame, small: DataFrame, keys: list[str], spread_by: list[str],
                 how: str = "inner", rows: int | None = None) -> DataFrame:
    """As ``salted_join``, by broadcast while ``small``, of a staged table, is within the bound."""
    if (small.count() if rows is None else rows) <= BROADCAST_ROWS:
        return big.join(F.broadcast(small), keys, how)
    return salted_join(big, small, keys, spread_by, how)


def cells(column) -> Iterator[bytes | None]:
    """The values of an Arrow string or binary array as bytes, one at a time."""
    import pyarrow as pa

    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
    else:
        column = column.cast(pa.binary())
    for value in column:
        yield value.as_py()


by_value(__name__)
