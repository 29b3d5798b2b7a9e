"""Train/test splits.

``hash_split`` puts a row in a side by an md5 bucket of its key: the same
row always lands on the same side, whatever the partitioning, the number
of re-evaluations or the engine (the bucket is plain SQL). It needs no
shuffle, sort or cache. ``random_split`` is Spark's Bernoulli
``randomSplit``, whose result depends on the partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_SEED = 123
BUCKETS = 10_000
HASHES = 16 ** 7  # values of the 7 hex digits
NULL_KEY = "\x00NULL"


def _key(cols: Sequence[str]) -> Column:
    cols = list(cols)
    if len(cols) == 1:
        return F.coalesce(F.col(f"`{cols[0]}`").cast("string"), F.lit(NULL_KEY))
    return F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(NULL_KEY))
                              for c in cols])


def hash_bucket(key_cols: Sequence[str], seed: int = DEFAULT_SEED,
                buckets: int = BUCKETS) -> Column:
    """``int(first 7 hex digits of md5('<seed>|<key>'), 16) % buckets``."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), _key(key_cols)))
    return F.pmod(F.conv(F.substring(digest, 1, 7), 16, 10).cast("bigint"), F.lit(buckets))


def split_label(key_cols: Sequence[str], weights: Sequence[float] = (0.8, 0.2),
                seed: int = DEFAULT_SEED) -> Column:
    """Index of the side (0, 1, ...) for each row, by cumulative weight of the whole hash."""
    total = float(sum(weights))
    bucket = hash_bucket(key_cols, seed, HASHES)
    cuts, acc = [], 0.0
    for w in weights[:-1]:
        acc += w
        cuts.append(math.ceil(acc / total * HASHES))
    expr = F.lit(len(weights) - 1)
    for i in reversed(range(len(cuts))):
        expr = F.when(bucket < cuts[i], F.lit(i)).otherwise(expr)
    return expr


def hash_split(df: DataFrame, key_cols: Sequence[str], weights: Sequence[float] = (0.8, 0.2),
               seed: int = DEFAULT_SEED) -> list[DataFrame]:
    label = split_label(key_cols, weights, seed)
    return [df.filter(label == i) for i in range(len(weights))]


def fold_column(key_cols: Sequence[str], n_folds: int, seed: int = DEFAULT_SEED) -> Column:
    """Deterministic fold id in ``[0, n_folds)`` for cross-validation."""
    return F.pmod(hash_bucket(key_cols, seed + 1), F.lit(n_folds)).cast("int")


def random_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2),
                 seed: int = DEFAULT_SEED) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed=seed)
