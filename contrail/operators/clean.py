"""Cleaning transforms: pure projections/filters plus small profile-driven decisions.

Decisions (which columns are sparse, constant, categorical) come from one
profile aggregate each; applying them is a lazy projection, so the plan
stays one Catalyst tree that the optimizer can prune and push down.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.casts import tolerant_double, tolerant_int
from contrail.functions.clock import hhmm_to_minutes, valid_clock
from contrail.functions.text import null_if_token
from contrail.operators.profile import null_profile, profile_columns

SPARSE_THRESHOLD_PCT = 25.0


def _q(name: str):
    return F.col(f"`{name}`")


def replace_null_tokens(df: DataFrame, token: str = "NA",
                        columns: Sequence[str] | None = None) -> DataFrame:
    """Exact ``token`` -> NULL in every text column (or the given ones), one projection."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    targets = set(columns)
    return df.select(*[null_if_token(_q(c), token).alias(c) if c in targets else _q(c)
                       for c in df.columns])


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop named columns; names that are not present are ignored."""
    return df.drop(*list(columns))


def sparse_columns(df: DataFrame, threshold_pct: float = SPARSE_THRESHOLD_PCT) -> list[str]:
    """Columns whose NULL share is strictly above ``threshold_pct`` percent."""
    rows = null_profile(df).filter(F.col("pct_null") > threshold_pct).collect()
    return [r.column_name for r in sorted(rows, key=lambda r: r.position)]


def drop_sparse_columns(df: DataFrame,
                        threshold_pct: float = SPARSE_THRESHOLD_PCT) -> DataFrame:
    return df.drop(*sparse_columns(df, threshold_pct))


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows holding a NULL in any (or any of ``subset``) column."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def constant_columns(df: DataFrame) -> list[str]:
    """Columns with exactly one distinct non-null value (all-NULL columns are kept)."""
    rows = profile_columns(df, ("is_constant",)).filter("is_constant").collect()
    return [r.column_name for r in sorted(rows, key=lambda r: r.position)]


def drop_constant_columns(df: DataFrame) -> DataFrame:
    return df.drop(*constant_columns(df))


def dedupe(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Full-row (or ``subset``) de-duplication: one hash shuffle, map-side combined."""
    return df.dropDuplicates(list(subset) if subset else None)


def cast_columns(df: DataFrame, columns: Iterable[str], kind: str = "int") -> DataFrame:
    """Tolerant text -> number cast of ``columns`` (``int`` truncates, ``double`` keeps decimals).

    Columns that are already numeric are cast plainly (``int`` truncation).
    """
    cast = {"int": tolerant_int, "double": tolerant_double}[kind]
    targets = set(columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in df.columns:
        if c not in targets:
            out.append(_q(c))
        elif isinstance(types[c], T.StringType):
            out.append(cast(_q(c)).alias(c))
        else:
            out.append(_q(c).cast(kind).alias(c))
    return df.select(*out)


def cast_numeric(df: DataFrame, categorical: Iterable[str], keep: Iterable[str] = (),
                 kind: str = "int") -> DataFrame:
    """Cast every column that is neither categorical nor in ``keep``."""
    skip = set(categorical) | set(keep)
    return cast_columns(df, [c for c in df.columns if c not in skip], kind)


def filter_valid_times(df: DataFrame, columns: Sequence[str], strict: bool = False) -> DataFrame:
    """Keep rows where every clock column passes ``NOT (c > 2359)`` (NULL drops the row)."""
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return df
    pred = valid_clock(_q(cols[0]), strict)
    for c in cols[1:]:
        pred = pred & valid_clock(_q(c), strict)
    return df.filter(pred)


def times_to_minutes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace hhmm clock columns by minutes after midnight (INT)."""
    targets = set(columns)
    return df.select(*[hhmm_to_minutes(_q(c)).alias(c) if c in targets else _q(c)
                       for c in df.columns])
