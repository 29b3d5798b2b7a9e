"""Clock times written as integers ``hhmm`` (741 = 07:41)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from contrail.functions.util import as_column

CLOCK_MAX = 2359


def hhmm_to_minutes(c: Column | str) -> Column:
    """Minutes since midnight as INT: whole hundreds are hours, the rest are minutes.

    741 -> 461, 2359 -> 1439, 1275 -> 795, -5 -> 35. NULL stays NULL.
    """
    h = as_column(c)
    hours = F.floor(h / F.lit(100))
    return (hours * 60 + F.pmod(h, F.lit(100))).cast("int")


def valid_clock(c: Column | str, strict: bool = False) -> Column:
    """Predicate for a usable clock value.

    Default is the reference's ``NOT (h > 2359)``: NULL makes the predicate
    NULL, so a filter drops the row; minutes above 59 and negatives pass.
    ``strict`` also requires ``0 <= h`` and a minute part below 60.
    """
    h = as_column(c)
    pred = ~(h > F.lit(CLOCK_MAX))
    if strict:
        pred = pred & (h >= 0) & (F.pmod(h, F.lit(100)) < 60)
    return pred
