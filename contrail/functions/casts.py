"""Tolerant numeric casts from text.

The reference casts raw text with ``cast('int')`` under Spark 3.5's
non-ANSI rules: malformed text becomes NULL and decimals truncate toward
zero ("32.89" -> 32). Under ANSI (Spark 4 default) that cast raises, and
``try_cast(.. as int)`` gives NULL for "32.89". Going through DOUBLE keeps
the old answers, and the range guard keeps the double -> int step from
raising on overflow.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from contrail.functions.util import as_column

_INT_LOW = -2147483649.0   # trunc(x) fits in INT  <=>  LOW < x < HIGH
_INT_HIGH = 2147483648.0
# Doubles also read "5D", "1e3" and "0x1p3"; an int cast takes plain decimals only.
_PLAIN = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)\s*$"


def tolerant_double(c: Column | str) -> Column:
    """Text -> DOUBLE, NULL when the text is not a number."""
    return as_column(c).try_cast("double")


def tolerant_int(c: Column | str) -> Column:
    """Text -> INT: truncates decimals, NULL when malformed or out of range."""
    d = tolerant_double(c)
    plain = as_column(c).cast("string").rlike(_PLAIN)
    return F.when(plain & (d > F.lit(_INT_LOW)) & (d < F.lit(_INT_HIGH)), d.cast("int"))
