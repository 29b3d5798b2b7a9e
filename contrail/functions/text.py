"""Text predicates and null-token handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from contrail.functions.util import as_column

LETTER_PATTERN = r"\p{L}"


def null_if_token(c: Column | str, token: str = "NA") -> Column:
    """Exact, case-sensitive, untrimmed match of ``token`` -> NULL."""
    return F.nullif(as_column(c), F.lit(token))


def has_letter(c: Column | str) -> Column:
    """True when the text holds at least one Unicode letter."""
    return as_column(c).rlike(LETTER_PATTERN)
