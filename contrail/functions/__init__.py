"""Column -> Column expressions (all JVM-side, codegen friendly)."""

from contrail.functions.casts import tolerant_double, tolerant_int
from contrail.functions.clock import hhmm_to_minutes, valid_clock
from contrail.functions.text import has_letter, null_if_token

__all__ = [
    "has_letter",
    "hhmm_to_minutes",
    "null_if_token",
    "tolerant_double",
    "tolerant_int",
    "valid_clock",
]
