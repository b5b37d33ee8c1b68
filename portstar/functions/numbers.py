"""Numeric casts that never fail a job under ANSI mode.

Source numerics arrive as doubles (SAS files store every number as a double). Identifiers and
codes are whole numbers; a fraction, NaN or an out-of-range value gives null instead of killing a
100 TB job, and staging keeps such rows in a reject table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The integer ranges each target type can hold exactly.
_BOUNDS = {
    "int": (-2_147_483_648, 2_147_483_647),
    "bigint": (-(2**53), 2**53),  # doubles are exact integers only up to 2^53
    "long": (-(2**53), 2**53),
}


def as_column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whole_number(c, to: str = "bigint") -> Column:
    """Double -> integral type when the value is a whole number in range, else null."""
    c = as_column(c)
    low, high = _BOUNDS[to]
    return F.when(c.between(low, high) & (c == F.floor(c)), c.cast(to))


def code_text(c) -> Column:
    """Numeric code held as a double -> its integer text ('209', not '209.0')."""
    return whole_number(c, "bigint").cast("string")
