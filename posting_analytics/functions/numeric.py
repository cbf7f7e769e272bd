"""Percentages with exact half-up rounding."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def percent(part, whole, scale: int = 2) -> Column:
    """``round(part * 100 / whole, scale)`` in decimal arithmetic (half-up),
    returned as double; NULL when ``whole`` is 0 or NULL."""
    num = as_col(part).cast("decimal(20,0)") * F.lit(Decimal("100.0"))
    ratio = F.try_divide(num, as_col(whole).cast("decimal(20,0)"))
    return F.round(ratio, scale).cast("double")
