"""Rounding that agrees with decimal arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(value: Column, digits: int) -> Column:
    """Round half up after removing binary noise: 53.349999999999994 counts as 53.35."""
    return F.round(F.round(value, 9), digits)
