"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def lenient_long(value: Column) -> Column:
    """Text to bigint; NULL where it is not an integer, whatever the ANSI mode."""
    return value.try_cast("bigint")


def at_least_zero(value: Column) -> Column:
    """Raise a negative number to 0. NULL stays NULL, unlike with greatest()."""
    return F.when(value < 0, F.lit(0).cast("bigint")).otherwise(value)


def at_most(value: Column, ceiling: Column) -> Column:
    """Lower a number to the ceiling. A NULL on either side leaves the value
    as it is, which least() would not."""
    return F.when(value > ceiling, ceiling).otherwise(value)


def thousands(value: Column) -> Column:
    """1234567 to the text 1,234,567."""
    return F.format_number(value, 0)
