"""Null-preserving numeric guards.  A missing measurement stays null and never becomes zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITY = float("inf")


def is_finite(x: Column) -> Column:
    """True for a number that is neither NaN nor infinite; false for null."""
    x = x.cast("double")
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < INFINITY)


def finite_or_null(x: Column) -> Column:
    return F.when(is_finite(x), x.cast("double"))


def fraction(part: Column, whole: Column) -> Column:
    """part / whole; null where whole is zero or null."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def count_true(condition: Column) -> Column:
    """Rows for which the condition holds; null counts as not."""
    return F.count(F.when(condition, F.lit(1)))
