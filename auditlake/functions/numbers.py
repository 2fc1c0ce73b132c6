"""Aggregate helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_true(condition: Column) -> Column:
    """Rows where the condition is true; NULL is not true."""
    return F.count_if(condition)


def sum_where(condition: Column, value: Column) -> Column:
    """Sum of ``value`` over rows where the condition is true, 0 for the others."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL when the denominator is 0."""
    return F.try_divide(numerator, denominator)
