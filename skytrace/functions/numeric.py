"""Numeric helpers with the missing-value rules of the data model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def round_even(c: Column, places: int) -> Column:
    """Half-even on the scaled value; minus zero becomes zero."""
    k = float(10**places)
    return F.rint(c * k) / k + F.lit(0.0)


def derivative(y: Column, t: Column, y_before: Column, t_before: Column, y_after: Column, t_after: Column) -> Column:
    """Second-order central difference on uneven steps, one-sided where a neighbour is missing."""
    d1, d2 = (t - t_before).cast("double"), (t_after - t).cast("double")
    inner = -d2 / (d1 * (d1 + d2)) * y_before + (d2 - d1) / (d1 * d2) * y + d1 / (d2 * (d1 + d2)) * y_after
    return F.when(t_before.isNull(), (y_after - y) / d2).when(t_after.isNull(), (y - y_before) / d1).otherwise(inner)


def one_decimal(x: Column) -> Column:
    """Text of a non-negative number with one decimal, rounded by its exact binary value.

    Twentieths decide: 4x against (2k + 1) - 16x, both of which are exact.
    """
    k = F.floor(x * 10)
    up = (x * 4 > (2 * k + 1) - x * 16) | ((x * 4 == (2 * k + 1) - x * 16) & (k % 2 == 1))
    tenths = k + up.cast("long")
    return F.when(F.isnan(x) | x.isNull(), "nan").otherwise(F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string")))
