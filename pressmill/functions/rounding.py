"""Percentages with one decimal, rounded as the published tables are.

Two rules meet in one table. Shares are rounded by the exact binary value of the
double, ties to even. Means are scaled, rounded to the nearest even integer and
scaled back. ``F.round`` does neither: it rounds the shortest decimal, half up.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round1_exact(x: Column) -> Column:
    """One decimal by the exact binary value of ``x`` (0 <= x), ties to even.

    ``x`` is halfway between two results when ``20 x`` is odd. ``20 x = 16 x + 4 x``
    where both products are exact, so the rounding error of their sum says on
    which side of the halfway point the double really lies.
    """
    big, small = x * 16, x * 4
    twenty = big + small
    carried = twenty - big
    error = (big - (twenty - carried)) + (small - carried)
    halfway = (twenty == F.floor(twenty)) & (F.floor(twenty) % 2 == 1)
    below = (twenty - 1) / 2
    return (
        F.when(~halfway, F.rint(twenty / 2))
        .when(error < 0, below)
        .when(error > 0, below + 1)
        .otherwise(F.rint(twenty / 2))
        / 10
    )


def round1_scaled(x: Column) -> Column:
    """One decimal by scaling: nearest even integer of ``10 x``, then a tenth of it."""
    return F.rint(x * 10) / 10
