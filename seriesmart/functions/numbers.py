"""Rounding and period-over-period arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _decimal(value: Column) -> Column:
    return value.cast("decimal(38,10)")


def round_half_up(value: Column, digits: int) -> Column:
    """Half away from zero on the decimal value, independent of binary noise in the double."""
    return F.round(_decimal(value), digits).cast("double")


def round_half_even(value: Column, digits: int) -> Column:
    """Half to even on the exact binary value, as Python's ``round`` does.

    ``format_number`` rounds the exact binary value; adding zero turns -0.0 into 0.0.
    """
    text = F.replace(F.format_number(value, digits), F.lit(","), F.lit(""))
    return text.cast("double") + F.lit(0.0)


def ppt_change(value: Column, previous: Column, digits: int = 3) -> Column:
    """Difference of two levels or two rates, rounded."""
    return round_half_up(value - previous, digits)


def percent_of(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``, unrounded; null where the whole is zero."""
    return part / F.nullif(whole, F.lit(0.0)) * 100


def pct_change(value: Column, previous: Column, digits: int = 2) -> Column:
    """Relative change in percent, from unrounded to rounded in one step."""
    return round_half_up(percent_of(value - previous, previous), digits)


def share_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    return round_half_up(percent_of(part, whole), digits)


def growth_category(change_pct: Column, band: float = 2.0) -> Column:
    """Growing or Shrinking from ``band`` percent on; everything else, unknown included, Stable."""
    return (
        F.when(change_pct >= band, "Growing").when(change_pct <= -band, "Shrinking").otherwise("Stable")
    )


def exact_sum(value: Column) -> Column:
    """Sum that does not depend on the order in which tasks deliver their partial sums.

    For presented values: six decimals are kept of each.
    """
    return F.sum(value.cast("decimal(28,6)")).cast("double")


def exact_avg(value: Column) -> Column:
    return exact_sum(value) / F.nullif(F.count(value), F.lit(0))
