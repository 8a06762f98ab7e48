"""Presentation strings for KPI cards and report columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The subtitle after a change, by KPI.
PPT_VS_LAST_MONTH = " ppt vs last month"
PCT_VS_LAST_YEAR = "% vs last year"
PPT_VS_LAST_YEAR = " ppt vs last year"
PCT_ONLY = "%"


def fixed_point(value: Column, digits: int) -> Column:
    """Plain decimal text without thousands separators."""
    return F.round(value.cast("decimal(38,10)"), digits).cast("string")


def change_label(change: Column, suffix: str) -> Column:
    """Arrow, magnitude at one decimal and a suffix; a missing change reads as no change."""
    arrow = F.when(change > 0, "▲").when(change < 0, "▼").otherwise("–")
    size = fixed_point(F.abs(F.coalesce(change, F.lit(0.0))), 1)
    return F.concat(arrow, F.lit(" "), size, F.lit(suffix))


def format_value(value: Column, kind: str) -> Column:
    """``pct`` 4.35%, ``signed_ppt`` +0.10 ppt, ``signed_pct`` +0.10%, ``thousands`` 14,201.3."""
    if kind == "pct":
        return F.concat(fixed_point(value, 2), F.lit("%"))
    if kind == "thousands":
        return F.format_number(F.round(value.cast("decimal(38,10)"), 1), 1)
    suffix = {"signed_ppt": " ppt", "signed_pct": "%"}[kind]
    text = fixed_point(value, 2)
    return F.concat(F.when(F.startswith(text, F.lit("-")), "").otherwise("+"), text, F.lit(suffix))


def delta_status(delta: Column, good_down: bool = False) -> Column:
    """Struct of direction and verdict; zero counts as up."""
    up = delta >= 0
    good = ~up if good_down else up
    return F.when(
        delta.isNotNull(),
        F.struct(
            F.when(up, "up").otherwise("down").alias("direction"),
            F.when(good, "good").otherwise("bad").alias("verdict"),
        ),
    )
