"""The named measures of the report."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmart.functions.labels import (
    PCT_ONLY,
    PCT_VS_LAST_YEAR,
    PPT_VS_LAST_MONTH,
    PPT_VS_LAST_YEAR,
    change_label,
    format_value,
)
from seriesmart.operators.semantic import at_flag, at_latest


@dataclass(frozen=True)
class Measure:
    """A figure: a column of a mart on its last date (``flag`` None) or under its latest flag."""

    name: str
    mart: str
    column: str
    style: str
    flag: str | None = None
    persons: bool = False


# --- Fixed values: the measures and, per label, the measure it describes and its suffix -----------

MEASURES = [
    Measure("Latest Unemployment Rate", "national", "unemployment_rate_pct", "pct"),
    Measure("Latest Employed Thousands", "national", "employed_thousands", "thousands"),
    Measure("Latest Participation Rate", "national", "participation_rate_pct", "pct"),
    Measure("Latest Emp To Pop Ratio", "national", "emp_to_pop_ratio_pct", "pct"),
    Measure("Unemployment Rate MoM Change", "national", "unemployment_rate_mom_change_ppt", "signed_ppt"),
    Measure("Unemployment Rate YoY Change", "national", "unemployment_rate_yoy_change_ppt", "signed_ppt"),
    Measure("Employed YoY Change Pct", "national", "employed_yoy_change_pct", "signed_pct"),
    Measure("National Avg Unemployment Rate", "national", "unemployment_rate_pct", "pct"),
    Measure("Selected State Unemployment Rate", "state", "unemployment_rate_pct", "pct", "is_latest_month"),
    Measure("Selected State Employed Thousands", "state", "employed_thousands", "thousands", "is_latest_month"),
    Measure("Latest Industry Employed", "industry", "employed_thousands", "thousands", "is_latest_year"),
    Measure("Latest Industry YoY Change", "industry", "employed_yoy_change_pct", "signed_pct", "is_latest_year"),
    Measure("Latest FT Share Persons", "ftpt", "fulltime_share_pct", "pct", "is_latest_month", True),
    Measure("Latest PT Share Persons", "ftpt", "parttime_share_pct", "pct", "is_latest_month", True),
    Measure("FT Share YoY Change", "ftpt", "fulltime_share_yoy_change_ppt", "signed_ppt", None, True),
]
LABELS = {
    "Unemployment Rate Subtitle": ("Unemployment Rate MoM Change", PPT_VS_LAST_MONTH),
    "Employed Subtitle": ("Employed YoY Change Pct", PCT_VS_LAST_YEAR),
    "Industry YoY Change Label": ("Latest Industry YoY Change", PCT_ONLY),
    "FT Share Subtitle": ("FT Share YoY Change", PPT_VS_LAST_YEAR),
}


def _aggregate(measure: Measure) -> Column:
    where = F.col("sex_label") == "Persons" if measure.persons else None
    if measure.flag:
        return at_flag(measure.column, measure.flag, where)
    return at_latest(measure.column, where)


def kpi_values(marts: dict[str, DataFrame], measures: list[Measure] = MEASURES) -> DataFrame:
    """(measure, value) of the measures whose mart is given, one pass over each mart."""
    parts = []
    for name, mart in marts.items():
        wanted = [m for m in measures if m.mart == name]
        if wanted:
            row = mart.agg(*[_aggregate(m).alias(m.name) for m in wanted])
            parts.append(row.unpivot([], [m.name for m in wanted], "measure", "value"))
    return reduce(DataFrame.unionByName, parts)


def kpi_texts(values: DataFrame) -> DataFrame:
    """(measure, text) of each measure in its display format, and of each change label."""
    styles = {m.name: m.style for m in MEASURES}
    value, name = F.col("value"), F.col("measure")
    shown = F.coalesce(
        *[
            F.when(name.isin([n for n, s in styles.items() if s == style]), format_value(value, style))
            for style in sorted(set(styles.values()))
        ]
    )
    labels = [
        F.when(
            name == source,
            F.struct(F.lit(label).alias("measure"), change_label(value, suffix).alias("text")),
        )
        for label, (source, suffix) in LABELS.items()
    ]
    own = F.struct(name.alias("measure"), shown.alias("text"))
    return values.select(F.inline(F.array_compact(F.array(own, *labels))))
