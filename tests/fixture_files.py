"""A small invented set of observation files with the properties a real one must have:
all regions in every month, both copies of the overlapping series, two years of months and three
annual periods, a gap, a comment with commas, a sub-division and the industry total."""

from __future__ import annotations

import csv
from pathlib import Path

MONTHS = [f"{y}-{m:02d}" for y in (2020, 2021) for m in range(1, 13)]
YEARS = ["2019", "2020", "2021"]
INDUSTRIES = [*"ABCDEFGHIJKLMNOPQRS", "TOTAL", "B06"]
LF_HEADER = [
    "DATAFLOW", "MEASURE", "SEX", "AGE", "TSEST", "REGION", "FREQ", "TIME_PERIOD", "OBS_VALUE",
    "UNIT_MEASURE", "UNIT_MULT", "OBS_STATUS", "OBS_COMMENT", "DECIMALS",
]
ACCOUNT_HEADER = [
    "DATAFLOW", "MEASURE", "ASGS_2016", "LABOURACCT_IND", "FREQ", "TIME_PERIOD", "OBS_VALUE",
    "UNIT_MEASURE", "UNIT_MULT", "OBS_STATUS", "OBS_COMMENT", "DECIMALS",
]
RATES = ("M12", "M13", "M16")


def level(measure: str, sex: str, region: str, i: int) -> float:
    """Employment by kind adds up over kinds and sexes; rates move slowly."""
    place = 1.0 if region == "AUS" else int(region) / 40
    full = {"1": 600 + i * 1.25, "2": 350 + i * 1.5}
    part = {"1": 100 + i * 0.75, "2": 250 - i * 0.25}
    sexes = ["1", "2"] if sex == "3" else [sex]
    if measure == "M1":
        return place * sum(full[s] for s in sexes)
    if measure == "M2":
        return place * sum(part[s] for s in sexes)
    if measure == "M3":
        return place * sum(full[s] + part[s] for s in sexes)
    if measure == "M6":
        return place * (70 - i * 0.5)
    return {"M12": 66.0, "M13": 5.0, "M16": 62.0}[measure] + place * (i % 7) * 0.125


def lf_rows(measures: list[str], sexes: list[str], tsest: str, regions: list[str]) -> list[list]:
    rows = []
    for measure in measures:
        for sex in sexes:
            for region in regions:
                for i, month in enumerate(MONTHS):
                    value = repr(level(measure, sex, region, i))
                    if measure == "M12" and month == "2020-05":
                        value = "NaN"
                    comment = "a break, in the series, in this month" if month == "2020-04" else ""
                    unit = ("PCT", "0") if measure in RATES else ("NUM", "3")
                    rows.append(
                        ["ABS:LF(1.0.0)", measure, sex, "1599", tsest, region, "M", month, value,
                         *unit, "", comment, "1"]
                    )
    return rows


def account_rows() -> list[list]:
    rows = []
    for k, industry in enumerate(INDUSTRIES):
        for i, year in enumerate(YEARS):
            value = repr(100.0 + 10 * k + i * (k - 8) * 1.5)
            rows.append(
                ["ABS:ABS_LABOUR_ACCT(1.0.0)", "M9", "AUS", industry, "A", year, value, "NUM", "3",
                 "", "", "1"]
            )
    return rows


def contents() -> dict[str, tuple[list[str], list[list]]]:
    states = [str(r) for r in range(1, 9)]
    return {
        "national_summary": (LF_HEADER, lf_rows(["M3", "M6", "M12", "M13", "M16"], ["3"], "20", ["AUS"])),
        "national_fulltime_parttime": (LF_HEADER, lf_rows(["M1", "M2", "M3"], ["1", "2", "3"], "20", ["AUS"])),
        "state_summary": (LF_HEADER, lf_rows(["M3", "M13"], ["3"], "30", states)),
        "national_trend": (LF_HEADER, lf_rows(["M3", "M13"], ["3"], "30", ["AUS"])),
        "industry_employment": (ACCOUNT_HEADER, account_rows()),
    }


def write(directory: str, files: dict[str, tuple[list[str], list[list]]] | None = None) -> str:
    for name, (header, rows) in (files or contents()).items():
        with open(Path(directory) / f"{name}.csv", "w", newline="", encoding="utf-8") as out:
            writer = csv.writer(out)
            writer.writerow(header)
            writer.writerows(rows)
    return directory
