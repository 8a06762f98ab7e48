"""Build the warehouse from a folder of observation files: `python -m seriesmart RAW_DIR`."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from seriesmart.plans.gap_report import figures, figures_json
from seriesmart.plans.warehouse import Config, build
from seriesmart.sinks import write_figures


def main() -> None:
    parser = argparse.ArgumentParser(prog="seriesmart", description=__doc__)
    parser.add_argument("raw_dir", help="folder with one CSV per extract")
    parser.add_argument("--export-dir", help="write the marts as CSV below this folder")
    parser.add_argument("--figures", help="write the figures document to this folder")
    parser.add_argument("--views", action="store_true", help="keep staging and marts as views")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("seriesmart").getOrCreate()
    cfg = Config(args.raw_dir, write_all=not args.views, export_dir=args.export_dir)
    result = build(spark, cfg)
    for name, rows in result.checks.items():
        failures = sum(r.failures for r in rows)
        warnings = sum(r.failures for r in rows if r.severity != "error")
        print(f"{name:32} {len(rows):>3} checks {failures:>6} failures, {warnings} of them warnings")
    if args.figures:
        write_figures(figures_json(figures(result.marts.ftpt)), args.figures)


if __name__ == "__main__":
    main()
