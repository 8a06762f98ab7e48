"""The gated build: land, stage, star, marts, export, each checked before the next is built."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmart.operators import quality as Q
from seriesmart.operators.staging import deduplicated, typed_observations
from seriesmart.operators.star import FACT_PARTITIONS, dim_date, dim_series, fct_observations
from seriesmart.plans.checks import CHECKS
from seriesmart.plans.marts import STATES, Marts, build_marts
from seriesmart.schemas import (
    EXTRACTS,
    LABOUR_ACCOUNT,
    LABOUR_FORCE,
    MART_CONTRACT,
    Extract,
)
from seriesmart.plans.views import mart_sql, staging_sql
from seriesmart.sinks import define_view, ensure_schemas, export_marts, overwrite_table, require_shared_warehouse
from seriesmart.sources.codelists import SEED_ROWS, CodeLists, load_seed
from seriesmart.sources.observations import (
    ingest_report,
    raise_on_problems,
    read_observations,
    required_columns,
)

#: The order of the stored fact within a partition.
FACT_CLUSTERING = ["series_id", "date_key"]

RAW_TABLES = {
    LABOUR_FORCE: "lf_observations",
    LABOUR_ACCOUNT: "labour_account_observations",
}


@dataclass(frozen=True)
class Config:
    """What to build from where.

    Raw and core tables are always written. ``write_all`` also writes staging and marts under their
    schema, so that checks, marts and report queries read them instead of deriving them again;
    without it those two layers are views of the catalog, derived whenever a session reads them.
    """

    raw_dir: str
    extracts: tuple[Extract, ...] = EXTRACTS
    #: Regions of a month; where it is the number of states, every month and state must have a row.
    members: int = 8
    write_all: bool = True
    export_dir: str | None = None


@dataclass
class Build:
    """The built layers and the outcome of every check."""

    raw: dict[str, DataFrame] = field(default_factory=dict)
    staged: DataFrame | None = None
    dates: DataFrame | None = None
    series: DataFrame | None = None
    fact: DataFrame | None = None
    marts: Marts | None = None
    checks: dict[str, list] = field(default_factory=dict)
    exports: list[str] = field(default_factory=list)


def land(spark: SparkSession, cfg: Config) -> dict[str, DataFrame]:
    """Raw tables, one per dataflow; every extract is saved before an incomplete one is reported."""
    raw = {}
    for dataflow, table in RAW_TABLES.items():
        rows = read_observations(spark, cfg.raw_dir, dataflow, cfg.extracts)
        raw[dataflow] = overwrite_table(rows, f"raw.{table}", required_columns(dataflow))
    for dataflow, df in raw.items():
        asked = [e for e in cfg.extracts if e.dataflow == dataflow]
        raise_on_problems(ingest_report(df, asked, {"region": _states(spark)}))
    return raw


STATE_CODES = [code for code, _, level in SEED_ROWS["seed_region"] if level != "National"]


def _states(spark: SparkSession) -> DataFrame:
    """The regions that every month of the state mart must have."""
    return load_seed(spark, "seed_region").filter(F.col("region_code").isin(STATE_CODES))


def _publish(df: DataFrame, schema: str, name: str, cfg: Config, sql: str) -> DataFrame:
    """Make a layer readable by name: a table where the configuration says so, else a lasting view."""
    spark = df.sparkSession
    full = f"{schema}.{name}"
    df = overwrite_table(df, full) if cfg.write_all else define_view(spark, full, sql)
    df.createOrReplaceTempView(name)
    return df


def _pass(build: Build, name: str, df: DataFrame, parents: dict[str, DataFrame] | None = None) -> None:
    build.checks[name] = Q.enforce(name, Q.run_checks(df, CHECKS[name], parents))


def _singular(build: Build, name: str, failing: DataFrame) -> None:
    """A check of its own: any row it returns stops the build."""
    rows = failing.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(name).alias("check"), F.lit("").alias("column"), "failures", F.lit("error").alias("severity")
    )
    build.checks[name] = Q.enforce(name, rows)


def build(spark: SparkSession, cfg: Config, codes: CodeLists | None = None) -> Build:
    """Everything from files to marts. A failed check stops the build before its dependants.

    ``codes`` replaces the standard code lists that series are decoded with; the declared checks of the
    series dimension hold for its names as well. Each layer reads columns of the one before from disk.
    """
    result = Build()
    require_shared_warehouse(spark)
    ensure_schemas(spark)
    seeds = {
        name: overwrite_table(load_seed(spark, name), f"seed.{name}") for name in SEED_ROWS
    }
    for name, df in seeds.items():
        _pass(result, name, df)

    result.raw = land(spark, cfg)
    for dataflow, name in RAW_TABLES.items():
        _pass(result, name, result.raw[dataflow])
    lf, account = result.raw[LABOUR_FORCE], result.raw[LABOUR_ACCOUNT]
    _singular(result, "overlapping_extracts_agree", Q.overlapping_extracts(lf))

    typed = typed_observations(lf, account)
    tables = [f"raw.{RAW_TABLES[flow]}" for flow in (LABOUR_FORCE, LABOUR_ACCOUNT)]
    staged = result.staged = _publish(
        deduplicated(typed), "staging", "stg_labour_force", cfg, staging_sql(*tables)
    )
    _pass(result, "stg_labour_force", staged, seeds)

    observed = staged if cfg.write_all else typed
    result.dates = overwrite_table(dim_date(observed), "core.dim_date")
    _pass(result, "dim_date", result.dates)
    decoded = dim_series(observed, codes or CodeLists.standard(spark))
    result.series = overwrite_table(decoded, "core.dim_series")
    _pass(result, "dim_series", result.series)
    _singular(
        result,
        "no_mixed_adjustment_types",
        Q.failing_mixed_basis(Q.comparison_series(result.series, STATES)),
    )
    result.fact = overwrite_table(
        fct_observations(staged, partitioned=True),
        "core.fct_labour_force",
        cluster_by=FACT_CLUSTERING,
        partition_by=FACT_PARTITIONS,
    )
    parents = {**seeds, "dim_series": result.series, "dim_date": result.dates}
    _pass(result, "fct_labour_force", result.fact, parents)

    marts = build_marts(result.fact, result.series).by_name()
    texts = mart_sql("core.fct_labour_force", "core.dim_series")
    for name, df in marts.items():
        marts[name] = _publish(df, "mart", name, cfg, texts[name])
        _pass(result, name, marts[name], parents)
    result.marts = Marts.of_names(marts)
    _singular(
        result,
        "all_members_present",
        Q.failing_coverage(result.marts.state, "date", "region_code", cfg.members),
    )
    if cfg.members == len(STATE_CODES):
        states = _states(spark)
        missing = Q.missing_members(result.marts.state, "date", "region_code", states, "region_code")
        _singular(result, "no_missing_cell", missing)
    # Names, positions and types of every column.
    differing = Q.check_fields(
        spark, MART_CONTRACT, {name: df.schema for name, df in result.marts.by_name().items()}
    )
    _singular(result, "mart_contract", differing)

    if cfg.export_dir:
        result.exports = export_marts(result.marts.by_name(), cfg.export_dir)
    return result


def declared_checks(names: Iterable[str] = CHECKS) -> int:
    return sum(len(CHECKS[name]) for name in names)
