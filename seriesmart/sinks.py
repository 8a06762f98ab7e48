"""Tables, exports and documents."""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmart.operators.quality import contract_status
from seriesmart.schemas import MART_CONTRACT
from seriesmart.sources.observations import read_csv_strings

BYTE_ORDER_MARK = "\ufeff"

# The file of each mart and the order of its rows.
EXPORTS = {
    "v_national_overview": ("national_overview", ["date"]),
    "v_unemployment_by_state": ("unemployment_by_state", ["region_name", "date"]),
    "v_fulltime_parttime": ("fulltime_parttime", ["sex_label", "date"]),
    "v_industry_breakdown": ("industry_breakdown", ["industry_name", "date"]),
}
SCHEMAS = ["raw", "staging", "core", "mart", "seed"]


def require_shared_warehouse(spark: SparkSession) -> None:
    """Tables of a cluster must not lie in a folder of the driver's machine."""
    where = spark.conf.get("spark.sql.warehouse.dir")
    if not spark.sparkContext.master.startswith("local") and where.startswith("file:"):
        raise ValueError(f"set spark.sql.warehouse.dir to shared storage, not {where}")


def ensure_schemas(spark: SparkSession, names: list[str] = SCHEMAS) -> None:
    for name in names:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def reject_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """The same rows; reading one with a null in a required column fails the query.

    The test rides along with the write, so a load need not be read twice to be checked.
    """
    return df.withColumns(
        {
            c: F.coalesce(F.col(c), F.raise_error(F.lit(f"null in required column {c}")).cast("string"))
            for c in columns
        }
    )


#: The property of a table's view that names the version it shows.
VERSION = "seriesmart.version"


def current_version(spark: SparkSession, name: str) -> str | None:
    """The stored table that ``name`` shows; None where nothing has been published under it."""
    if not spark.catalog.tableExists(name):
        return None
    shown = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return shown.get(VERSION)


def versions(spark: SparkSession, name: str) -> list[str]:
    """All stored versions of a table, those of failed or interrupted refreshes too."""
    schema, table = name.split(".")
    found = [r.tableName for r in spark.sql(f"SHOW TABLES IN {schema} LIKE '{table}__*'").collect()]
    return [f"{schema}.{t}" for t in found if re.fullmatch(re.escape(table) + "__[0-9a-f]{12}", t)]


def drop_versions(spark: SparkSession, name: str) -> None:
    """Remove every stored version but the one that ``name`` shows."""
    kept = current_version(spark, name)
    for version in versions(spark, name):
        if version != kept:
            spark.sql(f"DROP TABLE IF EXISTS {version}")


def publish_version(spark: SparkSession, name: str, version: str) -> None:
    """Let ``name`` show a version: one change of the catalog, so a reader sees the old or the new rows."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{VERSION}' = '{version}') AS SELECT * FROM {version}")


def overwrite_table(
    df: DataFrame,
    name: str,
    required: list[str] = (),
    cluster_by: list[str] = (),
    partition_by: list[str] = (),
) -> DataFrame:
    """Full refresh of a table; returns the table as written.

    ``name`` is a view of a stored version. The rows are written to a new version, which the view shows
    once it is complete; then all others are removed. A refresh that fails or is cut off leaves the old
    rows under the name, and what it has stored goes with its error or with the next refresh. Only one
    refresh of a table may run at a time; a reader that started before it may find its files gone.

    ``cluster_by`` ranges the rows over the files by these columns, so that a filter on their
    prefix skips files and row groups. ``partition_by`` gives each value of these a folder.
    """
    spark, fresh = df.sparkSession, f"{name}__{uuid.uuid4().hex[:12]}"
    if required:
        df = reject_nulls(df, list(required))
    _replace_plain_table(spark, name)
    try:
        _arranged(df, cluster_by, partition_by).write.partitionBy(*partition_by).format("parquet").saveAsTable(fresh)
        publish_version(spark, name, fresh)
    finally:
        drop_versions(spark, name)
    return spark.table(name)


def _arranged(df: DataFrame, cluster_by: list[str], partition_by: list[str]) -> DataFrame:
    order = [*partition_by, *cluster_by]
    return df.repartitionByRange(*order).sortWithinPartitions(*order) if cluster_by else df


def _replace_plain_table(spark: SparkSession, name: str) -> None:
    """A table that stands under the name itself becomes a version that the name shows."""
    if not spark.catalog.tableExists(name) or spark.catalog.getTable(name).tableType == "VIEW":
        return
    version = f"{name}__{uuid.uuid4().hex[:12]}"
    spark.sql(f"ALTER TABLE {name} RENAME TO {version}")
    publish_version(spark, name, version)


def overwrite_partitions(
    df: DataFrame, name: str, cluster_by: list[str] = (), partition_by: list[str] = ()
) -> DataFrame:
    """Refresh only the partitions that ``df`` has rows of; the others stay as they are.

    Meant for a late or revised period. Partitions are replaced once all of their files are written,
    one after the other. Without a stored version this is a full refresh.
    """
    spark = df.sparkSession
    version = current_version(spark, name)
    if version is None:
        return overwrite_table(df, name, cluster_by=cluster_by, partition_by=partition_by)
    rows = _arranged(df, cluster_by, partition_by).select(*spark.table(version).columns)
    # `insertInto` takes the mode from the session alone.
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.write.insertInto(version, overwrite=True)
    finally:
        spark.conf.set(mode, before)
    return spark.table(name)


def define_view(spark: SparkSession, name: str, query: str) -> DataFrame:
    """A view that lasts: its SQL is kept in the catalog, where every session finds it."""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    drop_versions(spark, name)
    return spark.table(name)


def write_csv(df: DataFrame, path: str, mark: bool = True) -> None:
    """CSV with header and ISO dates. ``mark`` puts a byte order mark before the header.

    As many part files as the data needs; a sorted frame keeps its order through the parts, and
    adaptive execution leaves a small one in a single part.
    """
    if mark:
        first = df.columns[0]
        df = df.withColumnRenamed(first, BYTE_ORDER_MARK + first)
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("dateFormat", "yyyy-MM-dd")
        .option("escape", '"')
        .csv(path)
    )


def export_mart(df: DataFrame, name: str, directory: str) -> str:
    """One mart in its own order."""
    stem, order = EXPORTS[name]
    path = f"{directory}/{stem}"
    write_csv(df.orderBy(*order), path)
    return path


def export_marts(marts: dict[str, DataFrame], directory: str) -> list[str]:
    return [export_mart(marts[name], name, directory) for name in EXPORTS]


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """An export as text columns, without the byte order mark."""
    df = read_csv_strings(spark, path)
    return df.withColumnsRenamed({c: c.lstrip(BYTE_ORDER_MARK) for c in df.columns})


def check_export_header(spark: SparkSession, path: str, columns: list[str]) -> str:
    """ok, stale, or skipped where nothing has been exported yet."""
    try:
        exported = read_export(spark, path).columns
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return "skipped"
    verdict, *_ = contract_status(columns, exported)
    return "ok" if verdict == "ok" else "stale"


def check_exports(spark: SparkSession, directory: str) -> dict[str, str]:
    return {
        stem: check_export_header(spark, f"{directory}/{stem}", MART_CONTRACT[name].fieldNames())
        for name, (stem, _) in EXPORTS.items()
    }


def write_figures(document: DataFrame, path: str) -> None:
    """The figures document, a single JSON line."""
    document.write.mode("overwrite").text(path)


def write_slice(df: DataFrame, path: str) -> None:
    """A slice of raw text columns, in the form the observation reader takes."""
    write_csv(df, path, mark=False)
