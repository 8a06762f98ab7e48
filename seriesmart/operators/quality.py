"""Data-quality checks. Each returns what fails; no rows means the check passes.

Checks on keys group first, so a key that holds most of a table is combined before the shuffle and
its failing rows come back as one row with a count.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmart.functions.keys import series_key
from seriesmart.operators.reporting import select_facts
from seriesmart.schemas import LABOUR_FORCE, LF_DIMENSIONS

log = logging.getLogger(__name__)


def failing_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def failing_unique(df: DataFrame, column: str) -> DataFrame:
    """(value, n_rows) of values that occur more than once; nulls are not compared."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter(F.col("n_rows") > 1)


def outside(column: str, values: list, where: Column | None = None) -> Column:
    """True for a non-null member that is not accepted."""
    wrong = F.col(column).isNotNull() & ~F.col(column).isin(values)
    return wrong if where is None else where & wrong


def failing_accepted(
    df: DataFrame, column: str, values: list, where: Column | None = None
) -> DataFrame:
    """(value, n_rows) of values that are not accepted."""
    wrong = df.filter(outside(column, values, where))
    return wrong.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def failing_fk(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """(value, n_rows) of values without a parent row; nulls refer to nothing.

    Both sides are reduced to distinct keys, which leaves them partitioned as the join needs them.
    """
    keys = (
        child.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    return keys.join(known, column, "left_anti")


def failing_grain(df: DataFrame, columns: list[str]) -> DataFrame:
    """(columns, n_rows) of combinations that occur more than once."""
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter(F.col("n_rows") > 1)


def failing_coverage(df: DataFrame, period: str, member: str, expected: int) -> DataFrame:
    """Periods that do not carry exactly the expected number of distinct members."""
    found = df.groupBy(period).agg(F.count_distinct(member).alias("members"))
    return found.filter(F.col("members") != expected).withColumn(
        "members_expected", F.lit(expected).cast("long")
    )


def missing_members(
    df: DataFrame, period: str, member: str, codes: DataFrame, code: str, step: str = "1 month"
) -> DataFrame:
    """(period, member) of the expected grid without a row: a whole period, a member that never occurs, or one cell.

    The grid has every ``step`` from the first period of ``df`` to the last, and every member of the
    code list, which is small by nature and one array here. Nulls are neither periods nor members. The
    table is read once, for its distinct pairs; their first and last period bound the grid.
    """
    pairs = df.filter(F.col(period).isNotNull()).select(period, member).distinct()
    bounds = pairs.agg(F.min(period).alias("first"), F.max(period).alias("last"))
    spine = bounds.select(F.explode(F.sequence("first", "last", F.expr(f"interval {step}"))).alias(period))
    expected = codes.agg(F.array_sort(F.collect_set(code))).scalar()
    grid = spine.select(period, F.explode(expected).alias(member))
    return grid.join(pairs, [period, member], "left_anti")


def failing_mixed_basis(series: DataFrame, basis: str = "adjustment_type") -> DataFrame:
    """One row if the series of a comparison are on more than one basis."""
    return series.agg(
        F.count_distinct(basis).alias("distinct_adjustment_types"),
        F.min(basis).alias("an_adjustment_type"),
        F.max(basis).alias("another_adjustment_type"),
    ).filter(F.col("distinct_adjustment_types") > 1)


def comparison_series(series: DataFrame, where: dict) -> DataFrame:
    """The series a comparison selects, including the predicate on the basis itself.

    With that predicate the check for a mixed basis can never fail; see ``feeding_series``.
    """
    for attribute, wanted in where.items():
        wanted = list(wanted) if isinstance(wanted, (list, tuple)) else [wanted]
        series = series.filter(F.col(attribute).isin(wanted))
    return series


def feeding_series(fact: DataFrame, series: DataFrame, where: dict) -> DataFrame:
    """The series with facts that a comparison would draw on if it did not fix the basis."""
    free = {a: w for a, w in where.items() if a != "tsest_code"}
    return select_facts(fact, series, free).select("series_id", "adjustment_type").distinct()


def failing_overlap(df: DataFrame, keys: list[str], value: str, tolerance: float = 1e-9) -> DataFrame:
    """Keys whose copies differ by more than the tolerance."""
    copies = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("copies"),
        F.min(value).alias("lowest_value"),
        F.max(value).alias("highest_value"),
    )
    spread = F.abs(F.col("highest_value") - F.col("lowest_value"))
    return copies.withColumn("spread", spread).filter(
        (F.col("copies") > 1) & (F.col("spread") > tolerance)
    )


def overlapping_extracts(raw_lf: DataFrame) -> DataFrame:
    """Series and periods that several extracts carry with different values."""
    observed = raw_lf.filter(F.col("obs_value").isNotNull()).withColumn(
        "series_id", series_key(LABOUR_FORCE, LF_DIMENSIONS)
    )
    return failing_overlap(observed, ["series_id", "time_period"], "obs_value")


# --- Contracts and regression --------------------------------------------------------------------


def contract_status(declared: list[str], actual: list[str] | None) -> tuple[str, list[str], list[str]]:
    """Verdict on a column list with the columns missing from and added to it."""
    if actual is None:
        return "missing view", list(declared), []
    missing = [c for c in declared if c not in actual]
    added = [c for c in actual if c not in declared]
    if missing or added:
        return "mismatch", missing, added
    return ("ok" if declared == actual else "order differs"), [], []


def contract_fields(declared: T.StructType, actual: T.StructType) -> list[tuple[int, str, str, str]]:
    """Fields that differ by position: (position, what differs, declared, actual)."""
    differing = []
    for k in range(max(len(declared), len(actual))):
        want = declared[k] if k < len(declared) else None
        have = actual[k] if k < len(actual) else None
        words = [f"{f.name} {f.dataType.simpleString()}" if f else "" for f in (want, have)]
        if want is None or have is None or want.name != have.name:
            differing.append((k, "name", *words))
        elif want.dataType != have.dataType:
            differing.append((k, "type", *words))
    return differing


def check_fields(spark: SparkSession, declared: dict[str, T.StructType], actual: dict[str, T.StructType]) -> DataFrame:
    """One row per field of a table that differs from its declaration in name, position or type."""
    rows = [
        (name, *field)
        for name, fields in declared.items()
        for field in contract_fields(fields, actual.get(name, T.StructType()))
    ]
    return spark.createDataFrame(rows, "name string, position int, differs string, declared string, actual string")


def check_contract(
    spark: SparkSession, declared: dict[str, list[str]], actual: dict[str, list[str] | None]
) -> DataFrame:
    """One row per declared table: verdict, missing and added columns. Metadata only."""
    rows = [(name, *contract_status(columns, actual.get(name))) for name, columns in declared.items()]
    return spark.createDataFrame(
        rows, "name string, status string, missing array<string>, added array<string>"
    )


def diff_rows(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on which two builds of a table differ: (keys, status, changed columns).

    Both sides are grouped together instead of joined, so a key that is repeated, which is itself
    reported, cannot multiply rows.
    """
    return _diff_tagged(*_tagged(left, right, keys), keys)


def _tagged(left: DataFrame, right: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """The rows of both builds with their side, and the columns they share besides the keys."""
    values = [c for c in left.columns if c not in keys and c in right.columns]
    columns = [*keys, *values]
    tagged = left.select(*columns, F.lit("left").alias("side")).unionByName(
        right.select(*columns, F.lit("right").alias("side"))
    )
    return tagged, values


def _diff_tagged(tagged: DataFrame, values: list[str], keys: list[str]) -> DataFrame:
    def on(side: str) -> list[Column]:
        here = F.col("side") == side
        row = F.struct(F.lit(1).alias("present"), *values)
        return [F.count_if(here).alias(f"n_{side}"), F.max(F.when(here, row)).alias(side)]

    grouped = tagged.groupBy(*keys).agg(*on("left"), *on("right"))
    changed = F.array_compact(
        F.array(
            F.lit(None).cast("string"),
            *[F.when(~F.col("left")[c].eqNullSafe(F.col("right")[c]), F.lit(c)) for c in values],
        )
    )
    status = (
        F.when((F.col("n_left") > 1) | (F.col("n_right") > 1), "repeated key")
        .when(F.col("n_right") == 0, "only left")
        .when(F.col("n_left") == 0, "only right")
        .when(F.size("changed") > 0, "changed")
    )
    both = (F.col("n_left") == 1) & (F.col("n_right") == 1)
    marked = grouped.withColumn("changed", F.when(both, changed)).withColumn("status", status)
    return marked.filter(F.col("status").isNotNull()).select(*keys, "status", "changed")


DIGEST_RANGES = 4096


def differing_ranges(
    left: DataFrame, right: DataFrame, keys: list[str], ranges: Column | None = None
) -> DataFrame:
    """Ranges of keys whose rows differ between two builds.

    A range's digest does not depend on the order of its rows: their number and the sums of two 64-bit
    hashes of each. Unequal ranges have equal digests with a chance of about 2 to the -128th. Only
    digests are shuffled, one row for each range and task.
    """
    tagged, values = _tagged(left, right, keys)
    return _differing(_ranged(tagged, keys, ranges), values, keys)


def _ranged(tagged: DataFrame, keys: list[str], ranges: Column | None) -> DataFrame:
    place = F.pmod(_hash(keys, 0), F.lit(DIGEST_RANGES)) if ranges is None else ranges
    return tagged.withColumn("key_range", place)


def _hash(columns: list[str], salt: int) -> Column:
    """A hash that tells nulls apart by their place, which the plain one passes over."""
    nulls = F.concat(F.lit(""), *[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(F.lit(salt), nulls, *columns)


def _differing(ranged: DataFrame, values: list[str], keys: list[str]) -> DataFrame:
    sides = {"left": F.col("side") == "left", "right": F.col("side") == "right"}
    hashes = [_hash([*keys, *values], salt).cast("decimal(20,0)") for salt in (1, 2)]
    digests = ranged.groupBy("key_range").agg(
        *[F.count_if(here).alias(f"n_{side}") for side, here in sides.items()],
        *[F.sum(F.when(here, h)).alias(f"h{k}_{side}") for side, here in sides.items() for k, h in enumerate(hashes)],
    )
    same = [F.col(f"{part}_left").eqNullSafe(F.col(f"{part}_right")) for part in ("n", "h0", "h1")]
    return digests.filter(~reduce(Column.__and__, same)).select("key_range")


def diff_rows_by_digest(
    left: DataFrame, right: DataFrame, keys: list[str], ranges: Column | None = None
) -> DataFrame:
    """`diff_rows` that moves only rows of ranges whose digests differ; equal builds move none.

    ``ranges`` numbers the ranges of a row's keys, at most a few thousand of them so that their list
    is small; by default they are hashes of the keys. Where differences sit together, as after a late
    delivery, ranges of the key itself leave more out. Keys are those of a grain that is checked: one that
    both builds repeat alike is reported only where its range differs otherwise.
    """
    tagged, values = _tagged(left, right, keys)
    ranged = _ranged(tagged, keys, ranges)
    wanted = _differing(ranged, values, keys)
    # The list has a row for each differing range at most; adaptive execution broadcasts it by its size.
    rows = ranged.join(wanted, "key_range", "left_semi").drop("key_range")
    return _diff_tagged(rows, values, keys)


def diff_schemas(left: DataFrame, right: DataFrame) -> list[tuple[str, str | None]]:
    """(status, column) of columns that one build lacks, that differ in type, or in order."""
    mine, other = dict(left.dtypes), dict(right.dtypes)
    found: list[tuple[str, str | None]] = [("column only left", c) for c in left.columns if c not in other]
    found += [("column only right", c) for c in right.columns if c not in mine]
    found += [("type differs", c) for c in left.columns if c in other and mine[c] != other[c]]
    shared = [[c for c in d.columns if c in mine and c in other] for d in (left, right)]
    return found + ([("order differs", None)] if shared[0] != shared[1] else [])


def diff_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """("rows differ", null, difference) if the builds have different numbers of rows."""
    one, two = left.agg(F.count("*").alias("n")), right.agg(F.count("*").alias("m"))
    return one.join(two).filter("n <> m").select(
        F.lit("rows differ").alias("status"), F.lit(None).cast("string").alias("column"), F.abs(F.expr("n - m")).alias("n_keys")
    )


def diff_builds(
    left: DataFrame, right: DataFrame, keys: list[str], digests: bool = False, ranges: Column | None = None
) -> DataFrame:
    """`diff_tables` with differences of columns (n_keys null) and of the numbers of rows.

    ``digests`` compares ranges of keys first, see `diff_rows_by_digest`.
    """
    columns = left.sparkSession.createDataFrame(
        [(s, c, None) for s, c in diff_schemas(left, right)], "status string, column string, n_keys long"
    )
    rows = diff_rows_by_digest(left, right, keys, ranges) if digests else diff_rows(left, right, keys)
    return _by_status(rows).unionByName(columns).unionByName(diff_counts(left, right))


def diff_tables(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """(status, column, n_keys): differing keys by status, and by column where values changed."""
    return _by_status(diff_rows(left, right, keys))


def _by_status(differing: DataFrame) -> DataFrame:
    cause = F.explode_outer("changed").alias("column")
    return (
        differing.select("status", cause)
        .groupBy("status", "column")
        .agg(F.count(F.lit(1)).alias("n_keys"))
    )


# --- Declared checks and their run ---------------------------------------------------------------


@dataclass(frozen=True)
class Checks:
    """What must hold for one table."""

    not_null: list[str] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    accepted: dict[str, list] = field(default_factory=dict)
    grain: list[str] = field(default_factory=list)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    severity: str = "error"
    #: Checks, as (check, column), whose failures are reported but stop nothing.
    warn: list[tuple[str, str]] = field(default_factory=list)

    def __len__(self) -> int:
        declared = [self.not_null, self.unique, self.accepted, self.references]
        return sum(map(len, declared)) + bool(self.grain)


def _same(columns: list[Column]) -> Column:
    """Text that is equal exactly where all columns are, nulls included."""
    texts = [c.cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in texts])


def run_checks(df: DataFrame, checks: Checks, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """(check, column, failures, severity) for every declared check of a table.

    All checks share one scan of the table and one shuffle: a row becomes one (check, key) for each
    check on a key and one for each check of single rows that it fails. They are counted before the
    shuffle, so a hot key or a check that fails everywhere is a row for each task. A parent adds its
    own keys to the same shuffle.
    """
    rows, keys = [("not_null", c) for c in checks.not_null], []
    bad = [F.col(c).isNull() for c in checks.not_null]
    rows += [("accepted_values", c) for c in checks.accepted]
    bad += [outside(c, v) for c, v in checks.accepted.items()]
    keys += [(("unique", c), [c]) for c in checks.unique]
    keys += [(("grain", ", ".join(checks.grain)), checks.grain)] if checks.grain else []
    keys += [(("relationships", c), [c]) for c in checks.references]
    declared = [*rows, *[name for name, _ in keys]]
    if not declared:
        return df.sparkSession.createDataFrame([], "check string, column string, failures long, severity string")
    place = {name: k for k, name in enumerate(declared)}

    def entry(name: tuple[str, str], key: Column, when: Column | None = None) -> Column:
        made = F.struct(F.lit(place[name]).alias("place"), key.alias("key"))
        return made if when is None else F.when(when, made)

    entries = [entry(name, F.lit(""), failed) for name, failed in zip(rows, bad, strict=True)]
    for name, columns in keys:
        given = None if name[0] == "grain" else F.col(columns[0]).isNotNull()
        entries.append(entry(name, _same([F.col(c) for c in columns]), given))
    parts = [df.select(F.inline(F.array_compact(F.array(*entries)))).withColumn("of_parent", F.lit(0))]
    for c, (parent, parent_column) in checks.references.items():
        value = F.col(parent_column).cast(df.schema[c].dataType)
        known = (parents or {})[parent].filter(value.isNotNull())
        found = F.lit(place["relationships", c]).alias("place")
        parts.append(known.select(found, _same([value]).alias("key"), F.lit(1).alias("of_parent")))
    counted = reduce(DataFrame.unionByName, parts).groupBy("place", "key").agg(
        F.count_if(F.col("of_parent") == 0).alias("n"), F.max("of_parent").alias("known")
    )
    n, at = F.col("n"), F.col("place")
    of_keys = [place[name] for name, _ in keys if name[0] != "relationships"]
    failing = (
        F.when(at < len(rows), n)
        .when(at.isin(of_keys), (n > 1).cast("long"))
        .otherwise(((n > 0) & (F.col("known") == 0)).cast("long"))
    )
    failures = counted.groupBy("place").agg(F.sum(failing).alias("failures"))
    severity = [
        "warn" if name in [tuple(w) for w in checks.warn] else checks.severity for name in declared
    ]
    listed = df.sparkSession.createDataFrame(
        [(k, *name, level) for k, (name, level) in enumerate(zip(declared, severity, strict=True))],
        "place int, check string, column string, severity string",
    )
    return listed.join(failures, "place", "left").select(
        "check", "column", F.coalesce("failures", F.lit(0)).alias("failures"), "severity"
    )


class CheckFailure(RuntimeError):
    """A table did not pass its checks, so nothing that depends on it is built."""


def enforce(name: str, results: DataFrame) -> list:
    """Run the checks of a table; raise if one of severity error has failures, log the others."""
    rows = results.collect()
    failed = [r for r in rows if r.failures]
    broken = [r for r in failed if r.severity == "error"]
    for r in failed:
        if r.severity != "error":
            log.warning("%s: %s on %s: %d", name, r.check, r.column, r.failures)
    if broken:
        found = "; ".join(f"{r.check} on {r.column}: {r.failures}" for r in broken)
        raise CheckFailure(f"{name}: {found}")
    return rows
