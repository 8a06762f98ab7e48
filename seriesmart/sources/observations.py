"""Observation files: scan, clean, align, append, select and report."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmart.schemas import (
    ACCOUNT_REQUIRED,
    EXTRACTS,
    LABOUR_FORCE,
    LF_REQUIRED,
    NA_TOKENS,
    RAW_ACCOUNT,
    RAW_LF,
    Extract,
)


class MissingExtract(FileNotFoundError):
    """An extract was asked for that has no file."""


def read_csv_strings(
    spark: SparkSession, path: str, multi_line: bool = False, files: list[str] | None = None
) -> DataFrame:
    """A CSV file or folder with a header, every column a string.

    The part files, or the ``files`` of the folder that are named, share one header. Leave ``multi_line``
    off unless cells hold line breaks: it makes a file unsplittable.
    """
    reader = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        # Every part file must have this header in this order, every row as many fields.
        .option("enforceSchema", False)
        # Else the width of a row is not seen where not all of its columns are read.
        .option("columnPruning", False)
        .option("mode", "FAILFAST")
    )
    return reader.csv(files or path)


def first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a file in any store that Spark reads, decompressed as Spark would."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        text = codec.createInputStream(stream) if codec else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(text, "UTF-8")).readLine()
    finally:
        stream.close()


def files_by_header(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files below ``path`` by their header; files without any line are left out.

    Spark lists the files; of each only the beginning is read, many at a time.
    """
    files = sorted(spark.read.text(path).inputFiles())
    found: dict[str, list[str]] = {}
    with ThreadPoolExecutor(16) as readers:
        for file, header in zip(files, readers.map(lambda f: first_line(spark, f), files)):
            if header is not None:
                found.setdefault(header.removeprefix("\ufeff"), []).append(file)
    return found


def csv_parts(spark: SparkSession, path: str, multi_line: bool = False) -> list[DataFrame]:
    """A file or folder as one frame for each distinct header, since files may order columns their own way.

    Within a frame headers and row widths are enforced. The columns are as the files name them; whoever
    appends the frames selects by name.
    """
    found = files_by_header(spark, path)
    if len(found) < 2:
        return [read_csv_strings(spark, path, multi_line)]
    return [read_csv_strings(spark, path, multi_line, [unquote(f) for f in files]) for files in found.values()]


def null_tokens(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Every spelling of "no value" becomes NULL."""
    names = list(columns or df.columns)
    return df.withColumns(
        {c: F.when(~F.col(c).isin(NA_TOKENS), F.col(c)) for c in names}
    )


def project_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Lower-case the file's column names and keep the wanted ones, in order; all must be there."""
    named = df.withColumnsRenamed({c: c.strip().lower() for c in df.columns})
    missing = [c for c in wanted if c not in named.columns]
    if missing:
        raise ValueError(f"missing expected columns: {missing}")
    return named.select(*wanted)


def tag_source(df: DataFrame, name: str) -> DataFrame:
    """Lineage: the extract a row came from."""
    return df.withColumn("source_extract", F.lit(name))


def parse_number(text: Column) -> Column:
    """A decimal or scientific number, else NULL.

    The character test keeps out spellings that only the JVM reads as a number, such as "1.5d".
    """
    return F.when(~text.rlike("[^0-9eE+.\\s-]"), text.try_cast("double"))


def parse_integer(text: Column) -> Column:
    """A whole number, else NULL; a fraction is a defect in the file and fails the load."""
    number = parse_number(text)
    broken = F.raise_error(F.concat(F.lit("not a whole number: "), text)).cast("int")
    return F.when(number == F.floor(number), number.cast("int")).when(number.isNotNull(), broken)


def coerce_numeric(df: DataFrame, doubles: Iterable[str] = (), integers: Iterable[str] = ()) -> DataFrame:
    """Text to numbers; what is not a number becomes NULL."""
    casts = {c: parse_number(F.col(c)) for c in doubles}
    casts |= {c: parse_integer(F.col(c)) for c in integers}
    return df.withColumns(casts)


def typed_extract(df: DataFrame, name: str, schema: T.StructType) -> DataFrame:
    """Raw text columns of one extract as the raw table's columns."""
    columns = [f.name for f in schema.fields if f.name != "source_extract"]
    clean = null_tokens(project_columns(df, columns))
    typed = coerce_numeric(clean, doubles=["obs_value"], integers=["unit_mult"])
    return tag_source(typed, name).select(*schema.fieldNames())


def append_extracts(parts: Iterable[DataFrame]) -> DataFrame:
    """All rows of all extracts; overlapping copies stay."""
    return reduce(DataFrame.unionByName, parts)


def raw_schema(dataflow: str) -> T.StructType:
    return RAW_LF if dataflow == LABOUR_FORCE else RAW_ACCOUNT


def required_columns(dataflow: str) -> list[str]:
    return LF_REQUIRED if dataflow == LABOUR_FORCE else ACCOUNT_REQUIRED


def read_extract(
    spark: SparkSession, directory: str, extract: Extract, multi_line: bool = False
) -> DataFrame:
    """``<directory>/<name>.csv``, a file or a folder of part files, as raw rows.

    Columns are taken by name from each file, whatever their order; a wanted one that a file lacks is an error.
    """
    path = f"{directory}/{extract.name}.csv"
    try:
        parts = csv_parts(spark, path, multi_line)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise MissingExtract(f"{path} not found") from error
    schema = raw_schema(extract.dataflow)
    return append_extracts(typed_extract(part, extract.name, schema) for part in parts)


def read_observations(
    spark: SparkSession,
    directory: str,
    dataflow: str,
    extracts: Iterable[Extract] = EXTRACTS,
    multi_line: bool = False,
) -> DataFrame:
    """All extracts of one dataflow, appended."""
    wanted = [e for e in extracts if e.dataflow == dataflow]
    return append_extracts(read_extract(spark, directory, e, multi_line) for e in wanted)


def select_series(df: DataFrame, dimensions: list[str], key: str) -> DataFrame:
    """Rows of the series a key names: ``.`` between dimensions, ``+`` for or, empty for any."""
    members = key.split(".")
    if len(members) != len(dimensions):
        raise ValueError(f"key {key!r} has {len(members)} positions, expected {len(dimensions)}")
    for name, wanted in zip(dimensions, members):
        if wanted:
            df = df.filter(F.col(name).isin(wanted.split("+")))
    return df


def members_found(df: DataFrame, columns: Iterable[str], by: str | None = None) -> DataFrame:
    """Distinct non-null members of each column, one row per (column, member).

    One scan for all columns; repeated members are collapsed before the shuffle.
    """
    pairs = [
        F.when(
            F.col(c).isNotNull(),
            F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("member")),
        )
        for c in columns
    ]
    keys = [by] if by else []
    exploded = df.select(*keys, F.explode(F.array_compact(F.array(*pairs))).alias("found"))
    return exploded.select(*keys, "found.dimension", "found.member").distinct()


def _expected(expect: dict[str, int]) -> Column:
    """The expected member count of a row's ``dimension``."""
    branches = [F.when(F.col("dimension") == c, F.lit(n)) for c, n in expect.items()]
    return F.coalesce(*branches).cast("long")


def check_member_counts(df: DataFrame, expect: dict[str, int]) -> DataFrame:
    """For each column: members expected, members found and whether they agree.

    A column without any member has a row too, with zero found.
    """
    counts = [F.count_distinct(F.col(c)).alias(c) for c in expect]
    found = df.agg(*counts).unpivot([], list(expect), "dimension", "actual")
    return found.select(
        "dimension",
        _expected(expect).alias("expected"),
        "actual",
        (F.col("actual") == _expected(expect)).cast("int").alias("is_complete"),
    )


def slice_from_year(df: DataFrame, year: int, period: str = "time_period") -> DataFrame:
    """Monthly rows whose period is in ``year`` or later; annual rows are kept whole."""
    monthly = F.col(period).contains("-")
    return df.filter(~monthly | (F.substring(F.col(period), 1, 4).cast("int") >= year))


#: Members that a failure names of each dimension; how many there are is counted in full.
NAMED_MEMBERS = 40


def ingest_report(
    df: DataFrame,
    extracts: Iterable[Extract] = EXTRACTS,
    codes: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Per extract: rows landed, status ok, failed (no rows) or incomplete, and what is missing.

    An incomplete dimension names the members it has. ``codes`` gives the members a dimension should
    have, as a code list whose first column is the code; those that are missing are named as well.
    One pass over the appended rows, grouped by extract; hot extracts are combined map-side, and
    members are distinct before they are listed.
    """
    extracts = list(extracts)
    spark = df.sparkSession
    dimensions = sorted({c for e in extracts for c, _ in e.expect})
    landed = df.groupBy("source_extract").agg(F.count(F.lit(1)).alias("rows_landed"))
    if dimensions:
        order = Window.partitionBy("source_extract", "dimension").orderBy("member")
        named = F.when(F.row_number().over(order) <= NAMED_MEMBERS, F.col("member"))
        found = members_found(df, dimensions, by="source_extract").withColumn("named", named)
        members = (
            found.groupBy("source_extract")
            .pivot("dimension", dimensions)
            .agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("named")).alias("members"))
        )
        landed = landed.join(members, "source_extract", "left")
    asked = spark.createDataFrame(
        [(e.name, *(dict(e.expect).get(c) for c in dimensions)) for e in extracts],
        ", ".join(["source_extract string", *(f"expected_{c} long" for c in dimensions)]),
    )
    report = asked.join(landed, "source_extract", "left")
    rows = F.coalesce(F.col("rows_landed"), F.lit(0))
    gaps = []
    for c in dimensions:
        expected, found = F.col(f"expected_{c}"), F.coalesce(F.col(f"{c}_n"), F.lit(0))
        have = F.coalesce(F.col(f"{c}_members"), F.array().cast("array<string>"))
        more = F.when(found > NAMED_MEMBERS, ", ...").otherwise("")
        text = [F.lit("expected "), expected, F.lit(f" distinct {c}, got "), found, F.lit(": "), F.array_join(have, ", "), more]
        if codes and c in codes:
            listed = codes[c].select(F.col(codes[c].columns[0]).cast("string").alias("code"))
            wanted = listed.agg(F.array_sort(F.collect_set("code"))).scalar()
            missing = F.array_join(F.array_except(wanted, have), ", ")
            # With more members than are named, what is missing from the names may be there.
            known = (F.size(wanted) == expected) & (found <= NAMED_MEMBERS) & (missing != "")
            text.append(F.when(known, F.concat(F.lit("; missing "), missing)).otherwise(""))
        gaps.append(F.when((rows > 0) & (expected != found), F.concat(*text)))
    detail = F.nullif(F.concat_ws("; ", *gaps), F.lit("")) if gaps else F.lit(None).cast("string")
    status = F.when(rows == 0, "failed").when(detail.isNotNull(), "incomplete").otherwise("ok")
    return report.select(
        "source_extract", rows.alias("rows_landed"), status.alias("status"), detail.alias("detail")
    )


def raise_on_problems(report: DataFrame) -> None:
    """Fail the run, after everything has been saved, if any extract is not ok."""
    bad = report.filter(F.col("status") != "ok").orderBy("source_extract").collect()
    if bad:
        raise RuntimeError(
            "; ".join(
                f"{r.source_extract}: {r.status}" + (f" ({r.detail})" if r.detail else "") for r in bad
            )
        )
