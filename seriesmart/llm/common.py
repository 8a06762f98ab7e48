"""What the operators share: shared-folder tables, Arrow column mapping, words, range buckets."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words are runs of anything but these: space, and tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


# --- Tables in the shared folder -----------------------------------------------------------------


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; in a local session without one, a new temporary folder."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.conf.set("spark.checkpoint.dir", folder := "file://" + tempfile.mkdtemp(prefix="run-"))
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read back: cuts lineage and survives lost executors.

    The files of its shuffles are given up at once, not when the driver happens to collect its garbage.
    """
    df.write.parquet(path := new_path(spark, name))
    spark.sparkContext._jvm.System.gc()
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def unstore(spark: SparkSession, *tables: DataFrame) -> None:
    """Remove stored tables that nothing reads any more: what was made of them is stored itself."""
    for table in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# --- Python per Arrow batch ----------------------------------------------------------------------


def ship(spark: SparkSession) -> None:
    """Give executors this package, once per application, as `--py-files` would.

    Batches are kept small, unless the application says how large: texts are long.
    """
    context = spark.sparkContext
    if getattr(context, "_seriesmart_shipped", False):
        return
    if not context.getConf().contains(BATCH_ROWS):
        spark.conf.set(BATCH_ROWS, "2000")
    package = Path(__file__).resolve().parent.parent
    archive = f"{tempfile.mkdtemp(prefix='run-')}/seriesmart.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(archive)
    context._seriesmart_shipped = True


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: What a worker holds over the tasks of one stage: vocabularies and the ids of known words.
_HELD: dict = {}


def held(key: tuple, make: Callable):
    """`make()`, once for each worker and stage."""
    if key not in _HELD:
        _HELD[key] = make()
    return _HELD[key]


def release() -> None:
    """Give memory that is free back to the system; else a worker keeps the most that it ever needed."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def map_arrow(df: DataFrame, run: Callable, schema: T.StructType | str) -> DataFrame:
    """`mapInArrow` of a function of this package.

    Workers serve one stage after the other. What one holds is dropped when it comes to another stage, and
    free memory is given back after each task.
    """
    ship(df.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stage = TaskContext.get().stageId()
        if _HELD.get("stage") != stage:
            _HELD.clear()
            gc.collect()
            release()
            _HELD["stage"] = stage
        yield from run(batches)
        release()

    return df.mapInArrow(task, schema)


def slices(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most so many bytes of a text column; a longer row stands alone."""
    if not batch.num_rows:
        return
    length = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(length) // most_bytes
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)


def add_columns(
    df: DataFrame,
    text: str,
    fields: list[T.StructField],
    start: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
    most_bytes: int = 4 << 20,
) -> DataFrame:
    """`df` with new columns made from slices of its rows; a column of the same name is replaced.

    `start` runs once per task and returns the function of a slice.
    """
    base = df.drop(*[f.name for f in fields])
    whole = base if text in base.columns else base.withColumn(text, df[text])
    names = [n for n in base.columns]
    schema = T.StructType([*base.schema.fields, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = start()
        for batch in batches:
            for part in slices(batch, text, most_bytes):
                kept = [part.column(n) for n in names]
                yield pa.RecordBatch.from_arrays(
                    [*kept, *make(part)], names=[*names, *[f.name for f in fields]]
                )

    return map_arrow(whole, run, schema)


def texts_of(part: pa.RecordBatch, column: str) -> list[str]:
    return ["" if t is None else t for t in part.column(column).to_pylist()]


def lists(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


# --- Columns -------------------------------------------------------------------------------------


def n_words(text: Column) -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(seed: int, *columns: Column) -> Column:
    """60 random bits of the columns' values, the same in every run and engine."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

