"""Token ids of documents in binary files of fixed-width bit packing, written and read by Spark tasks.

A file holds documents in ascending order of their id, in blocks:

    magic  8 bytes  "IDPACK02"
    block  payload of every id in `bits` bits, most significant first, padded to a byte, at `offset`
    footer int64 arrays: document ids, their numbers of ids, block offsets, block id counts
    tail   int64 x 5: bits, documents, documents without an id (they stand first), blocks, footer offset

`bits` is the least width that holds the vocabulary, so that id `i` of a block lies at bit `i * bits`
and any range of ids is read with one seek and unpacked by numpy. A file is written under a name of
its own attempt and then moved to its final name, so a repeated task leaves whole files only.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from seriesmart.llm.common import map_arrow, new_path, partitions, slices, stored, texts_of
from seriesmart.llm.library_ids import unit_cache, vocabulary_size

MAGIC = b"IDPACK02"
#: Ids in a block, unless one document has more.
BLOCK_IDS = 1 << 18


def width(vocabulary: int) -> int:
    """Least number of bits that holds ids 0 to vocabulary - 1."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """`bits` bits of each id, most significant first."""
    if len(ids) and (int(ids.max()) >> bits or int(ids.min()) < 0):
        raise ValueError(f"an id does not fit {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f">u{bits // 8}").tobytes()
    rows = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(rows[:, 32 - bits :]).tobytes()


def unpack(data: bytes, bits: int, count: int, first: int = 0) -> np.ndarray:
    """`count` ids from id `first` of a payload, as unsigned 32-bit integers."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f">u{bits // 8}", count, first * bits // 8).astype(np.uint32)
    start = first * bits
    flat = np.unpackbits(np.frombuffer(data, np.uint8)[start // 8 : (start + count * bits + 7) // 8])
    rows = flat[start % 8 : start % 8 + count * bits].reshape(count, bits)
    whole = np.zeros((count, 32), np.uint8)
    whole[:, 32 - bits :] = rows
    return np.packbits(whole, axis=1).view(">u4").ravel().astype(np.uint32)


class Writer:
    """One file: documents are added in order, blocks go out as they fill."""

    def __init__(self, out, bits: int):
        self.out, self.bits = out, bits
        self.docs: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.blocks: list[tuple[int, int]] = []
        self.waiting: list[np.ndarray] = []
        self.held = self.nulls = 0
        self.at = out.write(MAGIC)

    def add(self, docs: pa.Array, counts: np.ndarray, ids: np.ndarray) -> None:
        """Documents without an id come before all others."""
        self.nulls += docs.null_count
        self.docs.append(docs.fill_null(0).to_numpy())
        self.counts.append(counts)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK_IDS:
            self._block()

    def _block(self) -> None:
        if self.held:
            ids = np.concatenate(self.waiting)
            for a in range(0, len(ids), BLOCK_IDS):
                part = ids[a : a + BLOCK_IDS]
                self.blocks.append((self.at, len(part)))
                self.at += self.out.write(pack(part, self.bits))
        self.waiting, self.held = [], 0

    def close(self) -> None:
        self._block()
        docs, counts = np.concatenate(self.docs), np.concatenate(self.counts)
        offsets, sizes = np.array(self.blocks, "<i8").reshape(-1, 2).T
        for part in (docs, counts, offsets, sizes):
            self.out.write(np.ascontiguousarray(part, "<i8").tobytes())
        self.out.write(np.array([self.bits, len(docs), self.nulls, len(offsets), self.at], "<i8").tobytes())


class Reader:
    """Random access to one file."""

    def __init__(self, source, size: int):
        self.source = source
        source.seek(0)
        if source.read(len(MAGIC)) != MAGIC:
            raise ValueError("not a file of packed ids")
        source.seek(size - 40)
        self.bits, docs, self.nulls, blocks, at = np.frombuffer(source.read(40), "<i8").tolist()
        source.seek(at)
        footer = np.frombuffer(source.read((docs + blocks) * 16), "<i8")
        self.docs, self.counts = footer[:docs], footer[docs : 2 * docs]
        self.offsets, self.sizes = footer[2 * docs : 2 * docs + blocks], footer[2 * docs + blocks :]
        self.block_ends = np.cumsum(self.sizes)

    def doc_ids(self, first: int, end: int) -> pa.Array:
        return pa.array(self.docs[first:end], mask=np.arange(first, end) < self.nulls)

    def ids(self, first: int, count: int) -> np.ndarray:
        """Ids `first` to `first + count` of the file, from the blocks that hold them."""
        out, end = [], first + count
        block = int(np.searchsorted(self.block_ends, first, "right"))
        while first < end:
            base = int(self.block_ends[block] - self.sizes[block])
            upto = min(end, int(self.block_ends[block]))
            low, high = (first - base) * self.bits, (upto - base) * self.bits
            self.source.seek(int(self.offsets[block]) + low // 8)
            data = self.source.read((high + 7) // 8 - low // 8)
            skipped = low // 8 * 8
            if low == skipped:
                out.append(unpack(data, self.bits, upto - first))
            else:  # starts within a byte: shift by whole bits
                flat = np.unpackbits(np.frombuffer(data, np.uint8))[low - skipped :]
                out.append(unpack(np.packbits(flat).tobytes(), self.bits, upto - first))
            first, block = upto, block + 1
        return np.concatenate(out) if out else np.zeros(0, np.uint32)


# --- Spark ---------------------------------------------------------------------------------------

FILES = "file string, place int, first_doc long, n_docs long, n_ids long"


def write_ids(
    spark: SparkSession,
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    end_id: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Ids of all texts in files under `folder`, and the files as (file, place, first_doc, n_docs, n_ids, start).

    Documents are range-partitioned by id and a hash of the text, so that one id of many rows is split;
    a task writes one file. `start` is the number of ids in all files before. `end_id` follows every
    document. A null text counts as empty and has the end id alone. Rows without an id come first, as
    Spark orders nulls; rows that repeat an id stand beside each other, in order of that hash. An
    empty table gives no file. Columns other than the two named are not read.
    """
    shape = to_arrow_schema(T._parse_datatype_string(FILES))
    bits = width(max(vocabulary_size(tokenizer), end_id + 1))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = [F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit("")))]
    ordered = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        cache, writer, first = unit_cache(tokenizer), None, None
        name = uuid.uuid4().hex
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                ids, counts = cache.encode_texts(texts_of(part, "text"))
                if writer is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(f"{root}/{name}.writing")
                    writer, first = Writer(out, bits), part.column("doc_id")[0].as_py()
                writer.add(part.column("doc_id"), counts + 1, np.insert(ids, np.cumsum(counts), end_id))
        if writer is not None:
            writer.close()
            out.close()
            fs.move(f"{root}/{name}.writing", f"{root}/{name}.ids")
            n = [sum(map(len, writer.docs)), int(sum(c.sum() for c in writer.counts))]
            place = TaskContext.get().partitionId()  # ranges are numbered in their order
            yield pa.RecordBatch.from_pylist([dict(zip(shape.names, (f"{name}.ids", place, first, *n)))], shape)

    files = stored(spark, map_arrow(ordered, run, FILES), "id-files")
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_ids(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """Documents of the files: (doc_id, start, n_tokens, ids array<int>), one task per file or more."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.ArrayType(T.LongType(), False)),
        ]
    )
    return _over_files(spark, files, folder, schema, _id_rows)


def _id_rows(docs, starts, counts, ids):
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int64)))
    return [docs, pa.array(starts), pa.array(counts), listed]


def read_digests(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """As `read_ids` with the unsigned crc32 of each document's ids as little-endian 32-bit integers."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return _over_files(spark, files, folder, schema, _digest_rows)


def _digest_rows(docs, starts, counts, ids):
    import zlib

    data = memoryview(ids.astype("<u4").tobytes())
    ends = np.cumsum(counts) * 4
    digests = [zlib.crc32(data[e - 4 * n : e]) for e, n in zip(ends, counts, strict=True)]
    return [docs, pa.array(starts), pa.array(counts), pa.array(digests, pa.int64())]


def _over_files(spark, files: DataFrame, folder: str, schema, rows_of) -> DataFrame:
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for file, start in zip(*[batch.column(c).to_pylist() for c in ("file", "start")], strict=True):
                path = f"{root}/{file}"
                with fs.open_input_file(path) as source:
                    reader = Reader(source, source.size())
                    ends = np.cumsum(reader.counts)
                    a = 0
                    while a < len(ends):  # runs of documents with a block's worth of ids
                        low = int(ends[a] - reader.counts[a])
                        b = max(a + 1, int(np.searchsorted(ends, low + BLOCK_IDS, "right")))
                        counts = reader.counts[a:b]
                        ids = reader.ids(low, int(ends[b - 1]) - low)
                        starts = start + ends[a:b] - counts
                        yield pa.RecordBatch.from_arrays(
                            rows_of(reader.doc_ids(a, b), starts, counts, ids), names=names
                        )
                        a = b

    listed = files.select("file", "start").repartition(partitions(spark), "file")
    return map_arrow(listed, run, schema)


def id_folder(spark: SparkSession) -> str:
    return new_path(spark, "packed-ids")
