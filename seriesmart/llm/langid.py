"""Language identification by a byte convolutional network.

A text's UTF-8 bytes are cut into windows of fixed length. Bytes are embedded, filters of several widths
slide over a window, the maximum of each filter over positions goes through a softmax, and the
windows' probabilities are averaged with their numbers of bytes. The network is trained in
numpy on a bounded sample of labelled texts and applied to batches of windows of whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmart.llm.common import add_columns, map_arrow, texts_of

UNDETERMINED = "und"
WINDOW = 192
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDED = 8
#: The sample: texts of each language with the least hashes of their id, and windows of each text.
TRAIN_DOCS = 1000
TRAIN_WINDOWS = 2
EPOCHS = 4
BATCH = 128
CHUNK = 256
SEED = 5


@dataclass
class Model:
    langs: list[str]
    embedding: np.ndarray  # 256 x EMBEDDED
    filters: np.ndarray  # widest * EMBEDDED x all filters; rows beyond a filter's width are 0
    bias: np.ndarray
    out: np.ndarray  # all filters x languages
    out_bias: np.ndarray


def _windows(data: bytes) -> np.ndarray:
    """Consecutive windows of a text, the last padded with zero bytes; one at least."""
    n = max(1, -(-len(data) // WINDOW))
    flat = np.zeros(n * WINDOW, np.uint8)
    flat[: len(data)] = np.frombuffer(data, np.uint8)
    return flat.reshape(n, WINDOW)


def _columns(model: Model, windows: np.ndarray) -> np.ndarray:
    """What each position of the filters sees: (windows * WINDOW) x (widest * EMBEDDED)."""
    widest = max(WIDTHS)
    padded = np.pad(windows, ((0, 0), (0, widest - 1)))
    embedded = model.embedding[padded]
    seen = np.lib.stride_tricks.sliding_window_view(embedded, widest, axis=1)
    return np.ascontiguousarray(seen.transpose(0, 1, 3, 2)).reshape(len(windows) * WINDOW, -1)


def _pool(model: Model, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    columns = _columns(model, windows)
    at = (columns @ model.filters).reshape(len(windows), WINDOW, -1)
    return columns, at, np.maximum(at.max(1) + model.bias, 0)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def probabilities(model: Model, windows: np.ndarray) -> np.ndarray:
    parts = [
        _softmax(_pool(model, windows[a : a + CHUNK])[2] @ model.out + model.out_bias)
        for a in range(0, len(windows), CHUNK)
    ]
    return np.concatenate(parts)


def fit(windows: np.ndarray, kinds: np.ndarray, langs: list[str]) -> Model:
    """Adam on the mean cross entropy, with fixed seeds: the same windows give the same model."""
    rng = np.random.default_rng(SEED)
    widest, count = max(WIDTHS), len(WIDTHS) * FILTERS
    mask = np.zeros((widest, EMBEDDED, count), np.float32)
    for k, width in enumerate(WIDTHS):
        mask[:width, :, k * FILTERS : (k + 1) * FILTERS] = 1
    mask = mask.reshape(widest * EMBEDDED, count)
    model = Model(
        langs,
        rng.normal(0, 0.5, (256, EMBEDDED)).astype(np.float32),
        (rng.normal(0, 0.2, mask.shape) * mask).astype(np.float32),
        np.zeros(count, np.float32),
        rng.normal(0, 0.2, (count, len(langs))).astype(np.float32),
        np.zeros(len(langs), np.float32),
    )
    values = [model.embedding, model.filters, model.bias, model.out, model.out_bias]
    moments = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for a in range(0, len(order), BATCH):
            part = order[a : a + BATCH]
            own = windows[part]
            columns, at, pooled = _pool(model, own)
            p = _softmax(pooled @ model.out + model.out_bias)
            p[np.arange(len(part)), kinds[part]] -= 1
            p /= len(part)
            to_pool = (p @ model.out.T) * (pooled > 0)
            best = at.argmax(1) + np.arange(len(part))[:, None] * WINDOW
            seen = columns[best]  # batch x filters x columns
            to_filters = np.einsum("bfc,bf->cf", seen, to_pool) * mask
            to_seen = to_pool[:, :, None] * model.filters.T[None]
            to_embedding = np.zeros_like(model.embedding)
            padded = np.pad(own, ((0, 0), (0, widest - 1)))
            at_row, at_col = best // WINDOW, best % WINDOW
            for k in range(widest):
                bytes_seen = padded[at_row, at_col + k]
                np.add.at(to_embedding, bytes_seen, to_seen[:, :, k * EMBEDDED : (k + 1) * EMBEDDED])
            step += 1
            gradients = [to_embedding, to_filters, to_pool.sum(0), pooled.T @ p, p.sum(0)]
            for value, gradient, (m, s) in zip(values, gradients, moments, strict=True):
                m += 0.1 * (gradient - m)
                s += 0.001 * (gradient * gradient - s)
                value -= (
                    0.01 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
                ).astype(np.float32)
    return model


def train(
    spark: SparkSession,
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_lang: int = TRAIN_DOCS,
) -> Model | None:
    """A model of the languages of `docs`; None if no row has an id, a text and a language.

    At most `per_lang` texts of each language are learned from, those with the least hashes of their
    id, and `TRAIN_WINDOWS` windows spread evenly over each whole text.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    turn = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    drawn = rows.select("doc_id", "lang").withColumn("turn", F.row_number().over(turn))
    drawn = drawn.filter(F.col("turn") <= per_lang).select("doc_id").distinct()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, found = [], []
            for i, t, name in zip(*[batch.column(c).to_pylist() for c in range(3)], strict=True):
                whole = _windows(t.encode())
                for k in np.unique(np.linspace(0, len(whole) - 1, TRAIN_WINDOWS).astype(int)):
                    names.append((i, name))
                    found.append(whole[k].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([n[0] for n in names], pa.int64()), pa.array([n[1] for n in names], pa.string()),
                 pa.array(found, pa.binary())],
                names=["doc_id", "lang", "bytes"],
            )

    sample = rows.join(F.broadcast(drawn), "doc_id").select(F.col("doc_id").cast("long"), "text", "lang")
    schema = "doc_id long, lang string, bytes binary"
    found = sorted((r.lang, r.doc_id, bytes(r.bytes)) for r in map_arrow(sample, cut, schema).collect())
    if not found:
        return None
    langs = sorted({f[0] for f in found})
    kinds = np.array([langs.index(f[0]) for f in found])
    windows = np.frombuffer(b"".join(f[2] for f in found), np.uint8).reshape(len(found), WINDOW)
    return fit(windows, kinds, langs)


def predict(
    spark: SparkSession,
    docs: DataFrame,
    model: Model | None,
    text: str = "text",
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """`docs` with `lang_pred string` and `score double` (0 to 1, the mean probability of that language).

    All windows of a text count. A text that is null or has no letter is `und` with score 0, and so is
    every text if there is no model. `names` are those of the two columns; columns that have them are replaced.
    """
    shared = spark.sparkContext.broadcast(model)

    def start():
        own = shared.value

        def make(part: pa.RecordBatch) -> list[pa.Array]:
            texts = texts_of(part, text)
            langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            known = [i for i, t in enumerate(texts) if own and any(map(str.isalpha, t))]
            if known:
                data = [texts[i].encode() for i in known]
                cut = [_windows(b) for b in data]
                counts = np.array([len(w) for w in cut])
                weight = np.full(counts.sum(), float(WINDOW))
                ends = np.cumsum(counts)
                weight[ends - 1] = [len(b) - (n - 1) * WINDOW for b, n in zip(data, counts, strict=True)]
                p = probabilities(own, np.concatenate(cut)) * weight[:, None]
                mean = np.add.reduceat(p, ends - counts, axis=0)
                mean /= np.add.reduceat(weight, ends - counts)[:, None]
                for i, row in zip(known, mean, strict=True):
                    k = int(row.argmax())
                    langs[i], scores[i] = own.langs[k], min(1.0, float(row[k]))
            return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]

        return make

    fields = [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]
    return add_columns(docs, text, fields, start, 2 << 20)
