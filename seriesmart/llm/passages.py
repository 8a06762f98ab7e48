"""Substring dedup by compact windows: near-duplicate passages across documents.

Tokens are 5-word shingles. For one hash of the tokens, a compact window (l, c, r) stands for all
subsequences of positions l to r that contain c: their min-hash is that of c. The windows are the nodes
of the Cartesian tree of the hashes that span a passage at least, so a text of n tokens has about
2n / passage of them. Two passages with the same min-hash lie in windows of the same value.

Only positions that are the least of some passage-long run can be such nodes, and the smaller
neighbours that bound a node are such positions too, so the tree is built over them alone; they come
from sliding minima.

Texts are tokenized once, into a stored table that all later steps read. Windows whose value another
document has are joined as stars: each with the first window of its bucket. A bucket has one value and
one run of `SIDE` tokens that ends or starts at the centre, so that a token of a common phrase does not
bring unlike contexts together; a window is in two, and an edit spares one of them unless it has one on
both sides. Large buckets are dealt in parts, whose first windows form a star of their own. Where the
centre of a window is in no passage after that, its document is compared with all earlier ones of the
bucket that can have a similar passage: tasks count common tokens and bound the similarity between any two
ends, by bucket, and in blocks of a large one. Of windows with the same tokens the earliest stands for all.
The intervals of a pair of documents over all hashes are verified together: tokens of one side found on
the other, cut where they are far apart, are a passage if they are long enough and their shingle sets
similar enough.

One common signature is enough to verify, which `HASHES` hashes miss for a share of about (1 -
similarity) ** HASHES of passages. Exact passages do not depend on buckets: each run of passage length that no passage
found so far covers is joined with the least document that has it. A run holds a half as long that ends
or starts at its least token; only runs whose half another document has are hashed as a whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmart.llm.common import add_columns, map_arrow, n_words, slices, stored, unstore
from seriesmart.llm.marks import marked_rows
from seriesmart.llm.shingles import WORDS, Runs, hashes_of_texts, mix, shingles, word_hashes, words_of

#: A passage has so many words at least, and a shingle similarity of PERCENT / 100.
PASSAGE_WORDS = 50
PERCENT = 80
HASHES = 2
#: Tokens on one side of a window's centre that the windows of a bucket share.
SIDE = 12
#: Windows of a bucket that is dealt in parts, and its parts.
LARGE, PARTS = 5_000, 64
SEEDS = np.array([0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179, 0x510E527FADE682D1], np.uint64)
#: Steps between tokens with a counterpart that end a passage; if it is not similar enough as a whole,
#: the next smaller, down to exact runs. An edited word makes a step of WORDS + 1.
GAPS = (2 * WORDS, WORDS, 1)


def _sliding(v: np.ndarray, width: int, pick) -> np.ndarray:
    """`pick` (minimum or maximum) over every run of `width` columns, by doubling."""
    done = 1
    while 2 * done <= width:
        v = pick(v[:, :-done], v[:, done:])
        done *= 2
    rest = width - done
    return pick(v[:, : v.shape[1] - rest], v[:, rest:]) if rest else v


def _nearest(values: np.ndarray, group: np.ndarray, step: int, stops) -> np.ndarray:
    """For each value, the nearest in direction `step` that stops it or is of another group; there may be none.

    Those between do not stop it, nor do those between one that does not and what that has found so far.
    """
    n = len(values)
    to = np.arange(n) + step
    active = np.arange(n)
    values, group = np.append(values, np.uint64(0)), np.append(group, -1)  # also the one before the first
    while len(active):
        at = to[active]
        going = (group[at] == group[active]) & ~stops(values[at], values[active])
        active = active[going]
        to[active] = to[at[going]]
    return to


def compact_windows(
    tokens: np.ndarray, width: int, lengths: np.ndarray | None = None
) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each hash: its number, values, l, c and r of the windows of at least `width` tokens.

    `lengths` are those of the texts that follow each other in `tokens`; else it is one.
    """
    n = len(tokens)
    if n < width:
        return []
    ends = np.cumsum([n] if lengths is None else lengths)
    v = mix(tokens[None, :] ^ SEEDS[:HASHES, None])
    least = _sliding(v, width, np.minimum)
    across = (ends[:-1, None] + np.arange(1 - width, 0)).ravel()
    least[:, across[(across >= 0) & (across <= n - width)]] = 0
    padded = np.pad(least, ((0, 0), (width - 1, width - 1)))
    hashed, at = np.nonzero(_sliding(padded, width, np.maximum) == v)
    values, text = v[hashed, at], np.searchsorted(ends, at, "right")
    group = hashed * len(ends) + text
    starts, beside = ends - np.diff(ends, prepend=0), np.append(at, 0)
    before = _nearest(values, group, -1, np.less_equal)
    after = _nearest(values, group, 1, np.less)
    group = np.append(group, -1)
    l = np.where(group[before] == group[:-1], beside[before] + 1, starts[text])
    r = np.where(group[after] == group[:-1], beside[after], ends[text]) - 1
    kept = r - l + 1 >= width
    return [(k, *(x[kept & (hashed == k)] for x in (values, l, at, r))) for k in range(HASHES)]


#: Bytes of a token that are stored and sent, and tokens between windows that are sent with them.
SENT_BYTES = 5
SENT_GAP = 64


def positions(windows: list[tuple[int, int]]) -> np.ndarray:
    """Positions in windows (first, last), and in short gaps between them."""
    spans: list[list[int]] = []
    for a, b in sorted(windows):
        if spans and a <= spans[-1][1] + SENT_GAP:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b])
    return np.concatenate([np.arange(a, b + 1) for a, b in spans])


def sent(tokens: np.ndarray) -> bytes:
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SENT_BYTES].tobytes()


def received(data: bytes) -> np.ndarray:
    rows = np.zeros((len(data) // SENT_BYTES, 8), np.uint8)
    rows[:, :SENT_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, SENT_BYTES)
    return rows.view("<u8").ravel()


def _before(tokens: np.ndarray) -> np.ndarray:
    """For each token, the place of the same token before it; -1 without."""
    order = np.argsort(tokens, kind="stable")
    again = np.flatnonzero(tokens[order[1:]] == tokens[order[:-1]])
    before = np.full(len(tokens), -1)
    before[order[again + 1]] = order[again]
    return before


def common_passages(
    a: np.ndarray,
    at_b: np.ndarray,
    b: np.ndarray,
    windows: list[tuple[int, int]],
    width: int,
    percent: int,
    before_a: np.ndarray | None = None,
) -> list[tuple[int, int, int, int, float]]:
    """Token ranges (start, end, other start, other end, similarity) of a that b has as well.

    `b` are the tokens at the positions `at_b` of the other document, `windows` those of a that share
    a signature with it. `before_a` is `_before(a)`, for more than one call.
    """
    if not len(b):
        return []
    in_a, beside = np.zeros(len(a), bool), np.zeros(len(a), bool)
    for l, r in windows:
        in_a[l : r + 1] = True
        # A passage goes on from one window to another over such a gap.
        beside[l : r + 1 + GAPS[0]] = True
    sorted_b = np.argsort(b, kind="stable")
    values = b[sorted_b]
    at = beside.nonzero()[0]
    low = values.searchsorted(a[at])
    low[low == len(values)] = 0
    same = values[low] == a[at]
    hits, low = at[same], low[same]
    shared = _Shared(a, _before(a) if before_a is None else before_a, at_b, sorted_b, values, hits, low)
    found = []
    waiting = [(in_a[hits].nonzero()[0], 0)]
    while waiting:
        whole, level = waiting.pop()
        if not len(whole):
            continue
        places = hits[whole]
        cuts = (places[1:] - places[:-1] > GAPS[level]).nonzero()[0] + 1
        first, last = np.append(0, cuts), np.append(cuts, len(whole))
        long = places[last - 1] - places[first] + 1 >= width
        for f, e in zip(first[long].tolist(), last[long].tolist(), strict=True):
            part = whole[f:e]
            passage, rest = shared.aligned(part, width, percent)
            if passage:
                found.append(passage)
                # Tokens that lie elsewhere in b may be further passages.
                waiting.append((part[(places[f:e] < passage[0]) | (places[f:e] >= passage[1])], level))
            elif level + 1 < len(GAPS):
                waiting.append((part, level + 1))
            else:
                waiting.append((rest, level))
    return found


class _Shared:
    """Tokens at `hits` of a that b has too, the first of each at `low` of b's sorted `values`."""

    def __init__(self, a, before_a, at_b, sorted_b, values, hits, low):
        self.before_a, self.at_b, self.hits = before_a, at_b, hits
        new = np.append(True, values[1:] != values[:-1])
        number = new.cumsum() - 1
        starts = np.append(new.nonzero()[0], len(values))
        self.low, self.number = low, number[low]
        self.sizes = starts[self.number + 1] - low
        # Places of tokens in b, token by token.
        self.places = at_b[sorted_b]
        self.span = int(at_b[-1]) + 1
        self.keys = number * self.span + self.places
        again = (~new).nonzero()[0]
        self.before_b = np.full(len(values), -1)
        self.before_b[sorted_b[again]] = sorted_b[again - 1]

    def aligned(
        self, part: np.ndarray, width: int, percent: int
    ) -> tuple[tuple[int, int, int, int, float] | None, np.ndarray]:
        """The passage of some hits, if b has one like it, and the hits far from its line."""
        at, low, sizes = self.hits[part], self.low[part], self.sizes[part]
        # A token's counterpart is the occurrence nearest to the line through a token that b has once.
        single = (sizes == 1).nonzero()[0]
        middle = int(single[len(single) // 2]) if len(single) else 0
        other = self.places[low]
        shift = int(other[middle]) - int(at[middle])
        if len(single) < len(part):
            several = (sizes > 1).nonzero()[0]
            line, least = at[several] + shift, low[several]
            most = least + sizes[several] - 1
            wanted = self.number[part[several]] * self.span + line.clip(0, self.span - 1)
            after = self.keys.searchsorted(wanted)
            after, before = np.minimum(after, most), np.maximum(after - 1, least)
            after, before = self.places[after], self.places[before]
            other[several] = np.where(np.abs(before - line) <= np.abs(after - line), before, after)
        near = np.abs(other - at - shift) <= (at[-1] - at[0] + 1) // 4 + GAPS[0]
        rest = part[~near]
        if len(rest):
            part, at, other = part[near], at[near], other[near]
        if at[-1] - at[0] + 1 < width:
            return None, rest
        start, end, first, last = int(at[0]), int(at[-1]), int(other.min()), int(other.max())
        one = np.count_nonzero(self.before_a[start : end + 1] < start)
        p, q = self.at_b.searchsorted((first, last + 1)).tolist()
        two = np.count_nonzero(self.before_b[p:q] < p)
        # Hits from start to end, the first of each token there.
        f, e = self.hits.searchsorted((start, end + 1)).tolist()
        number = self.number[f:e][self.before_a[self.hits[f:e]] < start] * self.span
        at = self.keys.searchsorted(number + first)
        at[at == len(self.keys)] = 0
        found = self.keys[at]
        both = np.count_nonzero((found >= number + first) & (found <= number + last))
        union = one + two - both
        alike = 100 * both >= percent * union
        return (start, end + 1, first, last + 1, both / union) if alike else None, rest


def runs_of(l, c, r, width: int):
    """First and last run of `width` tokens that has the centre of a window as its least token."""
    return np.maximum(l, c - width + 1), np.minimum(c, r - width + 1)


def half_keys(hashed: Runs, l, c, r, wanted: np.ndarray, width: int) -> tuple[pa.Array, pa.Array]:
    """Hashes of the halves of runs that end and that start at the centres of windows; null where no run has it.

    A run's least token is the centre of the one window that holds it. Its half ends there if the run
    starts `width // 2` tokens or more before, else it starts there.
    """
    half = width // 2 + 1
    first, last = runs_of(l, c, r, width)
    keys = []
    for has, start, kind in ((first <= c - half + 1, c - half + 1, 1), (last > c - half + 1, c, 0)):
        kept = has & wanted
        key = np.zeros(len(c), np.int64)
        key[kept] = mix(hashed.at(start[kept], half) + np.uint64(kind)).view(np.int64)
        keys.append(pa.array(key, mask=~kept))
    return keys[0], keys[1]


# --- Spark ---------------------------------------------------------------------------------------


def _tokens(text: str | None) -> np.ndarray:
    """Shingles of a text, as many bytes of each as are stored and sent."""
    words = words_of(text)
    whole = shingles(word_hashes(words)) if len(words) >= WORDS else np.zeros(0, np.uint64)
    return whole & np.uint64((1 << 8 * SENT_BYTES) - 1)


def _portions(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


#: Bytes of texts and of tokens that are worked on at once.
TEXT_BYTES, TOKEN_BYTES = 4 << 20, 1 << 20


def _column_of(tokens: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Tokens of texts that follow each other, as bytes of each text."""
    offsets = np.append(0, np.cumsum(lengths * SENT_BYTES)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(sent(tokens))])


def _tokens_in(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all texts, one after the other, and the number of each text's."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = received(data[int(offsets[0]) : int(offsets[-1])]) if data and len(column) else np.zeros(0, np.uint64)
    return whole, np.diff(offsets.astype(np.int64)) // SENT_BYTES


def _tokenize(width: int):
    """Rows with `width` tokens at least, their number of words and those tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                words, counts = hashes_of_texts(part.column("text"))
                kept = counts >= width + WORDS - 1
                words, counts = words[np.repeat(kept, counts)], counts[kept]
                if not len(counts):
                    continue
                within = np.ones(len(words), bool)
                within[(np.cumsum(counts)[:, None] - np.arange(1, WORDS)).ravel()] = False
                tokens = shingles(words)[within[: 1 - WORDS]] & np.uint64((1 << 8 * SENT_BYTES) - 1)
                columns = [part.column(n).filter(pa.array(kept)) for n in ("doc", "cls")]
                columns += [pa.array(counts), _column_of(tokens, counts - WORDS + 1)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "cls", "n", "tokens"])

    return run


def _packed(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return high.astype(np.int64) << 32 | low.astype(np.int64)


#: `span` is l << 32 | r, `ends` and `starts` the buckets of the tokens left and right of the centre, null without
#: room, `at` is c << 1 | number of the hash. Windows of the first hash have the halves of runs that end (`early`) or
#: start (`late`) at their centre. `key` is the value for the first window that a task has of it, else of this window
#: alone; then, and if the first is followed by others, the value is `known` to be in several.
_WINDOWS = (
    "key long, doc long, cls long, span long, ends long, starts long, at long, early long, late long, known boolean"
)


def _windows(width: int):
    names = [f.split()[0] for f in _WINDOWS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = 0
        for batch in _portions(batches, 4000):
            parts: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(6)]
            texts, start, above = [np.zeros(0, np.uint64)], 0, 0
            for part in slices(batch, "tokens", TOKEN_BYTES):
                tokens, lengths = _tokens_in(part.column("tokens"))
                ends = np.cumsum(lengths)
                for k, values, l, c, r in compact_windows(tokens, width, lengths):
                    row = np.searchsorted(ends, c, "right") + above
                    for held, x in zip(parts, (values, row, np.full(len(c), k), l + start, c + start, r + start), strict=True):
                        held.append(x.view(np.int64))
                texts.append(tokens)
                start, above = start + len(tokens), above + len(lengths)
            value, row, k, l, c, r = map(np.concatenate, parts)
            tokens = np.concatenate(texts)
            hashed = Runs(tokens)
            # The number of the hash is part of the value that windows are joined by.
            value = mix(value.view(np.uint64) + k.view(np.uint64)).view(np.int64)
            order = np.argsort(value, kind="stable")
            value, row, k, l, c, r = (x[order] for x in (value, row, k, l, c, r))
            new = np.diff(value, prepend=value[:1] + 1) != 0
            turn = np.arange(turns + 1, turns + len(value) + 1)
            turns += len(value)
            key = np.where(new, value, mix(value.view(np.uint64) + turn.view(np.uint64)).view(np.int64))
            known = ~new | ~np.append(new[1:], True)[: len(new)]
            sides = []
            for kind, room, at in ((0, c - l, c - SIDE + 1), (1, r - c, c)):
                has = room >= SIDE - 1
                side = np.zeros(len(c), np.uint64)
                side[has] = mix(value[has].view(np.uint64) + hashed.at(at[has], SIDE) + np.uint64(kind))
                sides.append(pa.array(side.view(np.int64), mask=~has))
            early, late = half_keys(hashed, l, c, r, k == 0, width)
            lengths = pc.binary_length(batch.column("tokens")).to_numpy() // SENT_BYTES
            first = (np.cumsum(lengths) - lengths)[row]
            doc, cls = (batch.column(n).to_numpy()[row] for n in ("doc", "cls"))
            made = (key, doc, cls, _packed(l - first, r - first), *sides, (c - first) << 1 | k, early, late, known)
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in made], names=names)

    return run


_FOUND = (
    "doc_id long, cls long, first_doc_id long, word_start long, word_end long, first_start long, "
    "first_end long, similarity double"
)


def _spans(packed: list[int]) -> list[tuple[int, int]]:
    return [(x >> 32, x & 0xFFFFFFFF) for x in packed]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of the other document in its windows."""
    for batch in _portions(batches):
        data = []
        for theirs, tokens in zip(batch.column("theirs").to_pylist(), batch.column("tokens"), strict=True):
            whole = np.frombuffer(tokens.as_buffer(), np.uint8).reshape(-1, SENT_BYTES)
            data.append(whole[positions(_spans(theirs))].tobytes())
        names = ["doc", "cls", "other", "own", "theirs"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in names], pa.array(data, pa.binary())], names=[*names, "sent"]
        )


def _verify(width: int, percent: int):
    names = [f.split()[0] for f in _FOUND.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches):
            rows = []
            columns = [batch.column(c).to_pylist() for c in ("doc", "cls", "other", "own", "theirs", "sent")]
            last, tokens, before = None, None, None
            for k, (doc, cls, other, own, theirs, data) in enumerate(zip(*columns, strict=True)):
                if (doc, cls) != last:  # the pairs of a document stand beside each other
                    last, tokens = (doc, cls), received(batch.column("tokens")[k].as_buffer())
                    before = _before(tokens)
                at = positions(_spans(theirs))
                for s, e, p, q, near in common_passages(tokens, at, received(data), _spans(own), width, percent, before):
                    # Tokens s to e - 1 are words s to e + 3.
                    rows.append((doc, cls, other, s, e + WORDS - 1, p, q + WORDS - 1, near))
            found = list(zip(*rows, strict=True)) or [()] * len(names)
            kinds = [pa.int64()] * 7 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(found, kinds, strict=True)], names=names
            )

    return run


def _verified(spark: SparkSession, tokens: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """Passages of pairs (doc, cls, other, other_cls) of documents, in their windows `own` and `theirs`."""
    tokens = tokens.select("doc", "cls", "tokens")
    first = marked_rows(tokens, pairs.select("other")).withColumnsRenamed({"doc": "other", "cls": "other_cls"})
    asked = pairs.join(first, ["other", "other_cls"]).select("doc", "cls", "other", "own", "theirs", "tokens")
    schema = T.StructType([*asked.schema.fields[:5], T.StructField("sent", T.BinaryType())])
    answers = map_arrow(asked, _slices, schema)
    both = answers.join(marked_rows(tokens, pairs.select("doc")), ["doc", "cls"])
    both = both.select("doc", "cls", "other", "own", "theirs", "sent", "tokens")
    found = stored(spark, map_arrow(both, _verify(width, percent), _FOUND), "passages")
    unstore(spark, pairs)
    return found


def _runs(width: int):
    """Hashes and places of the runs (first to last) of a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches, 100):
            tokens, lengths = _tokens_in(batch.column("tokens"))
            places = [np.concatenate([np.arange(a, b + 1) for a, b in _spans(r)]) for r in batch.column("runs").to_pylist()]
            counts = [len(p) for p in places]
            at = np.concatenate([np.zeros(0, np.int64), *places])
            values = Runs(tokens).at(at + np.repeat(np.cumsum(lengths) - lengths, counts), width).view(np.int64)
            whose = [np.repeat(batch.column(n).to_numpy(), counts) for n in ("doc", "cls")]
            columns = zip((values, *whose, at), [pa.int64()] * 3 + [pa.int32()], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=["run", "doc", "cls", "at"])

    return run


def _exact(spark: SparkSession, tokens: DataFrame, halves: DataFrame, spans: DataFrame, width: int) -> DataFrame:
    """Longest exact passages, in the form of `_FOUND`, of runs of `width` tokens that an earlier document has.

    `halves` are those of runs that other documents have. Runs that lie in `spans` (s_doc, s_cls, s, e:
    words) are passages already.
    """
    covered = (
        (F.col("doc") == F.col("s_doc"))
        & (F.col("cls") == F.col("s_cls"))
        & (F.col("first") >= F.col("s"))
        & (F.col("last") + width + WORDS - 1 <= F.col("e"))
    )
    open_halves = stored(spark, halves.join(spans, covered, "left_anti").select("half").distinct(), "open-halves")
    asked = halves.join(open_halves, "half", "left_semi").groupBy("doc", "cls")
    runs = F.collect_set(F.shiftleft("first", 32).bitwiseOR(F.col("last"))).alias("runs")
    asked = stored(spark, asked.agg(runs), "asked-runs")
    whole = asked.join(marked_rows(tokens, asked.select("doc")), ["doc", "cls"]).select("doc", "cls", "runs", "tokens")
    runs = stored(spark, map_arrow(whole, _runs(width), "run long, doc long, cls long, at int"), "runs")
    unstore(spark, open_halves, asked)
    least = F.min(F.struct("doc", "cls", "at")).over(Window.partitionBy("run"))
    hits = runs.withColumn("o", least).filter("o.doc < doc AND o.cls <> cls").select(
        "doc", "cls", F.col("o.doc").alias("other"), F.col("o.cls").alias("other_cls"), "at",
        (F.col("o.at") - F.col("at")).alias("shift"),
    )
    # Runs that follow each other in both documents are one passage; a repeated row has its runs twice.
    by = ["doc", "cls", "other", "other_cls", "shift"]
    turn = F.dense_rank().over(Window.partitionBy(*by).orderBy("at"))
    joined = hits.withColumn("part", F.col("at") - turn).groupBy(*by, "part").agg(
        F.min("at").cast("long").alias("s"), (F.max("at") + width + WORDS - 1).cast("long").alias("e")
    )
    found = joined.select(
        F.col("doc").alias("doc_id"), "cls", F.col("other").alias("first_doc_id"), F.col("s").alias("word_start"),
        F.col("e").alias("word_end"), (F.col("s") + F.col("shift")).alias("first_start"),
        (F.col("e") + F.col("shift")).alias("first_end"), F.lit(1.0).alias("similarity"),
    )
    found = stored(spark, found, "exact")
    unstore(spark, runs)
    return found


def _spans_of(found: DataFrame) -> DataFrame:
    return found.select(
        F.col("doc_id").alias("s_doc"), F.col("cls").alias("s_cls"), F.col("word_start").alias("s"),
        F.col("word_end").alias("e"),
    ).distinct()


_PLACE = ("doc", "cls", "span")


def _with_first(df: DataFrame, *keys: str) -> DataFrame:
    """`df` with the first window of its bucket as `o_doc`, `o_cls` and `o_span`."""
    upto = Window.partitionBy(*keys).orderBy(*_PLACE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = df.withColumn("first", F.first(F.struct(*_PLACE)).over(upto))
    return first.select(*df.columns, *[F.col(f"first.{n}").alias(f"o_{n}") for n in _PLACE])


def _shared(spark: SparkSession, tokens: DataFrame, width: int) -> DataFrame:
    """Windows whose value another document has."""
    made = map_arrow(tokens.select("doc", "cls", "tokens"), _windows(width), _WINDOWS)
    # Later windows of a value within a task are each alone; the first says that they are there.
    alike = Window.partitionBy("key")
    beside = F.min("cls").over(alike) != F.max("cls").over(alike)
    shared = made.withColumn("shared", beside | F.col("known")).filter("shared")
    return stored(spark, shared.drop("key", "known", "shared"), "shared")


def _halves(shared: DataFrame, width: int) -> DataFrame:
    """(half, doc, cls, first, last): halves of runs that other documents have, and the runs that have them."""
    low, mask, half = F.lit(0xFFFFFFFF), F.lit(1), width // 2 + 1
    l, r, c = F.shiftright("span", 32), F.col("span").bitwiseAND(low), F.shiftright("at", 1)
    first, last, turn = F.greatest(l, c - width + 1), F.least(c, r - width + 1), c - half + 1
    early = F.struct(F.col("early").alias("half"), first.alias("first"), F.least(last, turn).alias("last"))
    late = F.struct(F.col("late").alias("half"), F.greatest(first, turn + 1).alias("first"), last.alias("last"))
    made = shared.filter(F.col("at").bitwiseAND(mask) == 0).select("doc", "cls", F.inline(F.array(early, late)))
    made = made.filter("half IS NOT NULL")
    alike = Window.partitionBy("half")
    several = F.min("cls").over(alike) != F.max("cls").over(alike)
    return made.withColumn("several", several).filter("several").drop("several")


def _members(spark: SparkSession, shared: DataFrame) -> DataFrame:
    """(side, doc, cls, span, at, large, o_doc, o_cls, o_span): windows of buckets, with the first of each."""
    sided = shared.select(F.explode(F.array("ends", "starts")).alias("side"), *_PLACE, "at").filter("side IS NOT NULL")
    large = sided.groupBy("side").agg(F.count("*").alias("n")).filter(F.col("n") > LARGE)
    large = stored(spark, large.select(F.col("side").alias("large")), "large")
    dealt = sided.join(large, F.col("side") == F.col("large"), "left")
    part = F.when(F.col("large").isNotNull(), F.pmod(F.xxhash64("doc"), F.lit(PARTS))).otherwise(0)
    stars = _with_first(dealt.withColumn("part", part), "side", "part")
    bucket = Window.partitionBy("side", "part")
    mixed = (F.min("cls").over(bucket) != F.max("cls").over(bucket)) | F.col("large").isNotNull()
    members = stars.withColumn("mixed", mixed).filter("mixed").drop("part", "mixed")
    members = stored(spark, members, "members")
    unstore(spark, large)
    return members


def _met(members: DataFrame) -> DataFrame:
    """Windows beside the first of their bucket; first ones of parts of a large bucket, beside its first."""
    heads = members.filter("large IS NOT NULL AND doc = o_doc AND cls = o_cls AND span = o_span")
    return members.unionByName(_with_first(heads.select("side", *_PLACE, "at"), "side"), allowMissingColumns=True)


def _by_documents(spark: SparkSession, met: DataFrame) -> DataFrame:
    """Pairs of documents with their windows that meet, the later one first."""
    by = ["doc", "cls", F.col("o_doc").alias("other"), F.col("o_cls").alias("other_cls")]
    windows = [F.collect_set("span").alias("own"), F.collect_set("o_span").alias("theirs")]
    earlier = (F.col("o_doc") < F.col("doc")) & (F.col("o_cls") != F.col("cls"))
    return stored(spark, met.filter(earlier).groupBy(*by).agg(*windows), "window-pairs")


#: Documents of a bucket that one task compares those with an open window with.
BLOCK = 500
#: Places of a window and others that are compared at once; more than any sum over places.
HELD_TOKENS, FAR = 1 << 20, 1 << 50

#: A window of a bucket: `own` says that it is met in this block, `asks` that it meets earlier ones.
_OPEN = "side long, block int, doc long, cls long, span long, asks boolean, own boolean, data binary"
_MET = "doc long, cls long, span long, o_doc long, o_cls long, o_span long"


def _open_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of windows, once in the block of their content, and in all of their bucket if they ask."""
    fields = [f.split() for f in _OPEN.split(", ")]
    for batch in _portions(batches, 100):
        rows = []
        columns = [batch.column(n).to_pylist() for n in ("doc", "cls", "windows", "tokens")]
        for doc, cls, windows, data in zip(*columns, strict=True):
            for w in windows:
                content = data[SENT_BYTES * (w["span"] >> 32) : SENT_BYTES * ((w["span"] & 0xFFFFFFFF) + 1)]
                home = zlib.crc32(content) % w["blocks"]
                for block in range(w["blocks"]) if w["asks"] else (home,):
                    rows.append((w["side"], block, doc, cls, w["span"], w["asks"], block == home, content))
        made = list(zip(*rows, strict=True)) or [()] * len(fields)
        arrays = [pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(made, fields, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


_ARROW = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}


def _groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Rows of equal keys, which stand beside each other, over the bounds of batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        at = np.column_stack([batch.column(k).to_numpy() for k in keys])
        cuts = [0, *(np.flatnonzero((np.diff(at, axis=0) != 0).any(axis=1)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            key = tuple(at[a].tolist())
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _steps(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens that differ from the one before, and the first and last place of each."""
    first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
    return tokens[first], first, np.append(first[1:], len(tokens)) - 1


class Members:
    """Tokens of windows, in ascending order, each with the windows that have it and its step there."""

    def __init__(self, windows: list[np.ndarray]):
        lengths = np.array([len(w) for w in windows])
        tokens, member = np.concatenate(windows), np.repeat(np.arange(len(windows)), lengths)
        step = np.append(True, tokens[1:] != tokens[:-1])
        step[np.cumsum(lengths)[:-1]] = True
        tokens, member = tokens[step], member[step]
        steps = np.bincount(member, minlength=len(windows))
        place = np.arange(len(tokens)) - np.repeat(np.cumsum(steps) - steps, steps)
        order = np.argsort(tokens, kind="stable")
        tokens, member = tokens[order], member[order]
        new = np.append(True, (tokens[1:] != tokens[:-1]) | (member[1:] != member[:-1]))
        self.tokens, self.member, self.place = tokens[new], member[new], place[order][new]
        self.plain = np.bincount(self.member, minlength=len(windows)) == steps

    def similar(self, window: np.ndarray, n: int, width: int, percent: int) -> np.ndarray:
        """Which of the first `n` windows can have a passage like one of `window`.

        A passage holds a run of `width` tokens and shares `percent` of its distinct ones, so as many as that of the
        run that has the fewest. Where neither window comes back to a token, the steps between the ends of a passage
        and those between their counterparts bound its similarity, so some two ends must be similar enough.
        """
        ordered = np.sort(window)
        if once := bool((ordered[1:] != ordered[:-1]).all()):
            own, first, fewest = window, np.arange(len(window)), width
            last = first
        else:
            (own, first, last), fewest = _steps(window), _fewest(window, width)
        low, high = np.searchsorted(self.tokens, own, "left"), np.searchsorted(self.tokens, own, "right")
        sizes = high - low
        at = np.repeat(np.arange(len(own)), sizes)
        found = np.arange(len(at)) + np.repeat(low - (np.cumsum(sizes) - sizes), sizes)
        earlier = self.member[found] < n
        at, found = at[earlier], found[earlier]
        member, place = self.member[found], self.place[found]
        alike = np.flatnonzero(100 * np.bincount(member, minlength=n) >= percent * fewest)
        if not len(alike) or not once and len(np.unique(own)) < len(own):
            return alike
        kept = [alike[~self.plain[alike]]]
        alike = alike[self.plain[alike]]
        # The last step at which a passage can start that ends at each.
        start = np.searchsorted(first, last - width + 1, "right") - 1
        ended = np.flatnonzero(start >= 0)
        step = max(1, HELD_TOKENS // len(own))
        for k in range(0, len(alike), step):
            some = alike[k : k + step]
            row = np.full(n, -1)
            row[some] = np.arange(len(some))
            row = row[member]
            cell = row[row >= 0], at[row >= 0]
            hits = np.zeros((len(some), len(own)), np.int64)
            hits[cell] = 1
            # (100 + percent) * both >= percent * (tokens of one + tokens of two), as a difference of two ends.
            ends = (100 + percent) * np.cumsum(hits, axis=1) - percent * np.arange(len(own))
            ends[cell] -= percent * place[row >= 0]
            least = np.minimum.accumulate(np.where(hits == 1, ends, FAR), axis=1)[:, start[ended]]
            near = np.where(hits == 1, ends, -FAR)[:, ended] - least + 100 - percent >= 0
            kept.append(some[near.any(axis=1)])
        return np.sort(np.concatenate(kept))


def _fewest(tokens: np.ndarray, width: int) -> int:
    """Distinct tokens of the run of `width` that has the fewest."""
    order = np.argsort(tokens, kind="stable")
    again = np.flatnonzero(np.diff(tokens[order]) == 0)
    if not len(again):
        return width
    before = np.full(len(tokens), -1)
    before[order[again + 1]] = order[again]
    runs = np.lib.stride_tricks.sliding_window_view(before, width)
    return int((runs < np.arange(len(runs))[:, None]).sum(1).min())


#: Pairs of windows that are returned at once, or those of one bucket.
MET_ROWS = 10_000


def _joined(rows: list[list[np.ndarray]], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows, strict=True)], names=names)


def _meet(width: int, percent: int):
    """Windows that ask, beside earlier ones of their bucket that can have a similar passage."""
    names = [f.split()[0] for f in _MET.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for group in _groups(batches, ("side", "block")):
            place = [group.column(n).to_numpy() for n in _PLACE]
            doc, asks, home = place[0], group.column("asks").to_numpy(), group.column("own").to_numpy()
            if not asks.any() or not home.any():
                continue
            data = group.column("data").to_pylist()
            # Of windows with the same tokens the earliest stands for all.
            firsts: dict[bytes, int] = {}
            for i in np.flatnonzero(home).tolist():
                firsts.setdefault(data[i], i)
            kept = np.fromiter(firsts.values(), np.int64)
            asking = np.flatnonzero(asks)
            earlier = np.searchsorted(doc[kept], doc[asking])
            if not earlier.any():
                continue
            members = Members([received(d) for d in list(firsts)[: earlier.max()]])
            met = [
                (i, members.similar(received(data[i]), n, width, percent))
                for i, n in zip(asking.tolist(), earlier.tolist(), strict=True)
                if n
            ]
            one = np.repeat([i for i, _ in met], [len(k) for _, k in met])
            other = kept[np.concatenate([k for _, k in met])]
            held.append([x[rows] for rows in (one.astype(np.int64), other) for x in place])
            size += len(one)
            if size >= MET_ROWS:
                yield _joined(held, names)
                held, size = [], 0
        if size:
            yield _joined(held, names)

    return run


def _left(spark: SparkSession, members: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc, cls, windows): windows by bucket (span: what those of a document span there) that are open or earlier.

    One is open, so that it asks the earlier ones of its bucket, if its centre is in no passage yet. It asks the
    first too, which it has met: then all windows of the two documents were verified together.
    Of equal texts only the first takes part.
    """
    covered = (
        (F.col("doc") == F.col("s_doc"))
        & (F.col("cls") == F.col("s_cls"))
        & F.shiftright("at", 1).between(F.col("s"), F.col("e") - WORDS)
    )
    by = ["side", "doc", "cls"]
    later = members.filter("large IS NOT NULL OR o_doc < doc")
    left = stored(spark, later.join(spans, covered, "left_anti").select(*by).distinct(), "left")
    l, r = F.min(F.shiftright("span", 32)), F.max(F.col("span").bitwiseAND(F.lit(0xFFFFFFFF)))
    firsts = members.join(left.select("side"), "side", "left_semi").groupBy("side", "cls").agg(
        F.min("doc").alias("doc"), F.shiftleft(l, 32).bitwiseOR(r).alias("span")
    )
    flagged = firsts.join(left.withColumn("left", F.lit(True)), by, "left")
    bucket = Window.partitionBy("side")
    asks = F.col("left").isNotNull() & (F.col("doc") > F.min("doc").over(bucket))
    last = F.max(F.when(F.col("asks"), F.col("doc"))).over(bucket)
    kept = flagged.withColumn("asks", asks).withColumn("last", last).filter("doc <= last")
    blocks = F.ceil(F.count("*").over(bucket) / BLOCK).cast("int")
    windows = F.collect_list(F.struct("side", "span", "asks", "blocks")).alias("windows")
    kept = kept.withColumn("blocks", blocks)
    found = stored(spark, kept.groupBy("doc", "cls").agg(windows), "open-windows")
    unstore(spark, left)
    return found


def _left_pairs(
    spark: SparkSession, tokens: DataFrame, members: DataFrame, spans: DataFrame, width: int, percent: int
) -> DataFrame:
    """Pairs of documents of a bucket of which the later has a window there that is in no passage yet.

    All earlier documents whose tokens there can make a similar passage are paired with it.
    """
    left = _left(spark, members, spans)
    rows = marked_rows(tokens.select("doc", "cls", "tokens"), left.select("doc"))
    asked = left.join(rows, ["doc", "cls"]).select("doc", "cls", "windows", "tokens")
    dealt = map_arrow(asked, _open_windows, _OPEN).repartition("side", "block")
    met = map_arrow(dealt.sortWithinPartitions("side", "block", "doc"), _meet(width, percent), _MET)
    pairs = _by_documents(spark, met)
    unstore(spark, left)
    return pairs


def repeated_passages(
    spark: SparkSession,
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = PASSAGE_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """Passages of `docs` that a document with a smaller id has too, one row per passage and document.

    (doc_id, cls, first_doc_id, word_start, word_end, first_start, first_end, similarity): words
    word_start to word_end - 1 of a document nearly repeat words of an earlier one; `cls` is the
    hash of the document's text. A document that equals an earlier one is a passage as a whole. Texts
    with fewer than `words` words, null texts and rows without an id have no passages; repeated
    rows are one document. An empty table gives no rows. Other columns are not read.
    """
    width = words - WORDS + 1
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc"), F.xxhash64(text).alias("cls"), F.col(text).alias("text")
    ).filter("doc IS NOT NULL AND text IS NOT NULL")
    schema = "doc long, cls long, n long, tokens binary"
    tokens = stored(spark, map_arrow(rows, _tokenize(width), schema), "tokens")
    shared = _shared(spark, tokens, width)
    halves, members = stored(spark, _halves(shared, width), "halves"), _members(spark, shared)
    unstore(spark, shared)
    near = _verified(spark, tokens, _by_documents(spark, _met(members)), width, percent)
    spans = stored(spark, _spans_of(near), "spans")
    spanned = (
        (F.col("doc_id") == F.col("s_doc"))
        & (F.col("cls") == F.col("s_cls"))
        & (F.col("word_start") >= F.col("s"))
        & (F.col("word_end") <= F.col("e"))
    )
    exact = _exact(spark, tokens, halves, spans, width)
    unstore(spark, halves)
    settled = stored(spark, _spans_of(near.union(exact)), "settled")
    more = _verified(spark, tokens, _left_pairs(spark, tokens, members, settled, width, percent), width, percent)
    unstore(spark, members, settled)
    sized = tokens.select(F.col("doc").alias("doc_id"), "cls", "n")
    lowest = sized.groupBy("cls").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    zero = F.lit(0).cast("long")
    copies = (
        sized.join(lowest.filter("low < high"), "cls")
        .filter("low < doc_id")
        .select("doc_id", "cls", F.col("low").alias("first_doc_id"), zero.alias("word_start"),
                F.col("n").alias("word_end"), zero.alias("first_start"), F.col("n").alias("first_end"),
                F.lit(1.0).alias("similarity"))
    )
    found = near.union(more).union(exact.join(spans, spanned, "left_anti")).union(copies).distinct()
    found = stored(spark, found, "passages")
    unstore(spark, tokens, near, more, spans, exact)
    return found


def without_passages(
    spark: SparkSession, docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`docs` without the passages `repeated_passages` found in them.

    A passage goes with the white space after it. A document of which no word is left goes; one that
    had no word before stays, as does a row without an id or text. Columns are those of `docs`.
    """
    spans = stored(
        spark,
        found.groupBy(F.col("doc_id").alias("__doc"), F.col("cls").alias("__cls")).agg(
            F.collect_set(F.struct("word_start", "word_end")).alias("__spans")
        ),
        "spans",
    )
    same = (F.col(doc_id).cast("long") == F.col("__doc")) & (F.xxhash64(text) == F.col("__cls"))
    marked = docs.join(spans, same, "left")

    def start():
        def make(part: pa.RecordBatch) -> list[pa.Array]:
            out = []
            pairs = zip(part.column(text).to_pylist(), part.column("__spans").to_pylist(), strict=True)
            for whole, spans in pairs:
                cuts = [(s["word_start"], s["word_end"]) for s in spans] if spans else []
                out.append(cut_words(whole, cuts) if cuts else whole)
            return [pa.array(out, pa.string())]

        return make

    cut = add_columns(marked, text, [T.StructField("__left", T.StringType())], start)
    emptied = F.col("__spans").isNotNull() & (n_words(F.col("__left")) == 0)
    kept = cut.filter(~emptied)
    return kept.select(*[F.col("__left").alias(c) if c == text else F.col(c) for c in docs.columns])


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """`text` without the words of the spans (start to end - 1)."""
    import re

    starts = [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    gone = np.zeros(len(starts) + 1, bool)
    for a, b in spans:
        gone[a:b] = True
    gone[-1] = False
    bounds = [*starts, len(text)]
    kept = [text[: bounds[0]]]
    kept += [text[bounds[i] : bounds[i + 1]] for i in range(len(starts)) if not gone[i]]
    return "".join(kept)
