"""Byte-level BPE encoding and decoding by recursive DuckDB queries, one DuckDB per worker.

Encoding. Texts are cut into matches of the split pattern; each distinct match is a word of
token-position rows, at first its bytes. A recursive query joins neighbouring tokens with the merge
table, finds each word's leftmost pair of least rank and contracts it, until no pair is left.
Decoding joins ids with the vocabulary and aggregates the pieces in order of position.

The rows a recursion keeps grow with the square of a word's length, so a word over `LONG_WORD` bytes
(an unbroken run of letters, digits or signs) is contracted by the same rule with a heap instead.
"""

from __future__ import annotations

import base64
import heapq

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from seriesmart.llm.common import add_columns, held, map_arrow, texts_of
from seriesmart.llm.pieces import UnitCache, id_lists

LONG_WORD = 512
#: Words of one recursive query have at most so many token rows over all rounds.
ROUND_ROWS = 2_000_000
#: Distinct units that a worker remembers.
REMEMBERED = 700_000
#: Tokens of one decoding query.
DECODED_ROWS = 250_000

# Positions count on over all words of a query. A round finds each word's least (rank, position) among
# pairs of neighbours that merge, and contracts that pair; a word without one leaves, so that its
# tokens are its rows of the last round it was in.
_CONTRACT = """
WITH RECURSIVE t(round, word, pos, next, token) AS (
    SELECT 0, word, pos, next, token FROM byte_rows
    UNION ALL
    (WITH least AS (
        SELECT a.word, min(m.rank::BIGINT << 32 | a.pos) AS k,
            arg_min(b.pos, m.rank::BIGINT << 32 | a.pos) AS gone,
            arg_min(coalesce(b.next, -1), m.rank::BIGINT << 32 | a.pos) AS beyond
        FROM t a JOIN t b ON a.next = b.pos
        JOIN merges m ON m.pair = a.token::BIGINT << 32 | b.token
        GROUP BY a.word)
    SELECT t.round + 1, t.word, t.pos,
        CASE WHEN t.pos <> (k & 4294967295) THEN t.next WHEN beyond >= 0 THEN beyond END,
        CASE WHEN t.pos <> (k & 4294967295) THEN t.token ELSE (k >> 32)::INTEGER END
    FROM t JOIN least USING (word) WHERE t.pos <> gone)
), ended AS (SELECT word, max(round) AS round FROM t GROUP BY word)
SELECT word, token FROM t JOIN ended USING (word, round) ORDER BY pos
"""

_DECODE = """
SELECT d.doc, string_agg(v.piece, '' ORDER BY d.pos) AS bytes, count(v.piece) AS known
FROM id_rows d LEFT JOIN vocabulary v USING (id) GROUP BY d.doc ORDER BY d.doc
"""


class Bpe:
    """The merge table and vocabulary of a rank file in a DuckDB of one worker."""

    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.cache = UnitCache(self.encode_units, REMEMBERED)
        self.words: dict[str, bytes] = {}
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        ranks = self.ranks
        merges = [
            (ranks[k[:i]] << 32 | ranks[k[i:]], rank)
            for k, rank in ranks.items()
            for i in range(1, len(k))
            if k[:i] in ranks and k[i:] in ranks
        ]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        merges_rows = pa.table(
            {
                "pair": pa.array([m[0] for m in merges], pa.int64()),
                "rank": pa.array([m[1] for m in merges], pa.int32()),
            }
        )
        vocabulary_rows = pa.table(
            {
                "id": pa.array(list(ranks.values()), pa.int32()),
                # A byte is the character of the same number: text that DuckDB can aggregate.
                "piece": pa.array([k.decode("latin-1") for k in ranks], pa.string()),
            }
        )
        self.db.register("merges_rows", merges_rows)
        self.db.register("vocabulary_rows", vocabulary_rows)
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merges_rows")
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM vocabulary_rows")

    # --- Encoding --------------------------------------------------------------------------------

    def encode_units(self, units: list[str]) -> list[bytes]:
        cut = [self.pattern.findall(u) for u in units]
        if len(self.words) > REMEMBERED:
            self.words = {}
        words = self.words
        short, most = [], 0
        new = set().union(*cut).difference(words)
        for word in new:
            coded = word.encode()
            if len(coded) > LONG_WORD:
                words[word] = self.contract_long(coded)
                continue
            short.append((word, coded))
            most += len(coded) ** 2
            if most > ROUND_ROWS:
                words.update(self.contract(short))
                short, most = [], 0
        if short:
            words.update(self.contract(short))
        get = words.__getitem__
        made = [b"".join(map(get, w)) for w in cut]
        for word in new:
            if len(word) > self.cache.longest:
                del words[word]
        return made

    def contract(self, words: list[tuple[str, bytes]]) -> dict[str, bytes]:
        lengths = np.array([len(b) for _, b in words])
        data = np.frombuffer(b"".join(b for _, b in words), np.uint8)
        following = np.arange(1, len(data) + 1, dtype=np.int32)
        last = np.zeros(len(data), bool)
        last[np.cumsum(lengths) - 1] = True
        rows = pa.table(
            {
                "word": np.repeat(np.arange(len(words), dtype=np.int32), lengths),
                "pos": np.arange(len(data), dtype=np.int32),
                "next": pa.array(following, mask=last),
                "token": self.byte_ids[data],
            }
        )
        self.db.register("byte_rows", rows)
        found = self.db.sql(_CONTRACT).to_arrow_table()
        counts = np.bincount(found["word"].to_numpy(), minlength=len(words))
        flat = found["token"].to_numpy().astype(np.int32).tobytes()
        ends = np.cumsum(counts) * 4
        return {w: flat[e - 4 * n : e] for (w, _), e, n in zip(words, ends, counts, strict=True)}

    def contract_long(self, word: bytes) -> bytes:
        """The same rule for one long word: a heap of (rank, position) over linked tokens."""
        ranks, n = self.ranks, len(word)
        end = list(range(1, n + 1))
        previous = list(range(-1, n - 1))

        def rank(i: int) -> int | None:
            j = end[i]
            return ranks.get(word[i : end[j]]) if j < n else None

        heap = [(r, i) for i in range(n) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        alive = bytearray(b"\x01") * n
        while heap:
            r, i = heapq.heappop(heap)
            if not alive[i] or rank(i) != r:
                continue
            gone = end[i]
            alive[gone] = 0
            end[i] = end[gone]
            if end[i] < n:
                previous[end[i]] = i
            for k in (i, previous[i]):
                if k >= 0 and (new := rank(k)) is not None:
                    heapq.heappush(heap, (new, k))
        return np.array([ranks[word[i : end[i]]] for i in range(n) if alive[i]], np.int32).tobytes()

    # --- Decoding --------------------------------------------------------------------------------

    def decode(self, flat: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """Bytes of documents whose ids stand one after the other, in runs of ids of one query each.

        A document that reaches over the end of a run is decoded in parts, so that no query grows with
        the length of a document.
        """
        parts: list[list[bytes]] = [[] for _ in counts]
        ends = np.cumsum(counts)
        for start in range(0, len(flat), DECODED_ROWS):
            run = flat[start : start + DECODED_ROWS]
            at = np.arange(start, start + len(run))
            rows = pa.table(
                {
                    "doc": np.searchsorted(ends, at, "right").astype(np.int32),
                    "pos": np.arange(len(run), dtype=np.int32),
                    "id": run,
                }
            )
            self.db.register("id_rows", rows)
            found = self.db.execute(_DECODE).fetchall()
            if sum(known for _, _, known in found) != len(run):
                raise ValueError("an id is not in the vocabulary")
            for doc, text, _ in found:
                parts[doc].append(text.encode("latin-1"))
        return [b"".join(p) for p in parts]


def _bpe(ranks_path: str, pattern: str) -> Bpe:
    """One per worker process, kept over the tasks of a stage."""
    return held(("bpe", ranks_path, pattern), lambda: Bpe(ranks_path, pattern))


def encode(
    df: DataFrame,
    ranks_path: str,
    text: str = "text",
    ids: str = "ids",
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """`df` with the token ids of each whole text as `ids array<int>`, without special tokens.

    A null or empty text has no ids (an empty list). Every row is kept, repeated rows too; an empty
    table stays empty. A column already named `ids` is replaced, other columns pass through. A text
    of any length is encoded whole.
    """

    def start():
        bpe = _bpe(ranks_path, pattern)
        return lambda part: [id_lists(*bpe.cache.encode_texts(texts_of(part, text)))]

    field = T.StructField(ids, T.ArrayType(T.IntegerType(), False))
    return add_columns(df, text, [field], start, 2 << 20)


def encode_and_decode(
    df: DataFrame,
    ranks_path: str,
    text: str = "text",
    ids: str = "ids",
    data: str = "decoded",
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """`encode`, and `decode` of what it gave, by the same worker: half the processes of both in turn.

    The decoded bytes come from the ids alone.
    """

    def start():
        bpe = _bpe(ranks_path, pattern)

        def make(part: pa.RecordBatch) -> list[pa.Array]:
            flat, counts = bpe.cache.encode_texts(texts_of(part, text))
            return [id_lists(flat, counts), pa.array(bpe.decode(flat, counts), pa.binary())]

        return make

    fields = [T.StructField(ids, T.ArrayType(T.IntegerType(), False)), T.StructField(data, T.BinaryType())]
    return add_columns(df, text, fields, start, 1 << 20)


def decode(
    df: DataFrame,
    ranks_path: str,
    ids: str = "ids",
    data: str = "decoded",
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """`df` with the bytes its ids stand for as `data binary`.

    A null or empty list gives no bytes (an empty value, not null); an id outside the vocabulary
    fails the task. Ids of a text that `encode` made give the UTF-8 of that text. A column already
    named `data` is replaced.
    """
    base = df.drop(data)
    names = base.columns
    schema = T.StructType([*base.schema.fields, T.StructField(data, T.BinaryType())])

    def run(batches):
        bpe = _bpe(ranks_path, pattern)
        for batch in batches:
            for k in range(0, batch.num_rows, 200):
                part = batch.slice(k, 200)
                column = part.column(ids)
                counts = np.array([0 if n is None else n for n in pc.list_value_length(column).to_pylist()], np.int64)
                flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
                made = pa.array(bpe.decode(flat, counts), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(n) for n in names], made], names=[*names, data]
                )

    return map_arrow(base, run, schema)

