"""Exact top-k search by pivot-table elimination.

Distances of all vectors to many pivots are computed once. For a query, the largest difference of
pivot distances bounds its distance to a candidate from below, and so the inner product from above:
2 <q, v> = |q|^2 + |v|^2 - d(q, v)^2. Candidates of a block are evaluated in order of the bound until
the k-th best score is above all bounds that are left. Pivots are rows themselves, so their own
scores give every block a k-th best to start from.

Queries and candidates are dealt in blocks of bounded size and every pair of blocks is a group; the best
k of each group are ranked per query at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesmart.llm.common import map_arrow, ship, stored

SCALE = 1024
K = 10
#: Pivots of a dimension: the rows with the smallest hashes of their id, at most so many.
PIVOTS = 64
#: Dimensions that have pivots, those of the most vectors; others are bounded by their norms alone.
PIVOT_DIMENSIONS = 8
#: Rows of a block of queries and of candidates.
QUERY_BLOCK = 256
CANDIDATE_BLOCK = 8192
#: Candidates evaluated at a time.
STEP = 256
EXACT = 2.0**53

_FOUND = "query long, query_id long, vec_id long, score long"


def quantized(df: DataFrame, vec_id: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<double>) with components floor(scale * x), of rows that take part."""
    doubles = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = df.filter(F.col(vec_id).isNotNull() & F.col(vector).isNotNull()).filter(finite)
    # floor() of a large double would not fit a long: it is then a whole number already.
    whole = F.transform(
        doubles,
        lambda x: F.when(F.abs(x) < 2.0**43, F.floor(x * scale).cast("double")).otherwise(x * scale),
    )
    return usable.select(F.col(vec_id).cast("long").alias("vec_id"), whole.alias("v"))


def _matrix(column: pa.Array, rows: int, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, width)


def _distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squared = (v * v).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * v @ pivots.T
    return np.sqrt(np.maximum(squared, 0))


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer inner products of rows of v with q."""
    if v.size and np.abs(q).max(initial=0) * np.abs(v).max(initial=0) * max(1, len(q)) >= EXACT:
        a = [int(x) for x in q]
        exact = [sum(x * int(y) for x, y in zip(a, row, strict=True)) for row in v]
        if any(abs(x) >= 1 << 63 for x in exact):
            raise OverflowError("an inner product does not fit 64 bits")
        return np.array(exact, np.int64)
    return (v @ q).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def search_block(
    q_rows: np.ndarray, q: np.ndarray, q_at: np.ndarray, rows: np.ndarray, ids: np.ndarray, v: np.ndarray,
    at: np.ndarray, pivot_rows: np.ndarray, pivots: np.ndarray, k: int,
) -> tuple[list[tuple[int, int, int]], int]:
    """(query, vec_id, score) of the best k candidates for each query, and how many were evaluated.

    Rows are told apart by their numbers, since an id may be that of several.
    """
    found, evaluated = [], 0
    norms = (v * v).sum(1)
    for i in range(len(q_rows)):
        others = pivot_rows != q_rows[i]
        seed = _scores(q[i], pivots[others])
        start = np.sort(seed)[-k] if len(seed) >= k else None
        lower = np.zeros(len(ids))
        for p in range(at.shape[1]):
            np.maximum(lower, np.abs(at[:, p] - q_at[i, p]), out=lower)
        q_norm = float(q[i] @ q[i])
        # Room for rounding: bounds may be a little high, never low.
        room = 1 + 1e-9 * (q_norm + norms) + 1e-6 * lower
        bound = (q_norm + norms - np.maximum(lower - 1e-7 * (lower + np.sqrt(q_norm)), 0) ** 2) / 2 + room
        bound[rows == q_rows[i]] = -np.inf
        order = np.argsort(-bound, kind="stable")
        scores, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for a in range(0, len(order), STEP):
            part = order[a : a + STEP]
            top = bound[part[0]]
            least = scores[k - 1] if len(scores) >= k else None
            floor = max((x for x in (least, start) if x is not None), default=None)
            if top == -np.inf or (floor is not None and top < floor):
                break
            part = part[bound[part] > -np.inf]
            evaluated += len(part)
            scores, best = _best(
                np.concatenate([scores, _scores(q[i], v[part])]), np.concatenate([best, ids[part]]), k
            )
        found += [(i, int(b), int(s)) for s, b in zip(scores, best, strict=True)]
    return found, evaluated


def top_k(
    spark: SparkSession,
    df: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    every: int = 100,
    k: int = K,
    scale: int = SCALE,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of every query, exactly.

    Queries are the rows whose id is divisible by `every`, candidates all rows with another id. Vectors
    that are null or hold a null or non-finite component take no part, nor do rows without an id. Rows that
    repeat an id are queries and candidates of their own, for each other too. Vectors of different lengths
    are not compared, an empty vector scores 0 with empty ones. Ties go to the smaller id. Fewer than k
    candidates give fewer rows; an empty table gives none. A product beyond 64 bits fails.
    """
    ship(spark)
    numbered = quantized(df, vec_id, vector, scale).select("*", F.size("v").alias("dim"), F.monotonically_increasing_id().alias("row"))
    rows = stored(spark, numbered, "vectors")
    often = rows.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(PIVOT_DIMENSIONS)
    turn = Window.partitionBy("dim").orderBy(F.xxhash64("vec_id", "row"), "vec_id")
    chosen = rows.join(often.select("dim"), "dim", "left_semi").withColumn("turn", F.row_number().over(turn))
    chosen = chosen.filter(F.col("turn") <= PIVOTS)
    pivots: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    found: dict[int, list] = {}
    for r in chosen.select("dim", "row", "v").collect():
        found.setdefault(r.dim, []).append((r.row, r.v))
    for dim, own in found.items():
        numbers = np.array([i for i, _ in own], np.int64)
        pivots[dim] = numbers, np.array([v for _, v in own], np.float64).reshape(len(own), dim)
    shared = spark.sparkContext.broadcast(pivots)

    def pivots_of(dim: int) -> tuple[np.ndarray, np.ndarray]:
        return shared.value.get(dim, (np.zeros(0, np.int64), np.zeros((0, dim))))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "vec_id", "v", "dim"]
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                own = pivots_of(int(dim))[1]
                at = _distances(_matrix(part.column("v"), part.num_rows, int(dim)), own)
                offsets = np.arange(len(at) + 1, dtype=np.int32) * at.shape[1]
                listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(at.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(n) for n in names], listed], names=[*names, "at"]
                )

    schema = "row long, vec_id long, v array<double>, dim int, at array<double>"
    measured = stored(spark, map_arrow(rows.select("row", "vec_id", "v", "dim"), measure, schema), "pivot-table")
    sizes = measured.groupBy("dim").agg(
        F.count("*").alias("n"), F.sum((F.col("vec_id") % every == 0).cast("long")).alias("q")
    )
    blocks = sizes.select(
        F.col("dim").alias("d"),
        F.ceil(F.col("n") / CANDIDATE_BLOCK).cast("int").alias("c_blocks"),
        F.ceil(F.greatest("q", F.lit(1)) / QUERY_BLOCK).cast("int").alias("q_blocks"),
    )
    dealt = measured.join(blocks, F.col("dim") == F.col("d"))
    draw = F.xxhash64("row", F.lit(1))

    def spread(own: str, other: str):
        return F.explode(F.sequence(F.lit(0), F.col(other) - 1)), F.pmod(draw, F.col(own)).cast("int")

    each_c, own_q = spread("q_blocks", "c_blocks")
    queries = dealt.filter(F.col("vec_id") % every == 0).select(
        "dim", own_q.alias("qb"), each_c.alias("cb"), "row", "vec_id", "v", "at"
    )
    each_q, own_c = spread("c_blocks", "q_blocks")
    candidates = dealt.select(
        F.col("dim").alias("c_dim"), each_q.alias("c_qb"), own_c.alias("c_cb"), F.col("row").alias("c_row"),
        F.col("vec_id").alias("c_id"), F.col("v").alias("c_v"), F.col("at").alias("c_at"),
    )

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        rows_found: list[tuple[int, int, int]] = []
        own = ids = np.zeros(0, np.int64)
        if left.num_rows and right.num_rows:
            numbers, pivots = pivots_of(dim := left.column("dim")[0].as_py())

            def parts(t: pa.Table):
                own, names, v, at = (t.column(c).combine_chunks() for c in range(3, 7))
                n = t.num_rows
                return own.to_numpy(), names.to_numpy(), _matrix(v, n, dim), _matrix(at, n, len(numbers))

            own, ids, q, q_at = parts(left)
            rows_found, _ = search_block(own, q, q_at, *parts(right), numbers, pivots, k)
        at, best, score = (np.array(c, np.int64) for c in (list(zip(*rows_found, strict=True)) or [(), (), ()]))
        names = ["query", "query_id", "vec_id", "score"]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, (own[at], ids[at], best, score), strict=True)})

    keys = ["dim", "qb", "cb"]
    both = queries.groupBy(*keys).cogroup(candidates.groupBy(*[f"c_{c}" for c in keys]))
    grouped = both.applyInArrow(search, _FOUND)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    ranked = grouped.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
