"""Document fingerprints: one-permutation MinHash in built-in functions.

Each 5-word shingle is hashed once. The top bits of a hash choose its bin, a bin keeps its least hash,
and an empty bin takes the value of a filled one by optimal densification: each empty bin draws bins at
random, the same ones for every text, until it meets a filled one. After `DRAWS` rounds over all bins, those
still empty take the filled bin that comes first in a random order of their own, which is the same law
without endless draws for texts of few shingles. The low `BITS` bits of every bin are
packed into a hexadecimal string. Two unrelated values agree in 2^-BITS of cases, for which the
likeness of two fingerprints is corrected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesmart.llm.common import SPACE, partitions

WORDS = 5
BIN_BITS = 7
BINS = 1 << BIN_BITS
BITS = 8
DIGITS = BITS // 4
#: Rounds of draws for empty bins; any number gives fingerprints of the same quality.
DRAWS = 6


def _bin(value: Column) -> Column:
    return F.shiftrightunsigned(value, 64 - BIN_BITS)


def with_fingerprint(df: DataFrame, text: Column, out: str) -> DataFrame:
    """`df` with `out string`, the fingerprint of a whole text.

    Equal texts have equal fingerprints. A text of one to four words is one shingle; a null text, or
    one without words, has the empty string. A column already named `out` is replaced.
    """
    base = df.drop(out).columns
    words = F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")
    hashed = df.withColumn("__words", F.transform(words, lambda w: F.xxhash64(w)))
    n = F.size("__words")
    whole = F.when(n > 0, F.array(F.xxhash64("__words"))).otherwise(F.array().cast("array<bigint>"))
    shingles = F.when(
        n >= WORDS,
        F.transform(
            F.slice("__words", 1, n - (WORDS - 1)),
            lambda w, i: F.xxhash64(w, *[F.get(F.col("__words"), i + k) for k in range(1, WORDS)]),
        ),
    ).otherwise(whole)
    ordered = hashed.withColumn("__hashes", F.sort_array(shingles))
    least = ordered.withColumn(
        "__least",
        F.filter(
            "__hashes",
            lambda h, i: (i == 0) | (_bin(h) != _bin(F.get(F.col("__hashes"), i - 1))),
        ),
    ).withColumn("__bins", F.transform("__least", lambda h: _bin(h).cast("int")))
    low = F.lit((1 << BITS) - 1).cast("long")
    every = F.sequence(F.lit(0), F.lit(BINS - 1))
    own = least.withColumn(
        "__own",
        F.transform(
            every,
            lambda b: F.get(
                F.col("__least"), (F.nullif(F.array_position("__bins", b), F.lit(0).cast("long")) - 1).cast("int")
            ).bitwiseAND(low),
        ),
    )
    # A bin and its value as one number, which takes part in the order of an empty bin by its turn.
    tagged = own.withColumn(
        "__tagged", F.transform("__least", lambda h: _bin(h) * (1 << BITS) + h.bitwiseAND(low))
    )
    def drawn(k: int):
        at = lambda b: F.xxhash64(F.lit(k), b).bitwiseAND(F.lit(BINS - 1).cast("long")).cast("int")
        return lambda v, b: F.coalesce(v, F.get(F.col("__own"), at(b)))

    filled: Column = F.col("__own")
    for k in range(DRAWS):
        filled = F.transform(filled, drawn(k))

    def first(b: Column) -> Column:
        """Of all filled bins the one whose turn for bin `b` is least."""
        turns = F.transform(
            "__tagged",
            lambda t: F.xxhash64(b, F.shiftright(t, BITS)).bitwiseAND(F.lit(~((1 << BITS) - 1)).cast("long"))
            + t.bitwiseAND(low),
        )
        return F.array_min(turns).bitwiseAND(low)

    digits = F.transform(
        filled, lambda v, b: F.lpad(F.lower(F.hex(F.coalesce(v, first(b)))), DIGITS, "0")
    )
    packed = F.when(F.size("__bins") > 0, F.array_join(digits, "")).otherwise(F.lit(""))
    return tagged.select(*base, packed.alias(out))


def likeness(a: Column, b: Column) -> Column:
    """Estimated similarity (0 to 1) of the shingle sets of two fingerprints.

    Two empty fingerprints are alike (1), an empty and another are not (0).
    """
    width = F.lit(DIGITS // 2)
    bins = F.sequence(F.lit(0), F.lit(BINS - 1))
    # Named once as bytes, where a bin is found at once; in a string its place would be counted anew.
    pair = F.array(F.struct(F.unhex(a).alias("a"), F.unhex(b).alias("b")))
    same = F.get(
        F.transform(
            pair,
            lambda p: F.size(
                F.filter(
                    bins,
                    lambda i: F.substring(p["a"], i * width + 1, width) == F.substring(p["b"], i * width + 1, width),
                )
            ),
        ),
        F.lit(0),
    )
    chance = 2.0**-BITS
    corrected = F.greatest(F.lit(0.0), (same / BINS - chance) / (1 - chance))
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(corrected)


# --- The next document ---------------------------------------------------------------------------


def with_next(spark: SparkSession, df: DataFrame, key: str, carried: list[str]) -> DataFrame:
    """`df` with `next_<column>` of the row after it by descending `key`; after the last comes the first.

    Rows are dealt to ranges of the key with about as many rows each and ordered there. The first
    row of a range is also sent to the range above, where it follows the last row; what the driver
    handles is one key per range, as many as shuffle partitions. Rows with equal keys follow
    each other in order of the carried columns, null keys come last.
    """
    n = partitions(spark)
    cuts = df.select(F.percentile_approx(key, [i / n for i in range(1, n)], 10_000)).first()[0] if n > 1 else []
    bounds = sorted(set(cuts or []))
    bucket = F.coalesce(
        F.aggregate(
            F.array(*[F.lit(b) for b in bounds]).cast("array<bigint>"),
            F.lit(0),
            lambda k, b: k + F.when(F.col(key) > b, 1).otherwise(0),
        ),
        F.lit(0),
    )
    heads = sorted(
        (r["b"], r["k"])
        for r in df.select(bucket.alias("b"), key).groupBy("b").agg(F.max(key).alias("k")).collect()
    )
    above = [b for b, _ in heads[1:]] + [b for b, _ in heads[:1]]
    extra = spark.createDataFrame(
        [(k, b) for (_, k), b in zip(heads, above, strict=True)], "__head long, __also int"
    )
    dealt = df.join(F.broadcast(extra), F.col(key).eqNullSafe(F.col("__head")), "left").withColumn(
        "__to",
        F.explode(
            F.when(
                F.col("__also").isNotNull(),
                F.array(
                    F.struct(bucket.alias("b"), F.lit(0).alias("copy")),
                    F.struct(F.col("__also").alias("b"), F.lit(1).alias("copy")),
                ),
            ).otherwise(F.array(F.struct(bucket.alias("b"), F.lit(0).alias("copy"))))
        ),
    )
    order = Window.partitionBy("__to.b").orderBy(
        F.col("__to.copy"), F.col(key).desc_nulls_last(), *[F.col(c) for c in carried]
    )
    following = dealt.select(
        *df.columns, "__to", *[F.lead(c).over(order).alias(f"next_{c}") for c in carried]
    )
    return following.filter(F.col("__to.copy") == 0).drop("__to")
