"""The corpus pipeline over `documents`, and the queries of the training-data operators by name.

Five stages, each over all that the one before kept:

1. language_id: documents that the byte network cannot place go: no letter, or a mean probability
   below `LEAST_SCORE`, close to the even chance among four languages.
2. jaccard: of each group of linked documents the one with the least doc_id stays.
3. passages: passages that an earlier document has are cut out; what has no word left goes.
4. mix: documents of each source are left out or repeated until it has its share of all words.
5. bpe: token ids of each text, their digest, and the digest of the bytes they decode to.

A document is a row: all stages take null ids, texts, languages and sources, repeated rows, an empty
table and further columns, and all but the last return the columns they get.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesmart.llm import bpe, jaccard, langid, mixing, passages
from seriesmart.llm.common import n_words, stored, table
from seriesmart.llm.queries import ORACLES, QUERIES, RANKS, bpe_digests, fold

LEAST_SCORE = 0.3
#: Names of working columns, unlike those of any table.
FOUND = ("__lang", "__score")
MIXED = ("__source_size", "__target", "__repeats", "__taken")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found. A null text or one without a letter has none."""
    model = langid.train(spark, docs.filter(fold(4) != 2))
    found = langid.predict(spark, docs, model, names=FOUND)
    known = (F.col(FOUND[0]) != langid.UNDETERMINED) & (F.col(FOUND[1]) >= LEAST_SCORE)
    return found.filter(known).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group. Of repeated rows one stays, rows without an id all stay."""
    linked = jaccard.link_components(spark, docs)
    least = F.max((F.col("component_id") == F.col("doc_id")).cast("int"))
    gone = linked.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(least.alias("least")).filter("least = 0")
    kept = docs.join(gone.select(F.col("doc_id").alias("__gone")), F.col("doc_id") == F.col("__gone"), "left_anti")
    # Rows without an id are each alone, so that many of them are no group.
    alone = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    turn = Window.partitionBy("doc_id", F.xxhash64("text"), "__alone").orderBy("doc_id")
    one = kept.withColumn("__alone", alone).withColumn("__turn", F.row_number().over(turn))
    return one.filter(F.col("__turn") == 1).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of earlier ones; `n_chars` is counted anew."""
    cut = passages.without_passages(spark, docs, passages.repeated_passages(spark, docs))
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    sized = docs.withColumn("__words", n_words(F.col("text")))
    keys = ("doc_id", "n_chars")
    return mixing.apply_mix(mixing.mix(spark, sized, "__words", keys=keys, names=MIXED), MIXED).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), a row for each document of the mix."""
    ranks = public_tokenizers.path(RANKS)
    return bpe_digests(bpe.encode_and_decode(docs.select("doc_id", "text"), ranks))


STAGES = [
    ("language_id", language_id),
    ("jaccard", near_duplicates),
    ("passages", repeated_passages),
    ("mix", mix_sources),
    ("bpe", tokens),
]

#: SQL can train no network and build no Cartesian trees; `tests/llm/test_pipeline.py` runs the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


LLM_QUERIES = {**QUERIES, "pipeline": run}
LLM_ORACLES = dict(ORACLES)
