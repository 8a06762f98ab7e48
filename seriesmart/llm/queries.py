"""The queries of this subpackage by name, each over its whole table, and SQL where it can say the same."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmart.llm import (
    bpe,
    cover_codes,
    fingerprint,
    jaccard,
    langid,
    merkle,
    mixing,
    packed_ids,
    packing,
    passages,
    sharding,
    topk,
    toxicity,
)
from seriesmart.llm.common import n_words, table

Query = Callable[[SparkSession, str], DataFrame]

RANKS = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- 1: byte-level BPE ---------------------------------------------------------------------------


@query
def op1_bpe(spark: SparkSession, d: str) -> DataFrame:
    ranks = public_tokenizers.path(RANKS)
    docs = table(spark, d, "documents").select("doc_id", "text")
    return bpe_digests(bpe.encode_and_decode(docs, ranks))


def bpe_digests(coded: DataFrame) -> DataFrame:
    """Digests of `ids` and `decoded`."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


# --- 4: fingerprints -----------------------------------------------------------------------------


@query
def op4_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return edited_likeness(spark, docs)


def edited_likeness(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Fingerprints of texts, of texts edited with the next document, and their likeness."""
    marked = fingerprint.with_fingerprint(docs, F.col("text"), "fingerprint")
    placed = fingerprint.with_next(spark, marked, "doc_id", ["text", "fingerprint"])
    n_chars = F.char_length("text")
    half = F.floor(n_chars / 2).cast("int")
    edited = placed.select(
        "doc_id",
        n_chars.cast("long").alias("n_chars"),
        F.concat(
            F.substring("text", F.lit(1), n_chars - half), F.substring("next_text", F.lit(1), half)
        ).alias("edited"),
        "fingerprint",
        "next_fingerprint",
    )
    both = fingerprint.with_fingerprint(edited, F.col("edited"), "edited_fingerprint")
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        fingerprint.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        fingerprint.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


# --- 6: mixing -----------------------------------------------------------------------------------


@query
def op6_mix(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", n_words(F.col("text")).alias("size"))
    return mixing.mix(spark, docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op6_mix"] = r"""
WITH rows AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
        ('0x' || substr(md5(concat_ws('|', '20', coalesce(doc_id::VARCHAR, ''))), 1, 15))::BIGINT AS k
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        [5.0, 2.0, 1.0][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT]::DOUBLE AS w
    FROM rows GROUP BY source
), filled AS (
    SELECT *, 3.0::DOUBLE * source_size AS cap,
        ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(3.0::DOUBLE * source_size) OVER before, 0))
            / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
    FROM sources
    WINDOW before AS (ORDER BY 3.0::DOUBLE * source_size / w, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
    SELECT source, source_size, least(cap, max(level) OVER () * w) AS target FROM filled
), ordered AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM rows
), cut AS (
    SELECT o.doc_id, o.size, t.source_size, t.target, o.before,
        CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END::BIGINT AS epochs
    FROM ordered o JOIN targets t ON o.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
    (size * (epochs + CASE WHEN epochs < 3 AND 2 * before + size <= 2 * (target - epochs * source_size)
        THEN 1 ELSE 0 END))::BIGINT AS taken
FROM cut
"""


# --- 7: sharding ---------------------------------------------------------------------------------


@query
def op7_shard(spark: SparkSession, d: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, d, "documents").select(
        "doc_id",
        "source",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    keys = ("doc_id", "text_crc32", "size")
    return sharding.interleave(spark, docs, keys=keys).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


ORACLES["op7_shard"] = """
WITH steps AS MATERIALIZED (
    SELECT list_transform(range(256), lambda n: list_reduce([n, -1, -1, -1, -1, -1, -1, -1, -1],
        lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS t
), crcs AS MATERIALIZED (
    SELECT doc_id, source, (strlen(coalesce(text, '')) + 16)::BIGINT AS size,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
            regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT)),
            lambda crc, b: xor(crc >> 8, t[1 + (xor(crc, b) & 255)])), 4294967295::BIGINT) AS text_crc32
    FROM documents, steps
), shuffled AS (
    SELECT *, coalesce('=' || source, '') AS g, count(*) OVER () AS total, count(*) OVER (PARTITION BY source) AS n,
        ('0x' || substr(md5(concat_ws('|', '7', coalesce(doc_id::VARCHAR, ''), text_crc32::VARCHAR, size::VARCHAR)),
            1, 15))::BIGINT AS k
    FROM crcs
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY g ORDER BY k, doc_id, text_crc32, size) - 1 AS r FROM shuffled
), placed AS (
    SELECT *, row_number() OVER (ORDER BY (2 * r + 1)::DOUBLE / (2 * n)::DOUBLE, g, k, doc_id, text_crc32, size) - 1 AS place
    FROM ranked
)
SELECT doc_id, size, text_crc32, 'rows' AS law, (place * 40 // total)::INTEGER AS shard,
    (place - (place * 40 // total * total + 39) // 40)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM placed
"""


# --- 10: packed ids ------------------------------------------------------------------------------


@query
def op10_packed_ids(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    folder = packed_ids.id_folder(spark)
    files = packed_ids.write_ids(spark, docs, public_tokenizers.path(TOKENIZER), folder)
    return packed_ids.read_digests(spark, files, folder)


# --- 3: n-gram Jaccard join ----------------------------------------------------------------------


@query
def op3_jaccard(spark: SparkSession, d: str) -> DataFrame:
    return jaccard.link_components(spark, table(spark, d, "documents"))


ORACLES["op3_jaccard"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
    FROM words
), sized AS MATERIALIZED (SELECT doc_id, len(s)::BIGINT AS n, s FROM sets
), flat AS MATERIALIZED (SELECT doc_id, n, unnest(s) AS g FROM sized
), linked AS MATERIALIZED (
    SELECT a.doc_id AS u, b.doc_id AS v FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach(u, v) AS (
    SELECT doc_id, doc_id FROM sized
    UNION SELECT r.u, l.v FROM reach r JOIN linked l ON r.v = l.u
)
SELECT s.doc_id, s.n AS n_shingles, min(r.v) AS component_id
FROM sized s JOIN reach r ON r.u = s.doc_id GROUP BY s.doc_id, s.n
"""


# --- 2: exact top-k search -----------------------------------------------------------------------


@query
def op2_topk(spark: SparkSession, d: str) -> DataFrame:
    return topk.top_k(spark, table(spark, d, "embeddings"))


ORACLES["op2_topk"] = """
WITH usable AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND NOT list_bool_or(list_transform(embedding,
        lambda x: x IS NULL OR NOT isfinite(x)))
), scored AS (
    SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND q.r <> c.r
), ranked AS (
    SELECT query_id, vec_id, score,
        row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


# --- 5: language ID ------------------------------------------------------------------------------


def fold(parts: int):
    """crc32 of the id as text, modulo `parts`."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


@query
def op5_langid(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    model = langid.train(spark, docs.filter(fold(4) != 2).select("doc_id", "text", "lang"))
    found = langid.predict(spark, docs.select("doc_id", "text"), model)
    return found.select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score")


# --- 8: toxicity ---------------------------------------------------------------------------------


@query
def op8_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    model = toxicity.train(spark, docs, table(spark, d, "labels").filter(fold(3) != 1))
    found = toxicity.score(spark, docs, model)
    return found.select("doc_id", (fold(3) == 1).alias("held_out"), "score", "predicted")


# --- 9: substring dedup --------------------------------------------------------------------------


@query
def op9_passages(spark: SparkSession, d: str) -> DataFrame:
    return passages.repeated_passages(spark, table(spark, d, "documents")).drop("cls")


# --- 11: vector code compression -----------------------------------------------------------------


@query
def op11_cover_codes(spark: SparkSession, d: str) -> DataFrame:
    coded = cover_codes.compress(spark, table(spark, d, "embeddings").select("vec_id", "embedding", "label"))
    digest = hashlib.sha256(",".join(map(str, coded.codebooks.ravel().tolist())).encode()).hexdigest()
    return cover_codes.error_of_groups(coded.rows, "label", "label_error").select(
        "vec_id",
        F.array_join(F.transform("code", lambda e: F.lpad(F.lower(F.hex(e)), 2, "0")), "").alias("code"),
        "error",
        "label_error",
        F.lit(digest).alias("codebooks_sha256"),
    )


def _codebook_round(before: str, after: str) -> str:
    """Parts assigned to the entries of `before`, and the entries they give."""
    return f"""{after}_assigned AS MATERIALIZED (
    SELECT r, p, arg_min(e, (distance << 8) + e) AS e, min(distance) AS distance
    FROM (SELECT t.r, t.p, c.e, list_sum(list_transform(list_zip(t.x, c.x),
            lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance
        FROM parts t JOIN {before} c USING (p))
    GROUP BY r, p
), {after} AS MATERIALIZED (
    SELECT p, e, coalesce(n.x, c.x) AS x FROM {before} c LEFT JOIN (
        SELECT p, e, list(m ORDER BY k) AS x FROM (
            SELECT p, e, k, floor(sum(y)::DOUBLE / count(*))::BIGINT AS m
            FROM (SELECT p, e, unnest(x) AS y, generate_subscripts(x, 1) AS k
                FROM {after}_assigned JOIN parts USING (r, p))
            GROUP BY p, e, k)
        GROUP BY p, e) n USING (p, e)
)"""


ORACLES["op11_cover_codes"] = f"""
WITH usable AS MATERIALIZED (
    SELECT *, row_number() OVER (ORDER BY vec_id, v) - 1 AS r FROM (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND NOT list_bool_or(list_transform(embedding,
            lambda x: x IS NULL OR NOT isfinite(x))))
), parts AS MATERIALIZED (
    SELECT r, p, v[p * len(v) // 16 + 1 : (p + 1) * len(v) // 16] AS x FROM usable, range(16) AS t(p)
), start AS MATERIALIZED (SELECT p, r AS e, x FROM parts WHERE r < 64
), {_codebook_round("start", "one")}, {_codebook_round("one", "two")}, {_codebook_round("two", "last")}, coded AS (
    SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(distance)::BIGINT AS error
    FROM last_assigned GROUP BY r
), books AS (
    SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM two
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN usable USING (r), books
"""


# --- 12: Merkle dataset manifest -----------------------------------------------------------------

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@query
def op12_merkle(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    fields = ["doc_id", "source", "lang", "n_chars"]
    changed = merkle.leaf(*map(F.col, fields), F.translate("text", UPPER, UPPER.lower()))
    rows = docs.select(
        "doc_id",
        "source",
        merkle.leaf(*map(F.col, fields), F.col("text")).alias("digest"),
        F.when(fold(5) == 0, changed).alias("tampered"),
    )
    found = merkle.manifest(spark, rows, "source", ["doc_id"], "digest")
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("steps"))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("steps")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _field(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


def _trees(nodes: str, leaves: str) -> str:
    """All nodes of trees, with the siblings on both sides of each."""
    run = "PARTITION BY tree, level, pos // 16 ORDER BY pos ROWS BETWEEN"
    return f"""{nodes}_all(tree, level, pos, n, h) AS (
    SELECT tree, 0, pos, n, h FROM {leaves}
    UNION ALL
    SELECT tree, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY pos))
    FROM {nodes}_all WHERE n > 1 GROUP BY tree, level, pos // 16, n
), {nodes} AS MATERIALIZED (
    SELECT *, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
        coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM {nodes}_all
)"""


# crc32 bit by bit: a byte is mixed in, then eight steps (-1) follow.
_CRC_OF_ID = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
        string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda crc, b: CASE WHEN b >= 0 THEN xor(crc, b) WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384::BIGINT)
        ELSE crc >> 1 END), 4294967295::BIGINT)"""

ORACLES["op12_merkle"] = f"""
WITH RECURSIVE rows AS MATERIALIZED (
    SELECT *, row_number() OVER () AS id, count(*) OVER (PARTITION BY tree) AS n,
        row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS pos
    FROM (SELECT doc_id, source AS tree, {_leaf("text")} AS h, CASE WHEN {_CRC_OF_ID} % 5 = 0
            THEN {_leaf(f"translate(text, '{UPPER}', '{UPPER.lower()}')")} END AS tampered
        FROM documents)
), {_trees("nodes", "rows")}, subroots AS MATERIALIZED (
    SELECT 0 AS tree, tree AS name, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos, h,
        count(*) OVER () AS n
    FROM nodes WHERE n = 1
), {_trees("tops", "subroots")}, below(id, level, pos, h, proof) AS (
    SELECT id, 0, pos, coalesce(tampered, h), '' FROM rows
    UNION ALL
    SELECT b.id, b.level + 1, b.pos // 16, sha256(x.l || b.h || x.r), b.proof || x.l || x.r
    FROM below b JOIN rows USING (id)
    JOIN nodes x ON x.tree IS NOT DISTINCT FROM rows.tree AND x.level = b.level AND x.pos = b.pos AND x.n > 1
), top_rows AS (
    SELECT id, 0 AS level, s.pos, b.h, b.proof
    FROM (SELECT id, arg_max(h, level) AS h, arg_max(proof, level) AS proof FROM below GROUP BY id) b
    JOIN rows USING (id) JOIN subroots s ON s.name IS NOT DISTINCT FROM rows.tree
), above(id, level, pos, h, proof) AS (
    SELECT * FROM top_rows
    UNION ALL
    SELECT a.id, a.level + 1, a.pos // 16, sha256(x.l || a.h || x.r), a.proof || x.l || x.r
    FROM above a JOIN tops x ON x.level = a.level AND x.pos = a.pos AND x.n > 1
), folded AS (SELECT id, arg_max(h, level) AS folded_root, arg_max(proof, level) AS proof FROM above GROUP BY id
), root AS (SELECT h AS root FROM tops WHERE n = 1)
SELECT doc_id, rows.h AS leaf, s.h AS subroot, root, sha256(proof) AS proof_sha256, folded_root,
    folded_root = root AS verified
FROM rows JOIN folded USING (id) JOIN subroots s ON s.name IS NOT DISTINCT FROM rows.tree, root
"""


# --- 13: best-fit packing ------------------------------------------------------------------------


@query
def op13_packing(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    packed = packing.pack(spark, docs, public_tokenizers.path(TOKENIZER), keep_ids=False)
    return packed.select(
        "doc_id",
        F.col("piece").cast("int").alias("piece"),
        "start",
        "length",
        "ids_crc32",
        "sequence_id",
        "offset",
    )
