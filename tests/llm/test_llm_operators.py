"""The dealt operators on small tables with nulls, empty and long texts, ties, repeated rows and clashing names."""

from __future__ import annotations

import base64
import hashlib
import random
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

import corpus_pipeline  # noqa: E402
from seriesmart.llm import (  # noqa: E402
    bpe,
    fingerprint,
    jaccard,
    langid,
    mixing,
    packed_ids,
    passages,
    sharding,
    topk,
    toxicity,
)
from seriesmart.llm.library_ids import load  # noqa: E402
from seriesmart.llm.pieces import units  # noqa: E402
from seriesmart.llm.shingles import Runs, shingle_set, shingles  # noqa: E402

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, score string, shard int"
WORDS = " ".join(f"wort{k}x" for k in range(400))
ROWS = [
    (1, WORDS, "de", "a", 1, "x", "y", 7),
    (2, WORDS.replace("wort5x", "other"), "de", "a", 1, "x", "y", 7),
    (2, WORDS.replace("wort5x", "other"), "de", "a", 1, "x", "y", 7),
    (3, None, None, None, None, None, None, None),
    (4, "", "en", "b", 0, "x", "y", 7),
    (5, "123 456 !!!", "en", "b", 0, "x", "y", 7),
    (None, "No id here, but a text.", "en", None, 3, None, None, None),
    (6, "é" * 3000 + " \n\t  x" + "ab" * 900, "fr", "b", 9, "x", "y", 7),
    (7, "other start here " + " ".join(f"wort{k}x" for k in range(100, 170)) + " and an end", "de", "c", 9, "x", "y", 7),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_is_tiktoken(docs, none):
    encoding = reference()
    rows = bpe.decode(bpe.encode(docs, RANKS), RANKS).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert r.ids == encoding.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    both = bpe.encode_and_decode(docs, RANKS).select("doc_id", "ids", "decoded")
    assert both.exceptAll(bpe.decode(bpe.encode(docs, RANKS), RANKS).select(*both.columns)).count() == 0
    assert bpe.encode(none, RANKS).count() == 0


def test_units_are_the_text():
    for text in ("a b", " a  b\n c", "　x y ", "", "a  b"):
        assert "".join(units(text)) == text


def test_packing_round_trips():
    rng = np.random.default_rng(1)
    for bits in (1, 7, 16, 17, 31, 32):
        ids = rng.integers(0, 1 << bits, 1001, dtype=np.uint64).astype(np.uint32)
        data = packed_ids.pack(ids.astype(np.int64), bits)
        assert (packed_ids.unpack(data, bits, 1001) == ids).all()
        assert (packed_ids.unpack(data, bits, 300, 77) == ids[77:377]).all()


def test_id_files_are_the_library_in_order(spark, docs, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = load(path)
    odd = [(9, "x  <|endoftext|> y"), (9, "a\n\nb \n c\nd"), (10, "e\tf\n"), (11, "one\ntwo three\nfour"), (None, "null\nid")]
    extra = spark.createDataFrame(odd, "doc_id long, text string")
    folder = packed_ids.id_folder(spark)
    both = docs.select("doc_id", "text").union(extra)
    files = packed_ids.write_ids(spark, both, path, folder)
    rows = sorted(packed_ids.read_ids(spark, files, folder).collect(), key=lambda r: r.start)
    texts = [(r[0], r[1] or "") for r in ROWS] + odd
    assert [r.doc_id for r in rows] == sorted([d for d, _ in texts], key=lambda d: (d is not None, d))
    ids = [(d, (*library.encode(t, add_special_tokens=False).ids, 0)) for d, t in texts]
    assert sorted(map(repr, ids)) == sorted(repr((r.doc_id, tuple(r.ids))) for r in rows)
    assert 50256 in [i for r in rows for i in r.ids]
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids)
        at += r.n_tokens
    empty = packed_ids.write_ids(spark, none, path, packed_ids.id_folder(spark))
    assert empty.count() == 0


def test_long_texts_are_coded_whole():
    b = bpe.Bpe(RANKS, public_tokenizers.PATTERN)
    text = "wort und " * 150_000 + "ab" * 5_000
    flat, counts = b.cache.encode_texts([text, "", "x y"])
    assert flat[: counts[0]].tolist() == reference().encode_ordinary(text)
    assert b.decode(flat, counts) == [text.encode(), b"", b"x y"]
    many = np.full(3_000_000, 64, np.int32)
    assert b.decode(many, np.array([0, 3_000_000])) == [b"", b"a" * 3_000_000]


def brute_components(rows):
    sets = {r[0]: set(shingle_set(r[1]).tolist()) for r in rows if r[0] is not None}
    label = {d: d for d in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if sets[a] and 100 * both >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    return label, sets


def test_jaccard_components(spark, docs, none):
    label, sets = brute_components(ROWS)
    rows = jaccard.link_components(spark, docs).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert r.component_id == (label[r.doc_id] if r.doc_id is not None else None)
        if r.doc_id is not None:
            assert r.n_shingles == len(sets[r.doc_id])
    assert jaccard.link_components(spark, none).count() == 0


def test_passages(spark, docs, none):
    found = passages.repeated_passages(spark, docs)
    rows = {(r.doc_id, r.first_doc_id): r for r in found.collect()}
    assert set(rows) == {(2, 1), (7, 1)} or set(rows) == {(2, 1), (7, 1), (7, 2)}
    assert (rows[7, 1].word_start, rows[7, 1].word_end) == (3, 73)
    kept = {r.doc_id: r.text for r in passages.without_passages(spark, docs, found).collect()}
    assert kept[7] == "other start here and an end" and kept[1] == WORDS
    assert kept[3] is None and kept[4] == "" and None in kept
    assert passages.repeated_passages(spark, none).count() == 0


def test_jaccard_of_pages_near_the_limit(spark):
    """Pages of one template just below and just above the limit, in sizes that differ a little too."""
    rng = np.random.default_rng(6)
    template = [f"t{k}" for k in range(400)]

    def page(k, own):
        words = list(template)
        for at in range(own):
            words.insert(int(rng.integers(0, len(words))) if at % 2 else 17 * at % len(words), f"p{k}x{at}")
        return words

    rows = [(k, " ".join(page(k, 3 + k % 9)), "z") for k in range(1, 70)]
    rows += [(k, " ".join([*template[: 300 + k % 5], *[f"own{k}x{i}" for i in range(33 + k % 7)]]), "z") for k in range(70, 140)]
    label, _ = brute_components(rows)
    found = jaccard.link_components(spark, spark.createDataFrame(rows, "doc_id long, text string, cls string"))
    assert {r.doc_id: r.component_id for r in found.collect()} == label
    assert 1 < len(set(label.values())) < len(rows)


def test_sets_without_room_are_never_linked_with_each_other():
    for percent in (50, 80, 90):
        for n in range(1, 26):
            for m in range(1, 26):
                for pos in range(n):
                    for at in range(m):
                        shared = min(n - pos, m - at)
                        fits = 100 * min(n, m) >= percent * max(n, m)
                        if fits and 100 * shared >= percent * (n + m - shared):
                            assert jaccard._roomy(percent, n, pos) or jaccard._roomy(percent, m, at)


def test_fragments_are_ranges_of_the_order():
    level = np.random.default_rng(1).integers(0, 4000, 1 << jaccard.COUNTER_BITS).astype(np.uint16)
    cuts = jaccard._cuts(level)
    assert len(cuts) == jaccard.FRAGMENTS - 1 and (np.diff(cuts.astype(float)) > 0).all()
    weights = 2.0 ** (level / 1000) - 1
    lowest = np.arange(len(level), dtype=np.uint64) << np.uint64(64 - jaccard.COUNTER_BITS)
    share = np.bincount(np.searchsorted(cuts, jaccard._order_key(lowest, level), "right"), weights) / weights.sum()
    assert np.allclose(share, 1 / jaccard.FRAGMENTS, atol=0.001)


def passage_words(name, n):
    return [f"{name}{k}" for k in range(n)]


def test_passages_elsewhere_in_the_other_text():
    """Joined passages and swapped paragraphs: what is far from the line of one passage is another."""
    p, q, r = (passage_words(name, 60) for name in "pqr")
    apart = [*p, *passage_words("x", 840), *q]
    swapped = [*p, *passage_words("x", 300), *q, *passage_words("y", 300), *r]
    for first, second in ((apart, [*p, *q]), (apart, [*q, *p]), (swapped, [*r, *q, *p]), (swapped, [*q, *r, *p])):
        b, a = (passages._tokens(" ".join(t)) for t in (first, second))
        sent = passages.received(passages.sent(b))
        rows = passages.common_passages(a, np.arange(len(b)), sent, [(0, len(a) - 1)], 46, 80)
        gone = {k for s, e, *_ in rows for k in range(s, e + 4)}
        assert gone == set(range(len(second)))


def test_texts_of_a_batch_are_tokenized_and_windowed_together(monkeypatch):
    """One call for many texts (before: one for each) gives what each gives alone."""
    r = random.Random(7)
    texts = [" ".join(f"W{r.randint(0, 60)}" for _ in range(r.randint(50, 300))) for _ in range(60)]
    texts += ["", " \t ", "Ä\u00a0b \x0b" + texts[0] + "\r\n", " ".join(["line of five words here"] * 40), "a " * 49]
    columns = [pa.array(range(len(texts))), pa.array(range(len(texts))), pa.array(texts)]
    batch = pa.RecordBatch.from_arrays(columns, names=["doc", "cls", "text"])
    rows = pa.Table.from_batches(passages._tokenize(46)(iter([batch.slice(0, 7), batch.slice(7)]))).to_pylist()
    alone = [passages._tokens(t) for t in texts]
    kept = [k for k, tokens in enumerate(alone) if len(tokens) >= 46]
    assert [(row["doc"], row["n"], row["tokens"]) for row in rows] == [(k, len(alone[k]) + 4, passages.sent(alone[k])) for k in kept]

    calls, plain = [], passages.compact_windows
    monkeypatch.setattr(passages, "compact_windows", lambda *a: calls.append(0) or plain(*a))
    tokens = pa.RecordBatch.from_arrays([pa.array([row[n] for row in rows]) for n in ("doc", "cls", "tokens")], names=["doc", "cls", "tokens"])
    found = pa.Table.from_batches(passages._windows(46)(iter([tokens]))).to_pylist()
    assert len(calls) == 1
    expected = []
    for k in kept:
        v = passages.mix(alone[k][None, :] ^ passages.SEEDS[: passages.HASHES, None])
        for number, values in enumerate(v.tolist()):
            # The least position of each run, the first of equal ones above it: windows that a run has as its own.
            for c, x in enumerate(values):
                l = max((i + 1 for i in range(c) if values[i] <= x), default=0)
                e = min((i for i in range(c + 1, len(values)) if values[i] < x), default=len(values))
                if e - l >= 46:
                    expected.append((k, l << 32 | e - 1, c << 1 | number))
    assert sorted((w["doc"], w["span"], w["at"]) for w in found) == sorted(expected)


def test_runs_are_hashed_at_places():
    words = np.random.default_rng(3).integers(0, 1 << 63, 400).astype(np.uint64)
    for width in (1, 12, 24, 46):
        at = np.arange(0, 401 - width, 7)
        assert (Runs(words).at(at, width) == shingles(words, width)[at]).all()


def test_common_passages_of_texts_that_repeat_tokens():
    """Counterparts are the nearest to the line, and similarities those of the sets of tokens."""
    r, found = random.Random(5), 0
    for _ in range(40):
        first = [r.choice(["p", "q", f"w{r.randint(0, 400)}"]) for _ in range(400)]
        copy = [f"x{r.randint(0, 9)}" if r.random() < 0.01 else w for w in first[50:250] + first[200:380]]
        a, b = (passages._tokens(" ".join(t)) for t in (copy, first))
        at = np.sort(np.array(r.sample(range(len(b)), 350)))
        for places in (np.arange(len(b)), at):
            for s, e, p, q, near in passages.common_passages(a, places, b[places], [(0, 120), (125, len(a) - 1)], 46, 50):
                one, two = set(a[s:e].tolist()), set(b[places][(places >= p) & (places < q)].tolist())
                assert near == len(one & two) / len(one | two) >= 0.5 and e - s >= 46
                found += 1
    assert found > 80


def frequent_lines():
    """Two lines of words with the least tokens of all three hashes; windows around a line have its values."""
    rng, least = np.random.default_rng(5), ([], [])
    words = rng.integers(0, 10**9, (100_000, 5))
    tokens = np.array([passages._tokens(" ".join(f"f{w}" for w in row))[0] for row in words.tolist()], np.uint64)
    for seed in passages.SEEDS:
        for line, k in zip(least, np.argsort(passages.mix(tokens ^ seed)), strict=False):
            line += [f"f{w}" for w in words[k]]
    return least


def around(name, line):
    """A passage whose only windows are those of the line."""
    return [*passage_words(name, 30), *line, *passage_words(f"{name}end", 30)]


def words_left(spark, texts):
    """Words of each document, from 1 on, outside passages found in it."""
    rows = [(k, " ".join(t)) for k, t in enumerate(texts, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = {k: set(range(len(t))) for k, t in enumerate(texts, 1)}
    for r in passages.repeated_passages(spark, df).collect():
        left[r.doc_id] -= set(range(r.word_start, r.word_end))
    return left


def test_passages_of_repeated_phrases(spark):
    """A phrase that a document has twice hides none of its passages, exact or near."""
    less, line = frequent_lines()
    p = around("p", line)
    edited = [*p[:10], "edited", *p[11:]]
    texts = [[*around(a, line), *around(b, less), *p] for a, b in ("ux", "vy")]
    texts[1:1] = [p, edited]
    left = words_left(spark, texts)
    assert not left[2] and not left[3]
    assert left[4] == set(range(len(texts[3]) - len(p)))


def brute_left(texts, words=50):
    """Words of each document outside runs of `words` words that an earlier document has."""
    seen, left = set(), {}
    for k, t in enumerate(texts, 1):
        runs = [tuple(t[i : i + words]) for i in range(len(t) - words + 1)]
        gone = {w for i, run in enumerate(runs) if run in seen for w in range(i, i + words)}
        left[k] = set(range(len(t))) - gone
        seen.update(runs)
    return left


def test_passages_against_brute_force(spark):
    """Mixed buckets, repeated phrases, parts of passages and swapped paragraphs: no exact run is missed."""
    less, line = frequent_lines()
    p, q, r = (around(name, line) for name in "pqr")
    texts = [[f"own{k}", *t] for k, t in enumerate((p, q, r, q, r, q))]
    texts += [[*p[:52], "a"], ["b", *q[-51:], "c"], [*r[3:60], "d", *q[:55]], [*r, *less, *q, *p]]
    texts += [[*passage_words("x", 60), *less, *p[10:70], *passage_words("y", 60)], [*passage_words("y", 60), *q[5:56], *passage_words("x", 60)]]
    rng = np.random.default_rng(3)
    pool = [*p, *less, *q, *passage_words("x", 60), *r]
    for k in range(25):
        cuts = [(int(a), int(a + n)) for a, n in zip(rng.integers(0, 230, 4), rng.integers(20, 90, 4), strict=True)]
        texts.append([w for i, (a, b) in enumerate(cuts) for w in (f"cut{k}n{i}", *pool[a:b])])
    found, exact = words_left(spark, texts), brute_left(texts)
    assert [len(found[k]) for k in range(1, 7)] == [76, 76, 76, 1, 1, 1]
    # Near passages may take more words.
    assert all(found[k] <= exact[k] for k in exact)


def test_near_copies_of_passages_that_share_a_line(spark):
    """Eight passages around one frequent line, then a copy of each with one word changed."""
    less, line = frequent_lines()
    own = [around(f"own{k}", line) for k in range(8)]
    copies = [[*p[:10], f"edited{k}", *p[11:]] for k, p in enumerate(own)]
    left = words_left(spark, own + copies)
    assert [len(left[k]) for k in range(9, 17)] == [0] * 8


def test_near_copies_beside_an_unlike_first(spark):
    """A near copy whose only common bucket begins with a text that has the same 22 words, and no more."""
    block = [*passage_words("l", 12), *frequent_lines()[1][:10]]
    first, own = ([*passage_words(n, 20), *block, *passage_words(f"{n}end", 33)] for n in "ab")
    copy = [*own[:44], "edited", *own[45:]]
    left = words_left(spark, [first, own, copy])
    assert [len(left[k]) for k in (1, 2, 3)] == [75, 75, 0]


def test_windows_that_cannot_be_similar_are_not_met():
    """The bound loses no pair that has a passage, with repeated words too, and keeps none that shares a line only."""
    rng = np.random.default_rng(11)
    for k in range(300):
        text = [f"w{x}" for x in rng.integers(0, 400, 90)]
        if k % 3 == 0:
            text = [w for w in text[:30] for _ in range(int(rng.integers(1, 9)))]
        if k % 7 == 0:
            text = [*text[:40], *text[:50]]
        copy = list(text)
        for at in rng.integers(0, len(text), k % 5):
            copy[at : at + int(rng.integers(0, 2))] = [f"edit{at}"] * int(rng.integers(0, 2))
        unlike = [*passage_words(f"u{k}", 30), *text[20:40], *passage_words(f"v{k}", 30)]
        windows = [passages._tokens(" ".join(t)) for t in (copy, unlike, text[30:], copy[:70])]
        own = passages._tokens(" ".join(text))
        met = set(passages.Members(windows).similar(own, 4, 46, 80).tolist())
        assert 3 not in passages.Members(windows).similar(own, 3, 46, 80)
        for i, theirs in enumerate(windows):
            if passages.common_passages(own, np.arange(len(theirs)), theirs, [(0, len(own) - 1)], 46, 80):
                assert i in met
        assert k % 3 == 0 or k % 7 == 0 or 1 not in met


def test_groups_over_batches():
    keys = [0, 0, 1, 2, 2, 2, 2, 3, 3, 4]
    whole = pa.RecordBatch.from_pydict({"side": keys, "block": [k // 2 for k in keys], "at": list(range(10))})
    for n in (1, 2, 3, 4, 10):
        parts = [whole.slice(k, n) for k in range(0, 10, n)]
        found = [g.column("at").to_pylist() for g in passages._groups([*parts, whole.slice(0, 0)], ("side", "block"))]
        assert found == [[0, 1], [2], [3, 4, 5, 6], [7, 8], [9]]


def test_open_windows_of_large_buckets_meet_in_blocks(spark, monkeypatch):
    """A near copy of the second of three texts around a line finds it, also if each block has one document."""
    less, line = frequent_lines()
    a, b, c = (around(name, [*line[:5], *line]) for name in "abc")
    copy = [*b[:10], "edited", *b[11:]]
    for block in (500, 1):
        monkeypatch.setattr(passages, "BLOCK", block)
        found = words_left(spark, [a, b, c, copy])
        assert [len(found[k]) for k in range(1, 5)] == [len(a), len(b), len(c), 0]


def test_recall_of_near_passages(spark):
    """Passages of 60 to 120 words with edits, at the limit of similarity too, in texts of their own and mixed lines."""
    rng = np.random.default_rng(8)
    less, line = frequent_lines()
    words = [f"v{k}" for k in range(3000)]

    def text(n):
        return [words[k] for k in rng.integers(0, len(words), n)]

    texts, edited, asked = [], [], 0
    for k in range(120):
        p = text(int(rng.integers(60, 120)))
        if k % 3 == 0:
            p = [*p[:30], *line, *p[30:]]
        q = list(p)
        for at in rng.integers(2, len(p) - 2, 1 + k % 2):
            q[at] = f"edit{k}"
        a, b = (set(passages._tokens(" ".join(t)).tolist()) for t in (p, q))
        texts.append([*text(40), *p, *text(40)])
        edited.append([*text(40), *q, *text(40)] if 100 * len(a & b) >= 80 * len(a | b) else None)
    left = words_left(spark, texts + [e for e in edited if e])
    caught = 0
    for k, e in enumerate([e for e in edited if e], len(texts) + 1):
        passage = set(range(45, len(e) - 45))
        caught += len(passage & left[k]) <= 0.2 * len(passage)
        asked += 1
    assert asked > 80 and caught >= 0.9 * asked


def test_topk_against_brute_force(spark):
    rng = np.random.default_rng(2)
    v = {i: rng.normal(size=8).astype(np.float32) for i in range(300)}
    v[7] = v[9]
    rows = [(i, [float(x) for x in x8], "z") for i, x8 in v.items()]
    rows += [(500, None, "z"), (600, [float("nan")] * 8, "z"), (700, [1.0, None], "z"), (None, [1.0] * 8, "z")]
    rows += [(i, rows[j][1], "z") for i, j in ((0, 0), (100, 9), (5, 250))]  # ids of several rows, one as a whole
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string")
    found = sorted(tuple(r) for r in topk.top_k(spark, df).collect())
    usable = [(i, np.floor(1024 * np.array(x, np.float32).astype(float)).astype(int)) for i, x, _ in rows
              if i is not None and x is not None and all(c is not None and np.isfinite(c) for c in x)]
    expected = []
    for at, (i, a) in enumerate(usable):
        if i % 100 == 0:
            best = sorted((-int(a @ b), j) for k, (j, b) in enumerate(usable) if k != at and len(b) == len(a))[:10]
            expected += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    assert found == sorted(expected) and len([r for r in found if r[0] == 0]) == 20
    assert topk.top_k(spark, df.limit(0)).count() == 0


def test_topk_of_many_lengths(spark):
    """Dimensions without pivots are searched by norms alone, as exactly."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=1 + i % 23)]) for i in range(0, 2300, 10)]
    found = topk.top_k(spark, spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=3).collect()
    whole = {i: np.floor(1024 * np.array(x)).astype(int) for i, x in rows}
    expected = []
    for i in whole:
        if i % 100 == 0:
            best = sorted((-int(whole[i] @ v), j) for j, v in whole.items() if j != i and len(v) == len(whole[i]))[:3]
            expected += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    assert sorted(map(tuple, found)) == sorted(expected)


def test_fingerprints(spark, docs, none):
    rows = fingerprint.with_fingerprint(docs, F.col("text"), "fingerprint").collect()
    by = {r.doc_id: r.fingerprint for r in rows}
    assert by[3] == by[4] == "" and len(by[1]) == fingerprint.BINS * fingerprint.DIGITS
    pairs = spark.createDataFrame([(by[1], by[2]), (by[1], by[1]), (by[3], by[1]), (by[3], by[4])], "a string, b string")
    near = [r[0] for r in pairs.select(fingerprint.likeness(F.col("a"), F.col("b"))).collect()]
    assert 0.85 < near[0] <= 1 and near[1:] == [1.0, 0.0, 1.0]
    placed = fingerprint.with_next(spark, docs.select("doc_id", "text"), "doc_id", ["text"])
    following = {r.doc_id: r.next_text for r in placed.collect()}
    texts = {r[0]: r[1] for r in ROWS}
    assert following[7] == texts[6] and following[1] == texts[None] and following[None] == texts[7]
    assert fingerprint.with_next(spark, none.select("doc_id", "text"), "doc_id", ["text"]).count() == 0


def test_mix_meets_targets(spark, none):
    rows = [(k, "abc"[k % 3] if k % 7 else None, 1 + k % 11, k) for k in range(900)] + [(1000, "abc", None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long, target long")
    found = mixing.mix(spark, df).collect()
    assert len(found) == len(rows)
    for source in {r.source for r in found}:
        own = [r for r in found if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 11
        assert all(r.repeats <= 3 for r in own) and own[0].target <= 3 * own[0].source_size
    total = sum({r.source: r.target for r in found}.values())
    assert total == pytest.approx(sum(r[2] or 0 for r in rows))
    assert sorted(map(repr, found)) == sorted(map(repr, mixing.mix(spark, df).collect()))
    assert mixing.mix(spark, none.withColumn("size", F.lit(1))).count() == 0


def test_shards_match_the_mixture(spark, docs, none):
    rows = [(k, "a" if k % 3 else None, 5) for k in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, slot int")
    found = sharding.interleave(spark, df, 7).collect()
    for s in range(7):
        own = [r for r in found if r.shard == s]
        assert len(own) in (142, 143) and sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.source is None for r in own) - len(own) / 3) <= 2
    assert sharding.interleave(spark, docs).count() == len(ROWS)
    assert sharding.interleave(spark, none).count() == 0


def test_languages(spark, docs, none):
    rows = [(k, f"the and of thing {k} with that " * 5 if k % 2 else f"der die das und {k} nicht ein " * 5,
             "en" if k % 2 else "de") for k in range(60)]
    model = langid.train(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    own = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    found = langid.predict(spark, own, model).collect()
    assert all(r.lang_pred == ("en" if r.doc_id % 2 else "de") and 0.5 < r.score <= 1 for r in found)
    other = {r.doc_id: r.lang_pred for r in langid.predict(spark, docs, model).collect()}
    assert other[3] == other[4] == other[5] == "und" and other[6] != "und"
    assert langid.train(spark, none) is None and langid.predict(spark, docs, None).count() == len(ROWS)


def test_toxicity(spark, docs, none):
    rows = [(k, f"you are an idiot and word{k}" if k % 4 == 0 else f"a plain text of word{k} here") for k in range(120)]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(100)] + [(None, 1)], "doc_id long, toxic int")
    model = toxicity.train(spark, texts, labels)
    assert all(r.predicted == (r.doc_id % 4 == 0) for r in toxicity.score(spark, texts, model).collect())
    assert toxicity.score(spark, docs, model).count() == len(ROWS)
    assert toxicity.train(spark, none, labels) is None
    matcher = toxicity.Matcher([("idiot", False), ("worthless", False)])
    assert matcher.match("idoit") is None and matcher.match("idot") == (1, 0) and matcher.match("wortless") == (1, 1)


def test_a_stem_leaves_its_word_its_edits():
    for entries in ([("idiot", False), ("idiot", True)], [("idiot", True), ("idiot", False)]):
        matcher = toxicity.Matcher(entries)
        assert matcher.match("idot")[0] == matcher.match("idjot")[0] == 1
        assert matcher.match("idiot")[0] == matcher.match("idiots")[0] == 0 and matcher.match("idots") is None


def test_pipeline_takes_odd_rows(spark, docs):
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        before = kept.columns
        kept = spark.createDataFrame(stage(spark, kept, "").collect(), stage(spark, kept, "").schema)
        if name != "bpe":
            assert kept.columns == before
    assert kept.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert hashlib.sha256(b"").hexdigest() not in {r.decoded_sha256 for r in kept.collect()}
