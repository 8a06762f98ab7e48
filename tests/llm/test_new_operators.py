"""Cover-tree codes, the Merkle manifest and packing against brute force, on odd rows too."""

from __future__ import annotations

import random
import sys
import zlib
from collections import Counter, defaultdict
from hashlib import sha256
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

from seriesmart.llm import cover_codes, merkle, packing  # noqa: E402
from seriesmart.llm.library_ids import load  # noqa: E402

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


# --- Cover-tree codes ----------------------------------------------------------------------------


def points(n: int, width: int, spread: int, seed: int) -> np.ndarray:
    r = np.random.default_rng(seed)
    centres = r.integers(-spread, spread, (5, width))
    return centres[r.integers(0, 5, n)] + r.integers(-spread // 8 - 1, spread // 8 + 2, (n, width))


@pytest.mark.parametrize("n,width,spread", [(1, 4, 10), (17, 1, 3), (3000, 4, 256), (2000, 2, 4), (500, 6, 100_000)])
def test_assignment_of_subtrees_is_the_nearest_entry(n, width, spread):
    data = points(n, width, spread, n)
    tree = cover_codes.Tree.load(cover_codes.build(data).dump())
    assert sorted(tree.order.tolist()) == list(range(n))
    assert (tree.points == data[tree.order]).all()
    for i in range(len(tree.low)):  # covering: everything within reach, children cover their parent's points
        within = cover_codes.squared(tree.points[tree.low[i] : tree.high[i]], tree.points[tree.low[i]])
        assert within.max() == tree.reach[i]
        kids = range(tree.first[i], tree.first[i] + tree.children[i])
        if kids:
            assert [tree.low[k] for k in kids] == [tree.low[i], *[tree.high[k] for k in kids][:-1]]
            assert tree.high[kids[-1]] == tree.high[i] and all(4 * tree.reach[k] <= tree.reach[i] for k in kids)
    for entries in (data[:1], data[: min(n, 64)], np.concatenate([data[:3], data[:3]])):
        found = cover_codes.Assignment(tree, entries)
        far = ((data[:, None, :] - entries[None]) ** 2).sum(-1)
        nearest = far.argmin(1)
        assert (found.labels == nearest[tree.order]).all()
        for e in range(len(entries)):
            assert found.counts[e] == (nearest == e).sum()
            assert (found.sums[e] == data[nearest == e].sum(0)).all()


def test_subtrees_spare_comparisons():
    data = points(8000, 4, 2000, 3)
    found = cover_codes.Assignment(cover_codes.build(data), np.stack([data[data[:, 0].argmin()], data[data[:, 0].argmax()]]))
    assert found.compared < len(data)


def brute_codes(vectors, parts, entries, rounds):
    width = max(1, -(-max(map(len, vectors)) // parts))
    whole = np.zeros((len(vectors), parts * width), np.int64)
    for row, v in zip(whole, vectors):
        row[: len(v)] = [int(np.floor(256 * float(x))) for x in v]
    whole = whole.reshape(len(vectors), parts, width)
    books = whole[:entries].transpose(1, 0, 2).copy()
    for last in range(rounds + 1):
        far = ((whole[:, :, None, :] - books[None]) ** 2).sum(-1)
        code, error = far.argmin(2), far.min(2).sum(1)
        if last < rounds:
            for p in range(parts):
                for e in range(books.shape[1]):
                    own = whole[code[:, p] == e, p]
                    if len(own):
                        books[p, e] = [int(t) // len(own) for t in own.sum(0)]
    return code.tolist(), error.tolist(), books


def test_codes_are_lloyds(spark):
    r = random.Random(5)
    vectors = [[r.gauss(0, 1) for _ in range(r.choice([32, 32, 32, 30, 0]))] for _ in range(400)]
    vectors += [[0.25] * 32] * 30
    rows = [(k // 2, v, "x", f"label{k % 3}" if k % 5 else None, k) for k, v in enumerate(vectors)]
    bad = [(900, None, "x", "b", 0), (901, [1.0, None], "x", "b", 0), (902, [float("nan")], "x", "b", 0),
           (903, [float("-inf")], "x", "b", 0)]
    schema = "vec_id long, embedding array<float>, code string, label string, part int"
    frame = spark.createDataFrame(rows + bad, schema).repartition(5)
    # The id repeats, so entries start from the vectors in order of (id, vector).
    floats = {k: np.array(v, np.float32).astype(float).tolist() for k, v in enumerate(vectors)}
    whole = {k: [int(np.floor(256 * x)) for x in v] for k, v in floats.items()}
    order = sorted(whole, key=lambda k: (k // 2, whole[k]))
    code, error, books = brute_codes([floats[k] for k in order], 16, 64, 2)
    found = cover_codes.compress(spark, frame)
    assert (found.codebooks == books).all()
    got = sorted((x.part, list(x.code), x.error, x.label) for x in found.rows.collect())
    expected = sorted((k, c, e, rows[k][3]) for k, c, e in zip(order, code, error))
    assert got == expected
    assert set(found.rows.columns) == {"vec_id", "label", "part", "code", "error"}
    summed = cover_codes.error_of_groups(found.rows, "label", "label_error").collect()
    totals = Counter()
    for _, _, e, label in expected:
        totals[label] += e
    assert len(summed) == len(expected) and all(x.label_error == totals[x.label] for x in summed)


def test_codes_of_little(spark):
    schema = "vec_id long, embedding array<double>"
    empty = cover_codes.compress(spark, spark.createDataFrame([], schema))
    assert empty.rows.collect() == [] and empty.codebooks.shape[1] == 0
    rows = [(None, [1.0] * 16), (None, [1.0] * 16), (3, [2e9] * 16), (4, [])]
    few = cover_codes.compress(spark, spark.createDataFrame(rows, schema))
    got = {(x.vec_id, x.code[0], x.error) for x in few.rows.collect()}
    assert got == {(3, 0, 0), (4, 1, 0), (None, 2, 0)}


# --- Merkle manifest -----------------------------------------------------------------------------


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def brute_tree(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root, and the siblings (left, right) of each leaf, level by level."""
    steps = [[] for _ in leaves]
    at, nodes = list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for k, place in enumerate(at):
            a = place // 16 * 16
            steps[k].append(("".join(nodes[a:place]), "".join(nodes[place + 1 : a + 16])))
        nodes = [digest(*nodes[a : a + 16]) for a in range(0, len(nodes), 16)]
        at = [place // 16 for place in at]
    return nodes[0], steps


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 4096, 4097])
def test_open_subtrees_are_the_tree(n):
    leaves = [digest(str(k)) for k in range(n)]
    root, steps = brute_tree(leaves)
    block = leaves[: merkle.BLOCK]
    subtrees = merkle.OpenSubtrees(min(merkle.LEVELS, merkle.height(n)))
    witnesses = []
    for leaf in block:
        witnesses.append([])
        subtrees.append(leaf, witnesses[-1])
    top = subtrees.close()
    if n <= merkle.BLOCK:
        assert top == root and witnesses == steps
    else:
        assert witnesses == [s[: merkle.LEVELS] for s in steps[: merkle.BLOCK]]


def test_manifest(spark):
    sources = [None, "", "a", "b", "é"]
    sizes = [300, 1, 17, 5000, 16]
    rows = []
    for source, n in zip(sources, sizes):
        for k in range(n):
            rows.append((None if k % 50 == 7 else k % 4000, source, f"Text {source} {k % 600}", "z", k))
    rows += [(1, "a", None, None, None), (1, "a", "", "same", 1), (1, "a", "", "same", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string, root string, steps int")
    given = frame.withColumn("digest", merkle.leaf(F.col("doc_id"), F.col("text")))
    found = merkle.manifest(spark, given, "source", ["doc_id"], "digest")
    folded = merkle.fold(F.col("leaf"), F.col("steps"))
    got = found.select("*", folded.alias("folded"), merkle.proof_digest(F.col("steps")).alias("proof")).collect()

    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    trees = defaultdict(list)
    for doc, source, text, *_ in rows:
        trees[source].append((doc is not None, doc or 0, digest(field(doc), field(text)), doc))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    made = {s: brute_tree([leaf for *_, leaf, _ in sorted(trees[s])]) for s in names}
    root, above = brute_tree([made[s][0] for s in names])
    expected = Counter()
    for s, top in zip(names, above):
        subroot, steps = made[s]
        for (_, _, leaf, doc), below in zip(sorted(trees[s]), steps):
            proof = digest(*[x for step in below + top for x in step])
            expected[doc, s, leaf, subroot, root, proof] += 1
    assert Counter((r.doc_id, r.source, r.leaf, r.subroot, r.root, r.proof) for r in got) == expected
    assert all(r.folded == root for r in got)
    assert found.columns == ["doc_id", "source", "text", "leaf", "steps", "subroot", "root"]
    tampered = found.select((merkle.fold(F.sha2("leaf", 256), F.col("steps")) == F.col("root")).alias("same"))
    assert tampered.filter("same").count() == 0
    none = given.limit(0)
    assert merkle.manifest(spark, none, "source", ["doc_id"], "digest").count() == 0


# --- Packing -------------------------------------------------------------------------------------


def brute_rooms(lengths: list[int], capacity: int) -> list[int]:
    rooms: list[int] = []
    for length in sorted(lengths, reverse=True):
        fit = [i for i, room in enumerate(rooms) if room >= length]
        if fit:
            rooms[min(fit, key=rooms.__getitem__)] -= length
        else:
            rooms.append(capacity - length)
    return rooms


def test_plan_is_best_fit_decreasing():
    r = random.Random(1)
    for _ in range(200):
        capacity = r.choice([1, 5, 16, 17, 32, 100])
        lengths = [r.randint(1, capacity) for _ in range(r.randint(0, 150))]
        sequences = defaultdict(dict)
        for run in packing.plan(Counter(lengths), capacity):
            for k in range(run.end_rank - run.first_rank):
                sequences[run.sequence + k // run.each][run.offset + k % run.each * run.length] = run.length
        assert sorted(x for s in sequences.values() for x in s.values()) == sorted(lengths)
        for s in sequences.values():
            starts = sorted(s)
            assert starts == [sum(s[o] for o in starts[:k]) for k in range(len(starts))]
        assert sorted(sequences) == list(range(len(sequences)))
        rooms = [capacity - sum(s.values()) for s in sequences.values()]
        assert sorted(rooms) == sorted(brute_rooms(lengths, capacity))


def test_plan_does_not_grow_with_documents():
    few = {n: 1 + 7_919 * n % 1_000 for n in range(1, 1025)}
    assert len(packing.plan({n: 10**8 * c for n, c in few.items()})) < 10_000


def test_packed_documents(spark):
    r = random.Random(2)
    texts = [" ".join(r.choice(["eine", "Zeile", "und", "noch", "x1"]) for _ in range(r.randint(0, 60))) for _ in range(200)]
    texts += [None, "", "word " * 5000, "a" * 30_000, "x <|endoftext|> y", "same text", "same text"]
    rows = [(None if k % 40 == 3 else k % 150, t, "z", 5) for k, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string, part int").repartition(4)
    got = packing.pack(spark, frame, TOKENIZER, capacity=64).collect()
    library = load(TOKENIZER)
    expected = Counter()
    for doc, text, *_ in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        head = (len(ids) - 1) % 64 + 1
        cuts = [0, *range(head, len(ids) + 1, 64)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            crc = zlib.crc32(np.array(ids[a:b], "<u4").tobytes())
            expected[doc, k, a, b - a, crc, tuple(ids[a:b])] += 1
    assert Counter((p.doc_id, p.piece, p.start, p.length, p.ids_crc32, tuple(p.ids)) for p in got) == expected
    by_sequence = defaultdict(list)
    for p in got:
        by_sequence[p.sequence_id].append((p.offset, p.length))
    for placed in by_sequence.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 64
    assert len(by_sequence) == len(brute_rooms([p.length for p in got], 64))
    packed = packing.pack(spark, frame, TOKENIZER, capacity=64)
    whole = packing.sequences(packed).collect()
    assert sum(len(s.ids) for s in whole) == sum(p.length for p in got) and max(len(s.ids) for s in whole) <= 64
    assert packing.pack(spark, frame.limit(0), TOKENIZER).count() == 0
