"""The stages of the corpus pipeline, one after the other, against brute force."""

from __future__ import annotations

import hashlib
import random
import sys
from collections import Counter, defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from test_llm_operators import brute_components, brute_left, reference  # noqa: E402

import corpus_pipeline  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
GERMAN = "der die das und nicht ein eine mit von zu im auf für ist des sich dem den als auch".split()
ENGLISH = "the of and to in that is was for it with as his on be at by had not are".split()


def corpus():
    r = random.Random(11)
    rows = []

    def add(words, lang="en", source="web"):
        rows.append((len(rows) + 1, " ".join(words) if words is not None else None, lang, source))

    def text(lang, n):
        own = GERMAN if lang == "de" else ENGLISH
        return [r.choice(own) + str(r.randint(0, 40) or "") for _ in range(n)]

    for k in range(40):
        lang = "de" if k % 2 else "en"
        add(text(lang, 60 + k), lang, ["web", "books", None][k % 3])
    plain = [row[1].split() for row in rows]
    add(plain[3], "de", "books")  # a copy, and another
    add(plain[3], "de", "web")
    edited = list(plain[20])
    edited[30] = "edited"
    add(edited, "en", None)  # a near copy
    passage = text("en", 70)
    add([*text("en", 30), *passage, *text("en", 30)], "en", "web")
    add([*text("en", 90), *passage[:60], *text("en", 25)], "en", "books")  # a passage of an earlier text
    add([*passage, *text("en", 2)], "en", "books")
    add(["12345", "678", "!!!"], "en", "web")  # no letter
    add(None, None, None)
    add([], "de", "books")
    return rows


def split(text):
    return (text or "").split()


def brute_mix(docs):
    """How often each document is taken: targets by filling up sources in turn, then a cut in random order."""
    sizes = {d: len(split(t)) for d, t, *_ in docs}
    by_source = defaultdict(list)
    for d, t, _, source, n_chars in docs:
        key = hashlib.md5(f"20|{d}|{'' if n_chars is None else n_chars}".encode()).hexdigest()[:15]
        by_source[source].append((int(key, 16), d))
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    weight = {s: [5.0, 2.0, 1.0][k % 3] for k, s in enumerate(names)}
    whole = {s: float(sum(sizes[d] for _, d in by_source[s])) for s in names}
    target, free, left = {}, set(names), sum(whole.values())
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        capped = [s for s in free if share[s] > 3 * whole[s]]
        if not capped:
            target.update(share)
            break
        for s in capped:
            target[s] = 3 * whole[s]
            left -= target[s]
            free.remove(s)
    taken = {}
    for s in names:
        full = int(target[s] // whole[s]) if whole[s] else 0
        before, rest = 0, target[s] - full * whole[s]
        for _, d in sorted(by_source[s]):
            taken[d] = full + (full < 3 and 2 * before + sizes[d] <= 2 * rest + 1e-9)
            before += sizes[d]
    return taken


def test_decisions_of_the_stages(spark):
    rows = [(*row, None if row[1] is None else len(row[1])) for row in corpus()]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, "")
        if name != "bpe":
            assert made.columns == docs.columns
        found = [tuple(r) for r in made.collect()]
        kept[name] = found
        docs = spark.createDataFrame(found, made.schema)

    with_letters = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    assert sorted(kept["language_id"]) == sorted(with_letters) and len(with_letters) == len(rows) - 3

    label, _ = brute_components(kept["language_id"])
    least = [r for r in kept["language_id"] if label[r[0]] == r[0]]
    assert sorted(kept["jaccard"]) == sorted(least) and len(least) == len(with_letters) - 3

    ordered = sorted(kept["jaccard"])
    left = brute_left([split(r[1]) for r in ordered])
    expected = {r[0]: [split(r[1])[i] for i in sorted(left[k])] for k, r in enumerate(ordered, 1)}
    got = {r[0]: split(r[1]) for r in kept["passages"]}
    assert got == {d: words for d, words in expected.items() if words}
    assert sum(len(expected[r[0]]) < len(split(r[1])) for r in ordered) == 2
    assert all(r[4] == len(r[1]) for r in kept["passages"])

    taken = brute_mix(kept["passages"])
    assert Counter(r[0] for r in kept["mix"]) == {d: n for d, n in taken.items() if n}
    assert {r[:5] for r in kept["mix"]} <= set(kept["passages"])

    encoding = reference()
    expected = []
    for d, text, *_ in kept["mix"]:
        ids = encoding.encode_ordinary(text or "")
        digests = [hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), (text or "").encode())]
        expected.append((d, len(ids), *digests))
    assert sorted(kept["bpe"]) == sorted(expected)


def test_an_empty_corpus(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.collect() == []
