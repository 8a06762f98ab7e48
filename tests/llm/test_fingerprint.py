"""Fingerprints and the edited texts of the query by loops."""

from __future__ import annotations

import hashlib
import re
import struct
import sys
from pathlib import Path

import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

from seriesmart.llm import fingerprint as P  # noqa: E402
from seriesmart.llm.queries import edited_likeness  # noqa: E402


def h64(*parts: bytes) -> int:
    """Spark's xxhash64 of several values, as a signed number."""
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def of_int(x: int) -> bytes:
    return struct.pack("<i", x)


def of_long(x: int) -> bytes:
    return struct.pack("<q", x)


def brute(text: str | None) -> str:
    words = [h64(w.encode()) for w in re.split(P.SPACE, text or "") if w]
    if not words:
        return ""
    runs = [words] if len(words) < 5 else [words[i : i + 5] for i in range(len(words) - 4)]
    own: list[int | None] = [None] * P.BINS
    least: dict[int, int] = {}
    for run in runs:
        h = h64(*map(of_long, run))
        b = (h & (1 << 64) - 1) >> (64 - P.BIN_BITS)
        least[b] = min(least.get(b, h), h)
    for b, h in least.items():
        own[b] = h & 255
    filled = list(own)
    for k in range(P.DRAWS):
        for b in range(P.BINS):
            if filled[b] is None:
                filled[b] = own[h64(of_int(k), of_int(b)) & (P.BINS - 1)]
    for b in range(P.BINS):
        if filled[b] is None:
            filled[b] = min((h64(of_int(b), of_long(o)) & ~255) + (h & 255) for o, h in least.items()) & 255
    return "".join(f"{v:02x}" for v in filled)


def likeness(a: str, b: str) -> float:
    if a == b or not a or not b:
        return float(a == b)
    same = sum(a[i : i + 2] == b[i : i + 2] for i in range(0, len(a), 2)) / P.BINS
    return max(0.0, (same - 1 / 256) / (1 - 1 / 256))


def texts() -> dict[int, str | None]:
    words = [f"w{k * k % 997}" for k in range(3000)]
    return {
        5: " ".join(words[:300]), 7: "one", 9: "one two  three\tfour", 12: None, 13: "", 20: " \n ",
        21: " ".join(words[:40]), 22: "é漢🙂 " * 30, 30: " ".join(words), 31: " ".join(words[:300]),
    }


def test_fingerprints_by_loops(spark):
    rows = spark.createDataFrame(list(texts().items()), "doc_id long, text string")
    found = {r.doc_id: r.f for r in P.with_fingerprint(rows, F.col("text"), "f").collect()}
    assert found == {d: brute(t) for d, t in texts().items()}
    assert found[5] == found[31] and found[12] == found[13] == found[20] == ""


def test_edited_texts_by_loops(spark):
    own = {d: t or "" for d, t in texts().items()}
    rows = spark.createDataFrame(list(own.items()), "doc_id long, text string").repartition(3)
    order = sorted(own, reverse=True)
    following = dict(zip(order, order[1:] + order[:1]))
    got = {r.doc_id: r for r in edited_likeness(spark, rows).collect()}
    assert set(got) == set(own)
    for d, text in own.items():
        other = own[following[d]]
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        r = got[d]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == brute(text) and r.edited_fingerprint == brute(edited)
        assert abs(r.near_edited - likeness(brute(text), brute(edited))) < 1e-12
        assert abs(r.near_next - likeness(brute(text), brute(other))) < 1e-12
    assert edited_likeness(spark, rows.limit(0)).count() == 0
