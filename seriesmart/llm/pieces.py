"""Cutting texts into units that byte-level BPE encodes independently of each other.

The split pattern of the tokenizers lets no match reach from a character that is not white space
over white space, so a text falls into words with at most one leading space and into white space; a
single line feed is a match of its own.
Distinct units are few compared with their occurrences, and each is encoded once per worker.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

# White space as the split pattern means it (Unicode White_Space), but for space and line feed.
_OTHER_BLANK = r"\t\x0b-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BLANK = r"\n " + _OTHER_BLANK
_RARE = re.compile(f"[{_OTHER_BLANK}]")
_COARSE = re.compile(rf" ?[^{_BLANK}]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+")
_HEAD, _SPACED = 0, 1
_SIGNS = ".,;:!?%&$*#@|~^+=<>/\\()[]{}\"'`_-"


def _plain(text: str) -> bool:
    """Whether all white space of the text is single spaces and line feeds."""
    double = "  " in text or "\n\n" in text or " \n" in text or "\n " in text
    return not double and not _RARE.search(text)


def _cut(text: str) -> Iterator[tuple[int, list[str]]]:
    """Runs of units: as they stand (_HEAD), or without the one space before each (_SPACED)."""
    if not _plain(text):
        yield _HEAD, _COARSE.findall(text)
        return
    for k, line in enumerate(text.split("\n")):
        first, *rest = line.split(" ")
        yield _HEAD, ["\n", first] if k else [first]
        yield _SPACED, rest


def units(text: str) -> list[str]:
    """Parts of `text` whose separate encodings, one after the other, are the encoding of `text`."""
    return [u for kind, run in _cut(text) for u in ([" " + w for w in run] if kind else run) if u]


class UnitCache:
    """Ids of units, filled by `encode` (distinct new units to their ids as bytes of int32).

    Over `most` units the memory is emptied; units over `longest` characters are not remembered. A text
    that contains one of `whole` (strings that the tokenizer finds before it splits) is one unit.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], list[bytes]],
        most: int,
        longest: int = 64,
        whole: tuple[str, ...] = (),
    ):
        self.encode, self.most, self.longest, self.whole = encode, most, longest, whole
        self.known: list[dict[str, bytes]] = [{"": b""}, {}]

    def _runs(self, text: str) -> Iterable[tuple[int, list[str]]]:
        return [(_HEAD, [text])] if any(w in text for w in self.whole) else _cut(text)

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and how many each text has."""
        if sum(map(len, self.known)) > self.most:
            self.known = [{"": b""}, {}]
        gets = [known.get for known in self.known]
        coded: list[list[bytes | None]] = []
        gaps: list[tuple[list, int, list[tuple[int, str]]]] = []  # units not known: of a text, of a kind, at places
        for text in texts:
            coded.append(found := [])
            for kind, run in self._runs(text):
                got = list(map(gets[kind], run))
                if None in got:
                    at = len(found)
                    gaps.append((found, kind, [(at + i, u) for i, (u, c) in enumerate(zip(run, got)) if c is None]))
                found += got
        tables = self._learn(gaps)
        for found, kind, places in gaps:
            table = tables[kind]
            for i, u in places:
                found[i] = table[u]
        parts = [b"".join(found) for found in coded]
        counts = np.array([len(p) // 4 for p in parts], np.int64)
        return np.frombuffer(b"".join(parts), np.int32), counts

    def _learn(self, gaps: list[tuple[list, int, list[tuple[int, str]]]]) -> list[dict[str, bytes]]:
        """Ids of all units in the gaps, by kind; the shorter units are remembered.

        Signs after a letter or digit are a match of their own, so a word is encoded once whatever follows it.
        """
        fresh = [{u for _, k, places in gaps if k == kind for _, u in places} for kind in (_HEAD, _SPACED)]
        signed: list[list[tuple[str, str, str]]] = [[], []]
        for kind, units in enumerate(fresh):
            for u in units:
                word = u.rstrip(_SIGNS)
                if word is not u and word[-1:].isalnum() and not any(w in u for w in self.whole):
                    signed[kind].append((u, word, u[len(word) :]))
        heads, spaced = self.known
        wanted = [fresh[k].difference(u for u, _, _ in signed[k]).union(w for _, w, _ in signed[k]) for k in (0, 1)]
        wanted[_HEAD].update(signs for words in signed for _, _, signs in words)
        wanted = [[u for u in wanted[_HEAD] if u not in heads], [u for u in wanted[_SPACED] if u not in spaced]]
        ids = iter(self.encode([*wanted[_HEAD], *[" " + u for u in wanted[_SPACED]]]))
        tables = [dict(zip(units, ids)) for units in wanted]
        signs_of = {**tables[_HEAD], **{s: heads[s] for words in signed for _, _, s in words if s in heads}}
        for known, table, words in zip(self.known, tables, signed, strict=True):
            table.update([(u, (table.get(w) or known[w]) + signs_of[s]) for u, w, s in words])
            known.update([(u, c) for u, c in table.items() if len(u) <= self.longest])
        return tables


def id_lists(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))
