"""Hashes of words and of word shingles, for whole slices of texts at once.

Words are runs of anything but space and tab to carriage return, with A-Z lower-cased; splitting and
lower-casing bytes does both. A shingle's 64 bits come from its words' 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WORDS = 5
_M = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_M), -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit over all 64."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def hashes_of_texts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts, one text after the other, and the number of words of each.

    A word that comes again is hashed once.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    counts = pc.list_value_length(split).to_numpy()
    words = split.flatten()
    # White space at an end of a text makes an empty word.
    real = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    if not real.all():
        counts = np.bincount(np.repeat(np.arange(len(counts)), counts)[real], minlength=len(counts))
        words = words.filter(pa.array(real))
    coded = words.dictionary_encode()
    distinct = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)
    joined = pc.binary_join(distinct, " ")[0].as_buffer().to_pybytes()
    return word_hashes(joined.split())[coded.indices.to_numpy()], counts.astype(np.int64)


def shingles(words: np.ndarray, width: int = WORDS) -> np.ndarray:
    """Hash of each run of `width` words, in order; of the whole sequence if it is shorter."""
    n = min(width, len(words))
    if not n:
        return words
    h = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        h = h * _M + words[k : len(words) - n + 1 + k]
    return mix(h + np.uint64(n))


class Runs:
    """Shingles of one sequence at some places only, for any width, from differences of sums over all words before.

    All runs must be whole.
    """

    def __init__(self, words: np.ndarray):
        self.power = np.append(np.uint64(1), np.full(len(words), _M)).cumprod()
        inverse = np.append(np.uint64(1), np.full(len(words), _INVERSE)).cumprod()[: len(words)]
        self.sums = np.append(np.uint64(0), np.cumsum(words * inverse))

    def at(self, start: np.ndarray, width: int) -> np.ndarray:
        h = (self.sums[start + width] - self.sums[start]) * self.power[start + width - 1]
        return mix(h + np.uint64(width))


def shingle_set(text: str | None, width: int = WORDS) -> np.ndarray:
    """Distinct shingles of a text, ascending."""
    h = np.sort(shingles(word_hashes(words_of(text)), width))
    return h[np.flatnonzero(np.diff(h, prepend=h[:1] ^ np.uint64(1)))] if len(h) else h
