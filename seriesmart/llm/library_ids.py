"""Token ids of whole texts by the tokenizers library, each distinct unit asked once per worker.

Ids equal `Tokenizer.encode(text, add_special_tokens=False).ids` of a byte-level BPE file. Strings of
the file's added tokens in a text give that token's id, as the library does by default.
"""

from __future__ import annotations

import os

import numpy as np

from seriesmart.llm.common import held
from seriesmart.llm.pieces import UnitCache

#: Distinct units that a worker remembers.
REMEMBERED = 1_200_000
#: Units of one call, one on each line.
LINES = 20


def load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def vocabulary_size(path: str) -> int:
    return load(path).get_vocab_size(with_added_tokens=True)


def unit_cache(path: str) -> UnitCache:
    """The tokenizer of a JSON file, one per worker process and stage."""
    return held(("ids", path), lambda: _cache(load(path)))


def _cache(tokenizer) -> UnitCache:
    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    added = tuple(t.content for t in tokenizer.get_added_tokens_decoder().values())
    feed = encode(["\n"])[0]

    def of_lines(units: list[str]) -> list[bytes]:
        """A line feed is a token of its own between units, so a call can take many of them."""
        lines = ["\n".join(units[k : k + LINES]) for k in range(0, len(units), LINES)]
        flat = np.concatenate([np.array(ids + feed, np.int32) for ids in encode(lines)])
        ends = np.flatnonzero(flat == feed[0]).tolist()
        if len(ends) != len(units):
            raise ValueError("units are not separate in their lines")
        data, starts = flat.tobytes(), [0, *[e + 1 for e in ends]]
        return [data[4 * a : 4 * e] for a, e in zip(starts, ends)]

    def of_units(units: list[str]) -> list[bytes]:
        every = "\n".join(units)
        if len(feed) == 1 and not any(a in every for a in added):
            alone = [u[-1:].isspace() or "\n" in u for u in units]
        else:
            alone = [True] * len(units)
        simple = [u for u, odd in zip(units, alone) if not odd]
        ids = iter([])
        if simple:
            ids = (x for k in range(0, len(simple), 5000) for x in of_lines(simple[k : k + 5000]))
        odd_ids = iter(encode([u for u, odd in zip(units, alone) if odd]) if any(alone) else [])
        return [np.array(next(odd_ids), np.int32).tobytes() if odd else next(ids) for odd in alone]

    return UnitCache(of_units, REMEMBERED, whole=added)
