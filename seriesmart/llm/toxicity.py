"""Toxicity of texts: a learned lexicon, matched with misspellings, weighed by context.

Lexicon. Words and word beginnings (stems) that occur in toxic texts of a bounded labelled sample far
more often than in others, by the log-likelihood ratio of their document counts.
Matching. The lexicon is a trie; its intersection with the Levenshtein automaton of a word is run as
one deterministic automaton whose states are sets of (trie node, edits). States are made when
met and shared by all words, and most words leave the automaton after a few letters.
Context. Around each match a window of words tells quotation (quotation marks, words of reporting) from
abuse (words of address). Counts of both kinds go through a logistic regression.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmart.llm.common import add_columns, map_arrow, stored, texts_of

#: The sample: labelled texts of either kind with the least hashes of their id.
TOXIC_DOCS = 2000
CLEAN_DOCS = 6000
STEM_LENGTHS = (4, 5)
#: A lexicon entry's log-likelihood ratio and odds ratio, at least; entries, at most.
LEAST_RATIO = 20.0
LEAST_ODDS = 5.0
ENTRIES = 2000
CONTEXT = 8
THRESHOLD = 0.7
#: Distinct words and automaton states that a worker remembers.
REMEMBERED = 600_000
STATES = 100_000

# Marks and words that tell quotation and address.
QUOTES = "\"'“”„«»‘’‹›"
REPORTING = {
    "said", "says", "wrote", "called", "quoted", "quote", "reported", "dit", "écrit", "appelé", "sagte",
    "schrieb", "nannte", "dijo", "escribió", "llamó",
}
ADDRESS = {
    "you", "your", "you're", "u", "tu", "toi", "vous", "votre", "du", "dich", "dein", "ihr", "sie", "tú",
    "usted", "ustedes", "eres",
}
_EDGE = QUOTES + ".,;:!?()[]{}<>*_-–—…¡¿"


def plain(token: str) -> str:
    return token.strip(_EDGE)


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


class Matcher:
    """The lexicon's trie under Levenshtein edits, as a deterministic automaton made on demand."""

    def __init__(self, entries: list[tuple[str, bool]]):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[tuple[int, int, bool]]] = [[]]
        for k, (term, stem) in enumerate(entries):
            node = 0
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                node = self.children[node][letter]
            # A stem is matched as it is: what follows is free already. A word may end at the same node.
            self.ends[node].append((k, 0 if stem else edits_allowed(term), stem))
        self.most = max([edits_allowed(t) for t, stem in entries if not stem], default=0)
        self._empty()

    def _empty(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves: list[dict[str, int]] = []
        self.full: list[tuple[int, int] | None] = []
        self.stem: list[tuple[int, int] | None] = []
        self.first = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        """Number of the state with these least edits by node, after skipping letters of terms."""
        waiting = list(nodes)
        while waiting:
            node = waiting.pop()
            e = nodes[node] + 1
            if e <= self.most:
                for child in self.children[node].values():
                    if nodes.get(child, self.most + 1) > e:
                        nodes[child] = e
                        waiting.append(child)
        key = tuple(sorted(nodes.items()))
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
            ends = [(e, *end) for n, e in key for end in self.ends[n]]
            full = [(e, k) for e, k, allowed, _ in ends if e <= allowed]
            self.full.append(min(full, default=None))
            self.stem.append(min([(e, k) for e, k, _, stem in ends if stem and not e], default=None))
        return self.numbers[key]

    def _move(self, state: int, letter: str) -> int:
        nodes: dict[int, int] = {}
        for node, e in self.states[state]:
            for other, child in self.children[node].items():
                cost = e + (other != letter)
                if cost <= self.most and nodes.get(child, self.most + 1) > cost:
                    nodes[child] = cost
            if e < self.most and nodes.get(node, self.most + 1) > e + 1:
                nodes[node] = e + 1
        self.moves[state][letter] = found = self._state(nodes) if nodes else -1
        return found

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, entry) of the nearest entry, or None."""
        if len(self.states) > STATES:
            self._empty()
        state, best = self.first, None
        for letter in word:
            following = self.moves[state].get(letter)
            state = self._move(state, letter) if following is None else following
            if state < 0:
                return best
            if self.stem[state] is not None and (best is None or self.stem[state] < best):
                best = self.stem[state]
        full = self.full[state]
        return full if full is not None and (best is None or full < best) else best


@dataclass
class Lexicon:
    entries: list[tuple[str, bool]]
    weights: list[float]


@dataclass
class Model:
    lexicon: Lexicon
    coefficients: np.ndarray


class Features:
    """Counts of matches by context for texts, words remembered."""

    SIZE = 7

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.matcher = lexicon, Matcher(lexicon.entries)
        self.known: dict[str, tuple[int, int] | None] = {}

    def _match(self, tokens: list[str]) -> list[tuple[int, tuple[int, int]]]:
        known = self.known
        fresh = set(tokens).difference(known)
        if len(known) + len(fresh) > REMEMBERED:
            known.clear()
            fresh = set(tokens)
        for token in fresh:
            known[token] = self.matcher.match(plain(token))
        return [(i, m) for i, t in enumerate(tokens) if (m := known[t]) is not None]

    def of(self, text: str) -> np.ndarray:
        tokens = text.lower().split()
        exact = near = quoted = addressed = 0
        most = total = 0.0
        for i, (edits, entry) in self._match(tokens):
            before, after = tokens[max(0, i - CONTEXT) : i], tokens[i + 1 : i + 1 + CONTEXT]
            opened = any(t[0] in QUOTES for t in [*before, tokens[i]])
            closed = any(t.rstrip(".,;:!?")[-1:] in QUOTES and t.rstrip(".,;:!?") for t in [tokens[i], *after])
            reported = any(plain(t) in REPORTING for t in before)
            if (opened and closed) or reported:
                quoted += 1
                continue
            addressed += any(plain(t) in ADDRESS for t in [*before, *after])
            if edits:
                near += 1
                continue
            exact += 1
            weight = self.lexicon.weights[entry]
            most, total = max(most, weight), total + weight
        counts = [math.log1p(x) for x in (exact, near, quoted, addressed, total)]
        return np.array([1.0, *counts, most])


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge."""
    w, ridge = np.zeros(x.shape[1]), 0.1 * np.eye(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge @ w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


# --- Learning ------------------------------------------------------------------------------------


def _count_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: tuple[Counter, Counter] = Counter(), Counter()
    for batch in batches:
        for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
            words = {w for t in set(text.as_py().lower().split()) if len(w := plain(t)) > 2}
            counts[toxic].update(words)
            counts[toxic].update({w[:n] + "*" for w in words for n in STEM_LENGTHS if len(w) > n})
    keys = list(counts[1] | counts[0])
    yield pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.string()), *[pa.array([c[k] for k in keys], pa.int64()) for c in counts]],
        names=["key", "clean", "toxic"],
    )


def _lexicon(sample: DataFrame, n_clean: int, n_toxic: int) -> Lexicon:
    counted = map_arrow(sample.select("text", "toxic"), _count_keys, "key string, clean long, toxic long")
    keys = counted.groupBy("key").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    share = n_toxic / max(1, n_toxic + n_clean)
    t, c = F.col("toxic").cast("double"), F.col("clean").cast("double")
    log = lambda n, e: F.when(n > 0, n * F.log(n / e)).otherwise(0.0)
    ratio = 2 * (log(t, (t + c) * share) + log(c, (t + c) * (1 - share)))
    odds = ((t + 0.5) / (n_toxic + 1)) / ((c + 0.5) / (n_clean + 1))
    kept = keys.filter((ratio >= LEAST_RATIO) & (odds >= LEAST_ODDS))
    top = kept.select("key", F.log(odds).alias("weight"), ratio.alias("ratio")).orderBy(
        F.desc("ratio"), "key"
    )
    rows = top.limit(ENTRIES).collect()
    entries = [(r.key.removesuffix("*"), r.key.endswith("*")) for r in rows]
    return Lexicon(entries, [r.weight for r in rows])


def train(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    toxic_docs: int = TOXIC_DOCS,
    clean_docs: int = CLEAN_DOCS,
) -> Model | None:
    """A model of `labels` (doc_id, toxic) over `docs` (doc_id, text); None without labelled texts.

    At most so many texts of either kind are learned from, those with the least hashes of their id.
    Rows with a null id, label or text are not learned from; of repeated labels the highest counts.
    """
    marked = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    marked = marked.filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
    marked = stored(spark, marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "labels")
    all_of = {r.toxic: r["count"] for r in marked.groupBy("toxic").count().collect()}
    turn = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")
    drawn = marked.withColumn("turn", F.row_number().over(turn)).filter(
        F.col("turn") <= F.when(F.col("toxic") == 1, toxic_docs).otherwise(clean_docs)
    )
    texts = docs.select("doc_id", "text").filter("text IS NOT NULL")
    chosen = texts.join(F.broadcast(drawn.select("doc_id", "toxic")), "doc_id")
    sample = stored(spark, chosen, "toxic-sample")
    drawn_of = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not drawn_of:
        return None
    lexicon = _lexicon(sample, drawn_of.get(0, 0), drawn_of.get(1, 0))
    shared = spark.sparkContext.broadcast(lexicon)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(shared.value)
        for batch in batches:
            x = [features.of(t.as_py()).tolist() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(x, pa.list_(pa.float64()))],
                names=["doc_id", "toxic", "x"],
            )

    schema = "doc_id long, toxic int, x array<double>"
    own = sample.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "toxic")
    rows = sorted(map_arrow(own, measure, schema).collect(), key=lambda r: (r.doc_id, r.toxic, r.x))
    coefficients = fit(np.array([r.x for r in rows]), np.array([float(r.toxic) for r in rows]))
    if len(all_of) == 2 and len(drawn_of) == 2:
        # Both kinds are drawn at their own rates; the constant is set back to the labels' shares.
        coefficients[0] += math.log(all_of[1] / all_of[0]) - math.log(drawn_of[1] / drawn_of[0])
    return Model(lexicon, coefficients)


def score(spark: SparkSession, docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """`docs` with `score double` (0 to 1, of the whole text) and `predicted int` (score >= THRESHOLD).

    A null or empty text has no match and the score of such; without a model every score is 0.
    Columns of these names are replaced.
    """
    shared = spark.sparkContext.broadcast(model)

    def start():
        own = shared.value
        features = Features(own.lexicon) if own else None

        def make(part: pa.RecordBatch) -> list[pa.Array]:
            texts = texts_of(part, text)
            if features:
                z = np.array([features.of(t) @ own.coefficients for t in texts])
                scores = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            else:
                scores = np.zeros(len(texts))
            return [pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))]

        return make

    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return add_columns(docs, text, fields, start)
