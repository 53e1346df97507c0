"""Bags of hashed subword vectors under a linear softmax, trained in numpy.

A word is the mean of the vectors of its hashed character n-grams and of the whole
word; a passage is the mean of its words; two logits come from a linear layer on it.
Vectors and layer are learned jointly.  Because everything below the softmax is
linear, a trained model is one number per bucket: the vector's product with the
difference of the two output rows.  Words never seen share the buckets of their
n-grams with words that were.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import map_batches, pick

BUCKETS = 1 << 18
GRAMS = (3, 4, 5, 6)
DIMS = 8
BATCH = 64
RATE = 0.5
#: The output layer learns at this share of the rate.
OUTPUT_RATE = 0.2
#: Labelled documents of each class that a model is fitted on at most, and their bytes.
SAMPLE_DOCS = 1000
SAMPLE_BYTES = 16 << 20
#: Scores of words that a Python worker remembers at most.
WORD_ENTRIES = 1 << 18
DOCS_AT_ONCE = 256
_BASE = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)

Words = Callable[[str], list[str]]


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all words in one array, and where each word's begin."""
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    framed = [f"<{w}>" for w in words]
    sizes = np.fromiter(map(len, framed), np.int64, len(framed))
    points = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes) - np.arange(len(points))  # characters from here to the word's end
    owner = np.repeat(np.arange(len(words)), sizes)
    whole = np.fromiter((crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
    ids, owners = [_bucket(whole)], [np.arange(len(words))]
    rolling = np.zeros(len(points), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        shifted = np.zeros(len(points), np.uint64)
        rest = points[n - 1 :]
        shifted[: len(rest)] = rest
        rolling = rolling * _BASE + shifted + np.uint64(n)
        if n in GRAMS:
            inside = left >= n
            ids.append(_bucket(rolling[inside]))
            owners.append(owner[inside])
    order = np.argsort(np.concatenate(owners), kind="stable")
    starts = np.searchsorted(np.concatenate(owners)[order], np.arange(len(words)))
    return np.concatenate(ids)[order], starts


def _bucket(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(31))) * _MIX
    return (hashes >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def passages_of(count: int, size: int | None) -> np.ndarray:
    """Where the passages of a text of ``count`` words begin.

    Passages have ``size`` words; what is left joins the last one if it is less than
    half a passage.  Without a size the text is one passage.
    """
    if not count or size is None:
        return np.zeros(1, np.int64)
    return np.arange(0, max(1, count - size // 2 + 1), size)


@dataclass
class Model:
    """Score of each bucket, and the bias; ``constant`` where nothing could be learned."""

    table: np.ndarray
    bias: float
    constant: float | None = None

    def words(self, words: list[str]) -> np.ndarray:
        ids, starts = features(words)
        if not words:
            return np.empty(0)
        counts = np.diff(np.append(starts, len(ids)))
        return np.add.reduceat(self.table[ids].astype(np.float64), starts) / counts


class Trainer:
    """Joint stochastic gradient descent over passages, with rates that adapt per bucket."""

    def __init__(self, texts: list[list[str]], labels: list[int], passage: int | None, rate: float = RATE, seed: int = 7):
        self.rate = rate
        self.random = np.random.default_rng(seed)
        vocabulary: dict[str, int] = {}
        self.passages: list[np.ndarray] = []
        owner, self.labels = [], np.array(labels)
        for n, words in enumerate(texts):
            if not words:
                continue
            ids = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words])
            for part in np.split(ids, passages_of(len(ids), passage)[1:]):
                self.passages.append(part)
                owner.append(n)
        self.owner = np.array(owner)
        self.ids, self.starts = features(list(vocabulary))
        self.counts = np.diff(np.append(self.starts, len(self.ids)))
        self.vectors = self.random.normal(0, 0.1, (BUCKETS, DIMS))
        self.seen = np.full(BUCKETS, 1e-8)
        self.output = self.random.normal(0, 0.1, (DIMS, 2))
        self.bias = np.zeros(2)

    def _bags(self, rows: np.ndarray):
        """Words of the passages: the distinct ones, their buckets, and the means."""
        parts = [self.passages[r] for r in rows]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        distinct, place = np.unique(np.concatenate(parts), return_inverse=True)
        counts = self.counts[distinct]
        ends = np.cumsum(counts)
        spread = np.arange(ends[-1]) + np.repeat(self.starts[distinct] - ends + counts, counts)
        buckets = self.ids[spread]
        words = np.add.reduceat(self.vectors[buckets], ends - counts, axis=0) / counts[:, None]
        starts = np.cumsum(sizes) - sizes
        means = np.add.reduceat(words[place], starts, axis=0) / sizes[:, None]
        return means, sizes, distinct, place, counts, buckets

    def step(self, rows: np.ndarray, targets: np.ndarray) -> None:
        means, sizes, distinct, place, counts, buckets = self._bags(rows)
        logits = means @ self.output + self.bias
        chance = np.exp(logits - logits.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        chance[np.arange(len(rows)), targets] -= 1
        slope = (chance @ self.output.T) / sizes[:, None]
        self.output -= self.rate * OUTPUT_RATE * (means.T @ chance) / len(rows)
        self.bias -= self.rate * OUTPUT_RATE * chance.mean(axis=0)
        to_words = np.empty((len(distinct), DIMS))
        per_place = np.repeat(slope, sizes, axis=0)
        for d in range(DIMS):
            to_words[:, d] = np.bincount(place, per_place[:, d], len(distinct))
        per_bucket = np.repeat(to_words / counts[:, None], counts, axis=0)
        touched, at = np.unique(buckets, return_inverse=True)
        change = np.stack([np.bincount(at, per_bucket[:, d], len(touched)) for d in range(DIMS)], axis=1)
        self.seen[touched] += (change**2).mean(axis=1)
        self.vectors[touched] -= self.rate * change / np.sqrt(self.seen[touched])[:, None]

    def epoch(self, rows: np.ndarray) -> None:
        rows = self.random.permutation(rows)
        for at in range(0, len(rows), BATCH):
            part = rows[at : at + BATCH]
            self.step(part, self.labels[self.owner[part]])

    def hardest(self) -> np.ndarray:
        """Of every text the passage with the highest score."""
        model = self.model()
        scores = np.add.reduceat(model.table[self.ids].astype(np.float64), self.starts) / self.counts
        means = np.array([scores[p].mean() for p in self.passages])
        order = np.lexsort((-means, self.owner))
        first = np.unique(self.owner[order], return_index=True)[1]
        return order[first]

    def model(self) -> Model:
        toward = self.output[:, 1] - self.output[:, 0]
        return Model((self.vectors @ toward).astype(np.float32), float(self.bias[1] - self.bias[0]))


def fit(
    texts: list[list[str]],
    labels: list[int],
    passage: int | None = None,
    epochs: int = 4,
    rounds: int = 0,
    rate: float = RATE,
) -> Model:
    """Learn from whole passages, then ``rounds`` times from every text's highest one.

    With no or only one label present the model is the smoothed share of label 1.
    """
    usable = [(t, y) for t, y in zip(texts, labels, strict=True) if t]
    if len({y for _, y in usable}) < 2:
        share = (sum(labels) + 1) / (len(labels) + 2)
        return Model(np.zeros(BUCKETS, np.float32), 0.0, share)
    trainer = Trainer([t for t, _ in usable], [y for _, y in usable], passage, rate)
    for _ in range(epochs):
        trainer.epoch(np.arange(len(trainer.passages)))
    for _ in range(rounds):
        rows = trainer.hardest()
        for _ in range(3):
            trainer.epoch(rows)
    return trainer.model()


def sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int, size: int) -> list[tuple]:
    """At most ``per_class`` labelled documents of each class, and ``size`` bytes of text.

    The rows come by the hash of their id, whole texts, as far as the bytes reach.
    ``learn`` is a condition on the column ``id``.  A document with several labels
    counts with the largest one; of rows that share an id one is taken, that with the
    smallest digest of its text.
    """
    known = pick(labels, id="doc_id", label=label).filter(learn & F.col("label").isin(0, 1))
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    order = [F.md5(F.col("id").cast("string")), F.col("id")]
    parts = [known.filter(F.col("label") == y).orderBy(*order).limit(per_class) for y in (0, 1)]
    # The broadcast side has 2 * per_class rows of an id and a label at most.
    chosen = F.broadcast(parts[0].union(parts[1]))
    rows = docs.join(chosen, "id").groupBy("id", "label").agg(F.min_by("text", F.md5("text")).alias("text"))
    sizes = rows.select("id", "label", F.octet_length("text").alias("bytes")).collect()
    left, wanted = {0: size // 2, 1: size // 2}, []
    for row in sorted(sizes, key=lambda r: (crc32(str(r.id).encode()), r.bytes or 0)):
        if (row.bytes or 0) <= left[row.label]:
            left[row.label] -= row.bytes or 0
            wanted.append(row.id)
    if len(wanted) < len(sizes):
        rows = rows.filter(F.col("id").isin(wanted))
    return sorted((r.id, r.label, r.text or "") for r in rows.collect())


class Scorer:
    """Scores texts; remembers the scores of words it has met."""

    def __init__(self, model: Model, words: Words, passage: int | None):
        self.model, self.split, self.passage = model, words, passage
        self.known: dict[str, float] = {}

    def scores(self, texts: list[str | None]) -> list[float]:
        if self.model.constant is not None:
            return [self.model.constant] * len(texts)
        split = [self.split(t or "") for t in texts]
        fresh = sorted(set().union(*map(set, split)).difference(self.known)) if split else []
        if len(self.known) + len(fresh) > WORD_ENTRIES:
            self.known.clear()
            fresh = sorted(set().union(*map(set, split)))
        self.known.update(zip(fresh, self.model.words(fresh).tolist(), strict=True))
        return [self._score(words) for words in split]

    def _score(self, words: list[str]) -> float:
        highest = 0.0
        if words:
            values = np.fromiter(map(self.known.__getitem__, words), np.float64, len(words))
            starts = passages_of(len(words), self.passage)
            highest = float((np.add.reduceat(values, starts) / np.diff(np.append(starts, len(words)))).max())
            # Passages that lie over the borders, from cumulative sums.
            if self.passage and len(over := np.arange(self.passage // 2, len(words) - self.passage + 1, self.passage)):
                upto = np.append(0.0, np.cumsum(values))
                highest = max(highest, float((upto[over + self.passage] - upto[over]).max() / self.passage))
        return 1 / (1 + float(np.exp(-np.clip(highest + self.model.bias, -500, 500))))


def score(docs: DataFrame, model: Model, words: Words, passage: int | None = None) -> DataFrame:
    """``id, score`` for rows ``id, text``; the model (1 MB) travels with the tasks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model, words, passage)
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(at, DOCS_AT_ONCE)
                values = scorer.scores(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(values, pa.float64())], ["id", "score"])

    return docs.mapInArrow(work, f"id {dict(docs.dtypes)['id']}, score double")
