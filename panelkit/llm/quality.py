"""A quality classifier on learned word and character n-gram vectors.

Words, the n-grams inside them, and pairs of words that follow each other are hashed to rows of
one table of vectors. A text is the mean of the vectors of all of these, and a softmax layer turns
that into classes. Both are trained by plain stochastic gradient descent. With two classes the
layer only needs one number per table row, so a worker scores a text by adding numbers: those of
a word with its n-grams are added once, those of pairs are looked up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    KNOWN_WORDS,
    RecentWords,
    documents,
    held_out,
    in_pieces,
    joined_ranges,
    map_texts,
    mix64,
    powers,
    sample_per_class,
    text_slices,
    texts_of,
    thinned,
)

BUCKETS = 1 << 16
DIMENSIONS = 8
GRAMS = (3, 4)
TRAIN_ROWS = 1000
"""Labelled documents per class that are learned from, at most. Of each the driver gets BUCKETS
numbers at most, however long its text is."""
EPOCHS, BATCH, RATE = 4, 16, 0.5
LONG_WORD = 64
"""Of a longer word, n-grams are taken but not the word itself."""
PAIR = np.uint64(0x9E3779B97F4A7C15)

Features = tuple[np.ndarray, np.ndarray]  # table rows, and how often a text has each


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table rows of all words, one after another, how many each has, and a hash of each word.

    A word is marked at both ends, ``<word>``; its features are itself and its n-grams of
    GRAMS bytes.
    """
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    raw = [b"<" + w.encode() + b">" for w in words]
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64) + np.uint64(1)
    lengths = np.array([len(r) for r in raw])
    owner = np.repeat(np.arange(len(raw)), lengths)
    buckets, owners = [], []
    for n in GRAMS:
        if len(data) < n:
            continue
        gram = np.full(len(data) - n + 1, n, np.uint64)
        for i in range(n):
            gram = gram * np.uint64(257) + data[i : len(data) - n + 1 + i]
        inside = owner[: len(gram)] == owner[n - 1 :]
        buckets.append(mix64(gram[inside]))
        owners.append(owner[: len(gram)][inside])
    ends = np.cumsum(lengths)
    power = powers(0x100000001B3, LONG_WORD + 3)
    place = np.arange(len(data)) - np.repeat(ends - lengths, lengths)
    short = np.flatnonzero(lengths <= LONG_WORD + 2)
    scaled = data * power[np.minimum(place, LONG_WORD + 2)]
    whole = mix64(np.add.reduceat(scaled, ends - lengths) ^ np.uint64(0x5851F42D4C957F2D))
    buckets.append(whole[short])
    owners.append(short)
    bucket = (np.concatenate(buckets) % np.uint64(BUCKETS)).astype(np.int64)
    at = np.concatenate(owners)
    order = np.argsort(at, kind="stable")
    return bucket[order], np.bincount(at, minlength=len(raw)), whole


def pair_rows(hashes: np.ndarray) -> np.ndarray:
    """Table rows of the pairs of words that follow each other."""
    mixed = mix64(hashes[:-1] * PAIR + hashes[1:])
    return (mixed % np.uint64(BUCKETS)).astype(np.int64)


def text_features(text: str) -> Features:
    """Table rows of a whole text and their numbers; BUCKETS of them at most."""
    words = text.split()
    number: dict[str, int] = {}
    each = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    rows, counts, hashes = word_features(list(number))
    total = np.zeros(BUCKETS, np.int64)
    if len(words):
        times = np.bincount(each, minlength=len(number))
        total += np.bincount(rows, np.repeat(times, counts), BUCKETS).astype(np.int64)
        total += np.bincount(pair_rows(hashes[each]), minlength=BUCKETS)
    found = np.flatnonzero(total)
    return found, total[found]


class QualityModel:
    """Vectors and softmax weights, as the difference of the two classes per table row."""

    def __init__(self, vectors: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> None:
        self.per_row = (vectors @ (weights[:, 1] - weights[:, 0])).astype(np.float32)
        self.bias = float(bias[1] - bias[0])

    def word_sums(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each word the sum over its features, their number, and its hash."""
        rows, counts, hashes = word_features(words)
        out = np.empty(len(words), WORD)
        owner = np.repeat(np.arange(len(words)), counts)
        out["sum"] = np.bincount(owner, self.per_row[rows], minlength=len(words))
        out["count"], out["hash"] = counts, hashes
        return out, np.ones(len(words), np.int64)


WORD = np.dtype([("sum", np.float64), ("count", np.int64), ("hash", np.uint64)])


def fit(docs: list[Features], labels: list[int], seed: int = 0) -> QualityModel:
    """Stochastic gradient descent on small batches; all classes are drawn equally often."""
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    vectors = vectors.astype(np.float32)
    weights, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2)
    label = np.array(labels, int)
    if len(set(labels)) < 2:
        if labels:
            bias[label[0]] = 4.0
        return QualityModel(vectors, weights, bias)
    sizes = np.array([len(rows) for rows, _ in docs])
    starts = np.cumsum(sizes) - sizes
    all_rows = np.concatenate([rows for rows, _ in docs]).astype(np.int64)
    all_shares = np.concatenate([times / max(times.sum(), 1) for _, times in docs])
    all_shares = all_shares.astype(np.float32)
    classes = [np.flatnonzero(label == c) for c in (0, 1)]
    size = max(len(c) for c in classes)
    steps, total = 0, EPOCHS * -(-2 * size // BATCH)
    for _ in range(EPOCHS):
        drawn = np.concatenate([random.permutation(np.resize(c, size)) for c in classes])
        for batch in np.array_split(random.permutation(drawn), -(-2 * size // BATCH)):
            rate = RATE * (1 - steps / total)
            steps += 1
            at = joined_ranges(starts[batch], sizes[batch])
            row, share = all_rows[at], all_shares[at]
            doc = np.repeat(np.arange(len(batch)), sizes[batch])
            scaled = vectors[row] * share[:, None]
            hidden = np.zeros((len(batch), DIMENSIONS), np.float32)
            filled = np.flatnonzero(sizes[batch])
            if len(filled):
                begin = np.cumsum(sizes[batch]) - sizes[batch]
                hidden[filled] = np.add.reduceat(scaled, begin[filled], axis=0)
            logits = hidden @ weights + bias
            chance = np.exp(logits - logits.max(1, keepdims=True))
            chance /= chance.sum(1, keepdims=True)
            error = chance
            error[np.arange(len(batch)), label[batch]] -= 1
            back_hidden = (error @ weights.T).astype(np.float32)
            weights -= (rate * hidden.T @ error).astype(np.float32)
            bias -= 0.05 * rate * error.sum(0)
            order = np.argsort(row, kind="stable")
            change = (back_hidden[doc] * share[:, None])[order]
            first = np.flatnonzero(np.diff(row[order], prepend=-1))
            if len(first):
                summed = np.add.reduceat(change, first, axis=0)
                vectors[row[order][first]] -= rate * len(batch) * summed
    return QualityModel(vectors, weights, bias)


def train_quality(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> QualityModel:
    """Learn ``quality`` of (doc_id, quality) from at most ``rows`` documents of each class.

    Held-out documents, NULLs and values other than 0 and 1 are not learned from. The labels are
    thinned by class before any are ranked, and only then meet the documents; executors make the
    features of whole texts. Of labels or documents that repeat an id the least counts. Without
    labels of both classes the score is a constant.
    """
    marks = (
        labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
        .where(F.col("quality").isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    marks = sample_per_class(thinned(marks, "quality", "doc_id", rows), "quality", "doc_id", rows)
    # marks has 2 * rows rows at most, so it is broadcast
    chosen = documents(docs).join(F.broadcast(marks), "doc_id").select("doc_id", "text", "quality")

    def make():
        def step(part: pa.RecordBatch) -> dict:
            found = [text_features(t) for t in texts_of(part)]
            return {
                "doc_id": part.column("doc_id"),
                "quality": part.column("quality"),
                "rows": [f[0].astype(np.uint16).tobytes() for f in found],
                "times": [f[1].astype(np.uint32).tobytes() for f in found],
            }

        return step

    made = map_texts(chosen, make, "doc_id long, quality int, rows binary, times binary")
    least = made.groupBy("doc_id", "quality").agg(F.min(F.struct("rows", "times")).alias("least"))
    found = least.select("doc_id", "quality", "least.*").collect()
    found.sort(key=lambda r: r["doc_id"])
    texts = [
        (np.frombuffer(r["rows"], np.uint16).astype(np.int64), np.frombuffer(r["times"], np.uint32))
        for r in found
    ]
    return fit(texts, [r["quality"] for r in found])


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score, predicted) of every whole text; only the text is looked at.

    ``score`` is the chance of class 1, ``predicted`` is 1 from 0.5 on. A NULL or empty text
    has the score of the bias alone. Repeated rows give repeated rows, an empty table none. No
    shuffle; the model (one number per table row) is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(shared.value)

        def step(part: pa.RecordBatch) -> dict:
            score = scorer.scores(texts_of(part))
            return {
                "doc_id": part.column("doc_id"),
                "score": score,
                "predicted": (score >= 0.5).astype(np.int32),
            }

        return step

    return map_texts(documents(docs), make, "doc_id long, score double, predicted int")


def keep_good(docs: DataFrame, model: QualityModel) -> DataFrame:
    """Rows of ``docs`` with a score of 0.5 or more, with all their columns and no join.

    Each row is judged by its own text, so repeated rows stay or go together, there are no ties,
    and a NULL or empty text, which has the score of the bias alone, goes if that is below 0.5.
    An empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            for part in text_slices(batch):
                yield part.filter(pa.array(scorer.scores(texts_of(part)) >= 0.5))

    return docs.mapInArrow(run, docs.schema)


class Scorer:
    """Scores texts; remembers the sums of the words it met lately."""

    def __init__(self, model: QualityModel) -> None:
        self.model = model
        self.words = RecentWords(in_pieces(model.word_sums), KNOWN_WORDS)

    def scores(self, texts: list[str]) -> np.ndarray:
        cut = [t.split() for t in texts]
        starts, _ = self.words.of(cut)
        known = self.words.values[starts]
        owner = np.repeat(np.arange(len(texts)), [len(words) for words in cut])
        # sums run text by text, so a score does not depend on the texts beside it
        total = np.bincount(owner, known["sum"], minlength=len(texts))
        count = np.bincount(owner, known["count"], minlength=len(texts))
        if len(known) > 1:
            inside = owner[1:] == owner[:-1]
            pairs = self.model.per_row[pair_rows(known["hash"])[inside]]
            total += np.bincount(owner[1:][inside], pairs, minlength=len(texts))
            count += np.bincount(owner[1:][inside], minlength=len(texts))
        logit = total / np.maximum(count, 1) + self.model.bias
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
