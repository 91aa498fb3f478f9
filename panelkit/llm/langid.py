"""Language identification in two steps: first the family, then one language of it.

Languages are grouped into families by how alike their character n-grams are. Linear support
vector machines tell the families apart (one against the rest), and inside a family one machine
per pair of languages votes. Everything is learned from labelled documents.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, held_out, map_texts, mix64, sample_per_class, texts_of, thinned

UNKNOWN = "und"
FEATURES = 4096
"""Buckets for n-grams of one to four bytes."""
TRAIN_ROWS = 400
"""Labelled documents per language that are learned from, at most; each is FEATURES numbers."""
EPOCHS, MARGIN_WEIGHT = 30, 1e-4

LETTER = re.compile(r"[^\W\d_]")
_CLEAN = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint8)


def has_letter(text: str) -> bool:
    if text.isascii():
        return LETTER.search(text) is not None
    return any(c.isalpha() for c in text)


def profiles(texts: list[str]) -> np.ndarray:
    """Unit vectors of the square roots of n-gram counts of whole texts, one row per text."""
    raw = [t.lower().encode() for t in texts]
    data = _CLEAN[np.frombuffer(b" ".join(raw) + b" ", np.uint8)].astype(np.uint64)
    owner = np.repeat(np.arange(len(raw)), [len(r) + 1 for r in raw])
    counts = np.zeros(len(raw) * FEATURES)
    gram = np.zeros(len(data), np.uint64)
    for n in range(1, 5):
        gram = gram[: len(data) - n + 1] * np.uint64(256) + data[n - 1 :]
        blank = gram == sum(32 << 8 * i for i in range(n))
        inside = ~blank & (owner[: len(gram)] == owner[n - 1 :])
        bucket = (mix64(gram[inside]) % np.uint64(FEATURES)).astype(np.int64)
        counts += np.bincount(
            owner[: len(gram)][inside] * FEATURES + bucket, minlength=len(counts)
        )
    out = np.sqrt(counts.reshape(len(raw), FEATURES)).astype(np.float32)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def linear_svm(x: np.ndarray, positive: np.ndarray, seed: int = 0) -> np.ndarray:
    """Weights (the last one is the bias) by stochastic subgradients of the hinge loss.

    Both sides weigh the same, however many rows they have. The weights of the second half of
    the steps are averaged.
    """
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    y = np.where(positive, 1.0, -1.0)
    share = np.where(positive, 0.5 / max(positive.sum(), 1), 0.5 / max((~positive).sum(), 1))
    random = np.random.default_rng(seed)
    w, mean, steps, kept = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 0, 0
    total = EPOCHS * -(-len(x) // 32)
    for _ in range(EPOCHS):
        for rows in np.array_split(random.permutation(len(x)), -(-len(x) // 32)):
            steps += 1
            wrong = rows[y[rows] * (x[rows] @ w) < 1]
            rate = 2.0 / (1 + 0.01 * steps)
            pull = (share[wrong] * y[wrong] * len(x)) @ x[wrong] / len(rows)
            w += rate * (pull - MARGIN_WEIGHT * w)
            if steps > total // 2:
                mean += w
                kept += 1
    return mean / max(kept, 1)


def language_families(centres: np.ndarray) -> list[list[int]]:
    """Groups of alike rows, about as many as the square root of their number.

    The two most alike groups are merged until so many are left.
    """
    groups = [[n] for n in range(len(centres))]
    alike = centres @ centres.T
    while len(groups) > max(1, round(len(centres) ** 0.5)):
        a, b = max(
            combinations(range(len(groups)), 2),
            key=lambda p: alike[np.ix_(groups[p[0]], groups[p[1]])].mean(),
        )
        groups[a] += groups.pop(b)
    return groups


class LanguageModel:
    """Families, their machines, and one machine per pair of languages of a family."""

    def __init__(self, x: np.ndarray, labels: list[str]) -> None:
        self.languages = sorted(set(labels))
        self.families, self.family_weights, self.pairs = [], [], {}
        if not labels:
            return
        where = np.array([self.languages.index(label) for label in labels], int)
        centres = np.array([x[where == n].mean(0) for n in range(len(self.languages))])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
        self.families = language_families(centres)
        family_of = {n: f for f, members in enumerate(self.families) for n in members}
        family = np.array([family_of[n] for n in where.tolist()], int)
        if len(self.families) > 1:
            self.family_weights = [linear_svm(x, family == f) for f in range(len(self.families))]
        for members in self.families:
            for a, b in combinations(sorted(members), 2):
                rows = (where == a) | (where == b)
                self.pairs[a, b] = linear_svm(x[rows], where[rows] == a)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Languages and scores: the chance of the family times that of the language in it."""
        if not self.languages:
            return [UNKNOWN] * len(x), np.zeros(len(x))
        x = np.hstack([x, np.ones((len(x), 1), np.float32)])
        if self.family_weights:
            margins = x @ np.array(self.family_weights).T
            family = margins.argmax(1)
            score = sigmoid(margins.max(1))
        else:
            family, score = np.zeros(len(x), int), np.ones(len(x))
        language = np.zeros(len(x), int)
        for f, members in enumerate(self.families):
            rows = np.flatnonzero(family == f)
            votes = np.zeros((len(rows), len(self.languages)))
            worst = np.full((len(rows), len(self.languages)), np.inf)
            for a, b in combinations(sorted(members), 2):
                margin = x[rows] @ self.pairs[a, b]
                votes[:, a] += margin >= 0
                votes[:, b] += margin < 0
                worst[:, a] = np.minimum(worst[:, a], margin)
                worst[:, b] = np.minimum(worst[:, b], -margin)
            # most votes; among equals the one whose closest duel went best
            rank = votes + 0.5 * sigmoid(np.where(np.isfinite(worst), worst, 0))
            rank[:, [n for n in range(len(self.languages)) if n not in members]] = -1
            language[rows] = rank.argmax(1)
            closest = worst[np.arange(len(rows)), language[rows]]
            score[rows] *= np.where(np.isfinite(closest), sigmoid(closest), 1.0)
        return [self.languages[n] for n in language.tolist()], np.clip(score, 0.0, 1.0)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train_languages(docs: DataFrame, rows: int = TRAIN_ROWS) -> LanguageModel:
    """Learn from at most ``rows`` documents of each language in (doc_id, text, lang).

    Rows without text, language or id, and those held out, are not learned from. Executors
    make the profiles, so the driver gets rows * languages * FEATURES numbers however long
    the texts are.
    """
    usable = documents(docs, "lang").where(
        ~held_out() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    few = thinned(usable, "lang", "doc_id", rows)
    chosen = sample_per_class(few, "lang", "doc_id", rows)

    def make():
        def step(part: pa.RecordBatch) -> dict:
            x = profiles(texts_of(part)).astype(np.float16)
            return {
                "doc_id": part.column("doc_id"),
                "lang": part.column("lang"),
                "x": [row.tobytes() for row in x],
            }

        return step

    found = map_texts(chosen, make, "doc_id long, lang string, x binary").collect()
    found.sort(key=lambda r: (r["doc_id"], r["lang"], bytes(r["x"])))
    x = np.array([np.frombuffer(r["x"], np.float16) for r in found], np.float32)
    return LanguageModel(x.reshape(len(found), FEATURES), [r["lang"] for r in found])


def identify_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text; only the text is looked at.

    A text that is NULL or has no letter is UNKNOWN with score 0, and so is every text if
    nothing was learned. Repeated rows give repeated rows, an empty table none. No shuffle;
    the model (FEATURES weights per machine) is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def step(part: pa.RecordBatch) -> dict:
            texts = texts_of(part)
            names, scores = [], []
            for at in range(0, len(texts), 256):
                block = texts[at : at + 256]
                found, score = shared.value.predict(profiles(block))
                for text, name, s in zip(block, found, score.tolist(), strict=True):
                    known = name != UNKNOWN and has_letter(text)
                    names.append(name if known else UNKNOWN)
                    scores.append(s if known else 0.0)
            return {"doc_id": part.column("doc_id"), "lang_pred": names, "score": scores}

        return step

    return map_texts(documents(docs), make, "doc_id long, lang_pred string, score double")
