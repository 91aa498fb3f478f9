"""Packing documents into fixed windows, in order, by dynamic programming over cut places.

A cut may stand at the end of a document (free), of a sentence (small penalty) or, in a stretch
without either, at fixed steps (larger penalty). The best way to reach a place costs

    best[j] = penalty[j] + WINDOW - at[j] + min over at[j] - at[i] <= WINDOW of best[i] + at[i]

whose minimum slides with j and is kept in a monotone queue, so all cuts are found in one pass.
The last window is costed by what is done with it: it may be split into powers of two.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import deque
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import bpe
from .common import (
    PIECE_WORDS,
    RecentWords,
    documents,
    in_pieces,
    joined_ranges,
    text_slices,
    texts_of,
    total_by,
)
from .transducer import KNOWN_WORDS

WINDOW = 4096
END_OF_DOCUMENT = 2
SENTENCE_PENALTY = 4
HARD_PENALTY = 24
HARD_STEP = 32
"""Places for a cut in a stretch that has no sentence end for longer than this."""
BLOCK_TOKENS = 1_000_000
"""Tokens whose cuts a task finds together; the last two windows are left for the next block."""


class WordEncoder:
    """Ids of the lower-case word vocabulary, equal to those of the tokenizers library.

    Latin-1 texts are split by a pattern and their words merged here; of other texts the
    library encodes each different piece between two spaces, which no word crosses. Two
    generations of ``known_words`` words are remembered: fewer take less memory and more time.
    """

    def __init__(self, path: str, known_words: int = KNOWN_WORDS) -> None:
        at_once = max(PIECE_WORDS, known_words // 4)
        self.bpe = bpe.load(path)
        self.words = RecentWords(
            in_pieces(lambda new: self.bpe.merge_flat([w.encode() for w in new]), at_once),
            known_words,
        )
        self.pieces = RecentWords(in_pieces(self._by_library, at_once), known_words)
        self.ends = np.zeros(self.bpe.size, bool)  # tokens that end a sentence
        for token, n in self.bpe.vocab.items():
            self.ends[n] = token.removesuffix(self.bpe.suffix).endswith((".", "!", "?", "ãĢĤ"))

    def _by_library(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.bpe.library.encode_batch_fast(pieces, add_special_tokens=False)
        ids = [e.ids for e in found]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int32, counts.sum()), counts

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        plain = [
            bpe.is_latin(t) and not any(s in t for s in self.bpe.special) for t in texts
        ]
        out = [np.empty(0, np.int32)] * len(texts)
        for known, kind in ((self.words, True), (self.pieces, False)):
            rows = [n for n, p in enumerate(plain) if p == kind]
            if not rows:
                continue
            cut = [
                bpe.LOWER_WORDS.findall(texts[n].lower()) if kind else texts[n].split(" ")
                for n in rows
            ]
            starts, counts = known.of(cut)
            ids = known.values[joined_ranges(starts, counts)]
            ends = np.cumsum(total_by(counts, map(len, cut)))
            for n, own in zip(rows, np.split(ids, ends[:-1]), strict=True):
                out[n] = own
        return out


def cut_places(
    places: list[int],
    penalties: list[int],
    window: int,
    rest: Callable[[int], int] | None = None,
) -> list[int]:
    """The places (the first and the last included) that cost least; steps exceed no window.

    ``rest`` is the cost of the last step by its length; without it, it is padded like others.
    """
    best, back = [0] * len(places), [0] * len(places)
    value = [0] * len(places)
    queue: deque[int] = deque()
    for j in range(1, len(places)):
        value[j - 1] = here = best[j - 1] + places[j - 1]
        while queue and value[queue[-1]] > here:
            queue.pop()
        queue.append(j - 1)
        at = places[j]
        while at - places[queue[0]] > window:
            queue.popleft()
        i = queue[0]
        best[j] = value[i] + window - at + penalties[j]
        back[j] = i
    j = len(places) - 1
    if rest and j:
        near = range(bisect_left(places, places[j] - window), j)
        back[j] = min(near, key=lambda i: best[i] + rest(places[j] - places[i]))
    out = [places[-1]]
    while j:
        j = back[j]
        out.append(places[j])
    return out[::-1]


def candidates(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray) -> tuple[list, list]:
    """Places for cuts, from 0 to the last token, and their penalties."""
    sentence = np.flatnonzero(ends[ids]) + 1
    natural = np.union1d(np.concatenate([[0], sentence]), doc_ends)
    gaps = np.diff(natural)
    extra = [
        np.arange(a + HARD_STEP, b, HARD_STEP)
        for a, b in zip(natural[:-1][gaps > HARD_STEP], natural[1:][gaps > HARD_STEP], strict=True)
    ]
    hard = np.concatenate(extra) if extra else np.empty(0, np.int64)
    places = np.concatenate([natural, hard])
    penalty = np.concatenate(
        [
            np.where(np.isin(natural, doc_ends), 0, SENTENCE_PENALTY),
            np.full(len(hard), HARD_PENALTY),
        ]
    )
    order = np.argsort(places, kind="stable")
    return places[order].tolist(), penalty[order].tolist()


def split_rest(length: int, window: int) -> list[int]:
    """Lengths for the last tokens: one padded window, or powers of two, which need no padding."""
    powers = [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]
    return powers if _split_cost(length) < window - length else [length]


def _split_cost(length: int) -> int:
    return (length.bit_count() - 1) * HARD_PENALTY


def _rest_cost(length: int) -> int:
    return min(_split_cost(length), WINDOW - length)


class Packer:
    """Packs the documents of one task as they come."""

    def __init__(self, ends: np.ndarray, task: int) -> None:
        self.ends, self.sequence = ends, task << 36
        self.docs: list[tuple[object, np.ndarray, int]] = []
        self.held = 0

    def add(self, doc_id, ids: np.ndarray) -> Iterator[dict]:
        self.docs.append((doc_id, np.append(ids, np.int32(END_OF_DOCUMENT)), 0))
        self.held += len(ids) + 1
        if self.held >= BLOCK_TOKENS:
            yield self.pack(last=False)

    def pack(self, last: bool) -> dict:
        """Pieces of all held tokens, or of all but the last two windows."""
        ids = np.concatenate([d[1][d[2] :] for d in self.docs])
        sizes = np.array([len(d[1]) - d[2] for d in self.docs])
        doc_ends = np.cumsum(sizes)
        # tokens that stay for the next block cost nothing yet
        rest = _rest_cost if last else lambda length: 0
        cuts = cut_places(*candidates(ids, doc_ends, self.ends), WINDOW, rest)
        if not last:
            cuts = cuts[:-2] if len(cuts) > 3 else cuts
        elif len(cuts) > 1:
            lengths = split_rest(cuts[-1] - cuts[-2], WINDOW)
            cuts = cuts[:-1] + (cuts[-2] + np.cumsum(lengths)).tolist()
        cuts, end = np.array(cuts), cuts[-1]
        edges = np.union1d(cuts, doc_ends[doc_ends < end])
        starts, stops = edges[:-1], edges[1:]
        doc = np.searchsorted(doc_ends, starts, side="right")
        window = np.searchsorted(cuts, starts, side="right") - 1
        begun = np.array([d[2] for d in self.docs])
        raw = ids.astype("<u4")
        out = {
            "doc_id": [self.docs[d][0] for d in doc.tolist()],
            "start": starts - (doc_ends - sizes)[doc] + begun[doc],
            "length": stops - starts,
            "ids_crc32": [
                zlib.crc32(raw[a:b]) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)
            ],
            "doc_tokens": [len(self.docs[d][1]) for d in doc.tolist()],
            "sequence_id": window + self.sequence,
            "offset": starts - cuts[window],
        }
        self.sequence += len(cuts) - 1
        kept = []
        for (doc_id, own, used), stop, size in zip(
            self.docs, doc_ends.tolist(), sizes.tolist(), strict=True
        ):
            if stop > end:
                kept.append((doc_id, own, used + max(0, end - (stop - size))))
        self.docs, self.held = kept, int(doc_ends[-1] - end)
        return out


SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long"
)


def pack_documents(docs: DataFrame, path: str, known_words: int = KNOWN_WORDS) -> DataFrame:
    """One row per piece: which tokens of a document stand where in which window.

    ``docs`` has (doc_id, text) and any other columns; ``path`` is the word vocabulary of the
    tokenizers library. Every text gets its ids and then END_OF_DOCUMENT, a NULL or empty text
    that one alone. Documents keep the order of their rows. Tasks pack their own rows: there is
    no shuffle, a task holds about BLOCK_TOKENS tokens (or one document, if longer), and a lost
    task is packed again to the same pieces. Only the last window of a task can be short; it is
    cut into powers of two where that costs less than padding. Repeated rows are packed each;
    an empty table gives no piece.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path, known_words)
        packer = Packer(encoder.ends, TaskContext.get().partitionId())
        for batch in batches:
            for part in text_slices(batch):
                ids = encoder.encode(texts_of(part))
                for doc_id, own in zip(part.column("doc_id").to_pylist(), ids, strict=True):
                    for pieces in packer.add(doc_id, own):
                        yield _batch(pieces)
        if packer.docs:
            yield _batch(packer.pack(last=True))

    return documents(docs).mapInArrow(run, SCHEMA)


def _batch(pieces: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in pieces.items()})
