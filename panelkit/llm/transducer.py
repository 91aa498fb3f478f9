"""Encoding and decoding by byte pairs through a lexicon automaton.

Frequent words are counted over all texts and compiled into a minimal acyclic automaton that
shares prefixes and suffixes. Each arc carries how many words come before it, so a path sums to
the number of its word, and the number leads to the word's token ids. The automaton is one file:
Spark ships it once to each executor, and all Python workers there map the same pages. A word
that the lexicon lacks is merged exactly, so the lexicon decides speed, never a result.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators.staging import scratch_path, settle

from . import bpe
from .common import (
    RecentWords,
    documents,
    joined_ranges,
    map_texts,
    text_slices,
    texts_of,
    total_by,
)

LEXICON_WORDS = 1 << 16
"""Words in the automaton. It bounds what the driver compiles and every executor maps."""
LEXICON_WORD_BYTES = 32
COUNTED_WORDS = 200_000
"""Distinct words that a task holds while it counts; it passes those seen twice on and restarts."""
KNOWN_WORDS = 150_000
"""Distinct words that a Python worker remembers in each of two generations."""

# ---- the automaton -------------------------------------------------------------------------


def compile_lexicon(words: list[bytes], outputs: list[tuple[int, ...]]) -> bytes:
    """A file image of the minimal acyclic automaton of ``words`` (distinct) with outputs.

    Words are added in order; as soon as a branch can no longer change, its nodes are replaced
    by equal ones that exist already, which is what shares the suffixes.
    """
    order = sorted(range(len(words)), key=words.__getitem__)
    nodes: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    known: dict[tuple[bool, tuple[tuple[int, int], ...]], int] = {}

    def frozen(node: list) -> int:
        form = (node[0], tuple(node[1]))
        if form not in known:
            known[form] = len(nodes)
            nodes.append(form)
        return known[form]

    path: list[list] = [[False, []]]
    last = b""

    def close(depth: int) -> None:
        while len(path) - 1 > depth:
            child = path.pop()
            path[-1][1].append((last[len(path) - 1], frozen(child)))

    for n in order:
        word = words[n]
        same = 0
        while same < min(len(last), len(word)) and last[same] == word[same]:
            same += 1
        close(same)
        path.extend([False, []] for _ in word[same:])
        path[-1][0] = True
        last = word
    close(0)
    root = frozen(path[0])

    below = np.zeros(len(nodes), np.int64)
    keys, targets, skips = [], [], []
    for state, (final, arcs) in enumerate(nodes):  # children always come first
        total = int(final)
        for label, target in arcs:
            keys.append(state * 256 + label)
            targets.append(target)
            skips.append(total)
            total += int(below[target])
        below[state] = total
    ids = [outputs[n] for n in order]
    parts = [
        np.array([root], np.int64),
        np.array(keys, np.int64),
        np.array(targets, np.int64),
        np.array(skips, np.int64),
        np.array([f for f, _ in nodes], np.int64),
        np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int64),
        np.fromiter(chain.from_iterable(ids), np.int64),
    ]
    head = np.array([len(parts), *[len(p) for p in parts]], np.int64)
    return b"".join(p.tobytes() for p in (head, *parts))


class Lexicon:
    """A compiled lexicon, mapped from its file."""

    def __init__(self, file: str | bytes) -> None:
        if isinstance(file, bytes):
            data = np.frombuffer(file, np.int64)
        else:
            data = np.memmap(file, np.int64, "r")
        count = int(data[0])
        ends = np.cumsum([1 + count, *data[1 : 1 + count]])
        parts = [data[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        root, self.keys, self.targets, self.skips, self.final, self.starts, self.ids = parts
        self.root = int(root[0])

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 if the lexicon lacks it. All words walk side by side."""
        if not len(self.keys) or not words:
            return np.full(len(words), -1, np.int64)
        lengths = np.array([len(w) for w in words])
        width = min(int(lengths.max()), LEXICON_WORD_BYTES)
        padded = np.frombuffer(
            b"".join(w[:width].ljust(width, b"\0") for w in words), np.uint8
        ).reshape(len(words), width)
        state = np.full(len(words), self.root, np.int64)
        number = np.zeros(len(words), np.int64)
        alive = (lengths <= LEXICON_WORD_BYTES) & (lengths > 0)
        for column in range(width):
            rows = np.flatnonzero(alive & (lengths > column))
            key = state[rows] * 256 + padded[rows, column]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            alive[rows[~hit]] = False
            rows, at = rows[hit], at[hit]
            state[rows] = self.targets[at]
            number[rows] += self.skips[at]
        alive &= self.final[state] == 1
        return np.where(alive, number, -1)

    def find(self, words: list[bytes]) -> list[tuple[int, ...] | None]:
        """Token ids of each word, None if the lexicon lacks it."""
        return [
            tuple(self.ids[self.starts[n] : self.starts[n + 1]].tolist()) if n >= 0 else None
            for n in self.numbers(words).tolist()
        ]


# ---- counting words and shipping the file ---------------------------------------------------


def count_words(docs: DataFrame, path: str) -> DataFrame:
    """(word, n): how often words occur in all texts, for words that some task saw twice.

    A task holds COUNTED_WORDS distinct words at most; then it passes on what it saw more than
    once. Rare words may lose counts by that, frequent ones cannot.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = bpe.load(path)
        seen: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            pairs = [(w.encode(), n) for w, n in seen.items() if n > 1]
            pairs = [(w, n) for w, n in pairs if len(w) <= LEXICON_WORD_BYTES]
            seen.clear()
            return pa.RecordBatch.from_pydict(
                {
                    "word": pa.array([w for w, _ in pairs], pa.binary()),
                    "n": pa.array([n for _, n in pairs], pa.int64()),
                }
            )

        for batch in batches:
            for part in text_slices(batch):
                for text in texts_of(part):
                    seen.update(vocabulary.byte_words(text))
                if len(seen) > COUNTED_WORDS:
                    yield out()
        yield out()

    counted = docs.select("text").mapInArrow(run, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, path: str, words: int = LEXICON_WORDS) -> str:
    """Compile the most frequent words, ``words`` at most, and ship the file; returns its name.

    A histogram of the counts, of a few hundred steps, tells from which step on that many words
    are left, so only they are sent to the driver.
    """
    step = F.floor(F.log2("n") * 8).cast("int")
    counted = settle(count_words(docs, path).withColumn("step", step))
    steps = counted.groupBy("step").agg(F.count("*").alias("held")).collect()
    least, total = None, 0
    for row in sorted(steps, key=lambda r: -r["step"]):
        total += row["held"]
        if total > words:
            break
        least = row["step"]
    frequent = counted.where(F.col("step") >= least) if least is not None else counted.where("false")
    found = [bytes(r["word"]) for r in frequent.select("word").collect()]
    image = compile_lexicon(found, bpe.load(path).merge(found))
    return ship(docs.sparkSession, image, "lexicon")


def ship(spark: SparkSession, data: bytes, kind: str) -> str:
    """Put a file into the shared folder and let Spark bring it to every executor."""
    context = spark.sparkContext
    name = f"{kind}-{uuid.uuid4().hex}.bin"
    full = f"{scratch_path(spark)}/{name}"
    target = context._jvm.org.apache.hadoop.fs.Path(full)
    stream = target.getFileSystem(context._jsc.hadoopConfiguration()).create(target)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()
    context.addFile(full)
    return name


# ---- encoding and decoding ------------------------------------------------------------------


class Encoder:
    """Ids of texts; remembers words, asks the lexicon, merges what neither knows."""

    def __init__(self, path: str, lexicon: Lexicon | None = None) -> None:
        self.bpe, self.lexicon = bpe.load(path), lexicon
        self.recent = RecentWords(self._flat, KNOWN_WORDS)

    def counts(self, words: list[list[str]]) -> np.ndarray:
        """How many tokens each word of each list has."""
        return self.recent.of(words)[1]

    def words(self, text: str) -> list[str]:
        """Words of a text; a special token that it spells is a word of its own."""
        if not any(t in text for t in self.bpe.special):
            return self.bpe.byte_words(text)
        out: list[str] = []
        for n, part in enumerate(self.bpe.split_special.split(text)):
            out.extend([part] if n % 2 else self.bpe.byte_words(part))
        return out

    def _flat(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one word after another, and how many each has."""
        raw = [w.encode() for w in words]
        number = self.lexicon.numbers(raw) if self.lexicon else np.full(len(raw), -1, np.int64)
        special = [n for n, w in enumerate(words) if w in self.bpe.special]
        number[special] = -1
        held, rest = np.flatnonzero(number >= 0), np.flatnonzero(number < 0)
        merged, counts_of_rest = self.bpe.merge_flat([raw[n] for n in rest.tolist()])
        counts = np.zeros(len(words), np.int64)
        counts[rest] = counts_of_rest
        if len(held):
            begin = self.lexicon.starts[number[held]]
            counts[held] = self.lexicon.starts[number[held] + 1] - begin
        at = np.cumsum(counts) - counts
        out = np.empty(counts.sum(), np.int32)
        out[joined_ranges(at[rest], counts[rest])] = merged
        if len(held):
            ids = self.lexicon.ids[joined_ranges(begin, counts[held])]
            out[joined_ranges(at[held], counts[held])] = ids
        if special:  # a special token is one id, whatever it would be merged to
            out[at[special]] = [self.bpe.special[words[n]] for n in special]
            keep = np.ones(len(out), bool)
            keep[joined_ranges(at[special] + 1, counts[special] - 1)] = False
            out, counts[special] = out[keep], 1
        return out, counts

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self.words(t) for t in texts]
        starts, counts = self.recent.of(cut)
        ids = self.recent.values[joined_ranges(starts, counts)]
        ends = np.cumsum(total_by(counts, map(len, cut)))
        return np.split(ids, ends[:-1])

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no text become replacement characters."""
        return b"".join(map(self.bpe.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def encode_documents(docs: DataFrame, path: str, lexicon: str | None = None) -> DataFrame:
    """(doc_id, ids, text): token ids of every whole text, and the text decoded from them.

    ``docs`` has (doc_id, text) and any other columns; ``path`` is a byte-level vocabulary
    file of the tokenizers library. Special tokens spelt in a text become their ids, and none
    are added. A NULL text counts as empty: no ids. Repeated rows give repeated rows, an empty
    table an empty table. No shuffle but that of the word counts.
    """
    docs = documents(docs)
    lexicon = lexicon or build_lexicon(docs, path)
    return map_texts(docs, _encoding(path, lexicon, False), "doc_id long, ids array<int>, text string")


def digest_documents(docs: DataFrame, path: str, lexicon: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of ``encode_documents``, made in its tasks."""
    docs = documents(docs)
    lexicon = lexicon or build_lexicon(docs, path)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_texts(docs, _encoding(path, lexicon, True), schema)


def _encoding(path: str, lexicon: str, digests: bool):
    def make():
        encoder = Encoder(path, Lexicon(os.path.join(SparkFiles.getRootDirectory(), lexicon)))
        written = [str(n) for n in range(encoder.bpe.size)]

        def step(part: pa.RecordBatch) -> dict:
            ids = [own.tolist() for own in encoder.encode(texts_of(part))]
            columns = {"doc_id": part.column("doc_id")}
            if not digests:
                return columns | {"ids": ids, "text": [encoder.decode(i) for i in ids]}
            return columns | {
                "n_tokens": [len(i) for i in ids],
                "ids_sha256": [sha256(",".join(map(written.__getitem__, i))) for i in ids],
                "decoded_sha256": [sha256(encoder.decode(i)) for i in ids],
            }

        return step

    return make


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
