"""What the operators of this subpackage share: tables, text slices, 64-bit mixing, samples."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1_000_000
"""Text handled at once by a Python worker; a single longer text is a slice of its own."""
KNOWN_WORDS = 30_000
"""Distinct words that a worker of a stage of the pipeline remembers in each of two generations.
Workers live as long as their executor and keep the memory that their largest task took."""
PIECE_WORDS = 8192
"""New words whose values are found at once: the arrays for that are far larger than the words."""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(df: DataFrame, *extra: str) -> DataFrame:
    """(doc_id, text) of a table with whatever other columns; a missing text stays NULL."""
    return df.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        *[F.col(c) for c in extra],
    )


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the third of the documents from which nothing is learned; a NULL id is one."""
    rest = F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id) % 3
    return F.coalesce(rest == 1, F.lit(True))


def text_slices(batch: pa.RecordBatch, name: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a slice have about SLICE_BYTES, whatever their lengths."""
    lengths = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(lengths, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = total[start - 1] if start else 0
        end = int(np.searchsorted(total, before + SLICE_BYTES, side="right"))
        end = max(start + 1, end)
        yield batch.slice(start, end - start)
        start = end


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Texts as Python strings, a missing one as the empty text."""
    return [t if t is not None else "" for t in batch.column(name).to_pylist()]


def map_texts(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict]], schema: str
) -> DataFrame:
    """Run a function over slices of ``df`` (which has a ``text`` column), without a shuffle.

    ``make`` is called once per task, so that what it loads (a vocabulary, a model) is kept
    for all slices. The function gets a slice and returns the output columns as lists.
    """
    names = [field.strip().split(" ")[0] for field in schema.split(",")]
    empty = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(empty)
        step = None
        for batch in batches:
            step = step or make()
            for part in text_slices(batch):
                columns = step(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[n], type=out.field(n).type) for n in names], schema=out
                )

    return df.mapInArrow(run, schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit words (shift-multiply, as at the end of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


def thinned(df: DataFrame, label: str, key: str, rows: int) -> DataFrame:
    """Rows of each label with the lowest hashes of the key, about twice ``rows`` (or all).

    The share to take follows from the number of rows of the label, so what is left does not
    grow with the table or its number of tasks. ``sample_per_class`` takes the same rows from
    it as from the whole. There is one count per label, and labels are as few as a model has.
    """
    sizes = df.groupBy(F.col(label).alias("__class")).agg(F.count(F.lit(1)).alias("__size"))
    share = F.lit(2.0 * rows + 64) / F.col("__size")
    place = F.xxhash64(key) / F.lit(2.0**64) + F.lit(0.5)
    return (
        df.join(F.broadcast(sizes), F.col(label) == F.col("__class"))
        .where(place <= share)
        .drop("__class", "__size")
    )


def sample_per_class(df: DataFrame, label: str, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows of each label, chosen by a hash of the key.

    Spark's group limit keeps that many per task before the shuffle, so a label of any size
    never meets in one task.
    """
    from pyspark.sql import Window

    order = Window.partitionBy(label).orderBy(F.xxhash64(key), F.col(key))
    ranked = df.withColumn("__nth", F.row_number().over(order))
    return ranked.where(F.col("__nth") <= rows).drop("__nth")


def joined_ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] numbers), starts[1], ... in one array."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(counts.sum())


def in_pieces(
    learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], size: int = PIECE_WORDS
) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
    """``learn`` of ``size`` words at a time; the values of a word depend on no other word."""

    def learnt(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(words) <= size:
            return learn(words)
        found = [learn(words[at : at + size]) for at in range(0, len(words), size)]
        values, counts = zip(*found, strict=True)
        return np.concatenate(values), np.concatenate(counts)

    return learnt


class _Numbers(dict):
    """Numbers of words in the order in which they are first asked for."""

    def __init__(self) -> None:
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.fresh.append(word)
        return n


class RecentWords:
    """What a worker knows of the words it met lately: any number of values for each.

    ``learn`` gets words and returns their values, one word after another, and how many each
    has. There are two generations. When the younger holds ``limit`` words it becomes the older,
    and words met again move over, so frequent words stay known and twice ``limit`` words and
    those of one call are held at most.
    """

    def __init__(
        self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int
    ) -> None:
        self.learn, self.limit = learn, limit
        self.values = learn([])[0]
        self.now, self.before = self._nothing(), self._nothing()

    def _nothing(self) -> tuple[_Numbers, np.ndarray, np.ndarray, np.ndarray]:
        none = np.empty(0, np.int64)
        return _Numbers(), none, none, self.values[:0]

    def of(self, words: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Where the values of all words of all lists begin in ``values``, and how many there are."""
        if len(self.now[0]) > self.limit:
            self.before, self.now = self.now, self._nothing()
        numbers, starts, counts, values = self.now
        total = sum(map(len, words))
        each = np.fromiter(
            map(numbers.__getitem__, chain.from_iterable(words)), np.int64, total
        )
        if fresh := numbers.fresh:
            numbers.fresh = []
            new_values, new_counts = self._fresh(fresh)
            new_starts = len(values) + np.cumsum(new_counts) - new_counts
            starts, counts = np.append(starts, new_starts), np.append(counts, new_counts)
            values = np.concatenate([values, new_values])
            self.now = (numbers, starts, counts, values)
        self.values = values
        return starts[each], counts[each]

    def _fresh(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Values and counts of words that are new to the younger generation."""
        numbers, starts, counts, values = self.before
        get = numbers.get
        old = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        new = np.flatnonzero(old < 0)
        learnt, learnt_counts = self.learn([words[n] for n in new.tolist()])
        if len(new) == len(words):
            return learnt, learnt_counts
        again = np.flatnonzero(old >= 0)
        out_counts = np.empty(len(words), np.int64)
        out_counts[new], out_counts[again] = learnt_counts, counts[old[again]]
        at = np.cumsum(out_counts) - out_counts
        out = np.empty(out_counts.sum(), learnt.dtype)
        out[joined_ranges(at[new], out_counts[new])] = learnt
        out[joined_ranges(at[again], out_counts[again])] = values[
            joined_ranges(starts[old[again]], out_counts[again])
        ]
        return out, out_counts


def total_by(values: np.ndarray, lengths: Iterable[int]) -> np.ndarray:
    """Sums of consecutive stretches of ``values``; an empty stretch has the sum 0."""
    ends = np.cumsum(np.fromiter(lengths, np.int64))
    summed = np.concatenate([[0], np.cumsum(values)])
    return np.diff(summed[np.concatenate([[0], ends])])
