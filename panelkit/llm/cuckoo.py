"""Exact duplicates through a cuckoo-filter index over content digests.

The filter keeps a 16-bit fingerprint of every live digest in one of two buckets, which can be
told from each other by the fingerprint alone, so digests can also be taken out again. A hit is
compared with the digest stored for that slot. When an insertion finds no room after many
moves, the table is doubled and filled again from the stored digests.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.operators.staging import fits_in_broadcast, settle

from .common import documents

BLANKS = " \t\n\x0b\x0c\r"
SLOTS = 4
MOVES = 200
HELD_DIGESTS = 400_000
"""Live digests of a task's first index before it passes them on and starts afresh."""
BROADCAST_BYTES = 16 << 20


class CuckooIndex:
    """Digests (bytes of 16 or more) with a value each. One instance serves one task."""

    def __init__(self, buckets: int = 1 << 10) -> None:
        self.keys: list[bytes | None] = []
        self.values: list = []
        self.free: list[int] = []
        self.live = 0
        self._empty(buckets)

    def _empty(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.prints = array("H", bytes(2 * buckets * SLOTS))
        self.rows = array("q", bytes(8 * buckets * SLOTS))

    @staticmethod
    def _parts(key: bytes) -> tuple[int, int]:
        """Fingerprint (never 0, which marks a free slot) and first bucket before masking."""
        return int.from_bytes(key[:2], "little") or 1, int.from_bytes(key[2:8], "little")

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & self.mask

    def _slot(self, key: bytes) -> int:
        """Slot of a digest, -1 if it is not live. Equal fingerprints are verified."""
        mark, first = self._parts(key)
        bucket = first & self.mask
        for at in (bucket, self._other(bucket, mark)):
            for slot in range(at * SLOTS, at * SLOTS + SLOTS):
                if self.prints[slot] == mark and self.keys[self.rows[slot]] == key:
                    return slot
        return -1

    def get(self, key: bytes):
        slot = self._slot(key)
        return None if slot < 0 else self.values[self.rows[slot]]

    def put(self, key: bytes, value) -> None:
        """Insert a digest or give a live one a new value."""
        slot = self._slot(key)
        if slot >= 0:
            self.values[self.rows[slot]] = value
            return
        if self.free:
            row = self.free.pop()
            self.keys[row], self.values[row] = key, value
        else:
            row = len(self.keys)
            self.keys.append(key)
            self.values.append(value)
        self.live += 1
        if not self._place(key, row):
            self._grow()

    def delete(self, key: bytes) -> bool:
        """Take a digest out; False if it was not live."""
        slot = self._slot(key)
        if slot < 0:
            return False
        row = self.rows[slot]
        self.prints[slot] = 0
        self.keys[row] = self.values[row] = None
        self.free.append(row)
        self.live -= 1
        return True

    def _place(self, key: bytes, row: int) -> bool:
        mark, first = self._parts(key)
        bucket = first & self.mask
        for at in (bucket, self._other(bucket, mark)):
            for slot in range(at * SLOTS, at * SLOTS + SLOTS):
                if not self.prints[slot]:
                    self.prints[slot], self.rows[slot] = mark, row
                    return True
        for move in range(MOVES):
            slot = bucket * SLOTS + (row + move) % SLOTS
            mark, self.prints[slot] = self.prints[slot], mark
            row, self.rows[slot] = self.rows[slot], row
            bucket = self._other(bucket, mark)
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.prints[slot]:
                    self.prints[slot], self.rows[slot] = mark, row
                    return True
        return False

    def _grow(self) -> None:
        """Double the table until every stored digest finds room."""
        buckets = self.mask + 1
        while True:
            buckets *= 2
            self._empty(buckets)
            if all(
                self._place(key, row) for row, key in enumerate(self.keys) if key is not None
            ):
                return

    def items(self) -> Iterator[tuple[bytes, object]]:
        return ((k, v) for k, v in zip(self.keys, self.values, strict=True) if k is not None)


def content_digest(text: Column) -> Column:
    """SHA-256 (32 bytes) of a text without blanks; a NULL text is the empty one."""
    plain = F.translate(F.coalesce(text, F.lit("")), BLANKS, "")
    return F.unhex(F.sha2(plain.cast("binary"), 256))


def _merge(batches: Iterator[pa.RecordBatch], first: bool) -> Iterator[pa.RecordBatch]:
    """Combine rows of equal digests: their number, and the best (longest, smallest id, row)."""
    index = CuckooIndex()
    names = ("digest", "group_size", "chars", "doc_id", "row")
    types = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64())

    def out() -> Iterator[pa.RecordBatch]:
        found = [
            (k, n, -best[0], best[2], best[3]) for k, (n, best) in index.items() if first or n > 1
        ]
        for at in range(0, len(found), 50_000):
            part = list(zip(*found[at : at + 50_000], strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(part, types, strict=True)], names=list(names)
            )

    for batch in batches:
        for key, n, chars, doc_id, row in zip(
            *(batch.column(name).to_pylist() for name in names), strict=True
        ):
            best = (-chars, doc_id is None, doc_id or 0, row)
            best = (best[0], best[1], doc_id, row) if doc_id is None else best
            held = index.get(key)
            if held is None:
                index.put(key, (n, best))
            else:
                index.put(key, (held[0] + n, min(held[1], best, key=_order)))
        if first and index.live > HELD_DIGESTS:
            yield from out()
            index = CuckooIndex()
    yield from out()


def _order(best: tuple) -> tuple:
    return (best[0], best[1], best[2] or 0, best[3])


GROUP_SCHEMA = "digest binary, group_size long, chars long, doc_id long, row long"


def duplicate_groups(slim: DataFrame) -> DataFrame:
    """Groups of two and more among rows (digest, chars, doc_id, row), one row each.

    ``group_size`` is the number of rows, the other columns are those of the row that stays:
    the most characters, then the smallest id (NULL is last), then the smallest row. Every task
    combines its own rows in an index first, so a digest of very many rows leaves it as one
    row; then each digest's rows meet in the index of one task.
    """
    rows = slim.select("digest", F.lit(1).cast("long").alias("group_size"), "chars", "doc_id", "row")
    partial = rows.mapInArrow(lambda b: _merge(b, True), GROUP_SCHEMA)
    return partial.repartition("digest").mapInArrow(lambda b: _merge(b, False), GROUP_SCHEMA)


def _small(groups: DataFrame) -> DataFrame:
    return F.broadcast(groups) if fits_in_broadcast(groups, 64, BROADCAST_BYTES) else groups


def find_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of (doc_id, text).

    Texts are equal when they are without BLANKS; a NULL text is empty. Of equal texts the row
    with the most characters stays, then the one with the smallest id; of rows that repeat id
    and text just one is kept. An empty table gives none. Texts are read once: what is joined
    are digests, settled in the shared folder. A digest held by a third of all rows meets its
    group by broadcast while the groups are few, else by a join that Spark splits.
    """
    docs = documents(docs)
    slim = settle(
        docs.select(
            "doc_id",
            content_digest(F.col("text")).alias("digest"),
            F.length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    groups = settle(duplicate_groups(slim)).select(
        "digest", "group_size", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row")
    )
    joined = slim.join(_small(groups), "digest", "left")
    alone = F.col("group_size").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose texts ``find_duplicates`` keeps, with all their columns.

    A NULL text is the empty one, and an empty table stays empty. Of equal texts the row with
    the most characters stays, then the one with the smallest id (NULL is last); of rows that
    repeat id and text too the one whose other columns have the smallest hash, and one of those
    equal in everything. Texts are read once to find the groups and once to be kept or dropped:
    what is joined are digests, by broadcast while the groups are few, else the rows meet them
    by their digest.
    """
    marked = docs.withColumns(
        {
            "__digest": content_digest(F.col("text").cast("string")),
            "__chars": F.length(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("long"),
            "__id": F.col("doc_id").cast("long"),
            "__row": F.xxhash64(*[c for c, kind in docs.dtypes if "map<" not in kind]),
        }
    )
    slim = marked.select(
        F.col("__digest").alias("digest"),
        F.col("__chars").alias("chars"),
        F.col("__id").alias("doc_id"),
        F.col("__row").alias("row"),
    )
    groups = settle(duplicate_groups(slim)).select(
        F.col("digest").alias("__digest"),
        F.col("group_size").alias("__size"),
        F.col("doc_id").alias("__best_id"),
        F.col("row").alias("__best_row"),
    )
    joined = marked.join(_small(groups), "__digest", "left")
    alone = joined.where(F.col("__size").isNull())
    best = (F.col("__row") == F.col("__best_row")) & F.col("__id").eqNullSafe(F.col("__best_id"))
    # only rows that are equal in everything are still more than one
    kept = joined.where(F.col("__size").isNotNull() & best).dropDuplicates(["__digest"])
    return alone.unionByName(kept).select(docs.columns)
