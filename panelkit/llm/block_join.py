"""Nearest neighbours by inner product as a join of blocks of vectors.

Vectors are packed into blocks of int8 codes. Every query block meets every candidate block; the
product of the codes, a matrix product whose integers float32 holds exactly, gives each inner
product up to a known quantisation error. A candidate whose upper bound is below a query's k-th
lower bound cannot be among its neighbours; the others are computed again from the original
numbers in double precision. Heaps merge what the tiles found.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators.staging import settle

CANDIDATES = 8192
QUERIES = 1024
"""Vectors per block, at most. A tile holds CANDIDATES * QUERIES bounds for a moment."""
NEAREST = 20


def usable(vectors: DataFrame, every_row: bool = False) -> DataFrame:
    """(vec_id, embedding) as doubles, without vectors that take no part.

    That is: NULL, empty or zero vectors, NULL or non-finite components, NULL ids. Of rows
    that repeat an id, the smallest vector counts, with ``every_row`` each of them.
    """
    numbers = F.col("embedding").cast("array<double>")
    finite = F.forall(
        numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= 1.7976931348623157e308)
    )
    some = F.exists(numbers, lambda x: x != 0)
    kept = vectors.where(F.col("vec_id").isNotNull() & F.coalesce(finite & some, F.lit(False)))
    kept = kept.select(F.col("vec_id").cast("long").alias("vec_id"), numbers.alias("embedding"))
    if every_row:
        return kept
    return kept.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


BLOCK = (
    "block long, size int, dim int, ids binary, vectors binary, codes binary, scale binary, "
    "norm binary, error binary"
)


def blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """Pack each task's vectors into blocks of ``rows``, separate for each dimension.

    ``scale`` turns codes into numbers, ``norm`` is the length of a vector and ``error`` that
    of what the codes leave out.
    """

    def pack(number: int, dim: int, held: list) -> dict:
        ids = np.array([i for i, _ in held], np.int64)
        x = np.array([v for _, v in held], np.float64)
        peak = np.abs(x).max(1)
        scale = peak / 127
        safe = np.where(scale > 0, scale, 1.0)
        codes = np.rint(x / safe[:, None]).clip(-127, 127).astype(np.int8)
        left = x - codes * safe[:, None]
        return {
            "block": number,
            "size": len(ids),
            "dim": dim,
            "ids": ids.tobytes(),
            "vectors": x.tobytes(),
            "codes": codes.tobytes(),
            "scale": safe.tobytes(),
            "norm": np.linalg.norm(x, axis=1).tobytes(),
            "error": np.linalg.norm(left, axis=1).tobytes(),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: dict[int, list] = {}

        def out(dim: int) -> pa.RecordBatch:
            nonlocal number
            number += 1
            row = pack(number, dim, held.pop(dim))
            types = {"block": pa.int64(), "size": pa.int32(), "dim": pa.int32()}
            return pa.RecordBatch.from_pydict(
                {k: pa.array([v], types.get(k, pa.binary())) for k, v in row.items()}
            )

        for batch in batches:
            for vec_id, v in zip(
                batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist(), strict=True
            ):
                held.setdefault(len(v), []).append((vec_id, v))
                if len(held[len(v)]) >= rows:
                    yield out(len(v))
        for dim in list(held):
            yield out(dim)

    return vectors.mapInArrow(run, BLOCK)


def nearest(
    vectors: DataFrame, every: int = 20, k: int = NEAREST, every_row: bool = False
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of each query, nearest first.

    Queries are the vectors of (vec_id, embedding) whose id is divisible by ``every``,
    candidates all others of the same dimension. ``score`` is the inner product in double
    precision; equal scores are ranked by the smaller id. With fewer candidates all are
    returned. Vectors that ``usable`` leaves out take no part; an empty table gives none.
    With ``every_row``, rows that repeat an id are candidates each, and queries of one id share
    its ``k`` places; a vector is never a neighbour of its own id.

    Blocks are joined, not rows: a tile task holds one block of each side. A query block is
    copied to every candidate block, as the search asks for; the result of a tile is at most
    ``k`` rows per query.
    """
    kept = settle(usable(vectors, every_row))
    candidates = settle(blocks(kept, CANDIDATES))
    queries = settle(blocks(kept.where(F.col("vec_id") % every == 0), QUERIES))
    # the candidate blocks' names go along with every query block of their dimension
    names = candidates.groupBy("dim").agg(F.collect_list("block").alias("others"))
    left = queries.join(names, "dim").withColumn("other", F.explode("others")).drop("others")
    left = left.select("other", *[F.col(c).alias(f"q_{c}") for c in queries.columns if c != "dim"], F.col("dim"))
    right = candidates.select(
        F.col("block").alias("other"), *[F.col(c).alias(f"c_{c}") for c in candidates.columns if c != "dim"]
    )
    tiles = left.join(right, "other")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                cell = {n: batch.column(n)[row] for n in batch.schema.names}
                yield _tile(cell, k)

    found = tiles.mapInArrow(search, "query_id long, vec_id long, score double")
    merged = found.repartition("query_id").mapInArrow(
        lambda b: _merge(b, k), "query_id long, rank int, vec_id long, score double"
    )
    return merged


def _tile(cell: dict, k: int) -> pa.RecordBatch:
    """The best ``k`` candidates of one block for each query of another."""
    dim = cell["dim"].as_py()

    def part(name: str, kind: type, wide: bool = False) -> np.ndarray:
        data = np.frombuffer(cell[name].as_buffer(), kind)
        return data.reshape(-1, dim) if wide else data

    q_ids, c_ids = part("q_ids", np.int64), part("c_ids", np.int64)
    q_scale, c_scale = part("q_scale", np.float64), part("c_scale", np.float64)
    q_norm, c_norm = part("q_norm", np.float64), part("c_norm", np.float64)
    q_error, c_error = part("q_error", np.float64), part("c_error", np.float64)
    q, c = part("q_vectors", np.float64, True), part("c_vectors", np.float64, True)
    c_codes = part("c_codes", np.int8, True).astype(np.float32).T
    q_codes = part("q_codes", np.int8, True).astype(np.float32)
    out_q, out_c, out_s = [], [], []
    for at in range(0, len(q), 64):
        rows = slice(at, at + 64)
        if dim <= 1000:  # sums of products of codes stay below 2**24
            product = (q_codes[rows] @ c_codes).astype(np.float64)
        else:
            product = q_codes[rows].astype(np.float64) @ c_codes
        about = product * q_scale[rows, None] * c_scale
        # <x, y> = <x', y'> + <x - x', y> + <x', y - y'>, and |x'| <= |x| + |x - x'|
        slack = q_error[rows, None] * c_norm + (q_norm + q_error)[rows, None] * c_error
        slack += 1e-12 * (np.abs(about) + slack) + 1e-300
        low, high = about - slack, about + slack
        open_ = ~np.isfinite(about + slack)  # bounds of huge numbers overflow: look at them all
        low[open_], high[open_] = -np.inf, np.inf
        own = q_ids[rows, None] == c_ids
        low[own], high[own] = -np.inf, -np.inf
        keep = min(k, len(c_ids))
        border = np.partition(low, len(c_ids) - keep, axis=1)[:, len(c_ids) - keep]
        for n in range(len(low)):
            maybe = np.flatnonzero((high[n] >= border[n]) & ~own[n])
            score = np.zeros(len(maybe))
            for column, x in zip(c[maybe].T, q[at + n].tolist(), strict=True):
                score += column * x  # in the order of the components
            best = np.lexsort((c_ids[maybe], -score))[:k]
            out_q.append(np.full(len(best), q_ids[at + n]))
            out_c.append(c_ids[maybe][best])
            out_s.append(score[best])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(x) if x else []) for x in (out_q, out_c, out_s)],
        names=["query_id", "vec_id", "score"],
    )


def _merge(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """A heap of the ``k`` best per query of this task; its root is the worst of them."""
    heaps: dict[int, list[tuple[float, int]]] = {}
    for batch in batches:
        for query, vec, score in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            heap = heaps.setdefault(query, [])
            if len(heap) < k:
                heapq.heappush(heap, (score, -vec))
            elif (score, -vec) > heap[0]:
                heapq.heapreplace(heap, (score, -vec))
    rows = [
        (query, rank, -vec, score)
        for query, heap in heaps.items()
        for rank, (score, vec) in enumerate(sorted(heap, reverse=True), 1)
    ]
    for at in range(0, len(rows), 50_000):
        part = list(zip(*rows[at : at + 50_000], strict=True))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(part, kinds, strict=True)],
            names=["query_id", "rank", "vec_id", "score"],
        )
