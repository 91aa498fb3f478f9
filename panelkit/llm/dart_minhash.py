"""Near duplicates by DartMinHash signatures and banded joining.

A document is the set of its five-word shingles (or a weighted set). Every element owns a
region, as wide as its weight, into which darts fall at hashed places: a dart has a height and
belongs to one of the signature's coordinates, and the lowest dart of a coordinate is kept. All
documents that hold an element see the same darts, so two signatures agree in a coordinate with
the probability of the (weighted) Jaccard similarity. Darts are thrown strip by strip from the
bottom, only as high as is needed to fill all coordinates: about k log k darts per document.

Bands of coordinates are joined on their hash. Pairs that meet are compared exactly, and
documents that are linked, directly or through others, form a class.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators.staging import fits_in_broadcast, settle

from .common import documents, map_texts, mix64, powers, texts_of

SHINGLE = 5
COORDINATES, BAND = 120, 5
SIMILARITY = (4, 5)
"""Pairs are linked from 4/5 on. A pair just there shares no band with a chance of 7e-5."""
BLOCK = 128
"""Members of a band that are compared with each other, or with as many others, at once."""
COLUMNS = 8192
"""Different shingles of two blocks that are counted at once."""
BROADCAST_BYTES = 16 << 20

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_WORD = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of every word: runs of letters, digits and non-ASCII, in lower case."""
    data = np.frombuffer(text.lower().encode(), np.uint8)
    inside = _WORD[data]
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    power = powers(0x100000001B3, int(lengths.max()))
    scaled = (data[inside].astype(np.uint64) + np.uint64(1)) * power[place]
    return mix64(np.add.reduceat(scaled, np.cumsum(lengths) - lengths))


def shingles(text: str) -> np.ndarray:
    """Sorted distinct hashes of SHINGLE consecutive words; a shorter text is one shingle."""
    words = word_hashes(text)
    if not len(words):
        return words
    width = min(SHINGLE, len(words))
    out = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        out = out * _GOLD + words[i : len(out) + i]
    return np.unique(mix64(out))


@lru_cache(maxsize=1)
def _strips() -> tuple[np.ndarray, np.ndarray]:
    """Lower edges and heights: [0, 2**-10), doubling up to 1, then steps of 1."""
    low = np.concatenate([[0.0], 2.0 ** np.arange(-10, 0), np.arange(1.0, 4097.0)])
    return low, np.diff(np.append(low, 4097.0))


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53


def signature(elements: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """The lowest dart of each coordinate, for hashed elements (all of weight 1 by default).

    An element of weight w owns ceil(w) cells of width 1; in the last one only darts left of
    the weight's fraction count. The elements must not be empty.
    """
    cells, share = elements, None
    if weights is not None:
        count = np.maximum(np.ceil(weights), 1).astype(np.int64)
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        cells = mix64(np.repeat(elements, count) + nth.astype(np.uint64) * _GOLD)
        share = np.minimum(np.repeat(weights, count) - nth, 1.0)
    total = len(cells) if share is None else float(share.sum())
    low, height = _strips()
    wanted = COORDINATES * (np.log(COORDINATES) + 2)
    while True:
        strips = min(int(np.searchsorted(low, wanted / total)), len(low)) or 1
        salt = mix64(np.arange(1, strips + 1, dtype=np.uint64) * _GOLD)
        thrown = mix64(cells[:, None] ^ salt[None, :])
        chance = _unit(thrown)
        number = np.zeros(thrown.shape, np.int64)  # Poisson with the strip's height as mean
        term = np.exp(-height[:strips])
        below = term.copy()
        for n in range(1, 40):
            more = chance > below
            if not more.any():
                break
            number += more
            term = term * height[:strips] / n
            below = below + term
        cell, strip = np.nonzero(number)
        times = number[cell, strip]
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        cell, strip = np.repeat(cell, times), np.repeat(strip, times)
        dart = mix64(thrown[cell, strip] + (nth.astype(np.uint64) + np.uint64(1)) * _GOLD)
        rank = low[strip] + height[strip] * _unit(mix64(dart ^ np.uint64(1)))
        if share is not None:
            hit = _unit(mix64(dart ^ np.uint64(2))) < share[cell]
            dart, rank = dart[hit], rank[hit]
        order = np.argsort(rank, kind="stable")
        dart = dart[order]
        where, first = np.unique(
            mix64(dart ^ np.uint64(3)) % np.uint64(COORDINATES), return_index=True
        )
        if len(where) == COORDINATES:
            return dart[first]
        if strips == len(low):
            raise ValueError("the weights are too small to fill a signature")
        wanted *= 2


def bands(sign: np.ndarray) -> np.ndarray:
    """One join key per band of BAND coordinates."""
    out = np.arange(1, COORDINATES // BAND + 1, dtype=np.uint64)
    for i in range(BAND):
        out = mix64(out * _GOLD + sign[i::BAND])
    return out.view(np.int64)


def _signed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, node, n, keys): the node names the shingle set, NULL if empty."""

    def make():
        def step(part: pa.RecordBatch) -> dict:
            node, size, keys = [], [], []
            for text in texts_of(part):
                found = shingles(text)
                size.append(len(found))
                node.append(hashlib.md5(found.tobytes()).digest() if len(found) else None)
                keys.append(bands(signature(found)) if len(found) else None)
            return {
                "doc_id": part.column("doc_id"),
                "text_hash": part.column("text_hash"),
                "node": node,
                "n": size,
                "keys": keys,
            }

        return step

    schema = "doc_id long, text_hash long, node binary, n int, keys array<long>"
    return map_texts(docs, make, schema)


def _shingled(docs: DataFrame) -> DataFrame:
    """(node, found): the shingles of texts, as bytes."""

    def make():
        def step(part: pa.RecordBatch) -> dict:
            found = [shingles(t).tobytes() for t in texts_of(part)]
            return {"node": [hashlib.md5(f).digest() for f in found], "found": found}

        return step

    return map_texts(docs.select("text"), make, "node binary, found binary")


def _small(df: DataFrame, row_bytes: int) -> DataFrame:
    return F.broadcast(df) if fits_in_broadcast(df, row_bytes, BROADCAST_BYTES) else df


def _pairs(left: str, right: str) -> list:
    """Two nodes as (a, b) with a < b, if their sizes allow the similarity."""
    low, high = SIMILARITY
    fits = F.least("n", "other_n") * high >= F.greatest("n", "other_n") * low
    a, b = F.col(left), F.col(right)
    return [
        (a != b) & fits,
        F.least(a, b).alias("a"),
        F.greatest(a, b).alias("b"),
    ]


def _sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, found): the shingles of the wanted nodes; only their documents are read again."""
    chosen = settle(
        nodes.join(wanted, "node", "left_semi").select(
            F.col("doc_key").alias("__doc_key"), F.col("text_hash").alias("__text_hash")
        )
    )
    keyed = docs.withColumn("doc_key", _doc_key())
    texts = keyed.join(
        _small(chosen, 40),
        (keyed["doc_key"] == F.col("__doc_key")) & (keyed["text_hash"] == F.col("__text_hash")),
        "left_semi",
    )
    return settle(_shingled(texts).dropDuplicates(["node"]))


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes whose shingle sets reach the similarity, compared exactly."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = _sets(wanted, nodes, docs)
    both = (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("found").alias("found_a")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("found").alias("found_b")), "b")
        .select("a", "b", "found_a", "found_b")
    )
    low, high = SIMILARITY

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("found_a"), batch.column("found_b"), strict=True):
                one = np.frombuffer(x.as_buffer(), np.uint64)
                two = np.frombuffer(y.as_buffer(), np.uint64)
                same = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(same * high >= (len(one) + len(two) - same) * low)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(compare, "a binary, b binary")


def common_counts(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of ``one`` shares with each of ``two``, as a matrix product."""
    elements, place = np.unique(np.concatenate([*one, *two]), return_inverse=True)
    owner = np.repeat(np.arange(len(one) + len(two)), [len(s) for s in (*one, *two)])
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    out = np.zeros((len(one), len(two)), np.float32)
    for at in range(0, len(elements), COLUMNS):
        part = slice(*np.searchsorted(place, [at, at + COLUMNS]))
        held = np.zeros((len(one) + len(two), COLUMNS), np.float32)
        held[owner[part], place[part] - at] = 1
        out += held[: len(one)] @ held[len(one) :].T
    return out


def _bridges(tied: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) between components that meet in a band, from (key, node, root, held).

    All members of such a band are compared, in blocks: the members are dealt to blocks by a
    hash, blocks of a band are joined, and a task compares two blocks. One link is returned
    for two components of two blocks, never the pairs.
    """
    sets = _sets(tied.select("node").distinct(), nodes, docs)
    number = F.pmod(F.xxhash64("node"), F.ceil(F.col("held") / BLOCK).cast("long"))
    blocks = settle(
        tied.withColumn("block", number)
        .join(sets, "node")
        .groupBy("key", "block")
        .agg(F.collect_list(F.struct("node", "root", "found")).alias("members"))
    )
    others = blocks.select(
        "key", F.col("block").alias("other"), F.col("members").alias("other_members")
    )
    met = blocks.join(others, "key").where(F.col("block") <= F.col("other"))
    low, high = SIMILARITY

    def parts(members) -> tuple[list[bytes], list[bytes], list[np.ndarray]]:
        rows = members.values
        nodes, roots = (rows.field(n).to_pylist() for n in ("node", "root"))
        return nodes, roots, [np.frombuffer(x, np.uint64) for x in rows.field("found").to_pylist()]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links: dict[tuple[bytes, bytes], tuple[bytes, bytes]] = {}
            for left, right in zip(
                batch.column("members"), batch.column("other_members"), strict=True
            ):
                (a_nodes, a_roots, one), (b_nodes, b_roots, two) = parts(left), parts(right)
                same = common_counts(one, two)
                sizes = np.add.outer([len(x) for x in one], [len(x) for x in two])
                near = same * high >= (sizes - same) * low
                near &= np.array(a_roots, object)[:, None] != np.array(b_roots, object)[None, :]
                for i, j in zip(*np.nonzero(near), strict=True):
                    links.setdefault((a_roots[i], b_roots[j]), (a_nodes[i], b_nodes[j]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[n] for x in links.values()], pa.binary()) for n in (0, 1)],
                names=["a", "b"],
            )

    return met.select("members", "other_members").mapInArrow(compare, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of the component of each linked node.

    Links (a, b) are rewritten by turns until they form stars: first every node's larger
    neighbours, then its smaller ones, are tied to its smallest. That takes few rounds, each
    settled in the shared folder, and no node's neighbours are ever gathered.
    """

    def tie(edges: DataFrame, larger: bool) -> DataFrame:
        if larger:
            near = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        joined = near.join(low, "a")
        if larger:
            out = joined.where(F.col("b") > F.col("a")).select("b", "m")
        else:
            out = joined.select("b", "m").union(low.select(F.col("a").alias("b"), "m"))
        out = out.select(F.col("b").alias("a"), F.col("m").alias("b"))
        return out.where(F.col("a") != F.col("b")).distinct()

    def state(edges: DataFrame) -> tuple:
        total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        return tuple(edges.agg(F.count("*"), total).first())

    edges = settle(links.select("a", "b").distinct())
    seen = state(edges)
    while seen[0]:
        edges = settle(tie(tie(edges, True), False))
        now = state(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _doc_key():
    """The id, or a number no id has for a missing one."""
    return F.coalesce("doc_id", F.lit(-(2**63)).cast("long"))


def _classified(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, node, class_id, class_size, kept) of docs (doc_id, text, text_hash)."""
    signed = settle(_signed(docs))
    filled = signed.where(F.col("node").isNotNull())
    nodes = settle(
        filled.groupBy("node").agg(
            F.min(F.struct(_doc_key().alias("doc_key"), "text_hash")).alias("one"),
            F.first("n").alias("n"),
            F.first("keys").alias("keys"),
        )
        .select("node", "one.doc_key", "one.text_hash", "n", "keys")
    )
    rows = nodes.select("node", "n", F.explode("keys").alias("key"))
    shared = rows.groupBy("key").agg(
        F.count("*").alias("held"),
        F.min(F.struct(F.xxhash64("node", "key").alias("h"), "node", "n")).alias("lead"),
    )
    shared = shared.where("held > 1").select(
        "key", "held", F.col("lead.node").alias("other"), F.col("lead.n").alias("other_n")
    )
    # members of a band meet its leader, another one in each band
    met = settle(rows.join(shared, "key"))
    keep, a, b = _pairs("node", "other")
    pairs = settle(met.where(keep).select(a, b).distinct())
    links = settle(_verified(pairs, nodes, docs))
    roots = settle(components(links))
    # where a band of three or more still holds several components, its members meet each other
    tied = (
        met.where("held > 2")
        .select("key", "node", "held")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    mixed = tied.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"))
    mixed = mixed.where(F.col("x") != F.col("y")).select("key")
    tied = settle(tied.join(mixed, "key", "left_semi"))
    if not tied.isEmpty():
        links = settle(links.union(_bridges(tied, nodes, docs)))
        roots = settle(components(links))
    # every class takes the smallest id of its documents, and keeps one of them by id and text
    classes = nodes.join(roots, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root")
    )
    sized = filled.groupBy("node").agg(
        F.min("doc_id").alias("least"),
        F.count("*").alias("held"),
        F.min(
            F.struct(
                F.col("doc_id").isNull().alias("lacks_id"),
                _doc_key().alias("keep_key"),
                F.col("text_hash").alias("keep_hash"),
            )
        ).alias("keeper"),
    )
    classes = settle(classes.join(sized, "node"))
    whole = classes.groupBy("root").agg(
        F.min("least").alias("class_id"),
        F.sum("held").alias("class_size"),
        F.min("keeper").alias("first"),
    )
    named = classes.join(whole.where("class_size > 1"), "root").select(
        "node", "class_id", "class_size", "first.keep_key", "first.keep_hash"
    )
    found = signed.select("doc_id", "text_hash", "node").join(
        _small(settle(named), 80), "node", "left"
    )
    same = (_doc_key() == F.col("keep_key")) & (F.col("text_hash") == F.col("keep_hash"))
    return found.withColumn("kept", F.coalesce(same, F.lit(True))).drop("keep_key", "keep_hash")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, class_size, kept), one row per row of (doc_id, text).

    Documents of a class are linked, directly or through others, by shingle sets with a
    Jaccard similarity of 4/5 or more. ``class_id`` is the smallest id in the class, and that
    document is kept; of texts that share this id, or all lack one, the one with the smallest
    hash. Rows that repeat both id and text are one document. Texts without words (also NULL)
    are alone. NULL ids count as the last; an empty table gives an empty one. Equal shingle
    sets are one node before any join, so copies cost nothing, and no pair of nodes is lost
    that shares a band: members meet the leader of the band, then members of bands that are still
    not connected meet each other, in blocks.
    """
    docs = documents(docs).withColumn("text_hash", F.xxhash64("text"))
    found = _classified(docs)
    class_id = F.when(F.col("class_size").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    return found.select(
        "doc_id",
        class_id.alias("class_id"),
        F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"),
        "kept",
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` without the documents that ``near_duplicates`` does not keep.

    All columns stay. A document without words (also NULL) stays; of a class the document with
    the smallest id stays (NULL is last), of several texts under that id the one with the
    smallest hash, and rows that repeat both id and text are one document: they stay or go
    together. An empty table stays empty.
    """
    own = documents(docs).withColumn("text_hash", F.xxhash64("text"))
    gone = _classified(own).where(~F.col("kept"))
    gone = settle(
        gone.select(_doc_key().alias("__gone_key"), F.col("text_hash").alias("__gone_hash"))
        .distinct()
    )
    key = F.coalesce(docs["doc_id"].cast("long"), F.lit(-(2**63)).cast("long"))
    same = (key == F.col("__gone_key")) & (
        F.xxhash64(docs["text"].cast("string")) == F.col("__gone_hash")
    )
    return docs.join(_small(gone, 40), same, "left_anti")
