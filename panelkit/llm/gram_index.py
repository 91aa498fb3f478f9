"""Spelling variants: words one edit apart, by an index of grams of variable length.

Grams that many words share are extended by a letter, rare ones are not, so the lists of the index
have alike lengths. A word is decomposed into the grams of that dictionary that no other contains.
An edit can only change grams near its place: those that end well before it, and those that end
well behind it, are the same in both words. So for every place of a word its bound is known: which
grams, and how many, a near word must share. Their lists are merged by one key made of all of
them, and what a merged list holds is verified by the letters themselves.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.operators.staging import settle

from .common import documents, text_slices, texts_of

LETTERS = "A-Za-zÀ-ÿ"
RUN = re.compile(f"[{LETTERS}]+")
LEAST_LETTERS, LEAST_COUNT = 5, 3
FAULT_EVERY = 97
"""A word of a document whose checksum this divides loses a letter."""
FORM_RATIO = 2
"""A form must be that many times as frequent as its variant."""
SHORTEST, LONGEST = 2, 4
"""Lengths of grams. Words are padded so that one of LEAST_LETTERS has a gram apart from any edit."""
PAD = LONGEST - SHORTEST
FREQUENT = 4096
"""Grams of a length that are extended, at most: each has more than that share of all of them."""
LONG_REST = 64
"""Longer rests of words stand in the index as digests."""
BASE, PRIME = 1_000_003, (1 << 61) - 1
HELD_WORDS = 200_000
"""Distinct words that a task counts before it passes them on."""


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) of all words that count: long and frequent enough, with the planted faults.

    Tasks count before anything is shuffled, so a very frequent word is a row per task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for part in text_slices(batch):
                ids = part.column("doc_id").to_pylist()
                for doc_id, text in zip(ids, texts_of(part), strict=True):
                    add_words(seen, doc_id, text)
                    if len(seen) > HELD_WORDS:
                        yield _counts(seen)
        yield _counts(seen)

    counted = documents(docs).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def add_words(seen: Counter[str], doc_id: int | None, text: str) -> None:
    """Count the words of a document; bytes are lower-cased, which leaves letters beyond Z alone."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for word, n in Counter(RUN.findall(text.encode().lower().decode())).items():
        if len(word) < LEAST_LETTERS:
            continue
        check = zlib.crc32(word.encode(), start)
        if check % FAULT_EVERY == 0:
            at = check % len(word)
            word = word[:at] + word[at + 1 :]
            if len(word) < LEAST_LETTERS:
                continue
        seen[word] += n


def _counts(seen: Counter[str]) -> pa.RecordBatch:
    words = pa.array(seen.keys(), pa.string())
    out = pa.RecordBatch.from_arrays([words, pa.array(seen.values(), pa.int64())], ["word", "n"])
    seen.clear()
    return out


# ---- the dictionary and the grams of a word -------------------------------------------------


def frequent_grams(words: DataFrame) -> frozenset[str]:
    """The inner nodes of the gram trie: grams that are extended by the letter after them.

    A gram is extended if more than 1 / FREQUENT of all grams of its length are that one, so
    there are FREQUENT of each length at most, however many words there are.
    """
    padded = F.concat(F.lit("^" * PAD), F.col("word"), F.lit("$" * PAD))
    lengths = range(SHORTEST, LONGEST)

    def cut(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(padded) - n + 1)
        return F.transform(starts, lambda i: F.substring(padded, i, F.lit(n)))

    grams = words.select(F.explode(F.concat(*[cut(n) for n in lengths])).alias("gram"))
    counts = settle(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")))
    size = F.length("gram")
    totals = dict(counts.groupBy(size.alias("size")).agg(F.sum("n")).collect())
    least = F.lit(0.0)
    for n, total in totals.items():
        least = F.when(size == n, F.lit(total / FREQUENT)).otherwise(least)
    return frozenset(r["gram"] for r in counts.where(F.col("n") > least).select("gram").collect())


def decompose(word: str, frequent: frozenset[str]) -> list[tuple[int, int, str]]:
    """(first, last, gram) of a padded word: at each place the dictionary's gram, if no other
    holds it."""
    padded = "^" * PAD + word + "$" * PAD
    grams, reach = [], -1
    for first in range(len(padded) - SHORTEST + 1):
        end = first + SHORTEST
        while end - first < LONGEST and end < len(padded) and padded[first:end] in frequent:
            end += 1
        if end - 1 > reach:
            reach = end - 1
            grams.append((first, reach, padded[first:end]))
    return grams


def merge_keys(word: str, frequent: frozenset[str]) -> tuple[list[int], list[int]]:
    """Keys of the lists to merge, for each place: if its letter is replaced or deleted, and if
    a letter is inserted before it (or at the end).

    Unaffected by an edit at a place are the grams that begin LONGEST places before it or
    earlier, since the choice of a gram looks no further ahead, and those behind it that reach
    further than any gram that begins no later than the place, since no such gram can then
    hold them. The key names these grams, their places from the start or from the end, and the
    place itself. It is a checksum: lists that share one by chance are told apart later.
    """
    grams = decompose(word, frequent)
    size = len(word) + 2 * PAD
    before, behind = [zlib.crc32(b"")], [0]
    for first, _, gram in grams:
        before.append(zlib.crc32(f"{first}{gram}".encode(), before[-1]))
    for first, _, gram in reversed(grams):
        behind.append(zlib.crc32(f"{size - first}{gram}".encode(), behind[-1]))
    starts, ends = [g[0] for g in grams], [g[1] for g in grams]

    def key(place: int, first_behind: int, reach: int) -> int:
        left = bisect_right(starts, place - LONGEST)
        right = len(grams) - max(bisect_left(starts, first_behind), bisect_left(ends, reach))
        return ((before[left] & 0x7FFFFFFF) << 32 | behind[right]) ^ place * 0x9E3779B9

    places = range(PAD, PAD + len(word))
    changed = [key(at, at + 1, at + LONGEST) for at in places]
    longer = [key(at, at, at + LONGEST - 1) for at in (*places, PAD + len(word))]
    return changed, longer


def rest_digests(word: str) -> tuple[list[str], list[str]]:
    """For each place digests of the word without its letter there, and of the word as it is.

    They are made of polynomial hashes of what stands before and behind, so a long word costs
    no more than its length.
    """
    ahead, behind = [0], [0]
    for letter in word:
        ahead.append((ahead[-1] * BASE + ord(letter)) % PRIME)
    power = 1
    for letter in reversed(word):
        behind.append((behind[-1] + ord(letter) * power) % PRIME)
        power = power * BASE % PRIME
    size, powers = len(word), [1]
    for _ in word:
        powers.append(powers[-1] * BASE % PRIME)

    def digest(first: int, then: int) -> str:
        joined = (ahead[first] * powers[then] + behind[then]) % PRIME
        return f"#{first + then}:{joined}"

    whole = digest(size, 0)
    return [digest(i, size - i - 1) for i in range(size)], [whole] * (size + 1)


def entries(number: int, word: str, n: int, frequent: frozenset[str]) -> Iterator[tuple]:
    """(key, place, rest, last, letter, n, number) of a word, see ``index_words``."""
    changed, longer = merge_keys(word, frequent)
    digests = rest_digests(word) if len(word) > LONG_REST else None
    for letters, keys in ((word, changed), ([""] * len(longer), longer)):
        shorter = bool(letters[0])
        plain = len(word) - shorter <= LONG_REST
        for i, (letter, key) in enumerate(zip(letters, keys, strict=True)):
            last = word[i - 1] if i else ""
            if plain:
                rest = word[:i] + word[i + 1 :] if shorter else word
                yield key, i, rest, last, letter, n, None
            else:
                yield key, i, digests[0 if shorter else 1][i], last, letter, n, number


def index_words(words: DataFrame, frequent: frozenset[str]) -> DataFrame:
    """(key, place, rest, last, letter, n, number) of (number, word, n): the index.

    ``letter`` put at ``place`` of ``rest`` is the word, ``last`` the letter before it. A word
    has an entry for each of its letters, and one without a letter for each place where a longer
    word could have one more. A rest of more than LONG_REST letters is a digest and comes with
    the number of the word.
    """
    shared = words.sparkSession.sparkContext.broadcast(frequent)  # bounded, see frequent_grams
    kinds = [pa.int64(), pa.int32(), *[pa.string()] * 3, pa.int64(), pa.int64()]
    names = ["key", "place", "rest", "last", "letter", "n", "number"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rows = shared.value, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("number", "word", "n")]
            for number, word, n in zip(*columns, strict=True):
                for entry in entries(number, word, n, known):
                    rows.append(entry)
                    if len(rows) == 50_000:
                        yield batch_of(rows)
                        rows = []
        if rows:
            yield batch_of(rows)

    schema = "key long, place int, rest string, last string, letter string, n long, number long"
    return words.select("number", "word", "n").mapInArrow(run, schema)


def near_words(index: DataFrame, words: DataFrame) -> DataFrame:
    """(word, n_near, best): number of near words, and (-n, word) of the most frequent one.

    Entries of a merged list that agree in all other letters are near words, or the same one.
    The rest of the word is part of the shuffle key, so a long list is shared by many tasks and
    a group has an entry per letter of the alphabet and one without, at most. A word that loses
    one of several equal letters in a row is near by the first of them only, so no pair is
    counted twice. Pairs found by digests are verified by their words.
    """

    def apart(one: Column, other: Column) -> Column:
        return (
            (one["letter"] != other["letter"])
            & ((one["letter"] != "") | (F.col("last") != other["letter"]))
            & ((other["letter"] != "") | (F.col("last") != one["letter"]))
        )

    def whole(member: Column) -> Column:
        behind = F.substring("rest", F.col("place") + 1, F.length("rest"))
        return F.concat(F.substring("rest", F.lit(1), F.col("place")), member["letter"], behind)

    own = F.col("own")
    groups = index.groupBy("key", "place", "rest", "last").agg(
        F.collect_list(F.struct("letter", "n", "number")).alias("members")
    )
    each = groups.where(F.size("members") > 1).select(
        "place", "rest", "last", "members", F.explode("members").alias("own")
    )
    each = each.withColumn("near", F.filter("members", lambda other: apart(own, other)))
    each = settle(each.where(F.size("near") > 0).drop("members", "last"))
    best = F.array_min(
        F.transform("near", lambda m: F.struct((-m["n"]).alias("n"), whole(m).alias("word")))
    )
    short = each.where("own.number IS NULL").select(
        whole(own).alias("word"), F.size("near").cast("long").alias("n_near"), best.alias("best")
    )
    pairs = each.where("own.number IS NOT NULL").select(
        own["number"].alias("number"), F.explode("near.number").alias("other")
    )
    one = words.select("number", "word")
    other = words.select(
        F.col("number").alias("other"), (-F.col("n")).alias("n"), F.col("word").alias("near")
    )
    checked = pairs.join(one, "number").join(other, "other")
    long = checked.where(F.levenshtein("word", "near", 1) == 1).select(
        "word",
        F.lit(1).cast("long").alias("n_near"),
        F.struct("n", F.col("near").alias("word")).alias("best"),
    )
    return short.unionByName(long).groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min("best").alias("best")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the form of the form and so on, to the last.

    A form is more frequent than its word, so there are no circles. Each round doubles the
    steps that are taken at once.
    """
    links = settle(forms.select("word", F.col("form").alias("root")))
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = links.join(further, "root", "left")
        if joined.where("next IS NOT NULL").isEmpty():
            return links
        links = settle(joined.select("word", F.coalesce("next", "root").alias("root")))


def group_variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (doc_id, text).

    Words are runs of letters up to U+00FF, with A to Z lower-cased, of LEAST_LETTERS letters
    and LEAST_COUNT occurrences at least. A word of a document may lose a letter first, which a
    checksum of ``doc_id:word`` decides; a NULL doc_id counts as empty there. Words are near if
    one letter more, less or other makes one the other. The form is the most frequent near word
    (of equals the first in code-point order) if it is FORM_RATIO times as frequent, else NULL;
    the root is the last of the chain of forms, or the word itself. A NULL or empty text has no
    words, repeated rows count again, and an empty table gives none.
    """
    words = settle(count_words(docs).withColumn("number", F.monotonically_increasing_id()))
    found = settle(near_words(index_words(words, frequent_grams(words)), words))
    strong = -F.col("best.n") >= FORM_RATIO * F.col("n")
    out = words.join(found, "word", "left").select(
        "word",
        F.when(strong, F.col("best.word")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, -F.col("best.n")).alias("form_n"),
    )
    out = settle(out)
    root = roots(out.where("form IS NOT NULL"))
    return out.join(root, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
