"""Quality rules: an ordered list of learned conditions on plain statistics of a text.

Statistics of every document are columns. From those of labelled documents sequential covering
learns one rule after another: a conjunction of thresholds is grown on two thirds of what is left
until it covers no good document, then pruned on the other third, and what it covers is taken
away. The list is emitted as one conditional expression, which Spark evaluates itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (
    documents,
    held_out,
    map_texts,
    sample_per_class,
    texts_of,
    thinned,
    total_by,
)

LEAST_WORDS = 50
MOST_REPEATED = 50
"""Per cent of words in repeated windows, above which a text fails without any rule."""
WINDOW = 3
TRAIN_ROWS = 1000
"""Labelled documents of each quality that are learned from, at most: a row of numbers each."""
MOST_RULES, MOST_CONDITIONS = 12, 4
LEAST_PRECISION = 0.95
"""A rule must be right so often on the part that it was not grown on."""
LEAST_COVERED = 3

# Fixed value: characters that prose has few of.
SYMBOLS = b"#*$%&|<>"
_BLANK, _SYMBOL, _FIRST, _UPPER, _DIGIT, _MARK = (1 << n for n in range(6))


def _byte_kinds() -> np.ndarray:
    """What each byte of a text is; _FIRST marks the first byte of a character."""
    kinds = np.zeros(256, np.uint8)
    kinds[[*range(0x80), *range(0xC0, 256)]] |= _FIRST
    kinds[[9, 10, 11, 12, 13, 32]] |= _BLANK
    kinds[list(SYMBOLS)] |= _SYMBOL
    kinds[65:91] |= _UPPER
    kinds[48:58] |= _DIGIT
    kinds[list(b"!?")] |= _MARK
    return kinds


_KINDS = _byte_kinds()

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATES = {
    "word_length": ("word_chars", "n_words"),
    "symbol_rate": ("n_symbols", "n_words"),
    "dup_line_rate": ("n_dup_lines", "n_lines"),
    "repeat_rate": ("n_repeat_words", "n_words"),
    "upper_rate": ("n_upper", "word_chars"),
    "digit_rate": ("n_digits", "word_chars"),
    "mark_rate": ("n_marks", "n_words"),
    "again_rate": ("n_again", "n_words"),
    "top_rate": ("n_top", "n_words"),
    "line_length": ("n_words", "n_lines"),
}
FEATURES = ("n_words", *RATES)
OTHER_COUNTS = ("n_lines", "n_upper", "n_digits", "n_marks", "n_again", "n_top")


def repeated_words(words: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """Words of each text that stand in a window of WINDOW words which the text has twice.

    ``words`` are numbers of words, ``text`` the texts they stand in. Windows are told apart by
    numbering pairs of words, then pairs of pairs and words, then windows within a text.
    """
    if len(words) < WINDOW:
        return np.zeros(texts, np.int64)
    window = words[: len(words) - WINDOW + 1].astype(np.int64)
    for n in range(1, WINDOW):
        following = words[n : len(window) + n].astype(np.int64)
        window = np.unique(window << 32 | following, return_inverse=True)[1]
    owner = text[: len(window)]
    inside = np.flatnonzero(owner == text[WINDOW - 1 :])
    _, which, times = np.unique(
        owner[inside].astype(np.int64) << 32 | window[inside], return_inverse=True, return_counts=True
    )
    marked = np.zeros(len(words), bool)
    for n in range(WINDOW):
        marked[inside[times[which] > 1] + n] = True
    return np.bincount(text[marked], minlength=texts)


def statistics_of(texts: list[str]) -> dict[str, np.ndarray]:
    """COUNTS and OTHER_COUNTS of each text. Words are parted by ASCII blanks alone."""
    raw = [t.encode() for t in texts]
    sizes = [len(r) for r in raw]
    kinds = _KINDS[np.frombuffer(b"".join(raw), np.uint8)]

    def bytes_of(kind: int) -> np.ndarray:
        return total_by(kinds & kind > 0, sizes)

    words = [r.split() for r in raw]
    lengths = np.array([len(w) for w in words], np.int64)
    numbers: dict[bytes, int] = {}
    number = np.fromiter(
        (numbers.setdefault(w, len(numbers)) for w in chain.from_iterable(words)),
        np.int64,
        lengths.sum(),
    )
    text = np.repeat(np.arange(len(texts)), lengths)
    again = (number[1:] == number[:-1]) & (text[1:] == text[:-1])
    each, times = np.unique(text << 32 | number, return_counts=True)
    top = np.zeros(len(texts), np.int64)
    np.maximum.at(top, each >> 32, times)
    lines = [[line for line in r.split(b"\n") if line.strip()] for r in raw]
    n_lines = np.array([len(one) for one in lines], np.int64)
    return {
        "n_words": lengths,
        "word_chars": bytes_of(_FIRST) - bytes_of(_BLANK),
        "n_symbols": bytes_of(_SYMBOL),
        "n_dup_lines": n_lines - np.array([len(set(one)) for one in lines], np.int64),
        "n_repeat_words": repeated_words(number, text, len(texts)),
        "n_lines": n_lines,
        "n_upper": bytes_of(_UPPER),
        "n_digits": bytes_of(_DIGIT),
        "n_marks": bytes_of(_MARK),
        "n_again": np.bincount(text[1:][again], minlength=len(texts)),
        "n_top": top,  # of the most frequent word
    }


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, counts, rates) of every whole text; a NULL text has no words. No shuffle."""
    names = (*COUNTS, *OTHER_COUNTS)

    def make():
        def step(part: pa.RecordBatch) -> dict:
            return {"doc_id": part.column("doc_id")} | statistics_of(texts_of(part))

        return step

    counted = map_texts(
        documents(docs), make, "doc_id long, " + ", ".join(f"{n} long" for n in names)
    )
    rates = {
        name: F.when(F.col(below) > 0, F.col(above) / F.col(below)).otherwise(0.0)
        for name, (above, below) in RATES.items()
    }
    return counted.withColumns(rates).drop(*OTHER_COUNTS)


# ---- learning -------------------------------------------------------------------------------


class Condition(NamedTuple):
    """A statistic that is at most, or more than, a threshold."""

    feature: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        values = x[:, FEATURES.index(self.feature)]
        return values > self.threshold if self.above else values <= self.threshold

    def column(self) -> Column:
        value = F.col(self.feature).cast("double")
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def covered(rule: Sequence[Condition], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for condition in rule:
        out &= condition.holds(x)
    return out


def best_condition(x: np.ndarray, bad: np.ndarray) -> tuple[float, Condition | None]:
    """The threshold with the highest gain in information about the bad rows (FOIL's measure).

    All thresholds between two different values of all statistics are tried, by running sums.
    """
    p, n = bad.sum(), (~bad).sum()
    base = np.log2(p / (p + n))
    best: tuple[float, Condition | None] = (0.0, None)
    for k, feature in enumerate(FEATURES):
        order = np.argsort(x[:, k], kind="stable")
        values = x[order, k]
        edges = np.flatnonzero(values[1:] > values[:-1])
        if not len(edges):
            continue
        low_p = np.cumsum(bad[order])[edges]
        low = edges + 1
        for above in (False, True):
            inside_p = p - low_p if above else low_p
            inside = p + n - low if above else low
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(inside_p > 0, inside_p * (np.log2(inside_p / inside) - base), 0.0)
            at = int(gain.argmax())
            if gain[at] > best[0] + 1e-9:
                threshold = float((values[edges[at]] + values[edges[at] + 1]) / 2)
                best = float(gain[at]), Condition(feature, above, threshold)
    return best


def grow(x: np.ndarray, bad: np.ndarray) -> list[Condition]:
    """Add conditions until the rule covers no good row, or nothing more is gained."""
    rule: list[Condition] = []
    inside = np.ones(len(x), bool)
    while (~bad[inside]).any() and len(rule) < MOST_CONDITIONS:
        _, condition = best_condition(x[inside], bad[inside])
        if condition is None:
            break
        rule.append(condition)
        inside &= condition.holds(x)
    return rule


def prune(rule: list[Condition], x: np.ndarray, bad: np.ndarray) -> list[Condition]:
    """Cut the end of the rule off where that is right more often on rows it was not grown on."""

    def worth(n: int) -> tuple[float, int]:
        hit = covered(rule[:n], x)
        p, q = (hit & bad).sum(), (hit & ~bad).sum()
        return (float((p - q) / (p + q)) if p + q else -1.0), -n

    return rule[: max(range(1, len(rule) + 1), key=worth)] if rule else rule


def learn_rules(x: np.ndarray, bad: np.ndarray, seed: int = 0) -> list[Rule]:
    """An ordered list of rules for the bad rows; what no rule covers is good."""
    draw = np.random.default_rng(seed)
    rules: list[Rule] = []
    left = np.arange(len(x))
    while len(rules) < MOST_RULES and bad[left].any() and (~bad[left]).any():
        part = draw.permutation(len(left))
        # both parts hold bad and good rows in the same proportion
        order = part[np.argsort(bad[left][part], kind="stable")]
        tests = np.zeros(len(left), bool)
        tests[order[::3]] = True
        growing, testing = left[~tests], left[tests]
        if not bad[growing].any():
            break
        rule = prune(grow(x[growing], bad[growing]), x[testing], bad[testing])
        hit = covered(rule, x[testing])
        right, wrong = (hit & bad[testing]).sum(), (hit & ~bad[testing]).sum()
        gone = covered(rule, x[left])
        if not rule or not right or right / (right + wrong) < LEAST_PRECISION:
            break
        if (gone & bad[left]).sum() < LEAST_COVERED:
            break
        rules.append(tuple(rule))
        left = left[~gone]
    return rules


def train_rules(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> list[Rule]:
    """Rules from at most ``rows`` labelled documents of each ``quality`` in (doc_id, quality).

    Held-out documents, NULLs and values other than 0 and 1 are not learned from. Of labels or
    rows that repeat an id the least counts. Executors make the statistics, whole texts included,
    so the driver gets a few numbers per row however long the texts are. Without labels of both
    kinds there are no rules.
    """
    marks = (
        labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("quality").isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    marks = sample_per_class(thinned(marks, "quality", "doc_id", rows), "quality", "doc_id", rows)
    # marks has 2 * rows rows at most
    chosen = documents(docs).join(F.broadcast(marks.select("doc_id")), "doc_id", "left_semi")
    values = F.array(*[F.col(c).cast("double") for c in FEATURES]).alias("x")
    one = with_statistics(chosen).select("doc_id", values).groupBy("doc_id").agg(F.min("x").alias("x"))
    found = one.join(F.broadcast(marks), "doc_id").collect()
    found.sort(key=lambda r: r["doc_id"])
    x = np.array([r["x"] for r in found], float).reshape(len(found), len(FEATURES))
    return learn_rules(x, np.array([r["quality"] == 0 for r in found], bool))


def first_rule(rules: Sequence[Rule]) -> Column:
    """Number of the first rule that covers a row, from 1; 0 if none does."""
    if not rules:
        return F.lit(0)
    out = F
    for number, rule in enumerate(rules, 1):
        condition = F.lit(True)
        for part in rule:
            condition = condition & part.column()
        out = out.when(condition, number)
    return out.otherwise(0)


def judge(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(doc_id, counts, base_failed, kept, rule) of every whole text of (doc_id, text).

    A text fails at once that has fewer than LEAST_WORDS words or too many in repeated windows;
    of the others those are kept that no rule covers. A NULL or empty text has no words and
    fails. Repeated rows give repeated rows, an empty table none. No shuffle.
    """
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    rows = with_statistics(docs).withColumns({"base_failed": failed, "rule": first_rule(rules)})
    kept = ~F.col("base_failed") & (F.col("rule") == 0)
    return rows.select("doc_id", *COUNTS, "base_failed", kept.alias("kept"), "rule")
