"""Byte pair encoding of many words at once, exactly as the tokenizers library does it.

A vocabulary file (its path is an argument, the file is only read) gives symbols and merges.
Texts are cut into words by the file's own rule, and every distinct word is merged once:
``Bpe.merge`` takes all words of a slice together and does their next-best merges side by side.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import numpy as np

from .common import joined_ranges

NO_RANK = np.int32(2**31 - 1)
LONG_WORD = 48
"""Words of more symbols are merged one by one with a heap."""
WIDTHS = (7, 11, 17, LONG_WORD)
"""Shorter words are merged in blocks of these widths."""

# Letters, numbers and spaces of the first 256 code points.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = "\t\n\x0b\x0c\r \x85\xa0"
# Fixed value: endings that the splitting rules of both vocabularies keep apart.
ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"

BYTE_WORDS = re.compile(
    f"{ENDINGS}| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+"
    f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
LOWER_WORDS = re.compile(f"{ENDINGS}|[{LETTERS}]+|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+")


def is_latin(text: str) -> bool:
    """Only code points below 256, for which the rules above hold."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself if visible in Latin-1, else from 256 on."""
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    stand_in = {b: chr(b) for b in seen}
    for n, b in enumerate(b for b in range(256) if b not in stand_in):
        stand_in[b] = chr(256 + n)
    return [stand_in[b] for b in range(256)]


class Bpe:
    """Symbols and merges of one vocabulary file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.vocab = vocab
        self.suffix: str = spec["model"]["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = re.compile(
            "(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")"
        )
        self.size = 1 + max(max(vocab.values()), *self.special.values())
        symbols = byte_symbols()
        self.first = np.array([vocab[s] for s in symbols], np.int32)
        self.last = np.array([vocab[s + self.suffix] for s in symbols], np.int32)
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in spec["model"]["merges"]]
        self.made = np.array([p[2] for p in pairs], np.int32)
        self._build([a * self.size + b for a, b, _ in pairs])
        self.rank_of = {(a, b): n for n, (a, b, _) in enumerate(pairs)}
        back = {s: bytes([b]) for b, s in enumerate(symbols)}
        self.bytes_of: list[bytes] = [b""] * self.size
        for token, n in vocab.items():
            plain = token.removesuffix(self.suffix) if self.suffix else token
            if all(c in back for c in plain):
                self.bytes_of[n] = b"".join(back[c] for c in plain)
        for token, n in self.special.items():
            self.bytes_of[n] = token.encode()

    def _build(self, keys: list[int]) -> None:
        """Hash table from a pair of symbols to its rank, looked up for whole arrays."""
        self.bits = 20
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NO_RANK, np.int32)
        slots = self._slot(np.array(keys, np.int64)).tolist()
        mask, self.probes = (1 << self.bits) - 1, 1
        for rank, (key, slot) in enumerate(zip(keys, slots, strict=True)):
            step = 0
            while self.keys[(slot + step) & mask] >= 0:
                step += 1
            self.keys[(slot + step) & mask] = key
            self.ranks[(slot + step) & mask] = rank
            self.probes = max(self.probes, step + 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        spread = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of symbols; NO_RANK where either is -1 or they never merge."""
        key = left.astype(np.int64) * self.size + right
        key[(left < 0) | (right < 0)] = -2
        slot, mask = self._slot(key), (1 << self.bits) - 1
        out = np.full(key.shape, NO_RANK, np.int32)
        for step in range(self.probes):
            at = (slot + step) & mask
            hit = self.keys[at] == key
            out[hit] = self.ranks[at[hit]]
        return out

    def merge(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Token ids of each word."""
        flat, counts = self.merge_flat(words)
        ids, ends = flat.tolist(), np.cumsum(counts).tolist()
        return [tuple(ids[a:b]) for a, b in zip([0, *ends], ends, strict=False)]

    def merge_flat(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words, one word after another, and how many each has."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        counts = np.zeros(len(words), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for low, width in zip((0, *WIDTHS), WIDTHS, strict=False):
            rows = np.flatnonzero((lengths > low) & (lengths <= width))
            if not len(rows):
                continue
            padded = b"".join([words[n].ljust(width, b"\0") for n in rows.tolist()])
            raw = np.frombuffer(padded, np.uint8).reshape(len(rows), width)
            size, each = lengths[rows], np.arange(len(rows))
            symbols = self.first[raw]
            symbols[np.arange(width) >= size[:, None]] = -1
            symbols[each, size - 1] = self.last[raw[each, size - 1]]
            merged = self._merge_block(symbols)
            counts[rows] = (merged >= 0).sum(1)
            parts.append((rows, merged[merged >= 0]))
        for n in np.flatnonzero(lengths > LONG_WORD).tolist():
            ids = np.array(self._merge_long(words[n]), np.int32)
            counts[n] = len(ids)
            parts.append((np.array([n]), ids))
        flat = np.empty(counts.sum(), np.int32)
        at = np.cumsum(counts) - counts
        for rows, ids in parts:
            flat[joined_ranges(at[rows], counts[rows])] = ids
        return flat, counts

    def _merge_block(self, symbols: np.ndarray) -> np.ndarray:
        """Merge words side by side: in each round every word does its best, leftmost merge.

        A row holds a word's symbols, then -1. So does a row of the result.
        """
        done = symbols.copy()
        rows = np.arange(len(symbols))
        ranks = self.rank(symbols[:, :-1], symbols[:, 1:])
        while len(rows) and symbols.shape[1] > 1:
            at = ranks.argmin(1)
            best = ranks[np.arange(len(rows)), at]
            open_ = best < NO_RANK
            if not open_.all():
                done[rows[~open_]] = -1
                done[rows[~open_], : symbols.shape[1]] = symbols[~open_]
                rows, symbols, ranks, at, best = (
                    x[open_] for x in (rows, symbols, ranks, at, best)
                )
                if not len(rows):
                    break
            each = np.arange(len(rows))
            symbols[each, at] = self.made[best]
            columns = np.arange(symbols.shape[1] - 1)
            symbols = np.take_along_axis(symbols, columns + (columns > at[:, None]), 1)
            if symbols.shape[1] == 1:
                break
            columns = columns[:-1]
            ranks = np.take_along_axis(ranks, columns + (columns >= at[:, None]), 1)
            right = at < symbols.shape[1] - 1
            r, c = each[right], at[right]
            ranks[r, c] = self.rank(symbols[r, c], symbols[r, c + 1])
            left = at > 0
            r, c = each[left], at[left]
            ranks[r, c - 1] = self.rank(symbols[r, c - 1], symbols[r, c])
        if len(rows):
            done[rows] = -1
            done[rows, : symbols.shape[1]] = symbols
        return done

    def _merge_long(self, word: bytes) -> tuple[int, ...]:
        """The same for one long word, in n log n: a heap of pairs over a linked list."""
        ids = [int(self.first[b]) for b in word]
        ids[-1] = int(self.last[word[-1]])
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank_of, made = self.rank_of, self.made
        heap = [
            (rank, i, ids[i], ids[i + 1])
            for i in range(n - 1)
            if (rank := rank_of.get((ids[i], ids[i + 1]))) is not None
        ]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = int(made[rank]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := rank_of.get((ids[x], ids[y]))) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return tuple(i for i in ids if i >= 0)

    def byte_words(self, text: str) -> list[str]:
        """Words of a byte-level vocabulary: they cover the text. No special tokens inside."""
        if is_latin(text):
            return BYTE_WORDS.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]


@lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    """The vocabulary at ``path``, once per Python process."""
    return Bpe(path)
