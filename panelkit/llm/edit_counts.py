"""Token counts that follow edits without encoding a text again.

Each edited document keeps its words, as lengths and token counts, in the blocks of a balanced
tree whose nodes hold the sums of their subtrees. The splitting rule reads from left to right and
never looks back, and where a word ends depends on what follows up to the first character that is
no space. So after an edit it is enough to split again from the last word before it that is not
blank until a new word starts where an old one did; everything further right is as it was. Only
the words in between are encoded again. They replace the old ones in the tree, which renews the
sums on the paths to them and no others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, map_texts, texts_of, total_by
from .transducer import Encoder

FIRST_WINDOW = 64
"""Characters after an edit that are split at first; doubled until old and new words meet."""
BLOCK = 64
"""Words in a block of the tree, at most."""


class Node:
    """A block of words between the words of two subtrees, and the sums of all of them."""

    __slots__ = ("lengths", "tokens", "left", "right", "blocks", "words", "chars", "total")

    def __init__(self, lengths: np.ndarray, tokens: np.ndarray) -> None:
        self.lengths, self.tokens = lengths, tokens
        self.left: Node | None = None
        self.right: Node | None = None


class CountTree:
    """Consecutive words under sums of words, characters and tokens.

    ``touched`` counts the nodes whose sums were made or renewed. Joining two trees takes the
    root of either in proportion to its size, so the depth stays logarithmic.
    """

    def __init__(self, lengths: np.ndarray, tokens: np.ndarray) -> None:
        self.touched, self.state = 0, 1
        self.root = self._built(lengths, tokens)

    def _renew(self, node: Node, left: Node | None, right: Node | None) -> Node:
        self.touched += 1
        node.left, node.right = left, right
        node.blocks, node.words = 1, len(node.lengths)
        node.chars, node.total = int(node.lengths.sum()), int(node.tokens.sum())
        for side in (left, right):
            if side is not None:
                node.blocks += side.blocks
                node.words += side.words
                node.chars += side.chars
                node.total += side.total
        return node

    def _built(self, lengths: np.ndarray, tokens: np.ndarray) -> Node | None:
        def build(first: int, last: int) -> Node | None:
            if first == last:
                return None
            middle = (first + last) // 2
            part = slice(middle * BLOCK, (middle + 1) * BLOCK)
            node = Node(lengths[part], tokens[part])
            return self._renew(node, build(first, middle), build(middle + 1, last))

        return build(0, -(-len(lengths) // BLOCK))

    def _split(self, node: Node | None, words: int) -> tuple[Node | None, Node | None]:
        """The first ``words`` words, and the others."""
        if node is None:
            return None, None
        before = node.left.words if node.left else 0
        if words <= before:
            left, right = self._split(node.left, words)
            return left, self._renew(node, right, node.right)
        inside = words - before
        if inside >= len(node.lengths):
            left, right = self._split(node.right, inside - len(node.lengths))
            return self._renew(node, node.left, left), right
        rest = Node(node.lengths[inside:], node.tokens[inside:])
        right = self._joined(self._renew(rest, None, None), node.right)
        node.lengths, node.tokens = node.lengths[:inside], node.tokens[:inside]
        return self._renew(node, node.left, None), right

    def _joined(self, left: Node | None, right: Node | None) -> Node | None:
        if left is None or right is None:
            return right if left is None else left
        self.state = self.state * 6364136223846793005 % 2**64 + 1442695040888963407
        if (self.state >> 33) % (left.blocks + right.blocks) < left.blocks:
            return self._renew(left, left.left, self._joined(left.right, right))
        return self._renew(right, self._joined(left, right.left), right.right)

    @property
    def total(self) -> int:
        return self.root.total if self.root else 0

    @property
    def words(self) -> int:
        return self.root.words if self.root else 0

    def word_at(self, place: int) -> tuple[int, int]:
        """Number and start of the word that holds the character at ``place``.

        Behind the last character these are the number and the end of all words.
        """
        node, number, start = self.root, 0, 0
        while node is not None:
            chars = node.left.chars if node.left else 0
            if place < start + chars:
                node = node.left
                continue
            start += chars
            number += node.left.words if node.left else 0
            own = int(node.lengths.sum())
            if place < start + own:
                ends = np.cumsum(node.lengths)
                at = int(np.searchsorted(ends, place - start, side="right"))
                return number + at, start + int(ends[at] - node.lengths[at])
            start, number, node = start + own, number + len(node.lengths), node.right
        return number, start

    def replace(self, first: int, last: int, lengths: np.ndarray, tokens: np.ndarray) -> None:
        """Put new words in place of those from ``first`` to before ``last``."""
        left, rest = self._split(self.root, first)
        _, right = self._split(rest, last - first)
        self.root = self._joined(self._joined(left, self._built(lengths, tokens)), right)

    def leaves(self) -> Iterator[tuple[int, int]]:
        """Length and tokens of each word, in order."""
        stack, node = [], self.root
        while stack or node is not None:
            while node is not None:
                stack.append(node)
                node = node.left
            node = stack.pop()
            yield from zip(node.lengths.tolist(), node.tokens.tolist(), strict=True)
            node = node.right


class CountedText:
    """A text and the tree of its words; edits may follow each other."""

    def __init__(
        self, encoder: Encoder, text: str, words: list[str] | None = None,
        tokens: np.ndarray | None = None,
    ) -> None:
        self.encoder, self.text, self.encoded = encoder, text, 0
        words = encoder.bpe.byte_words(text) if words is None else words
        tokens = encoder.counts([words]) if tokens is None else tokens
        self.tree = CountTree(np.fromiter(map(len, words), np.int64, len(words)), tokens)

    def after(self, edits: list[tuple[int, int, str]]) -> int:
        """Token count after all edits (start, end, new text), which must not overlap.

        Offsets are code points of the text as it was. Text and tree then are those of the new
        text. The last edit is made first, so what is left of an edit is still the old text and
        what is right of it already the new one.
        """
        edits = sorted(edits)
        pieces, places, at, size = [], [], 0, 0
        for start, end, put in edits:
            if start < at or end < start or end > len(self.text):
                raise ValueError(f"edit {start}:{end} overlaps another or leaves the text")
            pieces += [self.text[at:start], put]
            places.append(size + start - at)
            size += start - at + len(put)
            at = end
        text = "".join([*pieces, self.text[at:]])
        for edit, place in zip(reversed(edits), reversed(places), strict=True):
            self._edit(*edit, text, place)
        self.text = text
        return self.tree.total

    def _edit(self, start: int, end: int, put: str, text: str, place: int) -> None:
        """One edit, which stands at ``place`` of the new ``text``."""
        tree = self.tree
        first, begin = tree.word_at(start)
        while first > 0:  # the word before, and further back over blank ones
            ended = begin
            first, begin = tree.word_at(ended - 1)
            if not self.text[begin:ended].isspace():
                break
        width = FIRST_WINDOW
        while True:
            stop = min(len(text), place + len(put) + width)
            words = self.encoder.bpe.byte_words(self.text[begin:start] + text[place:stop])
            if stop < len(text):
                words = words[:-1]  # the window may have cut it short
            at, kept, last = begin, None, tree.words
            for n in range(len(words) + 1):
                if at >= start + len(put):
                    number, old = tree.word_at(at - len(put) + end - start)
                    if old == at - len(put) + end - start:
                        kept, last = n, number
                        break
                if n < len(words):
                    at += len(words[n])
            if kept is None and stop < len(text):
                width *= 2
                continue
            words = words if kept is None else words[:kept]
            break
        tokens = self.encoder.counts([words])
        self.encoded += int(tokens.sum())
        tree.replace(first, last, np.fromiter(map(len, words), np.int64, len(words)), tokens)


def count_with_edits(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, n_edits, n_tokens_after, n_encoded_again) of every whole text.

    ``docs`` has (doc_id, text, edits) and any other columns; ``edits`` is an array of
    (start, end, text) in code points that do not overlap, or NULL. ``path`` is a byte-level
    vocabulary file; special tokens spelt in a text are ordinary text. A NULL text is empty and
    has 0 tokens; repeated rows give repeated rows; an empty table gives none. No shuffle. Only
    a document with edits needs a tree.
    """
    edits = F.col("edits").cast("array<struct<start:long,end:long,text:string>>").alias("edits")
    docs = docs.select(F.col("doc_id"), F.col("text"), edits)
    schema = "doc_id long, n_tokens long, n_edits long, n_tokens_after long, n_encoded_again long"

    def make():
        encoder = Encoder(path)

        def step(part: pa.RecordBatch) -> dict:
            texts = texts_of(part)
            cut = [encoder.bpe.byte_words(t) for t in texts]
            tokens, sizes = encoder.counts(cut), [len(words) for words in cut]
            ends = np.cumsum(sizes)
            before = total_by(tokens, sizes)
            n_edits, after, again = [], before.copy(), np.zeros(len(texts), np.int64)
            for n, edits in enumerate(part.column("edits").to_pylist()):
                changes = [(e["start"], e["end"], e["text"] or "") for e in edits or () if e]
                n_edits.append(len(changes))
                if changes:
                    own = tokens[ends[n] - sizes[n] : ends[n]]
                    counted = CountedText(encoder, texts[n], cut[n], own)
                    after[n] = counted.after(changes)
                    again[n] = counted.encoded
            return {
                "doc_id": part.column("doc_id"),
                "n_tokens": before,
                "n_edits": n_edits,
                "n_tokens_after": after,
                "n_encoded_again": again,
            }

        return step

    return map_texts(documents(docs, "edits"), make, schema)
