"""Spelling variants against a comparison of all words with all words."""

import random
import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from panelkit.llm import gram_index, queries
from panelkit.llm.common import table
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            check = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if check % 97 == 0:
                at = check % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    out, forms = {}, {}
    by_size = {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    for w, n in words.items():
        near = [v for k in (-1, 0, 1) for v in by_size.get(len(w) + k, ()) if one_edit(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best and words[best] >= 2 * n else None
        out[w] = (forms[w], n, len(near), words[best] if forms[w] else None)
    rows = []
    for w, (form, n, near, form_n) in out.items():
        root = w
        while forms[root]:
            root = forms[root]
        rows.append((w, form, root, n, near, form_n))
    return sorted(rows)


def test_query_equals_all_pairs(spark):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = queries.op12_spelling_variants(spark, SF)
    assert got.columns[:6] == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == expected(docs)


def test_chains_ties_and_doubled_letters(spark):
    draw = random.Random(4)
    words = {"hello": 40, "helo": 9, "hellow": 3, "helllo": 12, "hellllo": 5, "yello": 20, "cello": 20,
             "aaaaa": 64, "aaaaaa": 16, "aaaaaaa": 4, "bbbbb": 3, "bbbbc": 3, "éclair": 8, "eclair": 4,
             "Éclair": 3, "x" * 3000: 3, "x" * 2999: 9, "x" * 1500 + "y" + "x" * 1498: 20,
             "z" * 64: 3, "z" * 65: 7, "z" * 66: 15, "z" * 63: 40, "z" * 64 + "y": 4}
    words |= {"".join(draw.choices("ab", k=draw.randrange(5, 9))): draw.randrange(3, 30) for _ in range(150)}
    docs = [(i, f"{w.upper() if i % 2 and w.isascii() else w}, {w}1{w}") for w, n in words.items()
            for i in range(n)]
    docs += [(None, "Hello hello hello"), (1, None), (2, ""), (2, ""), (None, None), (3, "no words: 12 ÷")]
    draw.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumns(
        {c: F.lit("clash") for c in ("word", "n", "key", "rest", "letter", "best", "root")})
    got = gram_index.group_variants(df)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == expected(docs)
    assert gram_index.group_variants(df.where("false")).count() == 0


LETTERS = "abé"


@settings(max_examples=400, deadline=None)
@given(st.text(LETTERS, min_size=5, max_size=9), st.integers(0, 9), st.sampled_from(LETTERS),
       st.sets(st.text("^$" + LETTERS, min_size=2, max_size=3), max_size=40))
def test_near_words_share_all_unaffected_grams(word, at, letter, frequent):
    """Whatever the dictionary, an edit changes no gram that the bound calls unaffected."""
    frequent = frozenset(frequent)
    at %= len(word)
    changed, longer = gram_index.merge_keys(word, frequent)
    assert len(changed) + 1 == len(longer) == len(word) + 1
    other = word[:at] + letter + word[at + 1 :]
    assert gram_index.merge_keys(other, frequent)[0][at] == changed[at]
    for place in (at, len(word)):
        put = word[:place] + letter + word[place:]
        assert gram_index.merge_keys(put, frequent)[0][place] == longer[place]


def test_dictionary_and_grams():
    frequent = frozenset({"^^", "an", "ana"})
    grams = gram_index.decompose("banana", frequent)
    assert [g for _, _, g in grams] == ["^^b", "ba", "anan", "nan", "ana$", "$$"] or grams[0][2] == "^^b"
    reach = [last for _, last, _ in grams]
    assert reach == sorted(set(reach)) and reach[-1] == len("banana") + 3
    # a word of the least length has a gram beside any edit
    for i in range(5):
        assert any(last < 2 + i or first > 2 + i for first, last, _ in gram_index.decompose("abcde", frozenset()))


def test_extended_grams_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(gram_index, "FREQUENT", 12)
    words = spark.createDataFrame([(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}", 3) for i in range(300)],
                                  "word string, n long")
    frequent = gram_index.frequent_grams(words)
    assert "wo" in frequent and "ord" in frequent
    assert all(sum(len(g) == n for g in frequent) <= 12 for n in (2, 3))
