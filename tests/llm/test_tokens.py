"""Byte pairs, edits and windows against the tokenizers library."""

import hashlib
import random
import zlib

import public_tokenizers
from panelkit.llm import disclosure, edit_counts, packing, queries, transducer
from panelkit.llm.common import table
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"
BYTE, WORD = queries.BYTE_BPE, queries.WORD_BPE


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def check_encoding(docs, found):
    library = Tokenizer.from_file(BYTE)
    expected = []
    for r in docs.select("doc_id", "text").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(decoded)))
    got = [tuple(r) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_encoding_equals_library(spark, odd):
    check_encoding(odd, transducer.digest_documents(odd, BYTE))
    check_encoding(table(spark, SF, "documents"), queries.op3_bpe(spark, SF))


def test_small_lexicon_changes_nothing(odd):
    lexicon = transducer.build_lexicon(odd, BYTE, words=3)
    check_encoding(odd, transducer.digest_documents(odd, BYTE, lexicon))


def test_round_trip(odd, none):
    found = transducer.encode_documents(odd, BYTE).collect()
    texts = sorted(t or "" for (t,) in odd.select("text").collect())
    assert sorted(r["text"] for r in found) == texts
    assert transducer.encode_documents(none, BYTE).collect() == []


def test_lexicon_finds_its_words_only():
    words = sorted({bytes(random.Random(n).choices(b"abc", k=1 + n % 7)) for n in range(900)})
    outputs = [(n, n + 1) for n in range(len(words))]
    lexicon = transducer.Lexicon(transducer.compile_lexicon(words, outputs))
    others = [w + b"z" for w in words] + [b"", b"abcabcabcabc", b"q"]
    assert lexicon.find(words + others) == outputs + [None] * len(others)
    assert len(lexicon.keys) < sum(map(len, words))  # prefixes and suffixes are shared
    assert transducer.Lexicon(transducer.compile_lexicon([], [])).find([b"a"]) == [None]


def test_counts_follow_edits():
    library = Tokenizer.from_file(BYTE)
    library.encode_special_tokens = True
    encoder = transducer.Encoder(BYTE)
    draw = random.Random(7)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for _ in range(1500):
        text = "".join(draw.choices(" ab'sS.\n1é日́<|>  \t!X", k=draw.randint(0, 60)))
        at = sorted(draw.randint(0, len(text)) for _ in range(2 * draw.randint(0, 4)))
        edits = [
            (a, b, "".join(draw.choices(" ab.\n's1", k=draw.randint(0, 5))))
            for a, b in zip(at[::2], at[1::2], strict=True)
        ]
        edited, end = "", 0
        for a, b, put in sorted(edits):
            edited += text[end:a] + put
            end = b
        edited += text[end:]
        counted = edit_counts.CountedText(encoder, text)
        assert counted.tree.total == count(text)
        assert counted.after(edits) == count(edited), (text, edits)


def test_edits_follow_edits():
    encoder = transducer.Encoder(BYTE)
    draw = random.Random(8)
    for _ in range(500):
        text = "".join(draw.choices(" ab'sS.\n1é日́<|>  \t!X", k=draw.randint(0, 60)))
        counted = edit_counts.CountedText(encoder, text)
        for _ in range(4):
            at = sorted(draw.randint(0, len(text)) for _ in range(2 * draw.randint(0, 3)))
            edits = sorted(
                (a, b, "".join(draw.choices(" ab.\n's1", k=draw.randint(0, 5))))
                for a, b in zip(at[::2], at[1::2], strict=True)
            )
            shift = 0
            for a, b, put in edits:
                text = text[: a + shift] + put + text[b + shift :]
                shift += len(put) - (b - a)
            fresh = edit_counts.CountedText(encoder, text)
            assert counted.after(edits) == fresh.tree.total, (text, edits)
            assert counted.text == text
            assert list(counted.tree.leaves()) == list(fresh.tree.leaves())


def test_an_edit_touches_few_words():
    encoder = transducer.Encoder(BYTE)
    text = "a few plain words, " * 5000
    counted = edit_counts.CountedText(encoder, text)
    counted.after([(40_000, 40_005, "other")])
    assert counted.encoded < 50


def test_an_edit_renews_the_sums_of_few_nodes():
    """The sums on the paths to the edited words, not those of the whole tree."""
    encoder = transducer.Encoder(BYTE)
    text = "a few plain words, " * 20_000
    counted = edit_counts.CountedText(encoder, text)
    nodes = counted.tree.touched
    assert nodes == counted.tree.root.blocks > 1500
    draw = random.Random(2)
    for n in range(60):
        at, before = draw.randrange(len(counted.text)), counted.tree.touched
        counted.after([(at, min(at + 3, len(counted.text)), "some other words ")])
        assert counted.tree.touched - before < 150
        assert n % 20 or counted.tree.total == len(
            Tokenizer.from_file(BYTE).encode(counted.text, add_special_tokens=False).ids)
    assert sum(length for length, _ in counted.tree.leaves()) == len(counted.text)


def test_edit_counts_of_odd_documents(odd, none, spark):
    from pyspark.sql import functions as F

    edits = F.expr("array(struct(0L AS start, 0L AS end, 'new ' AS text))")
    found = edit_counts.count_with_edits(odd.withColumn("edits", edits), BYTE)
    library = Tokenizer.from_file(BYTE)
    library.encode_special_tokens = True
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    expected = [
        (r["doc_id"], count(r["text"] or ""), 1, count("new " + (r["text"] or "")))
        for r in odd.collect()
    ]
    got = [tuple(r)[:4] for r in found.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    missing = odd.withColumn("edits", F.expr("cast(null as array<struct<a:long,b:long,c:string>>)"))
    assert all(r["n_edits"] == 0 for r in edit_counts.count_with_edits(missing, BYTE).collect())
    assert edit_counts.count_with_edits(none.withColumn("edits", edits), BYTE).count() == 0


def test_masks_of_overlapping_spans(spark, tmp_path):
    texts = [
        "a 10.0.0.1@host.com b", "+14155550100@x.com", "x +1 4111 1111 1111 1111@b.cd y",
        "4111111111111111@b.cd and 10.0.0.1", "1.2.3.4.5.6.7.8@a.b, c@d.ef", "none", "", None,
    ]
    rows = list(enumerate(texts))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    docs = table(spark, tmp_path, "documents")
    expected = dict(disclosure.sanitise(docs).collect())
    marked = disclosure.with_spans(docs).select("doc_id", "text", queries._masks().alias("edits"))
    n_edits = {r["doc_id"]: r["n_edits"] for r in queries.op2_token_counts(spark, tmp_path).collect()}
    assert n_edits[0] == n_edits[1] == 1
    for r in marked.collect():
        text = r["text"]
        for start, end, put in reversed(r["edits"]):
            text = text[:start] + put + text[end:]
        assert text == expected[r["doc_id"]] and n_edits[r["doc_id"]] == len(r["edits"])


def check_packing(docs, pieces):
    """Every token in one piece, pieces gapless in their windows; returns the padding."""
    import numpy as np

    library = Tokenizer.from_file(WORD)
    expected = {}
    for r in docs.select("doc_id", "text").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        expected.setdefault(r["doc_id"], []).append(np.array(ids, "<u4"))
    rows = pieces.collect()
    windows, tokens = {}, 0
    starts = {}
    for r in rows:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        starts.setdefault(r["doc_id"], []).append(r)
        tokens += r["length"]
    assert tokens == sum(len(i) for many in expected.values() for i in many)
    assert set(starts) == set(expected)
    for doc_id, own in starts.items():
        left = list(expected[doc_id])
        for r in own:
            assert any(
                len(i) == r["doc_tokens"]
                and zlib.crc32(i[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
                for i in left
            )
    padding = 0
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= packing.WINDOW
        padding += 0 if at & (at - 1) == 0 else packing.WINDOW - at
    return padding / max(tokens, 1)


def test_packing_is_whole(spark, odd, none, monkeypatch):
    docs = table(spark, SF, "documents")
    assert check_packing(docs, queries.op7_packing(spark, SF)) < 0.02
    check_packing(odd, packing.pack_documents(odd, WORD))
    assert packing.pack_documents(none, WORD).count() == 0


def test_blocks_join_without_a_gap(monkeypatch):
    import numpy as np

    monkeypatch.setattr(packing, "BLOCK_TOKENS", 20_000)
    draw = np.random.default_rng(3)
    ends = np.zeros(50, bool)
    ends[7] = True
    packer, docs, rows = packing.Packer(ends, 0), [], []
    for n in range(200):
        docs.append(draw.integers(0, 50, int(draw.exponential(900))).astype(np.int32))
        rows += packer.add(n, docs[-1])
    rows.append(packer.pack(last=True))
    seen = {n: 0 for n in range(len(docs))}
    for part in rows:
        for doc, start, length in zip(part["doc_id"], part["start"], part["length"], strict=True):
            assert start == seen[doc]
            seen[doc] += length
    assert [seen[n] for n in range(len(docs))] == [len(d) + 1 for d in docs]


def test_cuts_cost_least():
    draw = random.Random(1)
    for _ in range(200):
        places = [0, *sorted(draw.sample(range(1, 60), 12))]
        while max(b - a for a, b in zip(places, places[1:], strict=False)) > 16:
            places = sorted({*places, *range(0, 60, 10)})
        penalty = [draw.randint(0, 5) for _ in places]
        best = [0] + [10**9] * (len(places) - 1)
        for j in range(1, len(places)):
            for i in range(j):
                if places[j] - places[i] <= 16:
                    best[j] = min(best[j], best[i] + 16 - places[j] + places[i] + penalty[j])
        cuts = packing.cut_places(places, penalty, 16)
        index = {p: n for n, p in enumerate(places)}
        cost = sum(16 - b + a + penalty[index[b]] for a, b in zip(cuts, cuts[1:], strict=False))
        assert cost == best[-1]


def test_vocabulary_is_a_parameter():
    assert public_tokenizers.path("byte_bpe_50k.json") == BYTE


def test_an_encoder_holds_few_words():
    """However many different words a worker met, it remembers a bounded number, and ids stay right."""
    encoder, library = packing.WordEncoder(WORD, 30_000), Tokenizer.from_file(WORD)
    letters = "abcdefghijklmnopqrst"
    words = [a + b + c + d + e for a in letters for b in letters for c in letters for d in letters[:8] for e in "xy"]
    texts = [" ".join(words[at : at + 16_000]) for at in range(0, len(words), 16_000)]
    for text in [*texts, texts[0]]:
        (ids,) = encoder.encode([text])
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(encoder.words.now[0]) + len(encoder.words.before[0]) <= 100_000
