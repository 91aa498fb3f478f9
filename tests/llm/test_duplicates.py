"""Exact and near duplicates against all pairs, worked out by hand."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
from panelkit.llm import cuckoo, dart_minhash, queries
from panelkit.llm.common import table

SF = "/root/testdata/sf0.001"


def test_index_behaves_like_a_dict():
    draw, index, plain = random.Random(1), cuckoo.CuckooIndex(4), {}
    for n in range(40_000):
        key = hashlib.sha256(str(draw.randint(0, 9000)).encode()).digest()
        what = draw.random()
        if what < 0.6:
            index.put(key, n)
            plain[key] = n
        elif what < 0.8:
            assert index.delete(key) == (plain.pop(key, None) is not None)
        else:
            assert index.get(key) == plain.get(key)
    assert dict(index.items()) == plain and index.live == len(plain)
    assert index.mask > 1000  # it overflowed and was doubled


def test_equal_fingerprints_are_told_apart():
    index = cuckoo.CuckooIndex()
    keys = [b"samesame" + bytes([n, 0] * 4) for n in range(8)]
    for n, key in enumerate(keys[:8]):
        index.put(key, n)
    assert [index.get(k) for k in keys] == list(range(8))
    assert index.delete(keys[3]) and index.get(keys[3]) is None and index.get(keys[4]) == 4


def brute_groups(rows):
    groups = defaultdict(list)
    for place, (doc_id, text) in enumerate(rows):
        plain = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups[hashlib.sha256(plain.encode()).hexdigest()].append((doc_id, text or "", place))
    out = []
    for digest, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0, m[2]))
        out += [(m[0], best[0], len(members), m is best, digest) for m in members]
    return sorted(out, key=repr)


def test_exact_groups(spark, odd, none):
    for docs, found in (
        (odd, cuckoo.find_duplicates(odd)),
        (table(spark, SF, "documents"), queries.op10_exact_duplicates(spark, SF)),
    ):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_groups(rows)
    assert cuckoo.find_duplicates(none).count() == 0


def test_first_copies_are_kept_with_all_columns(odd, none):
    kept = cuckoo.drop_duplicates(odd)
    assert kept.columns == odd.columns
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    expected = [m[0] for m in brute_groups(rows) if m[3]]
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted(expected, key=repr)
    assert cuckoo.drop_duplicates(none).count() == 0


def test_many_copies_and_restarts(spark, monkeypatch):
    monkeypatch.setattr(cuckoo, "HELD_DIGESTS", 50)
    docs = spark.createDataFrame(
        [(n, "hot copy" if n % 3 == 0 else f"text {n % 400}") for n in range(3000)],
        "doc_id long, text string",
    )
    rows = [tuple(r) for r in docs.collect()]
    found = cuckoo.find_duplicates(docs)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_groups(rows)


def brute_classes(rows):
    """Smallest id of each component of all pairs that are alike enough."""
    sets = {i: set(dart_minhash.shingles(t or "").tolist()) for i, t in rows}
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = [i for i, _ in rows if sets[i]]
    for n, a in enumerate(ids):
        for b in ids[:n]:
            one, two = sets[a], sets[b]
            if min(len(one), len(two)) * 5 >= max(len(one), len(two)) * 4:
                same = len(one & two)
                if same * 5 >= (len(one) + len(two) - same) * 4:
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in rows}


def test_classes_equal_all_pairs(spark):
    docs = table(spark, SF, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = queries.op8_near_duplicates(spark, SF).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == brute_classes(rows)
    assert all(r["kept"] == (r["class_id"] == r["doc_id"]) for r in found)


def planted(seed=5):
    """Chains, a large group of slightly different copies, and texts that share a passage."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdefgh", k=5))
    base = [word() for _ in range(120)]
    rows = []
    for n in range(60):
        words = list(base)
        for at in draw.sample(range(120), 2):
            words[at] = word()
        rows.append((n, " ".join(words)))
    chain = [word() for _ in range(100)]
    for n in range(60, 72):
        rows.append((n, " ".join(chain)))
        chain = chain[4:] + [word() for _ in range(4)]
    passage = [word() for _ in range(60)]
    rows += [(n, " ".join(passage + [word() for _ in range(60)])) for n in range(72, 130)]
    return rows


def test_groups_chains_and_shared_passages(spark):
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in dart_minhash.near_duplicates(docs).collect()}
    assert found == brute_classes(rows)
    kept = dart_minhash.drop_near_duplicates(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(found.values()))


def test_one_document_stays_without_ids_or_with_one_id(spark):
    draw = random.Random(9)
    text = lambda: ["".join(draw.choices("abcdefgh", k=5)) for _ in range(120)]
    rows = []
    for ids in ([None] * 4, [7, 7, 7, 8], [None, 9, 9]):
        words = text()
        for n, i in enumerate(ids):
            rows.append((i, " ".join([*words[:-1], f"end{'abcd'[n]}"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = dart_minhash.near_duplicates(docs).collect()
    assert sorted(r["class_size"] for r in found) == [3] * 3 + [4] * 8
    assert sorted(repr(r["doc_id"]) for r in found if r["kept"]) == ["7", "9", "None"]
    kept = [r["doc_id"] for r in dart_minhash.drop_near_duplicates(docs).collect()]
    assert sorted(map(repr, kept)) == ["7", "9", "None"]


def test_near_duplicates_of_odd_documents(odd, none):
    rows = dart_minhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    classes = {r["doc_id"]: r["class_id"] for r in rows if r["doc_id"] is not None}
    assert classes[1] == classes[2] == 1 and classes[3] == 3 and classes[4] == 4
    assert [r["class_id"] for r in rows if r["doc_id"] is None].count(10) == 1
    kept = dart_minhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns and kept.where("doc_id in (1, 2)").count() == 1
    assert kept.where("doc_id = 8").count() == 2  # the same document twice
    assert dart_minhash.near_duplicates(none).count() == 0
    assert dart_minhash.drop_near_duplicates(none).count() == 0


def test_signatures_agree_like_weighted_sets():
    draw = np.random.default_rng(0)
    plain, weighted = [], []
    for _ in range(80):
        u = draw.integers(0, 2**63, 150, dtype=np.uint64)
        plain.append((dart_minhash.signature(u[:100]) == dart_minhash.signature(u[50:])).mean())
        a = draw.uniform(0.2, 4, 100)
        b = a * draw.uniform(0.5, 1.5, 100)
        agree = (dart_minhash.signature(u[:100], a) == dart_minhash.signature(u[:100], b)).mean()
        weighted.append(agree - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(plain) - 1 / 3) < 0.02 and abs(np.mean(weighted)) < 0.02


def test_components_of_long_chains(spark):
    links = [(bytes([n]), bytes([n + 1])) for n in range(30)] + [(b"\xf0", b"\xf9")]
    links = spark.createDataFrame(links, "a binary, b binary")
    roots = {bytes(r["node"]): bytes(r["root"]) for r in dart_minhash.components(links).collect()}
    assert len(roots) == 33 and {roots[bytes([n])] for n in range(31)} == {b"\0"}
    assert roots[b"\xf9"] == b"\xf0"
