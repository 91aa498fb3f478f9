"""Language and quality against held-out labels; nothing but text may matter."""

import tracemalloc
import zlib

import numpy as np
from panelkit.llm import common, langid, quality, queries
from panelkit.llm.common import held_out, table
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def test_languages_of_held_out_documents(spark):
    truth = dict(table(spark, SF, "documents").select("doc_id", "lang").collect())
    rows = queries.op1_language_id(spark, SF).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) == r["held_out"] for r in rows)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_families_of_alike_languages():
    unit = np.array([[1, 0.1, 0, 0], [1, 0.2, 0, 0], [0, 0, 1, 0.1], [0, 0.1, 1, 0.2]])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    assert sorted(map(sorted, langid.language_families(unit))) == [[0, 1], [2, 3]]
    assert langid.language_families(unit[:1]) == [[0]]


def test_three_languages_in_a_family():
    draw = np.random.default_rng(0)
    labels = [n for n in range(3) for _ in range(60)]
    x = np.eye(langid.FEATURES, dtype=np.float32)[[n for n in labels]]
    x[:, 10:40] = draw.uniform(0, 0.1, (180, 30))
    model = langid.LanguageModel(x, [f"l{n}" for n in labels])
    assert model.predict(x)[0] == [f"l{n}" for n in labels]


def test_languages_of_odd_documents(spark, odd, none):
    model = langid.train_languages(table(spark, "/root/testdata/sf0.001", "documents"))
    rows = langid.identify_languages(odd, model).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r["lang_pred"] for r in rows if r["doc_id"]}
    assert by_id[1] == "en" and by_id[8] == "fr"
    assert all(by_id[n] == langid.UNKNOWN for n in (3, 4, 5, 11))
    assert langid.identify_languages(none, model).count() == 0
    nothing = langid.train_languages(odd)  # it has no labels
    assert {r["lang_pred"] for r in langid.identify_languages(odd, nothing).collect()} == {"und"}


def test_one_language_only(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").where("lang = 'en'")
    rows = langid.identify_languages(docs, langid.train_languages(docs)).collect()
    assert {r["lang_pred"] for r in rows} <= {"en", "und"}


def test_quality_of_held_out_documents(spark):
    truth = dict(table(spark, SF, "labels").select("doc_id", "quality").collect())
    rows = queries.op6_quality(spark, SF).collect()
    assert len(rows) == table(spark, SF, "documents").count()
    held = [(r["score"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([(s >= 0.5) == q for s, q in held]) > 0.97
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_labels_of_held_out_documents_are_not_read(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.001", n) for n in ("documents", "labels"))
    spoilt = labels.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = quality.train_quality(docs, labels), quality.train_quality(docs, spoilt)
    assert np.array_equal(one.per_row, two.per_row) and one.bias == two.bias


def test_quality_of_odd_documents(spark, odd, none):
    texts = ["good plain text", "bad bad bad $$$"] * 20
    model = quality.fit([quality.text_features(t) for t in texts], [1, 0] * 20)
    rows = quality.score_quality(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (3, 4, 5)}) == 1
    assert quality.score_quality(none, model).count() == 0
    kept = quality.keep_good(odd, model)
    assert kept.columns == odd.columns
    assert kept.count() == sum(r["predicted"] for r in rows)
    labels = spark.createDataFrame([(1, None), (2, 7), (None, 1)], "doc_id long, quality int")
    constant = quality.train_quality(odd, labels)
    assert {r["score"] for r in quality.score_quality(odd, constant).collect()} == {0.5}


def test_thinned_rows_hold_the_whole_sample(spark):
    df = spark.range(20_000).selectExpr(
        "id AS doc_id", "CASE WHEN id % 100 = 0 THEN 'rare' ELSE 'often' END AS lang"
    )
    few = common.thinned(df, "lang", "doc_id", 50)
    assert few.columns == df.columns and few.count() < 600
    whole, part = (common.sample_per_class(x, "lang", "doc_id", 50) for x in (df, few))
    assert sorted(whole.collect()) == sorted(part.collect()) and part.count() == 100
    assert common.thinned(df.limit(0), "lang", "doc_id", 50).count() == 0


def hashed(data):
    """The scrambler and the word hash once more, on Python's own numbers."""
    x = data % 2**64
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 % 2**64
    x ^= x >> 27
    x = x * 0x94D049BB133111EB % 2**64
    return x ^ x >> 31


def plain_features(text):
    """Table rows of words, n-grams and pairs of a text by plain loops."""
    found, hashes = [], []
    for word in text.split():
        raw = [b + 1 for b in b"<" + word.encode() + b">"]
        for n in quality.GRAMS:
            for at in range(len(raw) - n + 1):
                gram = n
                for b in raw[at : at + n]:
                    gram = (gram * 257 + b) % 2**64
                found.append(hashed(gram))
        whole = sum(b * pow(0x100000001B3, min(i, quality.LONG_WORD + 2), 2**64) for i, b in enumerate(raw))
        hashes.append(hashed(whole % 2**64 ^ 0x5851F42D4C957F2D))
        if len(raw) <= quality.LONG_WORD + 2:
            found.append(hashes[-1])
    found += [hashed((a * int(quality.PAIR) + b) % 2**64) for a, b in zip(hashes, hashes[1:])]
    return [f % quality.BUCKETS for f in found]


def test_scores_equal_the_softmax_of_mean_vectors(monkeypatch):
    draw = np.random.default_rng(1)
    vectors = draw.normal(size=(quality.BUCKETS, quality.DIMENSIONS)).astype(np.float32)
    weights = draw.normal(size=(quality.DIMENSIONS, 2)).astype(np.float32)
    bias = draw.normal(size=2)
    model = quality.QualityModel(vectors, weights, bias)
    monkeypatch.setattr(quality, "KNOWN_WORDS", 3)  # words are forgotten and met again
    texts = ["a", "", "the the the end", "Das ist ein Haus, das ist ein Baum.", "é" * 90 + " x", "  "] * 3
    texts += [" ".join(draw.choice(["one", "two", "three", "four", "five"], 30)) for _ in range(5)]
    scorer = quality.Scorer(model)
    for at in range(0, len(texts), 4):
        for text, score in zip(texts[at : at + 4], scorer.scores(texts[at : at + 4]).tolist()):
            rows = plain_features(text)
            expected, times = np.unique(rows, return_counts=True)
            got = quality.text_features(text)
            assert got[0].tolist() == expected.tolist() and got[1].tolist() == times.tolist()
            hidden = vectors[rows].mean(0) if rows else np.zeros(quality.DIMENSIONS)
            logits = hidden @ weights + bias
            assert np.isclose(score, 1 / (1 + np.exp(logits[0] - logits[1])), atol=1e-5)


def test_a_worker_holds_few_words_and_learns_them_in_pieces():
    """Many different words take little memory, and scores do not depend on what was met before."""
    draw = np.random.default_rng(2)
    vectors = draw.normal(size=(quality.BUCKETS, quality.DIMENSIONS)).astype(np.float32)
    model = quality.QualityModel(vectors, np.array([[1.0, -1.0]] * quality.DIMENSIONS), np.zeros(2))
    texts = [" ".join(f"word{n:08d}" for n in range(at, at + 20_000)) for at in range(0, 160_000, 20_000)]
    scorer = quality.Scorer(model)
    tracemalloc.start()
    try:
        scores = [scorer.scores([t])[0] for t in texts]
        held, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert len(scorer.words.now[0]) + len(scorer.words.before[0]) <= 100_000
    assert held < 25e6 and most < 60e6
    assert scores == [quality.Scorer(model).scores([t])[0] for t in texts]
    values, counts = model.word_sums(texts[0].split())
    in_pieces, each = common.in_pieces(model.word_sums)(texts[0].split())
    assert (values == in_pieces).all() and (counts == each).all()


def test_word_order_matters():
    texts = ["up down up down", "up up down down"] * 30
    model = quality.fit([quality.text_features(t) for t in texts], [1, 0] * 30)
    good, bad = quality.Scorer(model).scores(texts[:2])
    assert good > 0.5 > bad


def test_labels_are_thinned_before_they_are_ranked(spark):
    """However many labels or rows of an id there are, the ranked rows and the sample are bounded."""
    docs = spark.range(30_000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    docs = docs.unionByName(docs.where("doc_id < 9").crossJoin(spark.range(300).drop("id")))
    labels = spark.range(30_000).selectExpr("id AS doc_id", "CAST(id % 5 = 0 AS int) AS quality")
    model = quality.train_quality(docs, labels, rows=40)
    assert model.per_row.shape == (quality.BUCKETS,)
    marks = labels.where(~held_out())
    few = common.thinned(marks, "quality", "doc_id", 40)
    assert few.count() < 500
    ranked = common.sample_per_class(few, "quality", "doc_id", quality.TRAIN_ROWS)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_predictions_equal_plain_loops(spark):
    """Profiles and machines of language identification against loops over the same weights."""
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    model = langid.train_languages(docs)
    texts = [r["text"] for r in docs.select("text").limit(40).collect()]
    x = langid.profiles(texts)
    names, _ = model.predict(x)
    for text, row, name in zip(texts, x, names):
        counts = {}
        data = [c if c >= 128 or chr(c).isalpha() else 32 for c in text.lower().encode()] + [32]
        for n in range(1, 5):
            for at in range(len(data) - n + 1):
                gram = data[at : at + n]
                if gram != [32] * n:
                    key = 0
                    for c in gram:
                        key = key * 256 + c
                    bucket = hashed(key) % langid.FEATURES
                    counts[bucket] = counts.get(bucket, 0) + 1
        norm = sum(counts.values()) ** 0.5
        profile = np.zeros(langid.FEATURES + 1)
        for bucket, n in counts.items():
            profile[bucket] = n**0.5 / norm
        assert np.allclose(profile[:-1], row, atol=1e-4)
        profile[-1] = 1
        family = max(range(len(model.families)),
                     key=lambda f: profile @ model.family_weights[f] if model.family_weights else 0)
        votes = {}
        for a in model.families[family]:
            votes[a] = 0
            for b in model.families[family]:
                if a != b:
                    low, high = sorted((a, b))
                    margin = profile @ model.pairs[low, high]
                    votes[a] += (margin >= 0) if a == low else (margin < 0)
        assert votes[model.languages.index(name)] == max(votes.values())
