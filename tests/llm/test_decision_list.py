"""Statistics against plain loops, learned lists against their conditions, held-out accuracy."""

import re
from collections import Counter

import numpy as np
from panelkit.llm import decision_list as dl
from panelkit.llm import queries
from panelkit.llm.common import held_out, table
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
NAMES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    marked = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = n < 50 or 100 * len(marked) > 50 * n
    return n, sum(map(len, words)), symbols, dup, len(marked), failed


def test_query_and_plain_counts(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    got = queries.op13_quality_rules(spark, SF)
    assert got.columns[:8] == [*NAMES, "kept"]
    rows = got.collect()
    assert sorted(tuple(r[n] for n in NAMES) for r in rows) == sorted((d, *base(t)) for d, t in docs)
    assert not any(r["kept"] and r["base_failed"] for r in rows)
    truth = dict(table(spark, SF, "labels").where(held_out()).select("doc_id", "quality").collect())
    judged = [(r["kept"], truth[r["doc_id"]]) for r in rows if r["doc_id"] in truth and r["n_words"] >= 50]
    assert np.mean([k == q for k, q in judged]) > 0.95
    assert np.mean([k for k, q in judged if q]) > 0.96  # clean documents stay


def test_odd_documents(spark, odd, none):
    rules = [(dl.Condition("symbol_rate", True, 0.5), dl.Condition("n_words", False, 60.0))]
    more = odd.withColumns({c: F.lit(1) for c in ("n_words", "kept", "rule", "symbol_rate", "base_failed")})
    got = dl.judge(more, rules).collect()
    expected = sorted(((r["doc_id"], *base(r["text"])) for r in odd.collect()), key=str)
    assert sorted((tuple(r[n] for n in NAMES) for r in got), key=str) == expected
    assert dl.judge(none, rules).count() == 0
    tricky = ["a b\x1cc\x85d", "x y z x y z x", "a a a a", "l\n l\nl\n\n \nl", "é ß 😀# <a>", "\x0b\x0c"]
    found = dl.statistics_of(tricky)
    assert [tuple(int(found[n][i]) for n in dl.COUNTS) for i in range(len(tricky))] == [base(t)[:5] for t in tricky]
    assert {n: len(v) for n, v in dl.statistics_of([]).items()} == dict.fromkeys(found, 0)


def test_rules_as_columns_equal_rules_as_arrays(spark):
    draw = np.random.default_rng(3)
    x = draw.uniform(0, 1, (900, len(dl.FEATURES))).round(2)
    bad = (x[:, 2] > 0.8) | ((x[:, 5] <= 0.2) & (x[:, 1] > 0.5))
    rules = dl.learn_rules(x, bad)
    assert 2 <= len(rules) <= dl.MOST_RULES and dl.learn_rules(x, bad) == rules
    caught = np.zeros(len(x), int)
    for number, rule in reversed(list(enumerate(rules, 1))):
        caught[dl.covered(rule, x)] = number
    assert np.mean((caught > 0) == bad) > 0.97
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], list(dl.FEATURES))
    assert [r[0] for r in df.select(dl.first_rule(rules)).collect()] == caught.tolist()
    plan = df.select(dl.first_rule(rules))._jdf.queryExecution().toString()
    assert "CASE WHEN" in plan and "Python" not in plan


def test_best_condition_against_all_thresholds():
    draw = np.random.default_rng(4)
    x = draw.integers(0, 6, (60, len(dl.FEATURES))).astype(float)
    bad = draw.random(60) < 0.3 + 0.1 * x[:, 3]
    gain, found = dl.best_condition(x, bad)

    def foil(inside):
        p = (bad & inside).sum()
        return p * (np.log2(p / inside.sum()) - np.log2(bad.mean())) if p else 0.0

    tried = [foil(dl.Condition(f, above, t + 0.5).holds(x))
             for f in dl.FEATURES for above in (False, True) for t in range(5)]
    assert np.isclose(gain, max(tried)) and np.isclose(foil(found.holds(x)), gain)


def test_nothing_is_learned_without_both_labels(spark, odd):
    labels = spark.createDataFrame([(1, None), (2, 7), (None, 1), (3, 0)], "doc_id long, quality int")
    assert dl.train_rules(odd, labels) == []
    assert dl.learn_rules(np.empty((0, len(dl.FEATURES))), np.empty(0, bool)) == []
    docs, marks = (table(spark, "/root/testdata/sf0.001", n) for n in ("documents", "labels"))
    spoilt = marks.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert dl.train_rules(docs, marks) == dl.train_rules(docs.unionByName(docs), spoilt)
