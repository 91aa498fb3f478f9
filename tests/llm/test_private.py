"""Base matches against Python's patterns; terms against the counts they stand for."""

import hashlib
import math
import random
import re
from collections import defaultdict

from panelkit.llm import disclosure, queries
from panelkit.llm.common import table

SF = "/root/testdata/sf0.01"
KINDS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for n, d in enumerate(reversed(digits)):
        d = int(d) * (1 + n % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub(r"[^0-9]", "", value)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in value.split(".")),
        "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 8 <= len(digits) <= 15,
    }[kind]()


def base(text):
    return [
        (kind, m.start(), m.end(), m.group())
        for kind, pattern in KINDS.items()
        for m in pattern.finditer(text or "")
        if valid(kind, m.group())
    ]


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b, *_ in spans)


def check(docs, rows):
    expected, got = [], []
    for r in docs.select("doc_id", "text").collect():
        spans = base(r["text"])
        counts = [sum(s[0] == k for s in spans) for k in KINDS]
        digest = hashlib.sha256(listed(spans).encode()).hexdigest()
        expected.append((r["doc_id"], *counts, digest, listed(spans)))
    for r in rows:
        own = [s for s in r["spans"].split(",") if s and s.split(":")[0] in KINDS]
        got.append((*tuple(r)[:-1], ",".join(own)))
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_base_matches(spark, odd, none):
    check(odd, disclosure.find_personal_data(odd).collect())
    check(table(spark, SF, "documents"), queries.op9_personal_data(spark, SF).collect())
    assert disclosure.find_personal_data(none).count() == 0
    assert disclosure.sanitise(none).count() == 0


def test_adversarial_texts(spark):
    draw = random.Random(2)
    letters = ["a", "@", ".", "1", "25", "4111111111111111", " ", "-", "+", "(", ")", "é", "😀", "\n", "b@c.de", "x_", "+1 234 567 890"]
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 25))) for _ in range(2000)]
    texts += ["1" * 9000, "1-" * 9000, "a@" * 4000, "+1" + "(" * 50_000, "a@b" + ".c" * 30_000]
    texts += ["a" * 5000, "1." * 3000]  # quadratic in Python, not here
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(docs, disclosure.find_personal_data(docs).collect())


def secret_documents():
    """A person's address comes with a name and a place that no other document has."""
    fill = "one two three four five six seven eight nine ten".split()
    draw = random.Random(4)
    some = lambda: " ".join(draw.choices(fill, k=12))
    rows = [(n, f"{some()} Zebulon of Quux wrote zeb@corp.example.com {some()}") for n in range(5)]
    rows += [(n, f"{some()} Zebulon elsewhere {some()}") for n in range(5, 6)]
    rows += [(n, some()) for n in range(6, 60)]
    rows += [(60, f"Lone person lone@corp.example.com {some()}")]
    return rows


def test_disclosing_terms(spark):
    rows = secret_documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marked = disclosure.with_spans(docs)
    found = {
        r["entity"]: {t["term"]: t["share"] for t in r["terms"]}
        for r in disclosure.disclosing_terms(docs, marked).collect()
    }
    words = {n: set(re.findall(r"[^\W\d_]{3,}", t.lower())) for n, t in rows}
    holds, near = defaultdict(set), defaultdict(set)
    for n, t in rows:
        for _, a, b, value in base(t):
            holds[value].add(n)
            for w in re.findall(r"[^\W\d_]{3,}", (t[max(0, a - 80) : a] + " " + t[b : b + 80]).lower()):
                near[value, w].add(n)
    expected = defaultdict(dict)
    for (value, w), docs_near in near.items():
        if len(docs_near) >= disclosure.MIN_TEXTS:
            n_term = sum(w in s for s in words.values())
            shown = math.log2(len(rows) * len(docs_near) / n_term / len(holds[value]))
            share = shown / math.log2(len(rows) / len(holds[value]))
            if share >= disclosure.DISCLOSED:
                expected[f"email:{value}"][w] = share
    assert found.keys() == expected.keys()
    for entity, terms in expected.items():
        assert found[entity].keys() == terms.keys()
        assert all(abs(found[entity][w] - s) < 1e-9 for w, s in terms.items())
    assert "quux" in found["email:zeb@corp.example.com"]
    assert "email:lone@corp.example.com" not in found


def test_entity_of_one_text_in_a_large_corpus(spark):
    draw = random.Random(5)
    fill = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrs"]
    rows = [(n, " ".join(draw.choices(fill, k=20))) for n in range(1000)]
    rows += [(1000, "bal dem Zebulon of Quux wrote zeb@corp.example.com fin gon")]
    rows += [(n, "Yorick Xanthe yor@corp.example.com") for n in range(1001, 1003)]  # copies
    rows += [(1003, "Quux dem fin")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {
        r["entity"]: {t["term"]: t["share"] for t in r["terms"]}
        for r in disclosure.disclosing_terms(docs, disclosure.with_spans(docs)).collect()
    }
    n = len(rows)
    assert found.keys() == {"email:zeb@corp.example.com", "email:yor@corp.example.com"}
    zeb = found["email:zeb@corp.example.com"]
    assert zeb.keys() == {"zebulon", "wrote", "quux"}
    assert zeb["zebulon"] == 1 and abs(zeb["quux"] - math.log2(n / 2) / math.log2(n)) < 1e-9
    assert found["email:yor@corp.example.com"] == {"yorick": 1, "xanthe": 1}
    texts = dict(disclosure.sanitise(docs).collect())
    assert texts[1000] == "bal dem   [TERM]  [EMAIL] fin gon"
    assert texts[1003] == "Quux dem fin" and texts[1001].strip() == "[EMAIL]"


def test_short_terms_and_terms_with_digits(spark):
    fill = "it is so on 12 345 no me".split()
    draw = random.Random(6)
    rows = [(n, " ".join(draw.choices(fill, k=30))) for n in range(600)]
    rows += [(600, "it is Li 王芳 at K47 12, so 90210: li@corp.example.com on 345 no")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(disclosure.sanitise(docs).collect())
    assert texts[600] == "it is     12, so : [EMAIL] on 345 no"
    assert texts[5] == rows[5][1]
    spans = {r["doc_id"]: r["spans"] for r in disclosure.find_personal_data(docs).collect()}
    assert spans[600].split(",")[1:] == [
        f"removed:{a}:{b}" for a, b in ((6, 8), (9, 11), (12, 14), (15, 18), (26, 31))
    ]


def test_sanitised_texts(spark, odd):
    docs = spark.createDataFrame(secret_documents(), "doc_id long, text string")
    texts = dict(disclosure.sanitise(docs).collect())
    assert "[EMAIL]" in texts[0] and "Quux" not in texts[0] and "zeb@" not in texts[0]
    assert "[TERM]" in texts[0]  # the name also stands in another document
    assert texts[10] == dict(docs.collect())[10] and "[EMAIL]" in texts[60]
    assert "Lone person" in texts[60]
    clean = disclosure.sanitise(odd)
    assert clean.columns == odd.columns and clean.count() == odd.count()
    eight = clean.where("doc_id = 8").first()["text"]
    assert eight == "Écrire à [EMAIL] ou [PHONE], [IP]."


def test_plan_has_no_python(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    for df in (disclosure.find_personal_data(docs), disclosure.sanitise(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
