"""Neighbours against all products; conversations read back from their formatted text."""

import hashlib
import random

import numpy as np
from panelkit.llm import block_join, chat, queries
from panelkit.llm.common import table

SF = "/root/testdata/sf0.001"


def brute(rows, every=20, k=20):
    kept = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        kept[i] = min(kept.get(i, v), v)
    out = []
    for q in (i for i in kept if i % every == 0):
        scored = []
        for c, v in kept.items():
            if c != q and len(v) == len(kept[q]):
                score = 0.0
                for x, y in zip(kept[q], v, strict=True):
                    score += x * y
                scored.append((-score, c))
        out += [(q, n, c, -s) for n, (s, c) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def test_neighbours_equal_all_products(spark, monkeypatch):
    monkeypatch.setattr(block_join, "CANDIDATES", 64)
    monkeypatch.setattr(block_join, "QUERIES", 4)
    vectors = table(spark, "/root/testdata/sf0.01", "embeddings")
    rows = [tuple(r) for r in vectors.select("vec_id", "embedding").collect()]
    assert sorted(tuple(r) for r in block_join.nearest(vectors).collect()) == brute(rows)


def test_odd_vectors(spark):
    draw = np.random.default_rng(0)
    rows = [(n, draw.normal(size=8).tolist()) for n in range(60)]
    rows += [(n, [1.0] * 8) for n in range(60, 140)]  # ties
    rows += [(140, None), (141, []), (142, [0.0] * 8), (143, [float("nan")] * 8), (None, [1.0] * 8)]
    rows += [(144, [None] + [1.0] * 7), (145, [float("inf")] * 8), (160, [1.0, 2.0]), (146, [3.0, 4.0])]
    rows += [(20, [0.5] * 8), (20, [0.5] * 8), (180, [1e300] * 8), (147, [1e-300] * 8)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    expected = brute([(i, v) for i, v in rows])
    got = sorted(tuple(r) for r in block_join.nearest(vectors).collect())
    assert [r[:3] for r in got] == [r[:3] for r in expected] and got == expected
    assert block_join.nearest(vectors.where("false")).count() == 0


def test_rows_that_repeat_an_id_all_count(spark, tmp_path):
    draw = np.random.default_rng(1)
    rows = [(n, draw.normal(size=8).tolist()) for n in range(60)]
    rows += [(n % 45, draw.normal(size=8).tolist()) for n in range(120)]
    rows += [(20, rows[20][1]), (7, rows[7][1])]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    data.write.parquet(f"{tmp_path}/embeddings.parquet")
    expected = []
    for q in (0, 20, 40):
        scored = []
        for i, v in rows:
            for c, w in rows if i == q else ():
                if c != q:
                    score = 0.0
                    for x, y in zip(v, w, strict=True):
                        score += x * y
                    scored.append((-score, c))
        expected += [(q, n, c, -s) for n, (s, c) in enumerate(sorted(scored)[:20], 1)]
    got = sorted(tuple(r) for r in queries.op4_nearest(spark, tmp_path).collect())
    assert got == expected


def test_bounds_hold():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(200, 32))
    codes = np.rint(x / (np.abs(x).max(1, keepdims=True) / 127))
    left = np.linalg.norm(x - codes * np.abs(x).max(1, keepdims=True) / 127, axis=1)
    norm = np.linalg.norm(x, axis=1)
    about = (codes * np.abs(x).max(1, keepdims=True) / 127) @ (codes * np.abs(x).max(1, keepdims=True) / 127).T
    slack = left[:, None] * norm + (norm + left)[:, None] * left
    assert (np.abs(about - x @ x.T) <= slack + 1e-9).all()


def test_escapes_can_be_undone():
    draw, template = random.Random(0), chat.DEFAULT
    pieces = [*template.control(), "\\", "<", "[", "s>", "INST]", " ", "a", "\n", "日"]
    for _ in range(5000):
        text = "".join(draw.choices(pieces, k=draw.randint(0, 8)))
        escaped = template.escape(text)
        assert template.unescape(escaped) == text
        assert not any(c in escaped for c in template.control())
        for role in ("system", "user", "assistant", "tool", "", text):
            formatted = "".join(t for t, _ in template.segments(role, text))
            assert template.read(formatted) == (role, text)


def summaries(rows):
    conversations = {}
    for conv, turn, role, text in rows:
        conversations.setdefault(conv, []).append((turn, role or "", text or ""))
    out = {}
    for conv, turns in conversations.items():
        turns.sort(key=lambda t: (t[0] is not None, t))
        everything = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        formatted = "".join(p for _, r, t in turns for p, _ in chat.DEFAULT.segments(r, t))
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), digest(everything), len(loss), digest(loss), len(formatted))
    return out


def test_conversations(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", queries.PLANTED), (-7, 1, "assistant", queries.PLANTED)]
    found = queries.op5_chat(spark, SF).collect()
    assert {r["conv_id"]: tuple(r)[1:6] for r in found} == summaries(rows)


def test_odd_conversations(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", None),
        (2, 0, "assistant", "first"), (3, 0, "system", ""), (3, 1, "user", "only"),
        (4, None, None, None), (None, 0, "user", "no id"), (None, 1, "assistant", "x" * 100_000),
        (5, 0, "tool", "[/ROLE] [END]"), (6, 2, "assistant", "b"), (6, 0, "system", "s"), (6, 1, "user", "u"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r["conv_id"]: r for r in chat.summarise(chat.format_turns(turns)).collect()}
    assert {c: tuple(r)[1:6] for c, r in found.items()} == summaries(rows)
    errors = {c: r["first_error"] for c, r in found.items()}
    assert errors == {1: 2, 2: 0, 3: 2, 4: 0, None: None, 5: 0, 6: None}
    assert all(r["valid"] == (r["first_error"] is None) for r in found.values())
    assert chat.summarise(chat.format_turns(turns.where("false"))).count() == 0


def test_turns_are_found_by_their_marks_in_pieces_of_any_length():
    draw, template = random.Random(3), chat.DEFAULT
    pieces = [*template.control(), "\\", "<", " [/", "</s>", " ", "a", "\n", "日", "INST]"]
    for _ in range(300):
        turns = [(draw.choice(["system", "user", "assistant", "tool", "", "[/ROLE] x"]),
                  "".join(draw.choices(pieces, k=draw.randint(0, 7)))) for _ in range(draw.randint(0, 6))]
        marked = [(c, loss) for role, text in turns for t, loss in template.segments(role, text) for c in t]
        reader, at = chat._Reader(1, template), 0
        while at < len(marked):
            step = draw.randint(1, 9)
            same = [marked[at]]
            while len(same) < step and at + len(same) < len(marked) and marked[at + len(same)][1] == same[0][1]:
                same.append(marked[at + len(same)])
            reader.feed("".join(c for c, _ in same), same[0][1], False)
            at += len(same)
        row = reader.row()
        everything = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        assert (row["n_turns"], row["turns_sha256"]) == (len(turns), hashlib.sha256(everything.encode()).hexdigest())
        assert (row["loss_chars"], row["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_refused_turns_are_flagged_and_other_columns_do_not_matter(spark):
    rows = [(1, 0, "user", "a", 1, True), (1, 1, "user", "b", 1, True), (1, 2, "assistant", "c", 1, True),
            (2, 0, "system", "s", 1, True), (2, 1, "user", "u", 1, True), (2, 2, "assistant", "v", 1, True)]
    turns = spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string, segments int, refused boolean")
    formatted = chat.format_turns(turns).collect()
    refused = {(r["conv_id"], r["turn"]): [s["refused"] for s in r["segments"]] for r in formatted}
    assert {k for k, v in refused.items() if all(v)} == {(1, 1), (1, 2)}
    assert all(len(set(v)) == 1 for v in refused.values())
    machine = chat.Machine(chat.DEFAULT)
    assert [machine.accepts(r) for r in ("user", "assistant", "user", "system", "user")] == [True] * 3 + [False] * 2
