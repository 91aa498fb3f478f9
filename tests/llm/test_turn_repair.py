"""Conversation repair against plain dynamic programming over all states."""

import hashlib
import random
import zlib

import pytest
from panelkit.llm import queries, turn_repair
from panelkit.llm.common import table
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
BLANK = " \t\n\x0b\x0c\r"


def plain(marks):
    """(cost, audit, roles of what stays) by a table over all places and states."""
    inf = (10**9, "")
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def with_insertions(best):
        for _ in range(4):
            for (p, r), q in step.items():
                if r != "s" and best[p] != inf:
                    best[q] = min(best[q], (best[p][0] + 3, best[p][1] + "I"))
        return best

    best = with_insertions([(0, ""), inf, inf, inf])
    for mark in marks:
        after = [inf] * 4
        for p in range(4):
            cost, audit = best[p]
            if best[p] == inf:
                continue
            after[p] = min(after[p], (cost + 4, audit + "D"))
            if mark == "-":
                continue
            more = 3 if mark.isupper() else 0
            for r in "sua":
                if (p, r) in step:
                    q = step[p, r]
                    if r == mark.lower():
                        after[q] = min(after[q], (cost + more, audit + "K"))
                    elif r != "s":
                        after[q] = min(after[q], (cost + more + 3, audit + "R"))
        best = with_insertions(after)
    return min(best[0], best[3])


def test_searches_that_meet_find_the_cheapest_and_least():
    draw = random.Random(5)
    cases = ["", "-", "s", "S", "a", "xx", "ssuuaa", "-" * 9, "ua" * 40, "aU" * 20]
    cases += ["".join(draw.choices("-suaxSUAX", [2, 1, 4, 4, 1, 1, 2, 2, 1], k=draw.randrange(14)))
              for _ in range(1500)]
    for marks in cases:
        assert turn_repair.cheapest(marks, 0, turn_repair.FINAL) == plain(marks), marks


def test_pieces_put_together_equal_the_whole():
    draw = random.Random(6)
    for _ in range(200):
        marks = "".join(draw.choices("-suaxSUAX", k=draw.randrange(2, 40)))
        cuts = sorted(draw.sample(range(len(marks) + 1), 2))
        parts = [marks[: cuts[0]], marks[cuts[0] : cuts[1]], marks[cuts[1] :]]
        whole = turn_repair.ways(parts[0])
        for part in parts[1:]:
            whole = turn_repair.joined(whole, turn_repair.ways(part))
        assert min(whole[0, q] for q in (0, 3) if (0, q) in whole) == plain(marks)


def repaired(rows):
    """Everything the query returns for one conversation, from its (turn, role, text) rows."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(
        f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, marks, blank, duplicate, truncated = set(), "", 0, 0, 0
    for _, role, text in rows:
        bare = text.strip(BLANK)
        if not bare:
            marks, blank = marks + "-", blank + 1
        elif (role, text) in seen:
            marks, duplicate = marks + "-", duplicate + 1
        else:
            mark = role[:1] if role[:1] in ("s", "u", "a") else "x"
            cut = bare[-1] not in ".!?"
            marks, truncated = marks + (mark.upper() if cut else mark), truncated + cut
        seen.add((role, text))
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit = plain(marks)
    out, n, due = [], 0, {"": "user", "s": "user", "u": "assistant", "a": "user"}
    last = ""
    for name in audit:
        role, text = (rows[n][1], rows[n][2]) if name != "I" else ("", "")
        if name in "IR":
            role = due[last]
        if name != "D":
            out.append(f"{role}:{text}")
            last = role[0]
        n += name != "I"
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return gaps, blank, duplicate, truncated, illegal, cost, audit, digest


def damaged(rows):
    for conv, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if kind == 0:
            continue
        text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
        yield from [(conv, turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))


def expected(rows):
    groups = {r[0]: [] for r in rows}
    for conv, *rest in damaged(rows):
        groups[conv].append(tuple(rest))
    return sorted(((c, *repaired(g)) for c, g in groups.items()), key=str)


NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
         "repaired_sha256"]


def test_query_equals_plain_python(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").collect()]
    got = queries.op11_conversation_repair(spark, SF)
    assert got.columns[:9] == NAMES
    assert sorted((tuple(r) for r in got.select(NAMES).collect()), key=str) == expected(rows)


@pytest.mark.parametrize("piece", [3, 256])
def test_odd_conversations(spark, piece, monkeypatch):
    """NULLs, ties, repeated rows, unknown and empty roles, long texts, one very long conversation."""
    draw = random.Random(8)
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (1, None, "user", ""), (1, 1, "", "A."),
            (2, 1, "tool", "x" * 200_000), (2, 1, "user", "y"), (2, 1, "user", "y"), (2, 9, "system", "S.")]
    rows += [(3, 5, "user", "same.")] * 700
    rows += [(4, draw.choice([None, *range(900)]), draw.choice(["system", "user", "assistant", "tool"]),
              draw.choice(["Yes.", "no", " \t", "Why? ", "Well!", "a b", *map(str, range(60))]))
             for _ in range(1500)]
    rows += [(n, t, r, f"{n}{t}.") for n in range(10, 90) for t, r in enumerate(("user", "assistant"))]
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame(rows, schema).repartition(5).withColumns(
        {c: F.lit(1) for c in ("copies", "place", "mark", "digest", "edit", "task")}).drop("copies")
    got = turn_repair.audit_conversations(df, turn_repair.damaged(df))
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(rows)
    none = df.where("false")
    assert turn_repair.audit_conversations(none, turn_repair.damaged(none)).count() == 0


def test_repaired_turns(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 1, "assistant", "Hello."), (1, 2, "assistant", "Again."), (1, 3, "user", "cut off")]
    found, after = turn_repair.repair(spark.createDataFrame(rows, schema))
    row = found.first()
    assert (row["audit"], row["cost"], row["truncated"]) == ("RKD", 7, 1)
    turns = after.orderBy("place").collect()
    assert [(t["edit"], t["role"], t["text"]) for t in turns] == [
        ("R", "user", "Hello."), ("K", "assistant", "Again.")]
