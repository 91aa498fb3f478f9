"""Repair of conversations: the cheapest edits that make the turns alternate as they should.

A conversation is a string of turns, and the edit lattice has a node for each place in it and each
state of the wanted order of roles, ``(s?(ua)+)?``. Keeping, relabelling or deleting a turn leads
to the next place, inserting one stays. The cheapest way is found by Dijkstra's search from both
ends at once: the searches meet, all crossings of the same cost are finished, and of these the
least audit, the string of the edits' initials, is taken.

No task holds more than the marks of one conversation (a byte per turn), and never its texts: turns
are sorted over all tasks, each task cuts its stretch of a conversation into pieces and solves
these for every state at either end, and the pieces of a conversation are then put together.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.operators.staging import settle

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
"""Costs of the edits, and of a truncated turn that stays."""
PIECE = 256
"""Turns that are searched together."""
BLANK = " \t\n\x0b\x0c\r"
FORCED = "-"
"""Mark of a turn that must go; others are marked by their initial, in capitals if truncated."""

# The order of roles: nothing yet, after system, after user, after assistant.
STATES = range(4)
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FINAL = (0, 3)
DUE = {0: "u", 1: "u", 2: "a", 3: "u"}
"""The one role that a relabelled or inserted turn can have in a state."""
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}

Edge = tuple[int, str, int]  # cost, initial, state


def turn_edges(mark: str, state: int) -> list[Edge]:
    """Edits of a turn in a state: their costs, initials and the states after them."""
    edges = [(DELETE, "D", state)]
    if mark != FORCED:
        initial, more = mark.lower(), TRUNCATED * mark.isupper()
        if (state, initial) in STEP:
            edges.append((KEEP + more, "K", STEP[state, initial]))
        if DUE[state] != initial:
            edges.append((REROLE + more, "R", STEP[state, DUE[state]]))
    return edges


MARKS = (FORCED, *"suaxSUAX")
FORWARD = {m: [turn_edges(m, state) for state in STATES] for m in MARKS}
BACKWARD = {
    m: [
        [(cost, name, p) for p in STATES for cost, name, q in FORWARD[m][p] if q == state]
        for state in STATES
    ]
    for m in MARKS
}
PUT = [[(INSERT, "I", STEP[state, DUE[state]])] for state in STATES]
PUT_BACK = [
    [(INSERT, "I", p) for p in STATES if STEP[p, DUE[p]] == state] for state in STATES
]


@lru_cache(maxsize=1 << 14)
def cheapest(marks: str, entry: int, exits: tuple[int, ...]) -> tuple[int, str] | None:
    """Cost and least audit of the cheapest edits from ``entry`` to one of ``exits``, if any.

    A node is (place, state). The forward heap pops the lowest cost, and of equal costs the
    first place, the reverse heap the last place: an edit that costs nothing never leads back,
    so what is popped has its final cost and its least audit. Whenever a node is popped, its
    edges to nodes that the other search has popped are crossings. Every cheapest way has an
    edge whose ends are popped by either search once the heaps' lowest costs add up to more
    than the best crossing; until then equal crossings may still come.
    """
    end = len(marks)
    ahead = {(0, entry): (0, "")}
    behind = {(end, state): (0, "") for state in exits}
    forward, reverse = [(0, 0, entry)], [(0, -end, state) for state in exits]
    done_ahead: set[tuple[int, int]] = set()
    done_behind: set[tuple[int, int]] = set()
    best: tuple[int, str] | None = None

    def crossing(cost: int, audit: str) -> None:
        nonlocal best
        if best is None or (cost, audit) < best:
            best = cost, audit

    while forward or reverse:
        lowest = forward[0][0] if forward else None, reverse[0][0] if reverse else None
        if best is not None and (None in lowest or sum(lowest) > best[0]):
            break
        if lowest[1] is None or lowest[0] is not None and lowest[0] < lowest[1]:
            cost, at, state = heapq.heappop(forward)
            node = at, state
            if node in done_ahead:
                continue
            done_ahead.add(node)
            audit = ahead[node][1]
            if node in done_behind:
                crossing(cost + behind[node][0], audit + behind[node][1])
            edges = [(c, name, (at, q)) for c, name, q in PUT[state]]
            if at < end:
                edges += [(c, name, (at + 1, q)) for c, name, q in FORWARD[marks[at]][state]]
            for more, name, node in edges:
                found = cost + more, audit + name
                if node in done_behind:
                    crossing(found[0] + behind[node][0], found[1] + behind[node][1])
                if node not in done_ahead and (node not in ahead or found < ahead[node]):
                    ahead[node] = found
                    heapq.heappush(forward, (found[0], *node))
        else:
            cost, at, state = heapq.heappop(reverse)
            at = -at
            node = at, state
            if node in done_behind:
                continue
            done_behind.add(node)
            audit = behind[node][1]
            if node in done_ahead:
                crossing(cost + ahead[node][0], ahead[node][1] + audit)
            edges = [(c, name, (at, p)) for c, name, p in PUT_BACK[state]]
            if at:
                edges += [(c, name, (at - 1, p)) for c, name, p in BACKWARD[marks[at - 1]][state]]
            for more, name, node in edges:
                found = cost + more, name + audit
                if node in done_ahead:
                    crossing(found[0] + ahead[node][0], ahead[node][1] + found[1])
                if node not in done_behind and (node not in behind or found < behind[node]):
                    behind[node] = found
                    heapq.heappush(reverse, (found[0], -node[0], node[1]))
    return best


Ways = dict[tuple[int, int], tuple[int, str]]


def ways(marks: str) -> Ways:
    """The cheapest edits of a piece between every two states."""
    found = {(p, q): cheapest(marks, p, (q,)) for p in STATES for q in STATES}
    return {ends: way for ends, way in found.items() if way}


def joined(left: Ways, right: Ways) -> Ways:
    """The ways over two pieces. A least audit consists of least audits.

    Two audits of one stretch of the same cost and states never begin one with the other, as
    the longer one would hold more insertions; so what follows them cannot change their order.
    """
    out: Ways = {}
    for p in STATES:
        for r in STATES:
            pairs = [
                (left[p, q], right[q, r]) for q in STATES if (p, q) in left and (q, r) in right
            ]
            if pairs:
                cost = min(a[0] + b[0] for a, b in pairs)
                out[p, r] = cost, min(a[1] + b[1] for a, b in pairs if a[0] + b[0] == cost)
    return out


def walk(marks: str, audit: str, state: int, rest: bool) -> tuple[list[tuple], str, int]:
    """The edits (turn or None, initial, new role or None) of a piece, the audit left, the state.

    With ``rest`` the insertions after the last turn belong to the piece.
    """
    out, at, used = [], 0, 0
    for used, name in enumerate(audit):
        if at == len(marks) and not (rest and name == "I"):
            return out, audit[used:], state
        if name == "I":
            out.append((None, name, ROLES[DUE[state]]))
            state = STEP[state, DUE[state]]
            continue
        role = None
        if name == "R":
            role = ROLES[DUE[state]]
            state = STEP[state, DUE[state]]
        elif name == "K":
            state = STEP[state, marks[at].lower()]
        out.append((at, name, role))
        at += 1
    return out, "", state


# ---- turns, marks and pieces ----------------------------------------------------------------


def damaged(turns: DataFrame) -> DataFrame:
    """The turns with faults that a checksum of ``conv_id:turn`` chooses; a NULL is one space.

    Of 20 remainders 0 drops the turn, 1 empties it, 2 takes out its sentence ends, 3 repeats
    it and 4 makes it the user's.
    """
    key = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *key)) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 3, 2).otherwise(1).alias("copies"),
        kind.alias("__kind"),
    ).where("__kind <> 0").drop("__kind")


def _turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies, digest); the digest tells role and text apart."""
    copies = F.col("copies") if "copies" in turns.columns else F.lit(1)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        copies.cast("long").alias("copies"),
        F.unhex(F.sha2(F.concat(F.length(role), F.lit(":"), role, text), 256)).alias("digest"),
    )


def _marked(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, initial, mark, copies, blank, duplicate, truncated), no texts.

    Equal rows are one row with a number of copies; they are combined by the tasks that read
    them, and so are the first places of equal turns, so no group of them meets anywhere.
    """
    last = F.right(F.rtrim("text", F.lit(BLANK)), F.lit(1))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    mark = F.when(last == "", FORCED).when(last.isin(".", "!", "?"), kind).otherwise(F.upper(kind))
    rows = turns.select("conv_id", "turn", "digest", "copies", initial.alias("initial"), mark.alias("mark"))
    rows = settle(
        rows.groupBy("conv_id", "turn", "digest", "initial", "mark").agg(
            F.sum("copies").alias("copies")
        )
    )
    again = (
        rows.where(F.col("mark") != FORCED)
        .groupBy(F.col("conv_id").alias("__conv"), F.col("digest").alias("__digest"))
        .agg(F.min(F.struct("turn")).alias("__first"), F.count(F.lit(1)).alias("__n"))
        .where("__n > 1")
    )
    on = F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("digest") == F.col("__digest"))
    rows = rows.join(again, on, "left")
    later = F.col("__n").isNotNull() & ~F.col("__first.turn").eqNullSafe(F.col("turn"))
    blank = F.col("mark") == FORCED
    repeats = F.when(later, F.col("copies")).otherwise(F.col("copies") - 1)
    return rows.select(
        "conv_id",
        "turn",
        "digest",
        "initial",
        F.when(later, FORCED).otherwise(F.col("mark")).alias("mark"),
        "copies",
        F.when(blank, F.col("copies")).otherwise(0).alias("blank"),
        F.when(blank, 0).otherwise(repeats).alias("duplicate"),
        F.when(~blank & ~later & (F.col("mark") != F.lower("mark")), 1).otherwise(0).alias("truncated"),
    )


PIECES = (
    "conv_id long, task int, nth int, marks string, digests array<binary>, alone boolean, "
    "illegal long, first string, last string"
)


class _Pieces:
    """Pieces of the conversations of one task, whose turns come in order."""

    def __init__(self) -> None:
        self.task, self.nth = TaskContext.get().partitionId(), 0
        self.begun = False
        self.rows: list[tuple] = []
        self.clear()

    def clear(self) -> None:
        self.marks: list[str] = []
        self.digests: list[bytes | None] = []
        self.illegal, self.first, self.last = 0, None, None

    def cut(self, ended: bool, edge: bool) -> None:
        """End a piece; it stands alone if its conversation lies in it and inside the task."""
        if self.marks:
            alone = ended and not edge and not self.more
            self.rows.append(
                (self.conv, self.task, self.nth, "".join(self.marks), self.digests, alone,
                 self.illegal, self.first, self.last)
            )
            self.nth += 1
            self.more = not ended
            self.clear()

    def add(self, conv, digest: bytes, initial: str, mark: str, copies: int) -> None:
        if not self.begun or conv != self.conv:
            if self.begun:
                self.cut(True, self.edge)
            self.edge = not self.begun  # the first conversation may have begun in another task
            self.begun, self.conv, self.more = True, conv, False
        for n in range(copies):
            if len(self.marks) == PIECE:
                self.cut(False, True)
            if self.last is None:
                self.first = initial
            elif self.last + initial not in LEGAL:
                self.illegal += 1
            self.last = initial
            own = mark if n == 0 else FORCED
            self.marks.append(own)
            self.digests.append(digest if own != FORCED else None)

    def batch(self) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.binary()), pa.bool_(),
                 pa.int64(), pa.string(), pa.string()]
        names = [part.split(" ")[0] for part in PIECES.split(", ")]
        columns = list(zip(*self.rows, strict=True)) or [()] * len(names)
        self.rows = []
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names
        )


def _cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pieces = _Pieces()
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("conv_id", "digest", "initial", "mark", "copies")]
        for row in zip(*columns, strict=True):
            pieces.add(*row)
            if len(pieces.rows) >= 1000:
                yield pieces.batch()
    if pieces.begun:
        pieces.cut(True, True)  # the last conversation may go on in another task
    yield pieces.batch()


SOLVED = (
    "task int, nth int, state int, audit string, cost long, illegal long, whole string, head boolean"
)


def _solve_alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations that lie in one piece."""
    for batch in batches:
        found = [cheapest(m, 0, FINAL) for m in batch.column("marks").to_pylist()]
        audits = [audit for _, audit in found]
        yield pa.RecordBatch.from_pydict(
            {
                "task": batch.column("task"), "nth": batch.column("nth"),
                "state": pa.array([0] * len(found), pa.int32()), "audit": audits,
                "cost": pa.array([cost for cost, _ in found], pa.int64()),
                "illegal": batch.column("illegal"), "whole": audits,
                "head": [True] * len(found),
            }
        )


def _solve_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ways of single pieces, as a list."""
    for batch in batches:
        found = [
            [(p, q, cost, audit) for (p, q), (cost, audit) in ways(m).items()]
            for m in batch.column("marks").to_pylist()
        ]
        kind = pa.struct(
            [("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]
        )
        rows = [[dict(zip(("p", "q", "cost", "audit"), w, strict=True)) for w in one] for one in found]
        names = ["conv_id", "task", "nth", "marks", "illegal", "first", "last"]
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in names] + [pa.array(rows, pa.list_(kind))], [*names, "ways"]
        )


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order, conversation by conversation, to the audit of each piece.

    Ways are joined two and two, so a stretch is copied as often as the number of pieces can be
    halved.
    """
    held: list[dict] = []
    stack: list[tuple[int, Ways]] = []

    def push(one: Ways) -> None:
        size = 1
        while stack and stack[-1][0] == size:
            one, size = joined(stack.pop()[1], one), 2 * size
        stack.append((size, one))

    def close() -> pa.RecordBatch:
        whole = stack.pop()[1]
        while stack:
            whole = joined(stack.pop()[1], whole)
        cost, audit = min(whole[0, q] for q in FINAL if (0, q) in whole)
        illegal = sum(p["illegal"] for p in held) + sum(
            a["last"] + b["first"] not in LEGAL for a, b in zip(held, held[1:], strict=False)
        )
        rows, state, at = [], 0, 0
        for n, piece in enumerate(held):
            # a piece has at most two insertions next to each turn
            ahead = audit[at : at + 4 * len(piece["marks"]) + 4]
            _, left, after = walk(piece["marks"], ahead, state, n == len(held) - 1)
            used = ahead[: len(ahead) - len(left)]
            rows.append((piece["task"], piece["nth"], state, used, cost, illegal, audit if not n else None, not n))
            state, at = after, at + len(used)
        held.clear()
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
        names = [part.split(" ")[0] for part in SOLVED.split(", ")]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names
        )

    for batch in batches:
        for row in range(batch.num_rows):
            piece = batch.slice(row, 1).to_pylist()[0]
            if held and piece["conv_id"] != held[0]["conv_id"]:
                yield close()
            push({(w["p"], w["q"]): (w["cost"], w["audit"]) for w in piece.pop("ways")})
            held.append(piece)
    if held:
        yield close()


EDITS = "conv_id long, place long, edit string, role string, digest binary"


def _list_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The turns that a piece has after its edits."""
    for batch in batches:
        out: list[tuple] = []
        for piece in batch.to_pylist():
            edits, _, _ = walk(piece["marks"], piece["audit"], piece["state"], True)
            place = (piece["task"] << 20 | piece["nth"]) << 11
            out += [
                (piece["conv_id"], place + n, name, role, None if at is None else piece["digests"][at])
                for n, (at, name, role) in enumerate(edits) if name != "D"
            ]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
        names = [part.split(" ")[0] for part in EDITS.split(", ")]
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names
        )


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns after the repair).

    ``turns`` has (conv_id, turn, role, text), perhaps ``copies`` (how often a row stands there),
    and any other columns. Conversations: (conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit). Turns: (conv_id, place, edit, role, text), in the order of ``place`` within a
    conversation.

    Turns are ordered by ``turn`` (NULL first) and, where that is equal, by a digest of role and
    text. A NULL role or text counts as one space; rows without a conv_id are one conversation.
    Repeated rows are faults of the conversation (duplicates). A role whose initial is not s, u
    or a cannot be kept. An empty table gives no conversations.
    """
    turns = _turns(turns)
    marked = settle(_marked(turns))
    per_turn = marked.groupBy("conv_id", "turn").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]
    )
    span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    faults = per_turn.groupBy("conv_id").agg(
        F.coalesce(span, F.lit(0)).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
    )
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("digest").asc()]
    stretch = marked.select("conv_id", "turn", "digest", "initial", "mark", "copies")
    stretch = stretch.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = settle(stretch.mapInArrow(_cut_pieces, PIECES))
    solved = pieces.where("alone").mapInArrow(_solve_alone, SOLVED)
    parts = pieces.where("NOT alone").drop("digests", "alone").mapInArrow(
        _solve_pieces,
        "conv_id long, task int, nth int, marks string, illegal long, first string, last string, "
        "ways array<struct<p: int, q: int, cost: long, audit: string>>",
    )
    in_order = parts.repartition("conv_id").sortWithinPartitions("conv_id", "task", "nth")
    solved = settle(solved.unionByName(in_order.mapInArrow(_put_together, SOLVED)))
    heads = pieces.select("conv_id", "task", "nth").join(
        solved.where("head").drop("state", "audit", "head"), ["task", "nth"]
    )
    on = F.col("conv_id").eqNullSafe(F.col("__conv"))
    conversations = (
        heads.select("conv_id", "illegal", "cost", F.col("whole").alias("audit"))
        .join(faults.withColumnRenamed("conv_id", "__conv"), on)
        .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    )
    edits = pieces.join(solved.select("task", "nth", "state", "audit"), ["task", "nth"]).select(
        "conv_id", "task", "nth", "marks", "digests", "state", "audit"
    ).mapInArrow(_list_edits, EDITS)
    edits = settle(edits)
    texts = turns.groupBy(F.col("conv_id").alias("__conv"), F.col("digest").alias("__digest")).agg(
        F.any_value("role").alias("__role"), F.any_value("text").alias("text")
    )
    same = on & (F.col("digest") == F.col("__digest"))
    stay = edits.where("edit <> 'I'").join(texts, same)
    stay = stay.select("conv_id", "place", "edit", F.coalesce("role", "__role").alias("role"), "text")
    put = edits.where("edit = 'I'").select("conv_id", "place", "edit", "role", F.lit("").alias("text"))
    return conversations, stay.unionByName(put)


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``role:text`` lines in order, read turn by turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None
        done: list[tuple] = []
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "role", "text")]
            for own, role, text in zip(*columns, strict=True):
                if state is None or own != conv:
                    if state is not None:
                        done.append((conv, state.hexdigest()))
                    conv, state = own, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            yield _digest_batch(done)
            done = []
        if state is not None:
            yield _digest_batch([(conv, state.hexdigest())])

    in_order = turns.select("conv_id", "place", "role", "text").repartition("conv_id")
    in_order = in_order.sortWithinPartitions("conv_id", "place")
    return in_order.mapInArrow(run, "conv_id long, repaired_sha256 string")


def _digest_batch(rows: Sequence[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())],
        ["conv_id", "repaired_sha256"],
    )


def audit_conversations(original: DataFrame, turns: DataFrame) -> DataFrame:
    """A row per conv_id of ``original``: what ``repair`` found in ``turns``, and the digest.

    A conversation of which no turn is left, before or after the repair, has the digest of the
    empty string; one that ``turns`` lacks has zeros and an empty audit.
    """
    found, after = repair(turns)
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    ids = original.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    out = ids.join(
        found.withColumnRenamed("conv_id", "__conv"), _is("__conv"), "left"
    ).join(digests(after).withColumnRenamed("conv_id", "__of"), _is("__of"), "left")
    empty = hashlib.sha256().hexdigest()
    return out.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )


def _is(other: str) -> Column:
    return F.col("conv_id").eqNullSafe(F.col(other))
