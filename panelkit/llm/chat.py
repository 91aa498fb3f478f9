"""Formatting of conversations: a state machine over roles and a declarative template.

A template says how each role's turn is marked and whether its text counts for the loss. Control
strings inside texts are broken up by an escape character, which can be undone, so that the
turns can be read back from the formatted text alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class Turn:
    """What stands before and after a role's text, and whether the text is trained on."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Turns by role, the turn of any other role, and which role may follow which.

    ``other`` holds ``{role}`` in ``before``. ``follows`` maps a state (the last role, ``""``
    at the start) to the roles that may come next; a conversation may end in ``final``.
    """

    turns: dict[str, Turn] = field(
        default_factory=lambda: {
            "system": Turn("<<SYS>> ", " <</SYS>>"),
            "user": Turn("[INST] ", " [/INST]"),
            "assistant": Turn("<s> ", " </s>", loss=True),
        }
    )
    other: Turn = Turn("[ROLE] {role} [/ROLE] ", " [/END]")
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    final: tuple[str, ...] = ("assistant",)

    def control(self) -> list[str]:
        """Strings that must not occur in a text as they are."""
        pieces = [p for t in (*self.turns.values(), self.other) for p in (t.before, t.after)]
        return sorted({w for p in pieces for w in p.replace("{role}", " ").split()})

    def escaper(self) -> re.Pattern:
        """Matches the escape character, and the first character of every control string."""
        starts = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in self.control())
        return re.compile(f"{re.escape(ESCAPE)}|{starts}")

    def escape(self, text: str) -> str:
        return self.escaper().sub(lambda m: m.group() + ESCAPE, text)

    @staticmethod
    def unescape(text: str) -> str:
        """Every character of an escaped text that is followed by ESCAPE loses it."""
        return re.sub(rf"(.){re.escape(ESCAPE)}", r"\1", text, flags=re.S)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """(text, loss) pieces of one turn; together they are its formatted text."""
        turn = self.turns.get(role, self.other)
        before = turn.before
        if role not in self.turns:
            before = before.replace("{role}", self.escape(role))
        return [(before, False), (self.escape(text), turn.loss), (turn.after, False)]

    def head(self, formatted: str) -> tuple[str, str, int] | None:
        """Role, end mark and length of the head of a turn, if all of it is there."""
        for role, turn in self.turns.items():
            if formatted.startswith(turn.before):
                return role, turn.after, len(turn.before)
        start, middle = self.other.before.split("{role}")
        at = formatted.find(middle, len(start)) if formatted.startswith(start) else -1
        if at < 0:
            return None
        return self.unescape(formatted[len(start) : at]), self.other.after, at + len(middle)

    def read(self, formatted: str) -> tuple[str, str]:
        """Role and text of one formatted turn."""
        role, after, begin = self.head(formatted)
        return role, self.unescape(formatted[begin : -len(after)])


class Machine:
    """The state machine of one conversation: its state is the last role, None after an error."""

    def __init__(self, template: Template) -> None:
        self.template, self.state = template, ""

    def accepts(self, role: str) -> bool:
        allowed = self.state is not None and role in self.template.follows.get(self.state, ())
        self.state = role if allowed else None
        return allowed


DEFAULT = Template()
SEGMENTS = (
    "conv_id long, turn long, role string, "
    "segments array<struct<text:string,loss:boolean,refused:boolean>>"
)


def format_turns(conversations: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """(conv_id, turn, role, segments), one row per turn, conversations in order.

    The turns are sorted and run through the state machine, which passes each on as segments:
    concatenated over a conversation they are its formatted text, ``loss`` marks what is trained
    on, and ``refused`` the turns that the machine does not accept, which are all after the
    first. Turns with the same number are ordered by role and text. A NULL text or role is
    empty, a NULL conv_id a conversation; repeated rows are turns; other columns are left out.
    A task holds one turn at a time, however long the conversation is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = [("text", pa.string()), ("loss", pa.bool_()), ("refused", pa.bool_())]
        names = ["conv_id", "turn", "role", "segments"]
        conv, machine = None, None
        for batch in batches:
            out = []
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "role", "text")]
            for own, role, text in zip(*columns, strict=True):
                if machine is None or own != conv:
                    conv, machine = own, Machine(template)
                refused = not machine.accepts(role)
                out.append(
                    [
                        {"text": t, "loss": loss, "refused": refused}
                        for t, loss in template.segments(role, text)
                    ]
                )
            segments = pa.array(out, pa.list_(pa.struct(kind)))
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names[:3]], segments], names)

    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    in_order = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return in_order.mapInArrow(run, SEGMENTS)


SUMMARY = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, valid boolean, first_error long"
)


def summarise(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row per conversation, read back from the formatted text of ``format_turns``.

    A conversation is read as one text with its mask: where a turn ends and what its role is
    follows from the marks alone. Returned are digests of the turns and of all text under the
    mask, lengths in code points, whether the machine accepts the order of roles, and the
    position of the first turn that it refuses (NULL if none; after the last turn if the end is
    refused). ``formatted`` must be as ``format_turns`` leaves it, in order within a task; it is
    streamed, and a task holds the turn that it reads. An empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: _Reader | None = None
        for batch in batches:
            done = []
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "segments")]
            for conv, segments in zip(*columns, strict=True):
                if open_ is None or open_.conv_id != conv:
                    if open_ is not None:
                        done.append(open_.row())
                    open_ = _Reader(conv, template)
                for s in segments:
                    open_.feed(s["text"], s["loss"], s["refused"])
            if done:
                yield _summary(done)
        if open_ is not None:
            yield _summary([open_.row()])

    return formatted.select("conv_id", "segments").mapInArrow(run, SUMMARY)


def _summary(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"turns_sha256": pa.string(), "loss_sha256": pa.string(), "valid": pa.bool_()}
    return pa.RecordBatch.from_arrays(
        [pa.array([r[n] for r in rows], kinds.get(n, pa.int64())) for n in rows[0]],
        names=list(rows[0]),
    )


class _Reader:
    """Reads the formatted text of one conversation, in pieces of any length, and its mask."""

    def __init__(self, conv_id: int | None, template: Template) -> None:
        self.conv_id, self.template = conv_id, template
        self.turns, self.chars, self.loss_chars, self.error = 0, 0, 0, None
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()
        self.unread, self.masked = "", ""
        self.role: str | None = None  # of the turn that is open, with its end mark
        self.after, self.seen, self.last = "", 0, ""

    def feed(self, text: str, loss: bool, refused: bool) -> None:
        self.chars += len(text)
        if refused and self.error is None:
            self.error = self.turns
        if loss:
            self.masked += text
        elif self.masked:
            self._close_mask()
        self.unread += text
        while self._read_mark():
            pass

    def _close_mask(self) -> None:
        plain = self.template.unescape(self.masked)
        self.loss.update(plain.encode())
        self.loss_chars += len(plain)
        self.masked = ""

    def _read_mark(self) -> bool:
        """Take the head or the text of the next turn, if all of it is there."""
        if self.role is None:
            head = self.template.head(self.unread)
            if head is None:
                return False
            self.role, self.after, begin = head
            self.unread, self.seen = self.unread[begin:], 0
            return True
        at = self.unread.find(self.after, self.seen)
        if at < 0:
            self.seen = max(0, len(self.unread) - len(self.after) + 1)
            return False
        text = self.template.unescape(self.unread[:at])
        self.all.update(f"{self.role}\n{text}\n".encode())
        self.unread = self.unread[at + len(self.after) :]
        self.last, self.role, self.turns = self.role, None, self.turns + 1
        return True

    def row(self) -> dict:
        if self.masked:
            self._close_mask()
        if self.unread or self.role is not None:
            raise ValueError(f"conversation {self.conv_id} does not end with a turn")
        if self.error is None and self.last not in self.template.final:
            self.error = self.turns
        return {
            "conv_id": self.conv_id,
            "n_turns": self.turns,
            "turns_sha256": self.all.hexdigest(),
            "loss_chars": self.loss_chars,
            "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.chars,
            "valid": self.error is None,
            "first_error": self.error,
        }
