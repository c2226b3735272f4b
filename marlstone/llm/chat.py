"""Chat formatting by a finite-state machine over roles.

A template declares how turns are marked, which roles bear loss, and which role may
follow which. The machine walks a conversation's turns in order and emits text segments:
head, text and tail of each turn, each with its loss flag and the state after
it, and one closing segment with the verdict. Control strings inside a text are
escaped with backslashes, so a formatted conversation can be read back exactly.

Turns are dealt out by conversation and walked as a stream sorted by turn: a task keeps
one state and never a whole conversation, so its length does not matter to
memory; its turns do come one after another, as their order is what is checked.

Defined results: a null text counts as empty; a null or unknown role is formatted
under its own name, without loss, and makes the conversation invalid; turns with
equal numbers follow by role and text; repeated rows are turns of their own; a
null turn number comes first; null ids are one conversation; an empty table gives no segments;
other columns are ignored. An invalid conversation is formatted whole and says so.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import staged

#: ``states``: state -> role -> next state. ``final``: states in which a conversation may end.
TEMPLATE = {
    "names": {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"},
    "head": "### {name}: ",
    "other": "Role {role}",
    "tail": "</turn>\n",
    "loss": ("assistant",),
    "start": "start",
    "states": {
        "start": {"system": "ready", "user": "asked"},
        "ready": {"user": "asked"},
        "asked": {"assistant": "answered", "tool": "asked"},
        "answered": {"user": "asked", "tool": "asked"},
    },
    "final": ("answered",),
}
REJECTED, ACCEPTED = "rejected", "accepted"
#: What ends a role's name in a head and begins or ends a turn; escaped inside texts and unknown roles.
CONTROL = ("### ", "</turn>", ": ")

SEGMENTS = "conv_id long, seq long, kind string, role string, text string, loss boolean, state string"
_ESCAPED = re.compile("|".join(map(re.escape, ("\\", *CONTROL))))
_UNESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return _UNESCAPED.sub(r"\1", text)


class Machine:
    """The state of one conversation under a template."""

    def __init__(self, template: dict):
        self.template, self.state = template, template["start"]

    def segments(self, role: str | None, text: str | None) -> Iterator[tuple[str, str, bool]]:
        """kind, text and loss flag of the segments of the next turn."""
        t = self.template
        self.state = t["states"].get(self.state, {}).get(role, REJECTED)
        name = t["names"].get(role) or t["other"].format(role=escape(role or ""))
        yield "head", t["head"].format(name=name), False
        yield "text", escape(text or ""), role in t["loss"]
        yield "tail", t["tail"], False

    def verdict(self) -> str:
        return ACCEPTED if self.state in self.template["final"] else REJECTED


def _streams(df: DataFrame, order: list[str], walk: Callable, schema: str) -> DataFrame:
    """``df`` dealt out by conv_id, sorted, and walked row by row; ``walk`` gets an iterator of tuples and yields tuples."""
    arrow = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [(name, arrow[kind]) for name, kind in (column.split() for column in schema.split(", "))]
    columns = df.columns

    def run(batches):
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in columns)))
        held, size = [], 0
        for row in walk(rows):
            held.append(row)
            size += 64 + sum(len(x) for x in row if isinstance(x, str))
            if size > 8 << 20:
                yield _batch(held, fields)
                held, size = [], 0
        if held:
            yield _batch(held, fields)

    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order).mapInArrow(run, schema)


def _batch(rows: list[tuple], fields) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, (_, kind) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


def format_conversations(conversations: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """Segments (conv_id, seq, kind, role, text, loss, state) of all conversations (conv_id, turn, role, text).

    The texts of a conversation's segments in order of seq are its formatted text; its
    last segment, of kind "end", is empty and its state is the verdict.
    """
    def walk(rows):
        machine, current, seq = None, None, 0
        for conv_id, _, role, text in rows:
            if machine is None or conv_id != current:
                if machine is not None:
                    yield current, seq, "end", None, "", False, machine.verdict()
                machine, current, seq = Machine(template), conv_id, 0
            for kind, part, loss in machine.segments(role, text):
                yield conv_id, seq, kind, role, part, loss, machine.state
                seq += 1
        if machine is not None:
            yield current, seq, "end", None, "", False, machine.verdict()

    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return _streams(turns, ["turn", "role", "text"], walk, SEGMENTS)


def turn_pattern(template: dict) -> re.Pattern:
    """One formatted turn: the name in its head and its escaped text."""
    before, after = map(re.escape, template["head"].split("{name}"))
    tail = re.escape(template["tail"])
    body = r"(?:[^\\]|\\.)*?"
    return re.compile(rf"{before}({body}){after}({body}){tail}", re.DOTALL)


class Reader:
    """Reads formatted text back, whatever pieces it comes in, and digests it."""

    def __init__(self, template: dict):
        self.pattern = turn_pattern(template)
        self.roles = {name: role for role, name in template["names"].items()}
        self.other = template["other"].split("{role}")[0]
        self.rest, self.n_turns, self.chars, self.loss_chars = "", 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.verdict = None

    def feed(self, kind: str, text: str, loss: bool, state: str | None) -> None:
        self.chars += len(text)
        if loss:
            plain = unescape(text)
            self.loss_chars += len(plain)
            self.loss.update(plain.encode())
        self.rest += text
        if kind == "end":
            self.verdict = state
        if kind == "tail":
            self.drain()

    def drain(self) -> None:
        at = 0
        while m := self.pattern.match(self.rest, at):
            name, text = m.group(1), unescape(m.group(2))
            role = self.roles.get(name)
            if role is None:
                role = unescape(name.removeprefix(self.other))
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
            at = m.end()
        self.rest = self.rest[at:]

    def report(self) -> tuple:
        self.drain()
        if self.rest:
            raise ValueError(f"cannot read back {self.rest[:80]!r}")
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.verdict == ACCEPTED


REPORT = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"
)


def read_back(segments: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """Per conversation, from its formatted text and loss flags alone: turns, digests, lengths, and the verdict."""
    def walk(rows):
        reader, current = None, None
        for conv_id, _, kind, text, loss, state in rows:
            if reader is None or conv_id != current:
                if reader is not None:
                    yield current, *reader.report()
                reader, current = Reader(template), conv_id
            reader.feed(kind, text, loss, state)
        if reader is not None:
            yield current, *reader.report()

    return _streams(segments.select("conv_id", "seq", "kind", "text", "loss", "state"), ["seq"], walk, REPORT)


def round_trip(conversations: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """Format all conversations, store the segments, and read them back."""
    return read_back(staged(format_conversations(conversations, template), "segments"), template)
