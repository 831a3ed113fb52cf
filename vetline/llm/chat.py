"""Chat formatting by a finite-state machine over roles and a declarative template.

A template lists the parts of a turn (fixed strings, the role, the text), the
roles whose text is learned, and the moves of a machine over roles: state and
role to next state, the states that a conversation may end in.  A turn without
a move breaks the order; the conversation is formatted all the same and told
as out of order from that turn on.

Turns are dealt by ranges of (conversation, turn), so a conversation of any
size spreads over tasks.  A task does not know in which state the machine
enters its first conversation, so each block of turns carries the whole step it
is: for every state the state after it, and the first turn that breaks the
order.  Steps compose, and whole conversations are told by composing a few.

Control strings inside texts are escaped: a backslash more between ``<`` and
``|``, after any that stand there; taking one out restores the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from enum import Enum

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetline.llm import common as c

BROKEN = "broken"
BLOCK = 1 << 16         # code points from which a block of turns is closed
HELD = 1 << 20          # code points of one conversation that a task keeps until the conversation is over

class Slot(Enum):
    """What a turn puts in."""
    ROLE = 1
    TEXT = 2


ROLE, TEXT = Slot.ROLE, Slot.TEXT


@dataclass(frozen=True)
class Template:
    """Parts of a turn, learned roles, and the machine over roles."""
    parts: tuple
    learned: frozenset
    start: str
    moves: dict
    accept: frozenset

    def __post_init__(self):
        slots = [k for k, p in enumerate(self.parts) if not isinstance(p, str)]
        if sorted(self.parts[k].name for k in slots) != ["ROLE", "TEXT"] or not isinstance(self.parts[0], str):
            raise ValueError("a turn begins with a fixed string and has one role and one text")
        for k in slots:
            after = self.parts[k + 1] if k + 1 < len(self.parts) else ""
            if not isinstance(after, str) or not (after.startswith("<|") or self.parts[k] is ROLE and after.startswith("\n")):
                raise ValueError("a text ends at a control string, a role there or at a line end")
        if any(re.search(r"<\\+\|", p) or p.endswith("<") for p in self.parts if isinstance(p, str)):
            raise ValueError("fixed strings must not look like escaped ones")

    @property
    def states(self) -> list[str]:
        return [*dict.fromkeys([self.start, *self.moves, *(s for m in self.moves.values() for s in m.values())]), BROKEN]


CHATML = Template(
    parts=("<|im_start|>", ROLE, "\n", TEXT, "<|im_end|>", "\n"),
    learned=frozenset({"assistant"}),
    start="start",
    moves={"start": {"system": "told", "user": "asked"}, "told": {"user": "asked"}, "asked": {"assistant": "answered"},
           "answered": {"user": "asked"}},
    accept=frozenset({"answered"}),
)

_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escaped(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text) if "<" in text else text


def unescaped(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text) if "<" in text else text


def escaped_role(role: str) -> str:
    """Of one line."""
    return escaped(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescaped_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(role))


def segments(template: Template, role: str, text: str) -> list[tuple[str, bool]]:
    """The texts of one turn, each with whether it is learned."""
    out = []
    for part in template.parts:
        if part is TEXT:
            out.append((escaped(text), role in template.learned))
        else:
            out.append((escaped_role(role) if part is ROLE else part, False))
    return out


def turns_of(template: Template, formatted: str) -> Iterator[tuple[str, str]]:
    """Role and text of each turn, from the formatted text alone."""
    at = 0
    while at < len(formatted):
        got = {}
        for k, part in enumerate(template.parts):
            if isinstance(part, str):
                if not formatted.startswith(part, at):
                    raise ValueError(f"no {part!r} at {at}")
                at += len(part)
            else:
                end = formatted.index(template.parts[k + 1], at)
                got[part], at = formatted[at:end], end
        yield unescaped_role(got[ROLE]), unescaped(got[TEXT])


# ---- blocks ----------------------------------------------------------------
_BLOCKS = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("block", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()),
                     ("learned", pa.list_(pa.list_(pa.int64()))), ("after", pa.list_(pa.int32())), ("broken_at", pa.list_(pa.int64()))])
BLOCKS = "conv_id long, part int, block long, n_turns long, formatted string, learned array<array<long>>, after array<int>, broken_at array<long>"


class _Block:
    """Consecutive turns of one conversation."""

    def __init__(self, template: Template, conv):
        self.template, self.conv = template, conv
        self.texts, self.learned, self.n, self.size = [], [], 0, 0
        self.states = template.states
        self.after = list(range(len(self.states)))
        self.broken = [-1] * len(self.states)
        self.moves = {r: [self.states.index(template.moves.get(s, {}).get(r, BROKEN)) for s in self.states]
                      for r in {r for m in template.moves.values() for r in m}}

    def add(self, role: str, text: str) -> None:
        move = self.moves.get(role)
        lost = len(self.states) - 1
        for k, s in enumerate(self.after):
            if s != lost:
                self.after[k] = move[s] if move else lost
                if self.after[k] == lost:
                    self.broken[k] = self.n
        for piece, learn in segments(self.template, role, text):
            if learn:
                self.learned.append([self.size, self.size + len(piece)])
            self.texts.append(piece)
            self.size += len(piece)
        self.n += 1

    def row(self, part: int, block: int) -> tuple:
        return self.conv, part, block, self.n, "".join(self.texts), self.learned, self.after, self.broken


def _blocks(template: Template):
    def run(batches):
        part = TaskContext.get().partitionId()

        def rows():
            now, block = None, 0
            for batch in batches:
                for conv, role, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                    if now is None or now.conv != conv or now.size >= BLOCK:
                        if now is not None:
                            yield now.row(part, block)
                            block += 1
                        now = _Block(template, conv)
                    now.add(role or "", text or "")
            if now is not None:
                yield now.row(part, block)
        yield from c.rebatched(rows(), _BLOCKS, 64)
    return run


def format_turns(conversations: DataFrame, template: Template = CHATML, id_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The formatted conversations in blocks of whole turns, in order of
    ``(part, block)``: ``conv_id``, ``part``, ``block``, ``n_turns``,
    ``formatted``, ``learned`` (spans of it, in code points, that carry loss),
    ``after`` and ``broken_at`` (for each state of the template the one after the
    block, and the number in the block of the turn that breaks the order, or
    -1).  A conversation is the blocks of its id joined by nothing.

    Null roles and texts are empty.  Turns stand by ``turn`` (null first); those of
    one turn by role, then by a hash of the text; repeated rows are turns like any
    other.  Rows of a null id are one conversation.  Other columns are not
    read, and an empty table gives no rows.
    """
    text = F.col(text_col).cast("string")
    turns = conversations.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                                 F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.xxhash64(text).alias("tie"),
                                 F.coalesce(text, F.lit("")).alias("text"))
    key = ["conv_id", "turn", "role", "tie"]
    return turns.repartitionByRange(*key).sortWithinPartitions(*key, "text").select("conv_id", "role", "text").mapInArrow(
        _blocks(template), BLOCKS)


# ---- reading back ----------------------------------------------------------
class _Reader:
    """One conversation, read block by block."""

    def __init__(self, template: Template, conv):
        self.template, self.conv = template, conv
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.chars = self.loss_chars = 0
        self.state, self.broken = template.states.index(template.start), -1

    def add(self, n_turns: int, formatted: str, learned: list, after: list, broken_at: list) -> None:
        if self.broken < 0 <= broken_at[self.state]:
            self.broken = self.n + broken_at[self.state]
        self.state = after[self.state]
        for role, text in turns_of(self.template, formatted):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n += 1
        for lo, hi in learned:
            text = unescaped(formatted[lo:hi])
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.chars += len(formatted)

    def row(self) -> tuple:
        return (self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
                self.template.states[self.state] in self.template.accept, None if self.broken < 0 else self.broken)


_TOLD = [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
         ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("in_order", pa.bool_()), ("broken_turn", pa.int64())]
TOLD = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, in_order boolean, broken_turn long"
_FIELDS = ["conv_id", "n_turns", "formatted", "learned", "after", "broken_at"]


def _whole(template: Template):
    """Conversations that lie in one task are told at once; the first and the
    last of a task, which may go on in another one, and those too long to be
    held leave their blocks."""
    schema = pa.schema([*_TOLD, ("part", pa.int32()), ("block", pa.int64()), ("rest", pa.struct([f for f in _BLOCKS if f.name in _FIELDS[1:]]))])

    def run(batches):
        def told(held):
            reader = _Reader(template, held[0]["conv_id"])
            for b in held:
                reader.add(*(b[f] for f in _FIELDS[1:]))
            return *reader.row(), None, None, None

        def left(b):
            return b["conv_id"], *[None] * 7, b["part"], b["block"], {f: b[f] for f in _FIELDS[1:]}

        def rows():
            held, size, open_ = [], 0, True         # the first one is open from the start
            conv, begun = None, False
            for batch in batches:
                for b in batch.to_pylist():
                    if begun and b["conv_id"] != conv:
                        if held:
                            yield told(held)
                        held, size, open_ = [], 0, False
                    conv, begun = b["conv_id"], True
                    held.append(b)
                    size += len(b["formatted"])
                    if open_ or size > HELD:
                        open_ = True
                        yield from map(left, held)
                        held = []
            yield from map(left, held)              # the last one
        yield from c.rebatched(rows(), schema, 64)
    return run


def _read(template: Template):
    def run(batches):
        def rows():
            now = None
            for batch in batches:
                for b in batch.to_pylist():
                    if now is None or now.conv != b["conv_id"]:
                        if now is not None:
                            yield now.row()
                        now = _Reader(template, b["conv_id"])
                    now.add(*(b["rest"][f] for f in _FIELDS[1:]))
            if now is not None:
                yield now.row()
        yield from c.rebatched(rows(), pa.schema(_TOLD), 512)
    return run


def read_back(blocks: DataFrame, template: Template = CHATML) -> DataFrame:
    """One row per conversation, from the formatted text and its spans alone:
    ``n_turns``, ``turns_sha256`` (of role, newline, text, newline per turn),
    ``loss_chars`` and ``loss_sha256`` (of the text under the loss, unescaped),
    ``formatted_chars``, ``in_order`` (the machine accepts its turns) and
    ``broken_turn`` (number of the turn that breaks the order, else null).

    Needs the order of ``format_turns``: blocks of one task follow each other.
    A digest is made in one pass over its conversation, so the blocks of one that
    spans tasks meet in one, which reads them one after the other.
    """
    rest = f"struct<{', '.join(x.strip().replace(' ', ':', 1) for x in BLOCKS.split(', ') if x.split()[0] in _FIELDS[1:])}>"
    told = c.stored(blocks.mapInArrow(_whole(template), f"{TOLD}, part int, block long, rest {rest}"), "conversations")
    columns = [f[0] for f in _TOLD]
    open_ = told.where("rest is not null").select("conv_id", "part", "block", "rest")
    spread = open_.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block").select("conv_id", "rest").mapInArrow(_read(template), TOLD)
    return told.where("rest is null").select(*columns).unionByName(spread)
