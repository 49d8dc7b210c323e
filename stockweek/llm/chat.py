"""Conversations as training text, with the span of every turn found from outside.

A template is any function from turns to a string. Successive prefixes of a
conversation are rendered, and consecutive outputs compared: what the longer one
adds is the new turn's piece. Rendering the last turn once more with a marker
for its text shows where the text lies in the piece. An output that does not
begin with the one before it gives away a template that rewrites history.

Every prefix is rendered whole, so that no rewriting is missed, and the time grows with
the square of the turns. A template may declare, by an attribute ``turn_by_turn``, that
what a turn adds follows from that turn alone. It then gets the turn before as the prefix,
for conversations of every length, and the declaration is put to proof: whenever the turns
have doubled, and at the end, the whole conversation must render to the same text and
spans, and an error is raised if it does not.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import partial
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweek.llm.columns import col, integer_id

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

# Rows leave in batches of about so many characters, and of so many rows at most.
_OUT_CHARS, _OUT_ROWS = 4 << 20, 10_000

# The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"

# Stands for a text; private characters, which a template has no reason to change.
_MARK = "\ue000\ue001text\ue001\ue000"


def escape(text: str) -> str:
    """The text with one more backslash inside each ``<|``, so it holds no control string."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def marked_turns(turns: list[Turn]) -> str:
    """A template that puts each turn between control strings; roles and texts are escaped.

    It declares that it renders each turn on its own.
    """
    return "".join(f"{START}{_escape_role(r)}\n{escape(t)}{END}\n" for r, t in turns)


marked_turns.turn_by_turn = True


_TURN = re.compile(
    re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.DOTALL
)


def read_turns(formatted: str) -> Iterator[Turn]:
    """The turns of text made by ``marked_turns``."""
    at = 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at {at}")
        yield _unescape_role(found[1]), unescape(found[2])
        at = found.end()


class Piece(NamedTuple):
    """What a turn adds to the output, and where its text lies in that; None if it can't be told.

    With ``restart`` the template has changed what it had put out: the piece is
    then the whole output so far, and takes the place of all earlier ones.
    """

    text: str
    start: int | None
    end: int | None
    restart: bool


def _text_span(piece: str, marked: str) -> tuple[int, int] | None:
    if marked.count(_MARK) != 1:
        return None
    head, tail = marked.split(_MARK)
    fits = len(head) + len(tail) <= len(piece) and piece.startswith(head) and piece.endswith(tail)
    return (len(head), len(piece) - len(tail)) if fits else None


def _added(
    template: Template, prefix: list[Turn], output: str, turn: Turn
) -> tuple[Piece, str | None, str]:
    """What a turn adds to a prefix and its output, that with the text marked, the new output."""
    longer = template([*prefix, turn])
    marked = template([*prefix, (turn[0], _MARK)])
    before = output if prefix else ""
    restart = not longer.startswith(before)
    at = 0 if restart else len(before)
    same = marked[:at] == longer[:at]
    start, end = (same and _text_span(longer[at:], marked[at:])) or (None, None)
    return Piece(longer[at:], start, end, restart), marked[at:] if same else None, longer


class IncrementalRenderer:
    """Renders a conversation turn by turn through a template it knows nothing of.

    ``add`` gives a turn's piece; ``finish`` ends the conversation. The turns are held. Of a
    template that declares ``turn_by_turn``, digests stand for what was put out.
    """

    def __init__(self, template: Template):
        self._template = template
        self._alone = bool(getattr(template, "turn_by_turn", False))
        self._turns: list[Turn] = []
        self._output = ""
        # Of a declared template: the pieces so far, and the same with each text marked.
        self._whole, self._marked = sha256(), sha256()
        self._check = 2

    def add(self, turn: Turn) -> Piece:
        if not self._alone:
            piece, _, self._output = _added(self._template, self._turns, self._output, turn)
            self._turns.append(turn)
            return piece
        before = self._turns[-1:]
        piece, marked, _ = _added(self._template, before, self._template(before) if before else "", turn)
        if piece.restart or marked is None:
            self._refuse()
        self._turns.append(turn)
        self._whole.update(piece.text.encode())
        self._marked.update(marked.encode())
        if len(self._turns) == self._check:
            self._prove()
            self._check *= 2
        return piece

    def finish(self) -> None:
        if self._alone and self._turns:
            self._prove()

    def _prove(self) -> None:
        """Compare the pieces with the whole conversation, as it is and with all texts marked."""
        marked = [(role, _MARK) for role, _ in self._turns]
        for turns, digest in ((self._turns, self._whole), (marked, self._marked)):
            if sha256(self._template(turns).encode()).digest() != digest.digest():
                self._refuse()

    def _refuse(self) -> None:
        raise ValueError("a template that declares turn_by_turn rendered a turn by what is around it")


FIELDS = (
    "conv_id bigint, seq bigint, role string, piece string, "
    "text_start bigint, text_end bigint, restart boolean"
)


def _rows(template: Template, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows sorted by conversation and turn; a conversation may go on over many batches."""
    current, renderer, seq = object(), None, 0
    for batch in batches:
        for conv, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if conv != current:
                if renderer:
                    renderer.finish()
                current, renderer, seq = conv, IncrementalRenderer(template), 0
            yield current, seq, role, *renderer.add((role, text))
            seq += 1
    if renderer:
        renderer.finish()


def _render(template: Template, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, chars = [], 0
    for row in _rows(template, batches):
        rows.append(row)
        chars += len(row[3])
        if chars >= _OUT_CHARS or len(rows) >= _OUT_ROWS:
            yield _batch(rows)
            rows, chars = [], 0
    yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 7
    long, string = pa.int64(), pa.string()
    types = (long, long, string, string, long, long, pa.bool_())
    names = ("conv_id", "seq", "role", "piece", "text_start", "text_end", "restart")
    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def format_conversations(
    turns: DataFrame,
    template: Template = marked_turns,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per turn: its conversation, place, role, rendered piece and the span of its text.

    The pieces of a conversation in order of ``seq`` are its formatted text; a row
    with ``restart`` starts it anew. That is so for conversations of any length; the
    turns of one are held by one task, and its text while it is rendered whole. Turns are
    ordered by number (nulls first), then role, then text, so ties and repeated rows have
    one order; repeated rows stay. A null role or text is empty. Conversation ids are
    integers, see ``columns.integer_id``. Rows without one are one conversation, as rows
    of any other id are. An empty table gives an empty result. Other columns are not
    read. Rows leave partitioned and sorted by conversation.
    """
    empty = F.lit("")
    ordered = turns.select(
        integer_id(turns, conv_id).alias("conv_id"),
        col(turn).alias("turn"),
        F.coalesce(col(role), empty).alias("role"),
        F.coalesce(col(text), empty).alias("text"),
    )
    ordered = ordered.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(partial(_render, template), FIELDS)


def loss_text(learned: str = "assistant") -> Column:
    """The part of a piece that is learned: the text of the given role's turns."""
    inside = F.substring("piece", F.col("text_start") + 1, F.col("text_end") - F.col("text_start"))
    return F.when(F.col("role") == learned, inside)
