"""Chat formatting: a finite-state machine over roles and a declarative template.

``Template`` declares the marker of each role, the end mark, which roles are trained on, and the
machine: for each state (the role of the turn before, or ``start``) the roles that may come next, and
the states a conversation may end in. ``segments`` runs the machine over each conversation's turns and
emits text segments with a loss flag each; ``read_back`` reads conversations from segments alone.

Control strings inside texts are escaped: the escape character goes before each control string and
before each escape character. A control string is a mark only where no escape character stands before
it, so reading is the exact inverse for any text, also one that holds markers or escapes itself.

Order: turns by (turn, role, escaped text), nulls first; so ties and repeated rows have a defined place, and the
machine marks a turn number that does not grow as out of order. Null text or role: empty. A role that the
template doesn't know gets the generic marker with its escaped name, no loss, and is out of order. Rows
with a null conversation id form one conversation. An empty table gives no segments. Other columns are
not read.

Conversations are dealt out by id and sorted on disk by Spark; the machine streams over the sorted rows
and holds one turn at a time, so a conversation of any length needs no more memory. Texts are escaped
before the shuffle, in the tasks that read them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.llm.frames import arrow_map, partitions


@dataclass(frozen=True)
class Template:
    """Markers, loss roles and turn order of a chat format."""

    markers: dict[str, str] = field(default_factory=lambda: {
        "system": "### System:", "user": "### User:", "assistant": "### Assistant:"})
    #: Opens a turn of a role without a marker; its escaped name and ``named`` follow.
    other: str = "### Role:"
    named: str = "</role>"
    end: str = "</turn>"
    escape: str = "\\"
    loss: frozenset[str] = frozenset({"assistant"})
    #: State -> roles that may come next; the state is the role before, at first ``start``.
    turns: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple[str, ...] = ("assistant",)

    def controls(self) -> list[str]:
        """The control strings, longest first."""
        return sorted({*self.markers.values(), self.other, self.named, self.end}, key=lambda c: (-len(c), c))

    def escaped(self, text: str) -> str:
        pattern = "|".join(map(re.escape, [self.escape, *self.controls()]))
        return re.sub(pattern, lambda m: self.escape + m[0], text)

    def marks(self) -> re.Pattern:
        """What a reader meets: an escaped control string or escape character, or a mark."""
        controls = "|".join(map(re.escape, self.controls()))
        esc = re.escape(self.escape)
        return re.compile(f"{esc}(?P<plain>{esc}|{controls})|(?P<mark>{controls})")


SEGMENTS = "conv_id {}, segment long, text string, loss boolean, in_order boolean"


def _escape(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(0), batch.column(1)]
            for k in (2, 3):
                cols.append(pa.array([template.escaped(t or "") for t in batch.column(k).to_pylist()], pa.string()))
            yield pa.RecordBatch.from_arrays([*cols, batch.column(2)], names=["conv_id", "turn", "name", "body", "role"])

    return run


def _machine(template: Template):
    by_role = template.markers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, before, n = object(), "start", None, 0
        for batch in batches:
            ids, number, text, loss, good = [], [], [], [], []
            for conv, turn, name, body, role in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if conv != at:
                    at, state, before, n = conv, "start", None, 0
                role = role or ""
                ok = role in template.turns.get(state, ()) and turn is not None and (before is None or turn > before)
                state, before = role, turn
                mark = by_role[role] if role in by_role else f"{template.other}{name}{template.named}"
                for part, counts in ((mark + " ", False), (body, role in template.loss), (template.end + "\n", False)):
                    ids.append(conv)
                    number.append(n)
                    text.append(part)
                    loss.append(counts)
                    good.append(ok)
                    n += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.schema.field(0).type), pa.array(number, pa.int64()), pa.array(text, pa.string()),
                 pa.array(loss, pa.bool_()), pa.array(good, pa.bool_())],
                names=["conv_id", "segment", "text", "loss", "in_order"])

    return run


def segments(turns: DataFrame, template: Template | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
             role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Text segments of all conversations: conv_id, segment (0, 1, ... in order), text, loss, in_order.

    A conversation's formatted text is its segments' texts one after another; ``loss`` says whether a
    segment is trained on, ``in_order`` whether the machine accepts the turn it belongs to. The rows of a
    conversation lie in one partition, in order.
    """
    template = template or Template()
    kind = turns.schema[conv_col].dataType.simpleString()
    rows = turns.select(
        F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.col(f"`{role_col}`").cast("string").alias("role"), F.col(f"`{text_col}`").cast("string").alias("body"))
    plain = arrow_map(rows, _escape(template), f"conv_id {kind}, turn long, name string, body string, role string")
    dealt = plain.repartition(partitions(turns), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "body")
    return arrow_map(dealt, _machine(template), SEGMENTS.format(kind))


def _read(template: Template):
    marks = template.marks()
    role_of = {m: r for r, m in template.markers.items()}

    class Reader:
        """One conversation, read segment by segment."""

        def __init__(self) -> None:
            self.turns, self.chars, self.loss_chars, self.good = 0, 0, 0, True
            self.all, self.loss = hashlib.sha256(), hashlib.sha256()
            self.role, self.parts, self.naming, self.last = None, [], False, "start"

        def take(self, text: str, loss: bool, good: bool) -> None:
            self.chars += len(text)
            self.good &= bool(good)
            at = 0
            for m in marks.finditer(text):
                self.keep(text[at:m.start()], loss)
                at = m.end()
                if m["plain"] is not None:
                    self.keep(m["plain"], loss)
                elif m["mark"] == template.end:
                    self.close()
                elif m["mark"] == template.named:
                    self.role, self.parts, self.naming = "".join(self.parts), [], False
                else:
                    self.naming, self.parts = m["mark"] == template.other, []
                    self.role = role_of.get(m["mark"])
            self.keep(text[at:], loss)

        def keep(self, text: str, loss: bool) -> None:
            if loss:
                self.loss_chars += len(text)
                self.loss.update(text.encode())
            self.parts.append(text)

        def close(self) -> None:
            # Between marker and text stands one space; after the end mark a line break, which no turn owns.
            text = "".join(self.parts)[1:]
            self.all.update(f"{self.role}\n{text}\n".encode())
            self.turns += 1
            self.last, self.parts = self.role, []

        def row(self) -> tuple:
            valid = self.good and self.last in template.final
            return (self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, valid)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, reader, kind = None, None, None

        def out(done: list) -> pa.RecordBatch:
            cols = list(zip(*done, strict=True))
            types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

        for batch in batches:
            kind, done = batch.schema.field(0).type, []
            for conv, _, text, loss, good in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if reader is None or conv != at:
                    if reader is not None:
                        done.append((at, *reader.row()))
                    at, reader = conv, Reader()
                reader.take(text, loss, good)
            if done:
                yield out(done)
        if reader is not None:
            yield out([(at, *reader.row())])

    return run


def read_back(parts: DataFrame, template: Template | None = None, dealt: bool = False) -> DataFrame:
    """Conversations as read from their segments alone, one row each.

    n_turns; turns_sha256 over role, line break, text, line break of each turn; loss_chars and loss_sha256
    of the unescaped text under the loss mask; formatted_chars; valid (all turns in order, and the last
    role may end a conversation). ``dealt``: the rows come straight from ``segments``, so they lie in order.
    """
    template = template or Template()
    kind = parts.schema["conv_id"].dataType.simpleString()
    rows = parts.select("conv_id", "segment", "text", "loss", "in_order")
    if not dealt:
        rows = rows.repartition(partitions(parts), "conv_id").sortWithinPartitions("conv_id", "segment")
    return arrow_map(rows, _read(template), f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                                            "loss_sha256 string, formatted_chars long, valid boolean")
