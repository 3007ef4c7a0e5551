"""Chat formatting: a role machine, a declarative template, segments with loss flags, and reading back."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType


@dataclass(frozen=True)
class Mark:
    """What stands before and after the text of a role, and whether the text counts in the loss."""

    opening: str
    closing: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """A chat format as data. Every opening ends with a space and every closing begins with one.

    ``other`` holds the marks of roles without an own entry: opening, border between role and text, closing.
    ``moves`` are the allowed steps of the role machine from each state; ``""`` is the start.
    """

    roles: dict[str, Mark] = field(default_factory=lambda: {
        "system": Mark("<<SYS>> ", " <</SYS>>"),
        "user": Mark("[INST] ", " [/INST]"),
        "assistant": Mark("<s> ", " </s>", True),
    })
    other: tuple[str, str, str] = ("[ROLE] ", " [TEXT] ", " [/ROLE]")
    moves: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",),
    })
    final: tuple[str, ...] = ("assistant",)

    def controls(self) -> list[str]:
        marks = [x.strip() for m in self.roles.values() for x in (m.opening, m.closing)] + [x.strip() for x in self.other]
        return sorted(set(marks), key=len, reverse=True)


DEFAULT = Template()


class Formatter:
    """Writes and reads single turns. A control string inside a text gets a backslash before it, and loses it again.

    Texts never touch a control string of the template (a space stands between), so a control string with a
    backslash before it belongs to a text and one without belongs to the template.
    """

    def __init__(self, template: Template):
        self.template = template
        control = "|".join(map(regex.escape, template.controls()))
        self.control, self.escaped = regex.compile(control), regex.compile(rf"\\(?={control})")
        self.openings = {m.opening: r for r, m in template.roles.items()}
        self.opening = regex.compile("|".join(map(regex.escape, [*self.openings, template.other[0]])))

    def escape(self, text: str) -> str:
        return self.control.sub(r"\\\g<0>", text)

    def unescape(self, text: str) -> str:
        return self.escaped.sub("", text)

    def write(self, role: str, text: str) -> list[tuple[str, bool]]:
        """The segments of a turn: opening, text, closing."""
        mark = self.template.roles.get(role)
        if mark is None:
            opening, border, closing = self.template.other
            mark = Mark(f"{opening}{self.escape(role)}{border}", closing)
        return [(mark.opening, False), (self.escape(text), mark.loss), (mark.closing, False)]

    def read(self, turn: str) -> tuple[str, str]:
        """Role and text of a formatted turn."""
        opening = self.opening.match(turn).group()
        role = self.openings.get(opening)
        if role is not None:
            return role, self.unescape(turn[len(opening) : len(turn) - len(self.template.roles[role].closing)])
        _, border, closing = self.template.other
        # The first border without a backslash before it; the role is escaped.
        cut = next(m for m in regex.finditer(rf"(?<!\\){regex.escape(border.strip())}", turn) if m.start() >= len(opening)).start() - 1
        return self.unescape(turn[len(opening) : cut]), self.unescape(turn[cut + len(border) : len(turn) - len(closing)])


SEGMENTS = "array<struct<text:string,loss:boolean>>"


def _ordered(df: DataFrame, conv: str, turn: str) -> DataFrame:
    """Rows of a conversation side by side, in order of turns; equal turns by role and text."""
    return df.repartition(F.col(conv)).sortWithinPartitions(conv, turn, "__role", "__text")


def format_turns(df: DataFrame, template: Template = DEFAULT, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each turn, in order: ``conv_id, turn, allowed, segments``.

    ``segments`` are the pieces of formatted text with their loss flags; joined over a conversation they are its
    formatted text. ``allowed`` says whether the role machine takes this turn after the one before it; a turn it does not
    take is formatted all the same and the machine goes on from its role, so no row is lost. Roles without marks in the
    template get the template's general marks. A null role or text is empty; null turns come first; equal turns are
    ordered by role and text; repeated rows are turns of their own; rows with a null conversation form one conversation.
    Other columns are dropped. Rows stream through sorted partitions, so a conversation of any length needs
    the memory of one batch.
    """
    rows = _ordered(df.select(df[conv].alias("conv_id"), df[turn].alias("turn"), F.coalesce(df[role], F.lit("")).alias("__role"), F.coalesce(df[text], F.lit("")).alias("__text")), "conv_id", "turn")
    out = StructType([rows.schema["conv_id"], rows.schema["turn"], *StructType.fromDDL(f"allowed boolean, segments {SEGMENTS}")])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, conv_now, state = Formatter(template), object(), ""
        for batch in batches:
            allowed, segments = [], []
            for conv_id, role_, text_ in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if conv_id != conv_now:
                    conv_now, state = conv_id, ""
                allowed.append(role_ in template.moves.get(state, ()))
                segments.append([{"text": s, "loss": loss} for s, loss in tool.write(role_, text_)])
                state = role_
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(allowed, pa.bool_()), pa.array(segments, arrow.field("segments").type)], schema=arrow)

    return rows.mapInArrow(run, out)


READ = "turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"


def read_back(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Reads the output of :func:`format_turns` and gives one row for each conversation.

    ``n_turns``; ``turns_sha256`` of role, line break, text, line break for each turn; ``loss_chars`` and ``loss_sha256``
    of all text under the loss mask with escapes undone; ``formatted_chars`` of all segments; ``valid``: the machine
    took every turn and ended in a final state. Must follow ``format_turns`` directly, whose order it relies on. No rows
    give no rows; a conversation's digests are kept as running hashes, never as text.
    """
    kind = formatted.schema["conv_id"]
    out = StructType([kind, StructField("n_turns", LongType()), *StructType.fromDDL(READ)])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, open_, conv_now = Formatter(template), None, None
        done: list[tuple] = []

        def close():
            n, turns, loss_n, loss, chars, valid, last = open_
            done.append((conv_now, n, turns.hexdigest(), loss_n, loss.hexdigest(), chars, valid and last in template.final))

        for batch in batches:
            for conv_id, allowed, segments in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if open_ is None or conv_id != conv_now:
                    if open_ is not None:
                        close()
                    conv_now, open_ = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, True, ""]
                whole = "".join(s["text"] for s in segments)
                role, text = tool.read(whole)
                open_[0] += 1
                open_[1].update(f"{role}\n{text}\n".encode())
                masked = tool.unescape("".join(s["text"] for s in segments if s["loss"]))
                open_[2] += len(masked)
                open_[3].update(masked.encode())
                open_[4] += len(whole)
                open_[5] = open_[5] and allowed
                open_[6] = role
            if len(done) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), arrow)], schema=arrow)
                done.clear()
        if open_ is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), arrow)], schema=arrow)

    return formatted.mapInArrow(run, out)
