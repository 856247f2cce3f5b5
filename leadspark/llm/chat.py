r"""Chat formatting by a declarative template and a finite-state machine over roles.

A template names the strings around a turn, the roles that are trained on, and the machine:
which role may follow in which state, and in which states a conversation may end. The
machine reads a conversation's roles in one fold and tells the first turn out of order.
Every conversation is put out, legal or not, as segments of text, each with its loss flag.

Control strings inside roles and texts are escaped: an escape sign is doubled, and one is
put behind the first sign of every control string. As control strings hold no escape sign
and cannot overlap themselves, none is left in an escaped text, and reading back is a split
at the control strings; then a sign behind an escape sign stands for itself.

One conversation is one training text, and so one row: its rows meet in one task, in which
they take about the memory of the text itself. What a text of that length cannot be (2 GB)
no conversation can be. Everything is column expressions and one grouping.

Edge cases: NULL texts and roles are empty; NULL turns come first, and rows of one turn are
ordered by role and text; rows with a NULL id are one conversation; repeated rows are turns
of their own; a conversation without turns is none; an empty table gives none. Only the four
columns asked for are read, so that others may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START = "start"


def _dialogue() -> dict[str, dict[str, str]]:
    return {
        START: {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"},
    }


@dataclass(frozen=True)
class Template:
    """A turn is `before`, role, `between`, text, `after`.

    `moves` has for each state the roles that may come and the states they lead to; `ends`
    are the states a conversation may end in.
    """

    before: str = "### "
    between: str = ": "
    after: str = "</turn>\n"
    escape: str = "\\"
    trained: tuple[str, ...] = ("assistant",)
    moves: Mapping[str, Mapping[str, str]] = field(default_factory=_dialogue)
    ends: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        if len(self.escape) != 1:
            raise ValueError("the escape is one sign")
        for control in self.controls:
            overlaps = any(control[:n] == control[-n:] for n in range(1, len(control)))
            if len(control) < 2 or self.escape in control or overlaps:
                raise ValueError(f"not a control string: {control!r}")
        if set(self.after) & set(self.between) or self.between in self.before:
            raise ValueError("the strings of a turn cannot be told apart")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.before, self.between, self.after)


def _literal(text: str) -> str:
    """A pattern for a text; signs that mean nothing to patterns stay as they are."""
    return re.sub(r"([^\w\s])", r"\\\1", text)


def escaped(text: Column, template: Template) -> Column:
    sign = template.escape
    put = f"\\{sign}" if sign in "\\$" else sign  # a replacement gives these two a meaning
    out = F.regexp_replace(text, _literal(sign), put + put)
    for control in template.controls:
        pattern = f"({_literal(control[0])})(?={_literal(control[1:])})"
        out = F.regexp_replace(out, pattern, f"$1{put}")
    return out


def unescaped(text: Column, template: Template) -> Column:
    return F.regexp_replace(text, f"(?s){_literal(template.escape)}(.)", "$1")


def _checked(roles: Column, template: Template) -> Column:
    """(state, at, fault): the machine's last state, and the first turn that has no move."""
    moves = [
        x
        for state, found in template.moves.items()
        for role, onward in found.items()
        for x in (F.struct(F.lit(state).alias("state"), F.lit(role).alias("role")), F.lit(onward))
    ]
    table = F.create_map(*moves)
    begin = F.struct(F.lit(START).alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("fault"))

    def onward(held: Column, role: Column) -> Column:
        move = F.try_element_at(table, F.struct(held["state"].alias("state"), role.alias("role")))
        fault = F.coalesce(held["fault"], F.when(move.isNull(), held["at"]))
        return F.struct(
            F.coalesce(move, held["state"]).alias("state"), (held["at"] + 1).alias("at"), fault.alias("fault")
        )

    return F.aggregate(roles, begin, onward)


def formatted(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """(conv_id, text, segments, valid, fault): conversations as training texts.

    `segments` has (text, loss) in order and makes up `text`; `fault` is the first turn out
    of order, counted from 0, or NULL where turns are in order; `valid` also asks for a
    legal end.
    """
    template = template or Template()
    empty = {c: F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")}
    turns = conversations.select("conv_id", F.struct("turn", *empty.values()).alias("turn"))
    turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))

    def segments(turn: Column) -> Column:
        head = F.concat(F.lit(template.before), escaped(turn["role"], template), F.lit(template.between))
        parts = (
            (head, F.lit(False)),
            (escaped(turn["text"], template), turn["role"].isin(*template.trained)),
            (F.lit(template.after), F.lit(False)),
        )
        return F.array(*(F.struct(text.alias("text"), loss.alias("loss")) for text, loss in parts))

    made = turns.select(
        "conv_id",
        F.flatten(F.transform("turns", segments)).alias("segments"),
        _checked(F.transform("turns", lambda turn: turn["role"]), template).alias("end"),
    )
    return made.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda x: x["text"]), "").alias("text"),
        "segments",
        (F.col("end.fault").isNull() & F.col("end.state").isin(*template.ends)).alias("valid"),
        F.col("end.fault").alias("fault"),
    )


def turns_of(text: Column, template: Template | None = None) -> Column:
    """Array of (role, text), read back from a formatted text."""
    template = template or Template()
    pieces = F.split(text, _literal(template.after), -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)  # nothing follows the last turn
    head = len(template.before)

    def turn(piece: Column) -> Column:
        at = F.locate(template.between, piece, head + 1)
        role = F.substring(piece, F.lit(head + 1), at - F.lit(head + 1))
        rest = F.substring(piece, at + F.lit(len(template.between)), F.length(piece))
        return F.struct(unescaped(role, template).alias("role"), unescaped(rest, template).alias("text"))

    return F.transform(pieces, turn)


def trained_text(segments: Column, template: Template | None = None) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    template = template or Template()
    under = F.filter(segments, lambda x: x["loss"])
    return F.array_join(F.transform(under, lambda x: unescaped(x["text"], template)), "")
