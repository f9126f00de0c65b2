"""Chat formatting: a finite-state machine over roles and a declarative template.

A template gives each role an opening string, whether its text carries loss,
and one closing string for all turns.  Control strings inside texts are escaped
(a backslash after their first character, backslashes doubled), so the output
parses back exactly.  DataFrame code only.

Defined results: a null text is empty and a null role is the empty role; a role
that the template does not know is written with the generic opening (its name
between the two ``other`` marks) and makes the conversation invalid; turns with
the same number are ordered by role and text; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    opening: dict = field(default_factory=lambda: {"system": "<<SYS>>", "user": "[INST]", "assistant": "[/INST]"})
    other: tuple = ("[ROLE]", "[/ROLE]")
    closing: str = "</s>"
    loss: tuple = ("assistant",)
    #: state -> {role: next state}; the machine starts in "start".
    moves: dict = field(default_factory=lambda: {
        "start": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"},
    })
    accepting: tuple = ("assistant",)

    def controls(self) -> list[str]:
        return [*self.opening.values(), *self.other, self.closing]


def escape(text: Column, t: Template) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in t.controls():
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _opening(role: Column, t: Template) -> Column:
    out = F.concat(F.lit(t.other[0]), escape(role, t), F.lit(t.other[1]))
    for name, mark in t.opening.items():
        out = F.when(role == name, F.lit(mark)).otherwise(out)
    return out


REJECT = "reject"


def _next(state: Column, role: Column, t: Template) -> Column:
    """The machine's move; from a state that knows no such role, and from ``reject``, to ``reject``."""
    out = F.lit(REJECT)
    for here, moves in t.moves.items():
        for name, there in moves.items():
            out = F.when((state == here) & (role == name), F.lit(there)).otherwise(out)
    return out


def states(roles: Column, t: Template) -> Column:
    """The machine's state after each turn."""
    def step(acc: Column, role: Column) -> Column:
        state = _next(acc["at"], role, t)
        return F.struct(state.alias("at"), F.concat(acc["all"], F.array(state)).alias("all"))

    begin = F.struct(F.lit("start").alias("at"), F.expr("cast(array() as array<string>)").alias("all"))
    return F.aggregate(roles, begin, step, lambda a: a["all"])


def format_chats(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation: conv_id, valid (the machine ends in an accepting state),
    n_rejected (turns from the first one that the machine has no move for) and segments
    array<struct<text, loss, state>> in output order, ``state`` being the machine's
    after the turn.  Rejected turns are written too, so that the text stays whole."""
    t = template
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    turn = F.struct("turn", "role", "text")
    per = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    per = per.withColumn("states", states(F.transform("turns", lambda x: x["role"]), t))

    def parts(x: Column, state: Column) -> Column:
        def segment(text: Column, loss: Column) -> Column:
            return F.struct(text.alias("text"), loss.alias("loss"), state.alias("state"))
        return F.array(segment(_opening(x["role"], t), F.lit(False)), segment(escape(x["text"], t), x["role"].isin(*t.loss)),
                       segment(F.lit(t.closing), F.lit(False)))

    return per.select("conv_id", F.element_at("states", -1).isin(*t.accepting).alias("valid"),
                      F.size(F.filter("states", lambda s: s == REJECT)).cast("long").alias("n_rejected"),
                      F.flatten(F.zip_with("turns", "states", parts)).alias("segments"))


def read_chats(formatted: Column, template: Template = Template()) -> Column:
    """The turns of a formatted text: array<struct<role, text>>, unescaped."""
    t = template

    def turn(body: Column) -> Column:
        role_end = F.locate(t.other[1], body)
        role = F.substr(body, F.lit(len(t.other[0]) + 1), role_end - 1 - len(t.other[0]))
        text = F.substr(body, role_end + len(t.other[1]))
        role, text = unescape(role), text
        for name, mark in t.opening.items():
            here = F.startswith(body, F.lit(mark))
            role = F.when(here, F.lit(name)).otherwise(role)
            text = F.when(here, F.substr(body, F.lit(len(mark) + 1))).otherwise(text)
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    closing = "".join(f"\\{c}" if not c.isalnum() else c for c in t.closing)
    bodies = F.split(formatted, closing, -1)
    return F.transform(F.slice(bodies, F.lit(1), F.size(bodies) - 1), turn)
