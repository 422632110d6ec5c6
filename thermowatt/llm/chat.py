"""Chat formatting, on built-in functions only.

A template says declaratively how a turn of each role is marked, which roles
count for the loss, and which role may follow which. A finite-state machine
over the roles of a conversation finds the first turn out of order; such a
conversation is still formatted, and marked. Control strings of the template
inside a text are escaped by one backslash after their first character (a text
that already has backslashes there gets one more), so the formatted string
can be read back exactly.

Defined results: null texts and roles count as empty; a role without marks of
its own is written out between the marks for other roles. Turns are ordered by
number, null last, ties by role and text. Rows with a null ``conv_id`` form
one conversation. Extra columns are ignored. A conversation becomes one string
in one row, as its output asks for; escaping and marking run before the
rows are brought together.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """``marks``: role -> (opening, closing); ``other``: opening, between role and text, closing for all other roles."""

    marks: dict[str, tuple[str, str]] = field(default_factory=lambda: {
        "system": ("<<SYS>>", "<</SYS>>"),
        "user": ("[INST]", "[/INST]"),
        "assistant": ("<s>", "</s>"),
    })
    other: tuple[str, str, str] = ("<<ROLE>>", "<</ROLE>>", "<</TEXT>>")
    loss_roles: tuple[str, ...] = ("assistant",)
    #: (state, role) -> state. A state is the role last seen.
    moves: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "system",
        ("start", "user"): "user",
        ("system", "user"): "user",
        ("user", "assistant"): "assistant",
        ("assistant", "user"): "user",
    })
    last_states: tuple[str, ...] = ("assistant",)

    def controls(self) -> str:
        """Pattern of all control strings: (first character)(backslashes)(rest)."""
        strings = [s for pair in self.marks.values() for s in pair] + list(self.other)
        firsts = sorted({s[0] for s in strings})
        rests = sorted({s[1:] for s in strings}, key=lambda s: (-len(s), s))
        return f"([{''.join(map(re.escape, firsts))}])(\\\\*)({'|'.join(map(re.escape, rests))})"


def escaped(text: Column, template: ChatTemplate) -> Column:
    return F.regexp_replace(text, template.controls(), r"$1\\$2$3")


def unescaped(text: Column, template: ChatTemplate) -> Column:
    return F.regexp_replace(text, template.controls().replace(r"(\\*)", r"\\(\\*)"), r"$1$2$3")


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def _turn_segments(template: ChatTemplate) -> Column:
    """Segments of one row: what opens the turn, its text, what closes it."""
    off, text = F.lit(False), escaped(F.col("text"), template)
    loss = F.col("role").isin(*template.loss_roles)
    before, between, after = template.other
    opening = F.concat(F.lit(before), escaped(F.col("role"), template), F.lit(between))
    closing = F.lit(after)
    for role, (start, end) in template.marks.items():
        opening = F.when(F.col("role") == role, F.lit(start)).otherwise(opening)
        closing = F.when(F.col("role") == role, F.lit(end)).otherwise(closing)
    return F.array(_segment(opening, off), _segment(text, loss), _segment(closing, off))


def _first_bad(roles: Column, template: ChatTemplate) -> Column:
    """Index of the first turn out of order, the number of turns if it ends too early, null if all is well."""
    moves = F.create_map(*[F.lit(x) for (state, role), to in template.moves.items() for x in (f"{state}|{role}", to)])

    def step(acc: Column, role: Column) -> Column:
        to = moves[F.concat_ws("|", acc["state"], role)]
        stuck = acc["bad"].isNotNull() | to.isNull()
        return F.struct(
            F.when(stuck, acc["state"]).otherwise(to).alias("state"),
            F.when(stuck, F.coalesce(acc["bad"], acc["at"])).alias("bad"),
            (acc["at"] + 1).alias("at"),
        )

    start = F.struct(F.lit("start").alias("state"), F.lit(None).cast("int").alias("bad"), F.lit(0).alias("at"))
    end = F.aggregate(roles, start, step)
    return F.coalesce(end["bad"], F.when(~end["state"].isin(*template.last_states), end["at"]))


def format_chats(conversations: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """One row per conversation: conv_id, segments array<struct<text, loss>>, formatted, bad_turn."""
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = [F.col("turn").isNull().alias("no_turn"), F.col("turn"), F.col("role"), F.col("text")]
    turns = rows.select("conv_id", F.struct(*order, _turn_segments(template).alias("segments")).alias("t"))
    joined = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "t.no_turn", "t.turn", "t.role", "t.text", "t.segments"
    ))).alias("turns"))
    return joined.select(
        "conv_id",
        F.flatten(F.transform("turns", lambda t: t["segments"])).alias("segments"),
        _first_bad(F.transform("turns", lambda t: t["role"]), template).alias("bad_turn"),
    ).select(
        "conv_id", "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "bad_turn",
    )


def read_turns(formatted: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """array<struct<role, text>> of a formatted string."""
    before, between, after = template.other
    pairs = [(role, *marks) for role, marks in template.marks.items()]
    either = "|".join(f"{re.escape(a)}.*?{re.escape(b)}" for a, b in [m[1:] for m in pairs] + [(before, after)])
    found = F.regexp_extract_all(formatted, F.lit(f"(?s)(?:{either})"), F.lit(0))

    def turn(raw: Column) -> Column:
        head = F.instr(raw, between)
        role = unescaped(F.substring(raw, F.lit(len(before) + 1), head - len(before) - 1), template)
        body_from, body_to = head + len(between), F.length(raw) - len(after)
        for name, start, end in pairs:
            own = raw.startswith(start)
            role = F.when(own, F.lit(name)).otherwise(role)
            body_from = F.when(own, F.lit(len(start) + 1)).otherwise(body_from)
            body_to = F.when(own, F.length(raw) - len(end)).otherwise(body_to)
        text = unescaped(F.substring(raw, body_from, body_to - body_from + 1), template)
        return F.struct(role.alias("role"), text.alias("text"))

    return F.transform(found, turn)


def chat_digests(formatted: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """Digests of what can be read back from the output of ``format_chats``."""
    loss = F.array_join(F.transform(
        F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"], template)
    ), "")
    read = formatted.select("conv_id", read_turns(F.col("formatted"), template).alias("turns"), loss.alias("loss"), "formatted", "bad_turn")
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.col("bad_turn").isNull().alias("in_order"),
    )
