"""Chat formatting with DataFrame functions only.

A declarative ``Template`` gives the control strings, which roles carry loss, and a finite-state machine over roles.
``format_chats`` folds the machine over a conversation's turns and emits text segments with a loss flag each; their
concatenation is the formatted text.  Control strings inside of texts and roles are escaped: a backslash goes behind the
first character of each, and backslashes double, so ``parse_chats`` gets back exactly what went in.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    begin: str = "<s>"
    turn_open: str = "<|im_start|>"
    turn_text: str = "<|im_sep|>"
    turn_close: str = "<|im_end|>"
    end: str = "</s>"
    reserved: tuple[str, ...] = ("[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    accept: tuple[str, ...] = ("answered",)
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {("start", "system"): "ready", ("start", "user"): "asked", ("ready", "user"): "asked", ("asked", "assistant"): "answered", ("answered", "user"): "asked"}
    )

    @property
    def controls(self) -> list[str]:
        return [self.begin, self.turn_open, self.turn_text, self.turn_close, self.end, *self.reserved]

    def check(self) -> None:
        if any(len(c) < 2 or "\\" in c for c in self.controls):
            raise ValueError("control strings need two characters or more and no backslash")


FAILED = "failed"


def escape(text: Column, template: Template) -> Column:
    """``text`` without any control string; undone by ``unescape``."""
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    first: dict[str, list[str]] = {}
    for c in template.controls:
        first.setdefault(c[0], []).append(c[1:])
    pattern = "|".join(f"{re.escape(a)}(?=" + "|".join(re.escape(x) for x in sorted(set(rest))) + ")" for a, rest in sorted(first.items()))
    return F.regexp_replace(doubled, f"({pattern})", r"$1\\")


def unescape(text: Column) -> Column:
    """Drop one backslash of each pair or single one."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _walk(roles: Column, template: Template) -> Column:
    """Struct (state, bad): the machine's state after all roles, and the number of the first turn it could not take (from 0)."""
    table = F.create_map(*[F.lit(x) for (state, role), to in template.moves.items() for x in (f"{state}\n{role}", to)])
    begin = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("bad"))

    def step(acc: Column, role: Column) -> Column:
        to = F.try_element_at(table, F.concat(acc["state"], F.lit("\n"), role))
        to = F.when(acc["state"] == FAILED, F.lit(None)).otherwise(to)
        bad = F.when(to.isNull(), F.coalesce(acc["bad"], acc["at"])).otherwise(acc["bad"])
        return F.struct(F.coalesce(to, F.lit(FAILED)).alias("state"), (acc["at"] + 1).alias("at"), bad.cast("int").alias("bad"))

    return F.aggregate(roles, begin, step)


def format_chats(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """One row per conversation: conv_id, valid, end_state, bad_turn, segments (text, loss), formatted.

    ``turns``: conv_id, turn, role, text, one row per turn; further columns are not used.  Turns stand in the order of turn, then role,
    then text (null turns first), so rows that repeat stay in a fixed order.  A null role or text is empty.
    Turns with a null conv_id form one conversation of their own.  A conversation that breaks the
    machine's order, or ends outside of its accepting states, is formatted all the same, with valid = false.  An empty
    table gives no rows.  A conversation is one output row, so it is gathered in one task.
    """
    template = template or Template()
    template.check()
    rows = turns.select(
        "conv_id", F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("t")
    )
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))

    def of_turn(t: Column) -> Column:
        loss = t["role"].isin(*template.loss_roles)
        return F.array(
            segment(F.concat(F.lit(template.turn_open), escape(t["role"], template), F.lit(template.turn_text)), F.lit(False)),
            segment(escape(t["text"], template), loss),
            segment(F.lit(template.turn_close), F.lit(False)),
        )

    head, tail = F.array(segment(F.lit(template.begin), F.lit(False))), F.array(segment(F.lit(template.end), F.lit(False)))
    segments = F.concat(head, F.flatten(F.transform("turns", of_turn)), tail)
    walked = chats.withColumn("walk", _walk(F.transform("turns", lambda t: t["role"]), template)).withColumn("segments", segments)
    return walked.select(
        "conv_id",
        F.col("walk.state").isin(*template.accept).alias("valid"),
        F.col("walk.state").alias("end_state"),
        F.col("walk.bad").alias("bad_turn"),
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
    )


def parse_chats(chats: DataFrame, template: Template | None = None) -> DataFrame:
    """``chats`` with ``turns`` (role, text) read back from its column ``formatted``."""
    template = template or Template()
    cut = F.split("formatted", re.escape(template.turn_open), -1)
    pieces = F.slice(cut, F.lit(2), F.greatest(F.size(cut) - 1, F.lit(0)))

    def turn(piece: Column) -> Column:
        both = F.split(F.substring_index(piece, template.turn_close, 1), re.escape(template.turn_text), 2)
        return F.struct(unescape(both[0]).alias("role"), unescape(both[1]).alias("text"))

    return chats.withColumn("turns", F.transform(pieces, turn))


def digests(chats: DataFrame, template: Template | None = None) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid, end_state of formatted chats, all read back."""
    parsed = parse_chats(chats, template)
    line = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    return parsed.withColumn("__loss", loss).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(line, 256).alias("turns_sha256"),
        F.length("__loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("__loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        "end_state",
    )
