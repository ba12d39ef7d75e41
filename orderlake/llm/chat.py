"""Chat formatting: a finite-state machine over roles and segments with loss flags.

A declarative template names the turn marks, the escapes and, for every role, whether its text is
trained on and which roles may follow. ``format_chats`` makes one row a conversation: the segments
in order, each with its loss flag, the formatted text, the spans under the loss mask, and what the
machine says of the order of turns. All of it is built-in Spark expressions.

Texts can't break out of their turn: the marks are made of ``<`` and ``>``, which never occur in
an escaped text, and the escapes (``\\b`` for a backslash, ``\\l`` for ``<``, ``\\g`` for ``>``) are
undone exactly by ``unescape``.

A conversation is one row of the output, so its turns meet in one task by definition. Edge cases:
turns are ordered by turn, then role, then text (nulls first); repeated rows are turns of their own; a null
text or role is empty; a null conversation id is a conversation like any other. A conversation in
an order that the machine does not know is formatted all the same, with ``valid`` false. An
unknown role is written as it is, without loss. An empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks: ``open + role + mid + text + close`` a turn. Every mark begins with < or ends with >."""

    open: str = "<turn "
    mid: str = ">"
    close: str = "</turn>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: state -> roles that may come next; a state is the role of the last turn.
    follow: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple[str, ...] = ("assistant",)


ESCAPES = [("\\", "\\b"), ("<", "\\l"), (">", "\\g")]


def escape(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def _machine(roles: Column, t: Template) -> Column:
    """The state after the last turn; null once a turn came out of order."""
    steps = F.create_map(*[x for s, nexts in t.follow.items() for r in nexts
                           for x in (F.lit(f"{s}>{r}"), F.lit(r))])
    return F.aggregate(roles, F.lit("start"),
                       lambda state, role: F.element_at(steps, F.concat(state, F.lit(">"), role)))


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", template: Template = Template()) -> DataFrame:
    """conv_id, segments (text, loss), formatted, loss_spans (start, length: code points), valid."""
    t = template
    cols = {"conv_id": F.col(conv), "turn": F.col(turn), "role": F.coalesce(F.col(role).cast("string"), F.lit("")),
            "text": F.coalesce(F.col(text).cast("string"), F.lit(""))}
    rows = turns.select(*[c.alias(n) for n, c in cols.items()])
    head = F.concat(F.lit(t.open), escape(F.col("role")), F.lit(t.mid))
    body = escape(F.col("text"))
    width = (F.length(head) + F.length(body) + F.lit(len(t.close))).cast("long")
    # Where each text starts: lengths of the turns before it, plus its own head.
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.sum(width).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - width
    placed = rows.withColumn("start", before + F.length(head))
    one = F.struct("turn", "role", "text", "start")
    chats = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("turns"))
    masked = lambda x: x["role"].isin(*t.loss_roles)
    segments = F.flatten(F.transform("turns", lambda x: F.array(
        F.struct(F.concat(F.lit(t.open), escape(x["role"]), F.lit(t.mid)).alias("text"), F.lit(False).alias("loss")),
        F.struct(escape(x["text"]).alias("text"), masked(x).alias("loss")),
        F.struct(F.lit(t.close).alias("text"), F.lit(False).alias("loss")))))
    spans = F.transform(F.filter("turns", masked), lambda x: F.struct(
        x["start"].alias("start"), F.length(escape(x["text"])).cast("long").alias("length")))
    last = _machine(F.transform("turns", lambda x: x["role"]), t)
    return (chats.withColumns({"valid": F.coalesce(last.isin(*t.final), F.lit(False)), "segments": segments,
                               "loss_spans": spans})
            .select("conv_id", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
                    "loss_spans", "valid"))


def read_back(chats: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, formatted, valid, turns (role, text: parsed from ``formatted``), loss_text (from the
    segments under the loss mask)."""
    t = template
    parts = F.split("formatted", F.lit(t.close))  # the part after the last close is empty
    turns = F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda p: F.struct(
        unescape(F.substring(F.substring_index(p, t.mid, 1), F.lit(len(t.open) + 1), F.length(p))).alias("role"),
        unescape(F.substring(p, F.instr(p, t.mid) + F.lit(len(t.mid)), F.length(p))).alias("text")))
    masked = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    return chats.select("conv_id", "formatted", "valid", turns.alias("turns"), F.array_join(masked, "").alias("loss_text"))
