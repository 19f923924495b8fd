"""Chat formatting: a role automaton checks the turn order, a declarative template writes the turns.

A conversation becomes one text and a list of segments; each segment says where it stands in the text and
whether it counts towards the loss. Control strings inside texts are escaped, and ``read_back`` undoes it. One
conversation is one training example, so its turns meet in one row; conversations are spread by hash.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import let


@dataclass(frozen=True)
class ChatTemplate:
    """How turns are written and which roles are learned. ``moves[state][role]`` is the next state."""

    start: str = "<|im_start|>"
    end: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    moves: dict = field(default_factory=lambda: {
        "begin": {"system": "told", "user": "asked"},
        "told": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    })
    accepting: tuple[str, ...] = ("answered",)


CHATML = ChatTemplate()


def escape(text: Column) -> Column:
    """A backslash becomes two, ``<|`` becomes ``<\\|``; no control string is left in the result."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    """As ``escape``; a line end is escaped too, as it ends the role."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def final_state(roles: Column, template: ChatTemplate = CHATML) -> Column:
    """The automaton's state after all roles; ``invalid`` after a move that the table lacks."""
    table = F.create_map(*[F.lit(x) for s, row in template.moves.items() for r, to in row.items() for x in (f"{s}>{r}", to)])
    return F.aggregate(roles, F.lit("begin"), lambda state, role: F.coalesce(
        F.try_element_at(table, F.concat(state, F.lit(">"), role)), F.lit("invalid")))


def format_chat(rows: DataFrame, template: ChatTemplate = CHATML) -> DataFrame:
    """``conv_id, formatted, segments, state, valid`` from rows of ``conv_id, turn, role, text``.

    ``segments``: array of (``start`` in code points from 0, ``length``, ``loss``), which covers the text without
    gaps: header, body and end of each turn; the loss flag is set on the bodies of learned roles. Turns are
    ordered by turn, then role and text (nulls first), so ties and repeated rows have one order; repeated rows
    are turns of their own. A null text or role is empty. A null conv_id is a conversation. Every conversation is
    formatted; ``valid`` says if the automaton accepts it. Other columns are not read. An empty table gives an
    empty table.
    """
    end = template.end
    role = F.coalesce(F.col("role"), F.lit(""))
    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = rows.select("conv_id", "turn", "role", "text").select(
        "conv_id", "turn", "role", "text", role.alias("who"),
        F.concat(F.lit(template.start), escape_role(role), F.lit("\n")).alias("head"),
        escape(F.coalesce(F.col("text"), F.lit(""))).alias("body"))
    size = F.length("head") + F.length("body") + F.lit(len(end)).cast("long")
    placed = turns.withColumn("start", F.coalesce(
        F.sum(size).over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")))
    convs = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("start", "who", "head", "body"))).alias("turns"))

    def pieces(t: Column) -> Column:
        head, body = F.length(t["head"]).cast("long"), F.length(t["body"]).cast("long")
        return F.array(
            F.struct(t["start"].alias("start"), head.alias("length"), F.lit(False).alias("loss")),
            F.struct((t["start"] + head).alias("start"), body.alias("length"),
                     t["who"].isin(*template.loss_roles).alias("loss")),
            F.struct((t["start"] + head + body).alias("start"), F.lit(len(end)).cast("long").alias("length"),
                     F.lit(False).alias("loss")))

    state = final_state(F.transform("turns", lambda t: t["who"]), template)
    return convs.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(end))), "").alias("formatted"),
        F.flatten(F.transform("turns", pieces)).alias("segments"),
        state.alias("state"),
        state.isin(*template.accepting).alias("valid"))


def read_back(formatted: Column, template: ChatTemplate = CHATML) -> Column:
    """The turns of a formatted text: array of (role, text), unescaped."""
    blocks = F.filter(F.split(formatted, r"\Q" + template.end + r"\E"), lambda b: b != "")

    def turn(block: Column) -> Column:
        def parts(b: Column) -> Column:
            return let(F.regexp_extract(b, r"^((?:[^\\\n]|\\[\s\S])*+)\n", 1), lambda role: F.struct(
                unescape(role).alias("role"),
                unescape(F.substring(b, F.length(role) + 2, F.length(b))).alias("text")))
        return let(F.substring(block, F.lit(len(template.start) + 1), F.length(block)), parts)

    return F.transform(blocks, turn)


def loss_text(formatted: Column, segments: Column) -> Column:
    """All text under the loss mask, unescaped, joined without a separator."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(
        F.substring(formatted, s["start"].cast("int") + 1, s["length"].cast("int")))), "")
