"""Chat formatting by a declarative template: a finite-state machine over roles checks the turn order,
and each turn becomes text segments with a loss flag.  Only DataFrame expressions.

Control strings inside texts are escaped and come back exactly: a backslash is doubled, then ``<|``
becomes ``<\\|``; in a role a line feed becomes ``\\n`` too.

Defined results: rows are ordered by turn (null first), then role, then text; a null text or role is
empty; rows repeated whole are turns of their own; an invalid order is formatted too and flagged.
texts of any length are formatted whole; an empty table gives no rows; only the four named columns are read, so
other columns may have any names.  A conversation's output is one string, so one task holds one conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHATML = {
    "start": "<|im_start|>",
    "end": "<|im_end|>",
    # segments of a turn, in order: (text, whether the loss covers it where the role has loss)
    "segments": [("{start}{role}\n", False), ("{text}", True), ("{end}\n", False)],
    "loss_roles": ["assistant"],
    "initial": "begin",
    "transitions": {
        "begin": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"},
    },
    "accepting": ["assistant"],
}


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    # an odd run of backslashes before n: the last one and the n stand for a line feed
    return unescape(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def _filled(pattern: str, template: dict, role: Column, text: Column) -> Column:
    parts: list[Column] = []
    rest = pattern
    while rest:
        head, brace, tail = rest.partition("{")
        if head:
            parts.append(F.lit(head))
        if not brace:
            break
        name, _, rest = tail.partition("}")
        parts.append({"role": escape_role(role), "text": escape(text)}[name] if name in ("role", "text")
                     else F.lit(template[name]))
    return F.concat(*parts)


def end_state(turns: Column, template: dict = CHATML) -> Column:
    """The machine's state after all turns; ``error`` once a role has no transition."""
    table = F.create_map(*[F.lit(x) for s, to in template["transitions"].items()
                           for r, t in to.items() for x in (f"{s}>{r}", t)])
    step = lambda s, x: F.coalesce(F.try_element_at(table, F.concat(s, F.lit(">"), x["role"])), F.lit("error"))
    return F.aggregate(turns, F.lit(template["initial"]), step)


def format_conversations(rows: DataFrame, template: dict = CHATML, id_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, n_turns, valid, state, segments array<struct<text, loss>>, formatted``."""
    turn = F.struct(F.col(turn_col).alias("turn"),
                    F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    convs = (rows.select(F.col(id_col).alias("conv_id"), turn.alias("t"))
             .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))

    def of_turn(x: Column) -> Column:
        has_loss = x["role"].isin(*template["loss_roles"])
        return F.array(*[F.struct(_filled(p, template, x["role"], x["text"]).alias("text"),
                                  (has_loss & F.lit(loss)).alias("loss")) for p, loss in template["segments"]])

    out = (convs.withColumn("segments", F.flatten(F.transform("turns", of_turn)))
           .withColumn("state", end_state(F.col("turns"), template)))
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                      F.col("state").isin(*template["accepting"]).alias("valid"), "state", "segments",
                      F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def parse_formatted(formatted: Column, template: dict = CHATML) -> Column:
    """The turns (role, text) read back from a formatted string of the ``CHATML`` layout."""
    parts = F.split(formatted, rf"\Q{template['start']}\E", -1)
    tail = len(template["end"]) + 1

    def turn(p: Column) -> Column:
        at = F.locate("\n", p)
        return F.struct(unescape_role(F.substring(p, F.lit(1), at - 1)).alias("role"),
                        unescape(F.substring(p, at + 1, F.length(p) - at - tail)).alias("text"))

    return F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped segment by segment."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
