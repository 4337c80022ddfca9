"""Chat formatting from an event log, with DataFrame functions only.

A conversation is a log of events. Its rows are partitioned by conversation
(one shuffle), sorted by turn and sequence, and folded into final messages:

* ``message`` starts a message with its text,
* ``delta`` appends to the newest message of its turn (a streamed piece),
* ``edit`` replaces the text of that message,
* ``regenerate`` empties it, so that later deltas write it anew.

A delta, edit or regeneration with no message before it in its turn starts
one. Messages are rendered as ``<|im_start|>role\\ntext<|im_end|>\\n``.
Control strings inside a role or text are escaped reversibly: ``&`` becomes
``&amp;`` and ``<|`` becomes ``&lt;|`` (in a role, also the line feed becomes
``&#10;``). The loss mask lists the code-point ranges of assistant texts.

Null text or role counts as empty, a null kind as ``message``; null
conversation ids form one conversation; null turns come first. Rows that tie
on turn and sequence are ordered by role, then text; repeated rows are kept.
An empty table gives an empty result. Very long conversations and streams take
time about in proportion (no fold copies what it has so far at every event); a
conversation's result is one row, so it meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.folds import between, let, parts_of
from kiln.llm.folds import folded as fold

START, END = "<|im_start|>", "<|im_end|>\n"
MESSAGE = "struct<role:string,text:string>"


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))
    return F.replace(out, F.lit("\n"), F.lit("&#10;")) if role else out


def unescape(text: Column, role: bool = False) -> Column:
    out = F.replace(text, F.lit("&#10;"), F.lit("\n")) if role else text
    return F.replace(F.replace(out, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def _fold(events: Column) -> Column:
    """Final messages of one turn from its sorted events: of each message, what
    follows its last reset (message, edit or regeneration), joined once."""
    def message(own):
        last = F.array_max(F.filter(F.sequence(F.lit(0), F.size(own) - 1), lambda i: (i == 0) | (F.get(own, i)["kind"] != "delta")))
        said = F.transform(F.slice(own, last + 1, F.size(own) - last), lambda e: F.when(e["kind"] == "regenerate", "").otherwise(e["text"]))
        role = F.get(F.filter(F.transform(own, lambda e: e["role"]), lambda r: r != ""), F.lit(0))
        return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.array_join(said, "").alias("text"))

    def turn(own):
        n = F.size(own)
        starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(own, i)["kind"] == "message"))
        cut = let(starts, lambda at: F.transform(at, lambda x, i: F.slice(own, x + 1, F.coalesce(F.get(at, i + 1), n) - x)))
        return F.transform(cut, message)

    return let(events, turn)


def conversations(log: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", seq_col: str | None = "seq",
                  kind_col: str | None = "kind", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows ``(conv, messages)``: the final messages of every conversation.
    Without a sequence or kind column every row is a message of its own."""
    events = log.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        (F.col(seq_col).cast("long") if seq_col else F.lit(0).cast("long")).alias("seq"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        (F.coalesce(F.col(kind_col), F.lit("message")) if kind_col else F.lit("message")).alias("kind"))
    # one exchange by conversation serves both aggregates
    turns = (events.repartition("conv").groupBy("conv", "turn")
             .agg(F.sort_array(F.collect_list(F.struct("seq", "role", "text", "kind"))).alias("events"))
             .select("conv", "turn", _fold(F.col("events")).alias("messages")))
    by_turn = turns.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("turn", "messages"))).alias("turns"))
    return by_turn.select("conv", F.flatten("turns.messages").alias("messages"))


def render(folded: DataFrame) -> DataFrame:
    """``folded`` with ``formatted`` (the training text) and ``loss_mask``
    (array of ``(start, stop)`` code points, the assistant texts)."""
    parts = F.transform("messages", lambda m: F.struct(
        F.concat(F.lit(START), escape(m["role"], True), F.lit("\n")).alias("head"), escape(m["text"]).alias("body"),
        (m["role"] == "assistant").alias("loss")))

    def step(at, p):
        start = at + F.length(p["head"])
        stop = start + F.length(p["body"])
        return stop + len(END), F.struct(p["loss"].alias("loss"), start.alias("start"), stop.alias("stop"))

    def mask(parts):
        spans = F.filter(fold(parts, F.lit(0), step, "struct<loss:boolean,start:int,stop:int>")["out"], lambda s: s["loss"])
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop")))

    return (folded.withColumn("parts", parts)
            .withColumn("formatted", F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), ""))
            .withColumn("loss_mask", mask(F.col("parts"))).drop("parts"))


def parsed(formatted: Column) -> Column:
    """The messages of a rendered conversation, read back and unescaped."""
    pieces = F.split(formatted, r"<\|im_start\|>", -1)

    def message(p):
        role = F.substring_index(p, "\n", 1)
        text = F.substring(p, F.length(role) + 2, F.length(p) - F.length(role) - 1 - len(END))
        return F.struct(unescape(role, True).alias("role"), unescape(text).alias("text"))

    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), message)


def under_mask(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return let(parts_of(formatted), lambda parts: F.array_join(
        F.transform(mask, lambda s: unescape(between(parts, s["start"], s["stop"]))), ""))
