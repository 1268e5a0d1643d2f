"""Chat formatting: conversations rebuilt from event logs, rendered by a template, with the spans to train on.

Main path in DataFrame functions only. Events of a conversation are sorted by sequence number and folded:

- `message` starts a message with a role and a text;
- `delta` adds its text to the message before it (streamed answers);
- `edit` replaces the text of the message before it;
- `regenerate` drops that text, and the deltas that follow write it anew.

Windows over (conversation, sequence) number the messages and find the last reset of each, so a conversation needs one
shuffle and is sorted once; a task holds one message list at a time, as the result does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_OPEN, _CLOSE = "<turn>### ", "</turn>\n"


def escaped(text: Column) -> Column:
    """Text without the template's control strings: backslashes are doubled, `<` before turn marks and `#` before
    another `#` get one behind them."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.regexp_replace(text, "<(?=/?turn>)", r"<\\")
    return F.regexp_replace(text, "#(?=#)", r"#\\")


def unescaped(text: Column) -> Column:
    """A backslash pair is a backslash; a single one behind `<` or `#` goes."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def fold(events: DataFrame) -> DataFrame:
    """Events (conv_id, seq, event, role, text) to final messages (conv_id, message, role, text), message from 0.

    Null texts and roles are empty ones. Events of one sequence number are taken in the order message, delta, edit,
    regenerate, then by role and text; repeated rows are events of their own. Deltas, edits and regenerations before
    any message, and events of unknown kind, belong to none and are left out. Other columns are left out.
    """
    kind = F.array_position(F.array(*map(F.lit, ("message", "delta", "edit", "regenerate"))), F.col("event"))
    order = Window.partitionBy("conv_id").orderBy("seq", "kind", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = events.select(
        "conv_id", "seq", kind.cast("int").alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).where("kind > 0")
    rows = rows.select(
        "*", F.row_number().over(order).alias("at"),
        (F.sum(F.when(F.col("kind") == 1, 1).otherwise(0)).over(so_far) - 1).alias("message"),
    ).where("message >= 0")
    resets = F.max(F.when(F.col("kind") != 2, F.col("at")))
    rows = rows.withColumn("reset", resets.over(Window.partitionBy("conv_id", "message"))).where("at >= reset or kind = 1")
    said = F.when((F.col("at") >= F.col("reset")) & (F.col("kind") != 4), F.struct("at", "text"))
    return rows.groupBy("conv_id", "message").agg(
        F.max(F.when(F.col("kind") == 1, F.col("role"))).alias("role"),
        F.array_join(F.transform(F.array_sort(F.collect_list(said)), lambda x: x["text"]), "").alias("text"),
    )


def render(messages: DataFrame, learn_from: str = "assistant") -> DataFrame:
    """Messages (conv_id, message, role, text) to one row per conversation: formatted, loss_spans.

    A message is `<turn>### role: text</turn>` and a line end, with the role URL-encoded and the text escaped.
    loss_spans are the (start, length) of the escaped texts of role `learn_from`, in characters from 0.
    """
    order = Window.partitionBy("conv_id").orderBy("message")
    head = F.concat(F.lit(_OPEN), F.url_encode("role"), F.lit(": "))
    rows = messages.select(
        "conv_id", "message", head.alias("head"), escaped(F.col("text")).alias("body"),
        (F.col("role") == learn_from).alias("learn"),
    )
    rows = rows.withColumn("n", F.char_length("head") + F.char_length("body") + len(_CLOSE))
    end = F.sum(F.col("n").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("start", end - F.col("n") + F.char_length("head"))
    span = F.struct("start", F.char_length("body").cast("long").alias("length"))
    parts = F.array_sort(F.collect_list(F.struct(
        "message", F.concat("head", "body", F.lit(_CLOSE)).alias("part"))))
    return rows.groupBy("conv_id").agg(
        F.array_join(F.transform(parts, lambda x: x["part"]), "").alias("formatted"),
        F.array_sort(F.collect_list(F.when(F.col("learn"), span))).alias("loss_spans"),
    )


def parse(formatted: Column) -> Column:
    """The messages of a formatted conversation, as an array of (role, text)."""
    turns = F.split(formatted, _CLOSE)
    turns = F.slice(turns, 1, F.greatest(F.size(turns) - 1, F.lit(0)))
    body = lambda t: F.substr(t, F.lit(len(_OPEN) + 1))
    return F.transform(turns, lambda t: F.struct(
        F.url_decode(F.substring_index(body(t), ": ", 1)).alias("role"),
        unescaped(F.substr(body(t), F.instr(body(t), ": ") + F.lit(2))).alias("text"),
    ))


def learned(formatted: Column, loss_spans: Column) -> Column:
    """The texts under the loss mask, unescaped, in order, with nothing between them."""
    return F.array_join(F.transform(
        loss_spans, lambda s: unescaped(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def format_conversations(events: DataFrame) -> DataFrame:
    """Event log to (conv_id, formatted, loss_spans). An empty log gives an empty table."""
    return render(fold(events))
