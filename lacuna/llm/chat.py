"""Chat formatting by event-sourced reconstruction (operator 10).

A log holds events (conv_id, message, seq, kind, role, text): ``message`` opens a whole message,
``start`` an empty or partial one, ``delta`` appends to the newest text, ``edit`` replaces it,
``regenerate`` drops it and starts anew, ``delete`` removes it.  Events are grouped by
conversation and message, sorted by seq and folded; the surviving messages of a conversation
are sorted by their first event and rendered.  Only final messages reach the second grouping,
so a conversation of many small deltas is folded before it is gathered; the rendered
conversation is one string and one row by definition.

Template: <|im_start|>role, new line, text, <|im_end|>, new line.  Control strings inside roles
and texts are broken by a backslash after their first character; one that already has
backslashes there gets one more, so taking one away everywhere restores the text exactly.  In a
role, backslash and new line are written ``\\\\`` and ``\\n`` before that.

Cases: null texts and roles are empty; rows with equal turns are ordered by role and text and
all kept; a null turn comes last; null is a conversation of its own; an empty table gives no
rows (but for what the caller adds); extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import let

START, END = "<|im_start|>", "<|im_end|>"
#: what follows the first character of each control string (fixed values)
CONTROL_TAILS = ("|im_start|>", "|im_end|>", "|endoftext|>", "s>", "/s>", "<SYS>>", "</SYS>>", "INST]", "/INST]")
_TAILS = "|".join(t.replace("|", r"\|").replace("[", r"\[").replace("]", r"\]") for t in CONTROL_TAILS)
ESCAPE = rf"([<\[])(\\*)({_TAILS})"
UNESCAPE = rf"([<\[])\\(\\*)({_TAILS})"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$2$3")


def escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescaped_role(role: Column) -> Column:
    """Inverse of ``escaped_role``: split at doubled backslashes, restore new lines between them."""
    parts = F.split(unescaped(role), r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\")


def fold(events: Column) -> Column:
    """Sorted events of one message id -> array of final (first, role, text)."""
    def entry(role, text):
        return F.array(F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")))

    def step(acc, e):
        last = F.element_at(acc, -1)
        before = F.slice(acc, 1, F.size(acc) - 1)
        role = F.coalesce(e["role"], last["role"])
        return (F.when(e["kind"].isin("message", "start"), F.concat(acc, entry(e["role"], e["text"])))
                .when(F.size(acc) == 0, F.when(e["kind"] == "delete", acc).otherwise(entry(e["role"], e["text"])))
                .when(e["kind"] == "delta", F.concat(before, entry(role, F.concat(last["text"], F.coalesce(e["text"], F.lit(""))))))
                .when(e["kind"].isin("edit", "regenerate"), F.concat(before, entry(role, e["text"])))
                .when(e["kind"] == "delete", before).otherwise(acc))

    return F.aggregate(events, F.array().cast("array<struct<role:string,text:string>>"), step)


def reconstruct(events: DataFrame) -> DataFrame:
    """conv_id, turns: array of (role, text) in order."""
    per_message = (events.groupBy("conv_id", "message").agg(
        F.sort_array(F.collect_list(F.struct("seq", "kind", "role", "text"))).alias("e"))
        .select("conv_id", F.element_at("e", 1)["seq"].alias("first"), "message", fold(F.col("e")).alias("m")))
    got = per_message.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct(F.col("first").isNull().alias("late"), "first", "message", "m"))).alias("all"))
    return got.select("conv_id", F.flatten(F.transform("all", lambda x: x["m"])).alias("turns"))


def render(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans: spans (start from 0, length, in code points) of the
    assistant texts inside ``formatted``."""
    piece = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(START), escaped_role(t["role"]), F.lit("\n")).alias("head"), escaped(t["text"]).alias("body"),
        (t["role"] == "assistant").alias("on")))
    tail = END + "\n"
    init = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def walk(acc, p):
        at = acc["at"] + F.length(p["head"])
        n = F.length(p["body"]).cast("long")
        spans = F.when(p["on"], F.concat(acc["spans"], F.array(F.struct(at.alias("start"), n.alias("length"))))).otherwise(acc["spans"])
        return F.struct((at + n + len(tail)).alias("at"), spans.alias("spans"))

    return (turns.withColumn("p", piece).select(
        "conv_id",
        F.concat_ws("", F.transform("p", lambda x: F.concat(x["head"], x["body"], F.lit(tail)))).alias("formatted"),
        F.aggregate("p", init, walk, lambda a: a["spans"]).alias("loss_spans")))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    parts = F.split(formatted, r"<\|im_end\|>\n", -1)

    def turn(part):
        body = F.substr(part, F.lit(len(START) + 1))
        role = F.substring_index(body, "\n", 1)
        return F.struct(unescaped_role(role).alias("role"), unescaped(F.substr(body, F.length(role) + 2)).alias("text"))

    return F.transform(let(parts, lambda p: F.slice(p, 1, F.size(p) - 1)), turn)


def digests(chats: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all from
    ``formatted`` and ``loss_spans``."""
    seen = chats.withColumn("t", read_back(F.col("formatted"))).withColumn("loss", F.concat_ws("", F.transform(
        "loss_spans", lambda s: unescaped(F.substr("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int"))))))
    said = F.concat_ws("", F.transform("t", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))))
    return seen.select("conv_id", F.size("t").cast("long").alias("n_turns"),
                       F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"),
                       F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def row_events(conversations: DataFrame) -> DataFrame:
    """A table of finished turns as an event log: each row is a whole message."""
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("message"), F.col("turn").cast("long").alias("seq"),
        F.lit("message").alias("kind"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
