"""Chat formatting: typed content parts flattened into marked, reversibly escaped text.

Everything is DataFrame expressions. A message's content is an array of parts

    struct(kind string, text string, ref string, units long)

where kind is text, image, audio or document. A visitor per kind turns a part into its place in the
text: a text part gives its escaped text; any other kind gives one placeholder, an attachment
record with its reference, and units times the kind's rate as expanded tokens. Attachments are
numbered in reading order through the conversation.

Defined results
- null text: empty text; null role: empty role; null kind: a text part; null or empty parts: empty text.
- an unknown kind is kept as text, so nothing is lost.
- null conversation id: one conversation of its own; a conversation is one output row, so its size
  bounds the memory of a group.
- rows with equal conversation and turn (ties, repeats) stay, ordered by turn, role, content; null turns first.
- empty table: empty result. Other columns of the input are not read, so their names can't clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SEP, END = "<|turn|>", "<|body|>", "<|end|>"
PLACEHOLDER = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
#: Tokens a unit of an attachment expands to: an image tile, a second of audio, a page.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 768}
#: Strings that steer a chat model; within a text each is escaped.
CONTROL = [START, SEP, END, *PLACEHOLDER.values(), "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>"]

PART = "struct<kind:string,text:string,ref:string,units:bigint>"


def _quoted(s: str) -> str:
    return "\\Q" + s + "\\E"


_FIRST = "|".join(f"{_quoted(c[0])}(?={_quoted(c[1:])})" for c in CONTROL)


def escape(text: Column) -> Column:
    """No control string is left in the result: backslashes are doubled, then one is put after the first
    character of every control string. Second characters of control strings are never backslashes, so
    `unescape` restores the text."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, f"({_FIRST})", r"$1\\")


def unescape(text: Column) -> Column:
    """Inverse of `escape`: every backslash goes and the character after it stays."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_part(text: Column) -> Column:
    """A content array of a single text part."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("units")))


def _visit(part: Column) -> Column:
    text = escape(F.coalesce(part["text"], F.lit("")))
    return reduce(lambda other, kind: F.when(part["kind"] == kind, F.lit(PLACEHOLDER[kind])).otherwise(other), PLACEHOLDER, text)


def _tokens(part: Column) -> Column:
    units = F.greatest(F.coalesce(part["units"], F.lit(1).cast("long")), F.lit(0).cast("long"))
    return reduce(lambda other, kind: F.when(part["kind"] == kind, units * F.lit(TOKENS_PER_UNIT[kind])).otherwise(other), TOKENS_PER_UNIT, F.lit(0).cast("long"))


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", content_col: str = "content", trained_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted string, loss_spans array<struct<start,length>> (code
    points of the bodies of the trained role's turns within formatted), attachments
    array<struct<index,kind,ref,tokens>> in the order of their placeholders, attachment_tokens long.

    content_col holds an array of parts (see the module). One shuffle, on the conversation.
    """
    content = F.coalesce(F.col(content_col).cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>"))
    flat = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), content.alias("content"))
    flat = flat.select(
        "conv_id", "turn", "role",
        F.array_join(F.transform("content", _visit), "").alias("body"),
        F.transform(
            F.filter("content", lambda p: p["kind"].isin(*PLACEHOLDER)),
            lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), _tokens(p).alias("tokens")),
        ).alias("attached"),
        F.concat(F.lit(START), escape(F.col("role")), F.lit(SEP)).alias("opened"),
    )
    # a running sum gives each message's place: one sort of a conversation, no array that grows by message
    order = ["turn", "role", "body", "attached"]
    upto = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum((F.length("opened") + F.length("body") + F.lit(len(END))).cast("long")).over(upto)
    flat = flat.withColumn("start", end - F.lit(len(END)) - F.length("body"))
    grouped = flat.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "body", "attached", "start", "opened"))).alias("messages"))
    trained = F.filter("messages", lambda m: m["role"] == trained_role)
    spans = F.transform(trained, lambda m: F.struct(m["start"].alias("start"), F.length(m["body"]).cast("long").alias("length")))
    attached = F.flatten(F.transform("messages", lambda m: m["attached"]))
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("messages", lambda m: F.concat(m["opened"], m["body"], F.lit(END))), "").alias("formatted"),
        spans.alias("loss_spans"),
        F.transform(attached, lambda a, i: F.struct(i.cast("long").alias("index"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))).alias("attachments"),
        F.aggregate(attached, F.lit(0).cast("long"), lambda s, a: s + a["tokens"]).alias("attachment_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """array<struct<role,text>> read back from a formatted string."""
    turns = F.slice(F.split(formatted, _quoted(START)), 2, 1 << 30)

    def one(turn: Column) -> Column:
        body = F.split(turn, _quoted(SEP), 2)
        text = F.element_at(body, 2)
        return F.struct(unescape(F.element_at(body, 1)).alias("role"), unescape(F.substring(text, F.lit(1), F.length(text) - F.lit(len(END)))).alias("text"))

    return F.transform(turns, one)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def digest(rows: DataFrame) -> DataFrame:
    """Of `format_conversations`' rows, what can be read back: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    read = rows.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
