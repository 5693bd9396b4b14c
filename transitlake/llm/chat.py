"""Chat formatting from an event log (operator 5), DataFrame functions only.

The log holds one row per event: conv_id, seq, message, kind, role, text. `delta` appends its text
to the message, `edit` replaces what the message holds so far, `regenerate` empties it. Events are
partitioned by conversation and sorted by seq; each message folds into its final text; then the
conversation is rendered:

    <turn:ROLE>TEXT</turn>\\n      for each message, in order

Inside ROLE and TEXT a backslash is written `\\b`, `<` as `\\l` and `>` as `\\g`, so no control string
can appear in a text and reading back is exact. The mask has one (start, length, loss) entry per
turn, in code points of the formatted string; loss is true for texts of the assistant.

One conversation is one output string, so its rows meet in one task; events of different messages
are folded before that, and everything runs on one exchange by conversation.

Edge cases: null text and null role count as empty; a null conv_id is a conversation of its own;
rows with equal conv_id and turn are separate turns ordered by role and text; an empty table gives
an empty result; other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

OPEN, MIDDLE, CLOSE = "<turn:", ">", "</turn>\n"
ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))


def escape(c: Column) -> Column:
    for raw, code in ESCAPES:
        c = F.replace(c, F.lit(raw), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    for raw, code in reversed(ESCAPES):
        c = F.replace(c, F.lit(code), F.lit(raw))
    return c


def log_of(turns: DataFrame) -> DataFrame:
    """Event log of a table of turns (conv_id, turn, role, text): each turn streams in two deltas."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    by_turn = W.partitionBy("conv_id").orderBy("turn", role, text)
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    rows = rows.select("conv_id", F.row_number().over(by_turn).cast("long").alias("message"), "role", "text")
    half = (F.length("text") / 2).cast("int")
    events = F.array(F.struct(F.lit(0).alias("part"), F.substr("text", F.lit(1), half).alias("text")),
                     F.struct(F.lit(1).alias("part"), F.substr("text", half + 1).alias("text")))
    return rows.select("conv_id", "message", "role", F.explode(events).alias("e")).select(
        "conv_id", (2 * F.col("message") + F.col("e.part")).alias("seq"), "message", F.lit("delta").alias("kind"),
        "role", F.col("e.text").alias("text"))


def fold(log: DataFrame) -> DataFrame:
    """Final messages: conv_id, message, role (of its first event), text."""
    events = F.sort_array(F.collect_list(F.struct(
        "seq", F.coalesce("kind", F.lit("delta")).alias("kind"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))))
    per_message = log.repartition("conv_id").groupBy("conv_id", "message").agg(events.alias("events"))
    reset = F.array_max(F.transform("events", lambda e, i: F.when(e["kind"].isin("edit", "regenerate"), i)))
    live = F.slice("events", F.coalesce(reset, F.lit(0)) + 1, F.size("events"))
    return per_message.select(
        "conv_id", "message", F.get("events", F.lit(0))["role"].alias("role"),
        F.array_join(F.transform(live, lambda e: F.when(e["kind"] == "regenerate", F.lit("")).otherwise(e["text"])), "").alias("text"))


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, mask: array of (start, length, loss) of the turns' texts."""
    parts = messages.select("conv_id", "message", escape(F.col("role")).alias("head"), escape(F.col("text")).alias("body"),
                            (F.col("role") == loss_role).alias("loss"))
    head = len(OPEN) + F.length("head") + len(MIDDLE)
    up_to = F.sum(head + F.length("body") + len(CLOSE)).over(W.partitionBy("conv_id").orderBy("message"))
    parts = parts.select("*", (up_to - len(CLOSE) - F.length("body")).alias("start"))
    turns = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "message", F.concat(F.lit(OPEN), "head", F.lit(MIDDLE), "body", F.lit(CLOSE)).alias("piece"),
        F.struct("start", F.length("body").cast("long").alias("length"), "loss").alias("mask")))).alias("turns"))
    return turns.select("conv_id", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
                        F.transform("turns", lambda t: t["mask"]).alias("mask"))


def read_back(chats: DataFrame) -> DataFrame:
    """conv_id, formatted, turns: array of (role, text, loss), parsed from the formatted string and its mask.

    A turn whose text is not as long as its mask entry says is read as null, and so is its digest."""
    split = chats.select("conv_id", "formatted", "mask", F.split("formatted", CLOSE, -1).alias("parts"))
    at = lambda p: F.locate(MIDDLE, p)
    turn = lambda p, m: F.when(
        F.length(p) - at(p) == m["length"],
        F.struct(unescape(F.substr(p, F.lit(len(OPEN) + 1), at(p) - len(OPEN) - 1)).alias("role"),
                 unescape(F.substr(p, at(p) + 1)).alias("text"), m["loss"].alias("loss")))
    return split.select("conv_id", "formatted", F.zip_with(
        F.slice("parts", 1, F.size("parts") - 1), "mask", turn).alias("turns"))


def digests(chats: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of formatted chats."""
    back = read_back(chats)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    whole = ~F.exists("turns", lambda t: t.isNull())
    back = back.select("conv_id", "formatted", F.size("turns").cast("long").alias("n_turns"),
                       F.when(whole, said).alias("said"), F.when(whole, loss).alias("loss"))
    return back.select("conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def format_chats(log: DataFrame) -> DataFrame:
    """Event log to formatted chats (conv_id, formatted, mask)."""
    return render(fold(log))
