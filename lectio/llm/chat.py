"""Chat formatting by event-sourced reconstruction.

A conversation is a log of events. Events are partitioned by conversation and sorted by sequence number; streamed deltas,
edits and regenerations are folded into final messages; the messages are rendered with a template whose control strings
cannot occur inside a text. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectio.llm.common import table

#: Control strings of the template. All begin with "<", which never occurs in an escaped text.
BEGIN, TURN, TEXT, LEARN, END = "<|begin|>", "<|turn|>", "<|text|>", "<|learn|>", "<|end|>"


def escape(text: Column) -> Column:
    r"""``\`` becomes ``\b`` and ``<`` becomes ``\l``: no control string is left, and unescape() undoes it."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def fold_events(events: DataFrame) -> DataFrame:
    """Event log -> final messages (conv_id, message, role, text).

    events: conv_id, seq, kind, role, text, target. Events apply in the order of seq; equal seq: by kind, role, text. Kinds:
    ``message`` opens the next message of its conversation (numbered from 0) with its role and text; ``delta`` appends its
    text; ``edit`` and ``regenerate`` replace what the message holds by their text (a regeneration is then streamed by
    deltas). The last three act on message number ``target``, null: the one opened last. Null texts and roles are empty;
    a null or unknown kind is a ``message``; events for a message that is never opened make one with an empty role.
    A null conv_id is a conversation of its own. Repeated rows are repeated events.
    """
    kind = F.when(F.col("kind").isin("delta", "edit", "regenerate"), F.col("kind")).otherwise("message")
    text, role = (F.coalesce(F.col(c), F.lit("")) for c in ("text", "role"))
    log = events.select("conv_id", "seq", kind.alias("kind"), role.alias("role"), text.alias("text"), F.col("target").cast("long").alias("target"))
    order = W.partitionBy("conv_id").orderBy("seq", "kind", "role", "text")
    opened = F.sum((F.col("kind") == "message").cast("long")).over(order.rowsBetween(W.unboundedPreceding, 0)) - 1
    log = log.withColumn("pos", F.row_number().over(order)).withColumn("opened", opened)
    number = F.when(F.col("kind") == "message", F.col("opened")).otherwise(F.coalesce("target", "opened"))
    step = F.struct("pos", (F.col("kind") != "delta").alias("resets"), "text")
    grouped = log.withColumn("message", number).groupBy("conv_id", "message").agg(F.sort_array(F.collect_list(step)).alias("steps"), F.max(F.when(F.col("kind") == "message", F.col("role"))).alias("role"))
    last = F.aggregate("steps", F.lit(0), lambda acc, x: F.when(x["resets"], x["pos"]).otherwise(acc))
    live = F.filter("steps", lambda x: x["pos"] >= F.col("last"))
    return grouped.withColumn("last", last).select("conv_id", "message", F.coalesce("role", F.lit("")).alias("role"), F.array_join(F.transform(live, lambda x: x["text"]), "").alias("text"))


def render(messages: DataFrame, learn_role: str = "assistant") -> DataFrame:
    """Messages -> (conv_id, n_turns, formatted, loss_spans): one row per conversation.

    formatted is BEGIN, then for each message TURN, role, TEXT (LEARN for the learn_role), text, END. loss_spans has the
    start (from 0, in code points) and length of each text of the learn_role as it stands, escaped, in formatted.
    """
    learn = F.col("role") == learn_role
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.when(learn, F.lit(LEARN)).otherwise(F.lit(TEXT)))
    parts = messages.select("conv_id", "message", learn.alias("learn"), head.alias("head"), escape(F.col("text")).alias("body"))
    parts = parts.withColumn("size", F.length("head") + F.length("body") + len(END))
    before = F.sum("size").over(W.partitionBy("conv_id").orderBy("message").rowsBetween(W.unboundedPreceding, -1))
    start = F.coalesce(before, F.lit(0)) + len(BEGIN) + F.length("head")
    turn = F.struct("message", F.concat("head", "body", F.lit(END)).alias("shown"), "learn", start.alias("start"), F.length("body").cast("long").alias("length"))
    turns = parts.select("conv_id", turn.alias("turn")).groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    spans = F.transform(F.filter("turns", lambda x: x["learn"]), lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length")))
    return turns.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.concat(F.lit(BEGIN), F.array_join(F.transform("turns", lambda x: x["shown"]), "")).alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """formatted -> array of (role, text, learn), unescaped."""
    body = F.split(formatted, r"<\|turn\|>")
    turns = F.slice(body, 2, F.size(body))

    def one(x: Column) -> Column:
        learn = F.instr(x, LEARN) > 0
        role = F.substring_index(F.substring_index(x, LEARN, 1), TEXT, 1)
        text = F.substring_index(F.substring_index(F.substring_index(x, LEARN, -1), TEXT, -1), END, 1)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"), learn.alias("learn"))

    return F.transform(turns, one)


def format_chats(events: DataFrame, learn_role: str = "assistant") -> DataFrame:
    """Event log -> one rendered conversation per row; see fold_events() and render(). Empty in, empty out."""
    return render(fold_events(events), learn_role)


def as_events(conversations: DataFrame) -> DataFrame:
    """Plain rows (conv_id, turn, role, text): each is one ``message`` event."""
    return conversations.select("conv_id", F.col("turn").alias("seq"), F.lit("message").alias("kind"), "role", "text", F.lit(None).cast("long").alias("target"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations and one more -> conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the
    formatted text. A null text is empty; rows of a null conv_id are one conversation; ties and repeated rows: see fold_events()."""
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    shown = format_chats(as_events(chats.unionByName(extra)))
    turns = shown.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), read_back(F.col("formatted")).alias("turns"))
    lines = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda x: x["learn"]), lambda x: x["text"]), "")
    return turns.withColumn("loss", loss).select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


OP9_SQL = """
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length(replace(replace(role, '\\', '\\b'), '<', '\\l')) + length(replace(replace(text, '\\', '\\b'), '<', '\\l'))
    + length('<|turn|>') + length('<|end|>') + CASE WHEN role = 'assistant' THEN length('<|learn|>') ELSE length('<|text|>') END AS size
  FROM said)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(size) + length('<|begin|>') AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
""".replace("\\\\", "\\")
