"""Chat formatting: prefix-target expansion.

Every assistant turn becomes one training example. Its text holds all turns up to and including
that reply, and only the reply is trainable (``loss_start``, ``loss_length``: code points of the
example's text, zero based). A conversation that does not end in an assistant turn gets one more
row for its remaining context with an empty loss mask, so that no turn is lost.

Template: ``### <role>:\\n<text></turn>\\n`` for each turn. A text or role that holds one of the
template's control strings is escaped by writing a backslash before the control string's second
character, and one before every backslash of its own; dropping the first of each such pair gives
the text back. The end mark can therefore never appear inside an escaped text, and a plain split
reads the turns back.

Defined results. Null text or role: the empty string. Null turn: sorts first. Turns with the same
number: ordered by role, then text; repeated rows stay. Null conversation id: one conversation of
its own. Empty table: no rows. Extra columns are ignored.

One row holds one conversation: an example of this kind *is* the conversation up to the reply, so a
conversation has to fit into a row. Nothing larger than one conversation is gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

END = "</turn>"
_CONTROL = r"(\\|<(?=/turn>)|#(?=##)|:(?=\n))"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, _CONTROL, r"$1\\")


def unescape(c: Column) -> Column:
    """Inverse of :func:`escape`: every backslash of an escaped text opens a pair that stands for
    its second character."""
    return F.regexp_replace(c, r"\\([\\/#\n])", "$1")


def expand_prefix_targets(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
                          role: str = "role", text: str = "text",
                          target_role: str = "assistant") -> DataFrame:
    """One row per assistant turn: ``conv_id, example, n_turns, text, loss_start, loss_length, whole``.

    ``example`` counts the examples of a conversation from 1; ``whole`` marks the one row of each
    conversation whose text covers all its turns.
    """
    t = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
                     F.coalesce(F.col(role), F.lit("")).alias("role"),
                     F.coalesce(F.col(text), F.lit("")).alias("text"))
    head = F.concat(F.lit("### "), escape(F.col("role")), F.lit(":\n"))
    body = escape(F.col("text"))
    t = t.select("conv_id", "turn", "role", "text", head.alias("head"), body.alias("body"))
    t = t.withColumn("block", F.concat("head", "body", F.lit(END + "\n")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_target = F.col("role") == target_role
    t = (t.withColumn("n", F.row_number().over(order))
          .withColumn("end", F.sum(F.char_length("block").cast("long")).over(so_far))
          .withColumn("example", F.sum(is_target.cast("int")).over(so_far)))
    loss_length = F.char_length("body").cast("long")
    t = t.select(
        "conv_id", F.struct("n", "block").alias("b"),
        F.struct("n", "end", "example", is_target.alias("target"),
                 (F.col("end") - F.char_length("block") + F.char_length("head")).alias("start"),
                 F.when(is_target, loss_length).otherwise(F.lit(0).cast("long")).alias("loss")
                 ).alias("m"))
    c = t.groupBy("conv_id").agg(F.array_sort(F.collect_list("b")).alias("b"),
                                 F.array_sort(F.collect_list("m")).alias("m"))
    c = c.select("conv_id", F.array_join(F.transform("b", lambda x: x["block"]), "").alias("full"),
                 F.size("m").alias("turns"),
                 F.filter("m", lambda x: x["target"] | (x["n"] == F.size("m"))).alias("m"))
    e = c.select("conv_id", "full", "turns", F.explode("m").alias("m"))
    end = F.col("m.end").cast("int")
    return e.select(
        "conv_id",
        (F.col("m.example") + (~F.col("m.target")).cast("int")).cast("long").alias("example"),
        F.col("m.n").cast("long").alias("n_turns"),
        F.substring(F.col("full"), F.lit(1), end).alias("text"),
        F.when(F.col("m.target"), F.col("m.start")).otherwise(F.col("m.end")).alias("loss_start"),
        F.col("m.loss").alias("loss_length"),
        (F.col("m.n") == F.col("turns")).alias("whole"))


def read_turns(text: Column) -> Column:
    """The turns of a formatted text as ``array<struct<role, text>>``."""
    blocks = F.filter(F.split(text, END + "\n"), lambda x: x != "")
    return F.transform(blocks, lambda b: F.struct(
        unescape(F.regexp_extract(b, r"^### ((?s).*?):\n", 1)).alias("role"),
        unescape(F.regexp_extract(b, r"^### (?s).*?:\n(.*)$", 1)).alias("text")))


def read_loss(text: Column, start: Column, length: Column) -> Column:
    """The text under an example's loss mask, unescaped."""
    return unescape(F.substring(text, (start + 1).cast("int"), length.cast("int")))


def conversation_digest(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted examples alone: its turns, the text under
    the loss masks, and the code points written."""
    turns = F.when(F.col("whole"), read_turns(F.col("text")))
    script = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"],
                                                                F.lit("\n"))), "")
    e = examples.select(
        "conv_id", F.char_length("text").cast("long").alias("chars"),
        F.when(F.col("whole"), F.size(turns).cast("long")).alias("n_turns"),
        F.sha2(script, 256).alias("turns_sha256"),
        F.struct("example", read_loss(F.col("text"), F.col("loss_start"), F.col("loss_length"))
                 .alias("loss")).alias("l"))
    g = e.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"),
        F.array_join(F.transform(F.array_sort(F.collect_list("l")), lambda x: x["loss"]), "")
        .alias("loss"), F.sum("chars").alias("formatted_chars"))
    return g.select("conv_id", "n_turns", "turns_sha256",
                    F.char_length("loss").cast("long").alias("loss_chars"),
                    F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


# A conversation whose texts hold the template's own control strings and a backslash.
CONTROL_CASE = r"\### Assistant: </turn> ok"


def query(spark, sf_dir: str) -> DataFrame:
    from portstar.llm.common import table

    t = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    case = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_CASE).alias("text"))
    return conversation_digest(expand_prefix_targets(t.unionByName(case)))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, role || chr(10) || text || chr(10) AS line,
    [ length(x) + (length(x) - length(replace(x, '\', '')))
      + (length(x) - length(replace(x, '</turn>', ''))) // 7
      + coalesce(list_sum([length(y) - 2 FOR y IN regexp_extract_all(x, '#{3,}')]), 0)
      + (length(x) - length(replace(x, ':' || chr(10), ''))) // 2
      FOR x IN [role, text] ] AS n
  FROM t
), s AS (
  SELECT *, sum(4 + n[1] + 2 + n[2] + 8) OVER w AS fin,
    row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS last
  FROM e WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(line, '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(CASE WHEN role = 'assistant' OR k = last THEN fin ELSE 0 END)::BIGINT AS formatted_chars
FROM s GROUP BY conv_id
"""
