"""Chat formatting by prefix-target expansion, with DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it as context, and its reply as the only text
under the loss. Turns after the last reply would be in no example, so a conversation that does not end with a reply
gets one more example without a target, which holds all of its turns.

An example is a row of turns, each `<|turn|>role<|text|>text<|end|>`; the target's text stands between `<|loss|>` and
`<|/loss|>`. In roles and texts `%` and `<` are written %25 and %3C, so that no control string can come from them
and reading back is exact.

Edge cases: NULL role or text is ''; a NULL conv_id is a conversation of its own; turns are ordered by (turn, role,
text) with NULL first, so ties and repeated rows have a fixed place and are all kept; an empty table gives no rows;
columns besides conv_id, turn, role and text are not looked at. A conversation is one row of its turns, as its
examples need them all; examples of it are built one at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opticlake.llm.catalog import query

TURN, TEXT, END, LOSS, UNLOSS = "<|turn|>", "<|text|>", "<|end|>", "<|loss|>", "<|/loss|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("%"), F.lit("%25")), F.lit("<"), F.lit("%3C"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("%3C"), F.lit("<")), F.lit("%25"), F.lit("%"))


def format_examples(conversations: DataFrame, reply_role: str = "assistant") -> DataFrame:
    """One row per example: conv_id, target (position of the trained turn, from 0; NULL where there is none), n_turns, formatted."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.select("conv_id", F.struct(F.col("turn").alias("turn"), role.alias("role"), text.alias("text")).alias("t"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    pieces = F.transform("turns", lambda t: F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT), escape(t["text"]), F.lit(END)))
    replies = F.transform("turns", lambda t, i: F.when(t["role"] == reply_role, i))
    last = F.when(F.element_at("turns", -1)["role"] != reply_role, F.size("turns"))
    at = F.filter(F.concat(replies, F.array(last)), lambda i: i.isNotNull())
    rows = whole.select("conv_id", "turns", pieces.alias("pieces"), F.explode(at).alias("at"))
    target = F.get("turns", F.col("at"))
    context = F.array_join(F.slice("pieces", F.lit(1), F.col("at")), "")
    reply = F.concat(F.lit(TURN), escape(target["role"]), F.lit(TEXT + LOSS), escape(target["text"]), F.lit(UNLOSS + END))
    trained = F.col("at") < F.size("turns")
    return rows.select(
        "conv_id", F.when(trained, F.col("at")).alias("target"),
        (F.col("at") + F.when(trained, 1).otherwise(0)).cast("long").alias("n_turns"),
        F.concat(context, F.when(trained, reply).otherwise(F.lit(""))).alias("formatted"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of an example: array of (role, text)."""
    plain = F.replace(F.replace(formatted, F.lit(LOSS), F.lit("")), F.lit(UNLOSS), F.lit(""))
    parts = F.filter(F.split(plain, r"<\|turn\|>"), lambda p, i: i > 0)
    return F.transform(parts, lambda p: F.struct(
        unescape(F.substring_index(p, TEXT, 1)).alias("role"),
        unescape(F.substring_index(F.substring_index(p, TEXT, -1), END, 1)).alias("text"),
    ))


def read_loss(formatted: Column) -> Column:
    """The text under the loss, NULL where there is none."""
    inner = F.substring_index(F.substring_index(formatted, LOSS, -1), UNLOSS, 1)
    return F.when(F.contains(formatted, F.lit(LOSS)), unescape(inner))


def digest_examples(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples: number and hash of the turns, and of the trained text."""
    longest = F.max_by("formatted", F.struct("n_turns", F.col("target").isNull())).alias("longest")
    loss = F.sort_array(F.collect_list(F.when(F.col("target").isNotNull(), F.struct("target", "loss"))))
    per = examples.withColumn("loss", read_loss(F.col("formatted"))).groupBy("conv_id").agg(
        longest, loss.alias("losses"), F.sum(F.length("formatted")).alias("formatted_chars"),
    )
    turns = per.select("conv_id", read_turns(F.col("longest")).alias("turns"), F.array_join("losses.loss", "").alias("loss"), "formatted_chars")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )


#: A conversation whose texts look like control strings.
ODD_TURNS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]

SQL = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed AS (
  SELECT *, length(replace(replace(role, '%', '%25'), '<', '%3C')) + length(replace(replace(text, '%', '%25'), '<', '%3C')) + 23 AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM turns
), summed AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY pos) AS upto FROM placed
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN upto + 17 WHEN pos = n THEN upto ELSE 0 END) AS BIGINT) AS formatted_chars
FROM summed GROUP BY conv_id
"""


@query("op4_chat_format", SQL)
def op4_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame(ODD_TURNS, rows.schema)
    return digest_examples(format_examples(rows.unionByName(odd)))
