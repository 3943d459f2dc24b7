"""Chat formatting by prefix-target expansion, with DataFrame functions only.

Every assistant turn becomes an example: the formatted conversation up to and with that reply, of which only the
reply is trainable (``loss_start`` to ``loss_end``, in code points). A conversation that does not end with the
assistant has one more example, without a trainable part, so that no turn is lost.

Template, a turn after the other without anything between:

    <<SYS>> text <</SYS>>    [INST] text [/INST]    <s> text </s>    <<ROLE name>> text <</ROLE>>

for system, user, assistant and any other role. Backslashes in texts are doubled and each control string gets one in
front, so a space before a closing mark occurs at real marks only, and a backslash always stands for the character
after it: both parsing and unescaping are exact.

A conversation is one unit of work, since its digest covers all its turns; conversations are spread over tasks by
their id, examples are made row by row and never held together.

Defined results: null texts and roles are empty; a null conv_id is a conversation; turns are in the order of
(turn, role, text), nulls first, so repeated rows are repeated turns; an empty table gives no rows; extra columns are
ignored. A reply's example holds all turns before it, so the text of a conversation of very many turns grows with the
square of their number; that is the method's own cost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eligo.llm.common import table

#: Strings that mark turns (fixed values).
CONTROL = r"\[/?INST\]|</?s>|<</?SYS>>|<</?ROLE"
TURN = r"(?s)(<<SYS>>|\[INST\]|<s>|<<ROLE ([^\\>]*+(?:\\.[^\\>]*+)*+)>>) (.*?) (?:<</SYS>>|\[/INST\]|</s>|<</ROLE>>)"
OPEN_REPLY, CLOSE_REPLY = "<s> ", " </s>"
SLASH = "\\"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit(SLASH), F.lit(SLASH * 2)), f"({CONTROL})", r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def rendered(role: Column, text: Column) -> Column:
    body = escaped(text)
    other = F.concat(F.lit("<<ROLE "), F.replace(escaped(role), F.lit(">"), F.lit("\\>")), F.lit(">> "), body, F.lit(" <</ROLE>>"))
    return (
        F.when(role == "system", F.concat(F.lit("<<SYS>> "), body, F.lit(" <</SYS>>")))
        .when(role == "user", F.concat(F.lit("[INST] "), body, F.lit(" [/INST]")))
        .when(role == "assistant", F.concat(F.lit(OPEN_REPLY), body, F.lit(CLOSE_REPLY)))
        .otherwise(other)
    )


def examples(turns: DataFrame) -> DataFrame:
    """conv_id, upto (turns in the example), last, text, loss_start, loss_end (null in an example without a reply)."""
    rows = turns.select(
        turns["conv_id"].cast("long").alias("conv_id"),
        turns["turn"].cast("long").alias("turn"),
        F.coalesce(turns["role"].cast("string"), F.lit("")).alias("role"),
        F.coalesce(turns["text"].cast("string"), F.lit("")).alias("text"),
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    parts = grouped.select(
        "conv_id",
        F.transform("turns", lambda t: rendered(t["role"], t["text"])).alias("parts"),
        F.filter(F.transform("turns", lambda t, i: F.when(t["role"] == "assistant", i + 1)), lambda k: k.isNotNull()).alias("replies"),
    )
    n = F.size("parts")
    parts = parts.withColumn("upto", F.explode(F.array_distinct(F.concat("replies", F.array(n)))))
    made = parts.select("conv_id", "upto", (F.col("upto") == n).alias("last"), F.array_contains("replies", F.col("upto")).alias("reply"), F.array_join(F.slice("parts", 1, F.col("upto")), "").alias("text"), F.length(F.element_at("parts", F.col("upto"))).alias("tail"))
    start = F.length("text") - F.col("tail") + len(OPEN_REPLY)
    return made.select("conv_id", "upto", "last", "text", F.when(F.col("reply"), start).alias("loss_start"), F.when(F.col("reply"), F.length("text") - len(CLOSE_REPLY)).alias("loss_end"))


def parsed(text: Column) -> Column:
    """array<struct<role, text>> of a formatted text."""
    group = lambda k: F.regexp_extract_all(text, F.lit(TURN), F.lit(k))
    zipped = F.arrays_zip(group(1).alias("mark"), group(2).alias("name"), group(3).alias("body"))
    role = lambda t: F.when(t["mark"] == "<<SYS>>", "system").when(t["mark"] == "[INST]", "user").when(t["mark"] == "<s>", "assistant").otherwise(unescaped(t["name"]))
    return F.transform(zipped, lambda t: F.struct(role(t).alias("role"), unescaped(t["body"]).alias("text")))


def digests(made: DataFrame) -> DataFrame:
    """Per conversation, what its examples say: turns from the longest one, replies from each one's trainable part."""
    loss = F.when(F.col("loss_start").isNotNull(), unescaped(F.col("text").substr(F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))))
    said = made.select("conv_id", "upto", F.when(F.col("last"), F.col("text")).alias("whole"), F.length("text").cast("long").alias("chars"), loss.alias("loss"))
    one = said.groupBy("conv_id").agg(
        F.max("whole").alias("whole"),
        F.sum("chars").alias("formatted_chars"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("upto", "loss"))), lambda x: F.coalesce(x["loss"], F.lit(""))), "").alias("loss"),
    )
    one = one.withColumn("turns", parsed(F.col("whole")))
    hashed = lambda c: F.sha2(c.cast("binary"), 256)
    return one.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        hashed(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        hashed(F.col("loss")).alias("loss_sha256"),
        "formatted_chars",
    )


def op10_chat_examples(spark, sf_dir) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = F.lit("</s>[INST] ok [/INST]")
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), hard.alias("text"))
    return digests(examples(turns.unionByName(own)))


ORACLE = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
parts AS (
    SELECT *, length(regexp_replace(replace(text, '\', '\\'), '(\[/?INST\]|</?s>|<</?SYS>>|<</?ROLE)', '\\\1', 'g'))
              + CASE role WHEN 'system' THEN 17 WHEN 'user' THEN 15 ELSE 9 END AS n,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back
    FROM turns),
sums AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn) AS upto FROM parts)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn)) AS loss_sha256,
       CAST(sum(CASE WHEN role = 'assistant' OR back = 1 THEN upto ELSE 0 END) AS BIGINT) AS formatted_chars
FROM sums GROUP BY conv_id
"""
