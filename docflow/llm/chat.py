r"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example: all turns before it as context and
its reply as the only text under the loss mask.  Turns after the last reply
(or a conversation without any) give one more example without a target, so
the output holds every turn.

A turn is written ``<|turn|>role<|text|>text<|end|>``.  Control strings inside
roles and texts (those of this template and the usual ``<s>``, ``</s>``,
``[INST]``, ``[/INST]``) get a backslash after their first character, and ones
that already have backslashes there get one more, so unescaping restores
every text.

Only DataFrame functions run.  A conversation is one value of the output by
definition; its turns meet in one row.

Defined cases: null roles and texts are empty; turns are ordered by turn (null
first), then role and text, and repeated rows are kept as turns of their own;
rows with a null conversation id form one conversation; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\])"
ESCAPED = r"([<\[])\\(\\*)(\||/?s>|/?INST\])"
HEAD = r"(?s)^<\|turn\|>(.*?)<\|text\|>(.*)$"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, CONTROL, r"$1\\$2$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, ESCAPED, "$1$2$3")


def examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text", target_role: str = "assistant") -> DataFrame:
    """conv_id, example (from 1), target_turn (position of the reply, null in
    an example without target), text, loss_start, loss_end (code points, from
    0, end exclusive; equal: nothing is trained)."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.struct(
        F.col(turn_col).alias("turn"), blank(role_col).alias("role"), blank(text_col).alias("text")).alias("t"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    head = lambda t: F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT))
    convs = convs.select(
        "conv_id", "turns",
        F.transform("turns", head).alias("heads"),
        F.transform("turns", lambda t: F.concat(escape(t["text"]), F.lit(END))).alias("bodies"))
    convs = convs.withColumn("pieces", F.zip_with("heads", "bodies", lambda h, b: F.concat(h, b)))
    is_target = F.transform("turns", lambda t: t["role"] == F.lit(target_role))
    each = convs.select("conv_id", "heads", "bodies", "pieces", F.size("turns").alias("n"), F.posexplode(is_target).alias("pos", "hit"))
    each = each.filter(F.col("hit") | (F.col("pos") == F.col("n") - 1))
    at = F.col("pos") + 1
    before = F.length(F.array_join(F.slice("pieces", F.lit(1), F.col("pos")), ""))
    start = before + F.length(F.element_at("heads", at))
    loss = F.when(F.col("hit"), F.length(F.element_at("bodies", at)) - len(END)).otherwise(0)
    return each.select(
        "conv_id", at.alias("example"), F.when(F.col("hit"), at).alias("target_turn"),
        F.array_join(F.slice("pieces", F.lit(1), at), "").alias("text"),
        start.cast("long").alias("loss_start"), (start + loss).cast("long").alias("loss_end"))


def parse(text: Column) -> Column:
    """Turns of a formatted text: array of (role, text), unescaped."""
    pieces = F.filter(F.split(text, r"<\|end\|>", -1), lambda p: p.startswith(TURN))
    return F.transform(pieces, lambda p: F.struct(
        unescape(F.regexp_extract(p, HEAD, 1)).alias("role"), unescape(F.regexp_extract(p, HEAD, 2)).alias("text")))


def read_back(examples_df: DataFrame) -> DataFrame:
    """Digests per conversation, taken from formatted examples alone."""
    loss = unescape(F.substring(F.col("text"), F.col("loss_start").cast("int") + 1, (F.col("loss_end") - F.col("loss_start")).cast("int")))
    per = examples_df.withColumn("loss", loss).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("losses"),
        F.max_by("text", "example").alias("last"),              # the texts of all examples are quadratic in the turns
        F.sum(F.length("text")).cast("long").alias("formatted_chars"))
    whole = parse(F.col("last"))
    per = per.withColumn("turns", whole).withColumn("trained", F.array_join(F.transform("losses", lambda x: x["loss"]), ""))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return per.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                      F.length("trained").cast("long").alias("loss_chars"), F.sha2("trained", 256).alias("loss_sha256"), "formatted_chars")
