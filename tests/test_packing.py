"""Packing by cut positions: long texts, block borders, nulls."""

from pyspark.sql import functions as F

from docflow.operators.packing import FOLD_LINES, pack
from docflow.operators.translate import translate_items


def greedy(text, limit):
    parts, cur = [], ""
    for line in text.split("\n"):
        if len(cur) + len(line) + 1 < limit:
            cur += line + "\n"
        else:
            parts.append(cur)
            cur = line + "\n"
    return [p.strip() for p in [*parts, cur] if p.strip()]


def test_cuts_go_on_over_blocks_of_lines(spark):
    texts = ["\n".join("ab " * (i % 7) + str(i) for i in range(n)) for n in (1, FOLD_LINES - 1, FOLD_LINES, FOLD_LINES + 1, 3 * FOLD_LINES + 5)]
    texts += ["", "\n", "\n" * (2 * FOLD_LINES), "x" * 1000, "é" * 299 + "\n" + "日" * 298 + "\n1"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, s string")
    for limit in (1, 40, 300):
        got = {r.i: r.p for r in df.select("i", pack("s", limit).alias("p")).collect()}
        assert got == {**{i: greedy(t, limit) for i, t in enumerate(texts)}, len(texts): None}


def test_many_parts_of_one_text(spark):
    """200,000 lines, each a part: an array that grows by copying would move 20 billion entries."""
    text = F.repeat(F.concat(F.repeat(F.lit("x"), 20), F.lit("\n")), (F.lit(200_000) + F.col("id")).cast("int"))
    assert spark.range(2).select(F.size(pack(text, 10)).alias("n")).collect() == [(200_000,), (200_001,)]


def test_items_packed_beforehand_translate_alike(spark):
    rows = [(1, "en", "ja", 0, "a\nb"), (1, "en", "fr", 0, "a\nb"), (2, "en", "ja", 0, None), (3, "en", "en", 0, "same"), (4, "en", "ja", 7, "long")]
    items = spark.createDataFrame(rows, "id int, src_lang string, to_lang string, status int, text string")
    plain = sorted(map(tuple, translate_items(items, "id").collect()), key=str)
    assert sorted(map(tuple, translate_items(items.withColumn("packed", pack("text")), "id", parts="packed").collect()), key=str) == plain
