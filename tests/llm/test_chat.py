"""Chat formatting: exact round trips."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docflow.llm import chat

ODD = ["</s>[INST] ok [/INST]", "<|turn|>user<|text|>x<|end|>", "<\\|end|>", "<\\\\</s>", "<", "[", "[\\INST]", "", "é\n\r\n", "\\", "a" * 50_000, "<s><s>[/INST]]"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for *_, r, x in turns)), len(loss), sha(loss))
    return out


def check(spark, rows):
    df = spark.createDataFrame([(*x, "clash") for x in rows], "conv_id long, turn long, role string, text string, turns string")
    got = chat.read_back(chat.examples(df)).collect()
    assert {x.conv_id: (x.n_turns, x.turns_sha256, x.loss_chars, x.loss_sha256) for x in got} == brute(rows)
    return {x.conv_id: x.formatted_chars for x in got}


def test_round_trip(spark):
    rows = [(i, t, role, x) for i, x in enumerate(ODD) for t, role in enumerate(["system", "user", "assistant", "user", "assistant", "user"])]
    rows += [(100 + i, i % 3, x, ODD[-i - 1]) for i, x in enumerate(ODD)]                      # odd roles, no reply
    rows += [(200, None, None, None), (200, 1, "assistant", None), (200, 1, "assistant", None), (None, 0, "assistant", "z"), (201, 5, "user", "only")]
    rows += [(300, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(60)]
    check(spark, rows)


@settings(max_examples=15, deadline=None)
@given(texts=st.lists(st.text(alphabet="<>[]|\\/sINST end_turnx\n", max_size=30), min_size=1, max_size=40))
def test_round_trip_of_any_text(spark, texts):
    check(spark, [(i // 4, i, ["user", "assistant"][i % 2], t) for i, t in enumerate(texts)])


def test_prefixes_and_masks(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo <|end|>"), (1, 2, "user", "bye"), (1, 3, "assistant", "ok"), (1, 4, "user", "tail")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    ex = chat.examples(df).orderBy("example").collect()
    assert [(x.example, x.target_turn) for x in ex] == [(2, 2), (4, 4), (5, None)]
    assert all(b.text.startswith(a.text) for a, b in zip(ex, ex[1:]))
    assert [x.text[x.loss_start:x.loss_end] for x in ex] == ["yo <\\|end|>", "ok", ""]
    assert ex[0].text == "<|turn|>user<|text|>hi<|end|><|turn|>assistant<|text|>yo <\\|end|><|end|>"
    per = chat.read_back(chat.examples(df)).first()
    assert per.formatted_chars == sum(len(x.text) for x in ex)


def test_escape_is_reversible_and_clean(spark):
    df = spark.createDataFrame([(x,) for x in ODD], "t string")
    got = df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect()
    assert all(x.t == x.u for x in got)
    assert not any(bad in x.e for x in got for bad in ("<|", "</s>", "<s>", "[INST]", "[/INST]"))


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.examples(df).collect() == [] and chat.read_back(chat.examples(df)).collect() == []


@pytest.fixture(scope="module", autouse=True)
def _quiet(spark):
    spark.sparkContext.setLogLevel("OFF")
    yield
    spark.sparkContext.setLogLevel("ERROR")


def test_no_row_gathers_all_example_texts(spark):
    """Of the examples' texts, quadratic in the turns, a row holds one: the
    only collected column is that of the replies."""
    df = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yo")], "conv_id long, turn long, role string, text string")
    ex = spark.createDataFrame(chat.examples(df).collect(), chat.examples(df).schema)
    plan = chat.read_back(ex)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list(") == 1 and "max_by(text" in plan
