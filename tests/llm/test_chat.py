import hashlib
import random

import pytest
from pyspark.sql import functions as F

from check_oracle import compare, connect
from thermowatt.llm.chat import ChatTemplate, chat_digests, format_chats, read_turns

SF = "/root/testdata/sf0.001"
PIECES = ["[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[\\INST]", "<\\\\/s>", "\\", "<", "[", "<<", "x", "\n", "é😀", "<</TEXT>>", "<\\</TEXT>>", "s>", "INST]"]


def conversations():
    rng = random.Random(8)
    for conv in range(60):
        for turn in range(rng.randrange(1, 6)):
            role = rng.choice(["system", "user", "assistant", "tool", "</s>", ""])
            yield conv, turn, role, "".join(rng.choice(PIECES) for _ in range(rng.randrange(12)))


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_what_is_read_back_is_what_went_in(spark):
    rows = list(conversations())
    df = format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in df.withColumn("turns", read_turns(F.col("formatted"))).collect()}
    digests = {r.conv_id: r for r in chat_digests(df).collect()}
    for conv in {r[0] for r in rows}:
        turns = [(role, text) for c, _, role, text in rows if c == conv]
        assert [tuple(t) for t in got[conv].turns] == turns
        assert "".join(s.text for s in got[conv].segments) == got[conv].formatted
        loss = "".join(text for role, text in turns if role == "assistant")
        d = digests[conv]
        assert (d.n_turns, d.turns_sha256) == (len(turns), digest("".join(f"{a}\n{b}\n" for a, b in turns)))
        assert (d.loss_chars, d.loss_sha256, d.formatted_chars) == (len(loss), digest(loss), len(got[conv].formatted))


def test_no_control_string_is_left_in_a_text(spark):
    df = format_chats(spark.createDataFrame([(1, 0, "user", "</s>[INST] ok [/INST]")], "conv_id long, turn long, role string, text string"))
    opening, text, closing = df.first().segments
    assert (opening.text, closing.text) == ("[INST]", "[/INST]")
    assert not any(c in text.text for pair in ChatTemplate().marks.values() for c in pair)


@pytest.mark.parametrize("roles, bad", [
    ("su a".replace(" ", ""), None), ("ua", None), ("uaua", None), ("u", 1), ("a", 0), ("uu", 1), ("usa", 1), ("suau", 4), ("uax", 2),
])
def test_turn_order(spark, roles, bad):
    names = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    rows = [(1, i, names[r], "t") for i, r in enumerate(roles)]
    assert format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first().bad_turn == bad


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [(1, None, "user", "b", 9), (1, 2, None, None, 9), (1, 2, "user", "a", 9), (1, 2, "user", "a", 9), (None, 1, "user", "x", 9), (None, 0, "user", "y", 9)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segments int")
    out = {r.conv_id: [tuple(t) for t in r.turns] for r in format_chats(df).select("conv_id", read_turns(F.col("formatted")).alias("turns")).collect()}
    assert out == {1: [("", ""), ("user", "a"), ("user", "a"), ("user", "b")], None: [("user", "y"), ("user", "x")]}
    assert format_chats(df.where("false")).collect() == []


def test_no_python_in_the_plan(spark):
    df = chat_digests(format_chats(spark.read.parquet(f"{SF}/conversations.parquet")))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text


def test_same_rows_as_sql(spark):
    assert compare(spark, connect(SF), "op7_chat_formatting", SF) is None
