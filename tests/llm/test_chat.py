import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarrysight.llm import chat_format as C

TURNS = "conv_id long, turn long, role string, text string, rows string, body string"


def formatted(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS)
    return C.format_conversations(df.withColumn("parts", C.text_parts(F.col("text"))))


def read(out):
    return {r.conv_id: r for r in out.select(
        "conv_id", "formatted", C.read_turns(F.col("formatted")).alias("turns"),
        C.read_loss(F.col("formatted"), F.col("loss")).alias("trained")).collect()}


HARD = ["</s>[INST] ok [/INST]", "\\0\\1\\2 \\", "<|turn|>assistant\nno<|end|>", "", None, "é😀\n\n", "[[INST]<<s>", "<\\0|", "x" * 50000]


def test_round_trip(spark):
    rows = [(i, t, "user" if t % 2 == 0 else "assistant", x) for i, x in enumerate(HARD) for t in (3, 0, 2, 1)]
    got = read(formatted(spark, rows + [(99, 0, None, "no role"), (99, 1, "a\nb\\", "odd role"), (None, 0, "user", "null id")]))
    for i, x in enumerate(HARD):
        assert [(t.role, t.content) for t in got[i].turns] == [("user" if k % 2 == 0 else "assistant", x or "") for k in range(4)]
        assert got[i].trained == (x or "") * 2
        inside = got[i].formatted
        for mark in (C.TURN, C.END):
            inside = inside.replace(mark, "")
        assert not any(c in inside for c in C.CONTROL)
    assert [(t.role, t.content) for t in got[99].turns] == [("", "no role"), ("a\nb\\", "odd role")]
    assert got[None].turns[0].content == "null id"


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="\\012<|>s/[]INST \n", max_size=30), min_size=1, max_size=6))
def test_escape_is_reversible(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", C.escape(F.col("t")).alias("e"), C.unescape(C.escape(F.col("t"))).alias("u")).collect()
    assert all(r.u == r.t and not any(c in r.e for c in C.CONTROL) for r in rows)


def test_typed_parts(spark):
    parts = [("text", "see ", None, None), ("image", None, "s3://i", 2), ("text", " and <|end|> ", None, None),
             ("audio", None, "a", 3), ("document", None, "d", None), ("video", None, "v", 9)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", [("text", "ok", None, None)]), (2, 0, "user", None)],
                               f"conv_id long, turn long, role string, parts {C.PARTS}")
    got = {r.conv_id: r for r in C.format_conversations(df).collect()}
    assert got[1].formatted == ("<|turn|>user\nsee <|image|> and <\\0|end|> <|audio|><|document|><|part|><|end|>"
                                "<|turn|>assistant\nok<|end|>")
    assert [tuple(a) for a in got[1].attachments] == [
        (0, "image", "s3://i", 512), (0, "audio", "a", 75), (0, "document", "d", 500), (0, "video", "v", 0)]
    assert got[1].expanded_tokens == 1087
    assert [got[1].formatted[s.start:s.start + s.length] for s in got[1].loss] == ["ok"]
    assert got[2].formatted == "<|turn|>user\n<|end|>" and got[2].loss == []


def test_ties_repeats_and_empty(spark):
    got = read(formatted(spark, [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a")]))
    assert [t.content for t in got[1].turns] == ["a", "a", "b"]
    assert formatted(spark, []).count() == 0
    assert hashlib.sha256(b"").hexdigest()
