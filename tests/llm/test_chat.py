from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terraloom.llm import chat

PIECES = st.lists(st.sampled_from([*chat.CONTROL, chat.FILLER, "<", "|", "s>", "[", "INST]", "a", "\n", "/", "<<SYS>>x", chat.TURN, chat.BODY, chat.END]), max_size=12).map("".join)


@given(PIECES)
@settings(max_examples=400, deadline=None)
def test_escape_is_reversible_and_leaves_no_control(t):
    e = chat.escape(t)
    assert chat.unescape(e) == t
    assert not any(c in e for c in chat.CONTROL)


@given(PIECES, PIECES)
@settings(max_examples=200, deadline=None)
def test_a_turn_reads_back(role, body):
    v = chat.PartVisitor(role, chat.ChatParams(trained=(role,)))
    v.visit({"kind": "text", "text": body})
    out = v.finish()
    assert chat.read_turn(out) == (role, body)
    assert "".join(chat.unescape(out[a:b]) for a, b in v.spans) == body


def digest(turns):
    return hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns).encode()).hexdigest()


def test_conversations(spark):
    rows = [(1, 1, "assistant", "two"), (1, 0, "user", "one"), (2, 0, None, None), (None, 0, "assistant", "n"), (3, None, "assistant", "é</s>"), (3, 0, "user", ""), (3, 0, "user", ""), (4, 0, "assistant", "long " * 50_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in chat.conversation_digests(chat.format_turns(chat.from_texts(df))).collect()}
    assert set(out) == {1, 2, 3, 4, None}
    assert out[1].turns_sha256 == digest([("user", "one"), ("assistant", "two")])
    assert (out[1].n_turns, out[1].loss_chars, out[1].loss_sha256) == (2, 3, hashlib.sha256(b"two").hexdigest())
    assert out[2].turns_sha256 == digest([("", "")]) and out[2].loss_chars == 0
    assert out[3].n_turns == 3 and out[3].turns_sha256 == digest([("assistant", "é</s>"), ("user", ""), ("user", "")])
    assert out[4].loss_chars == 250_000
    assert chat.conversation_digests(chat.format_turns(chat.from_texts(df.limit(0)))).count() == 0


def test_parts(spark):
    part = lambda kind, **k: {f.name: k.get(f.name) for f in chat.PART.fields} | {"kind": kind}
    parts = [part("text", text="<"), part("text", text="|see "), part("image", ref="i.png", width=28, height=15), part("audio", ref="a", seconds=1.5), part("document", ref="d", pages=2), part("video", ref="v"), None, part("text", text=None), part(None)]
    df = spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, "user", None)], chat.StructType([chat.StructField("conv_id", chat.LongType()), chat.StructField("turn", chat.LongType()), chat.StructField("role", chat.StringType()), chat.StructField("parts", chat.ArrayType(chat.PART))])).withColumn("spans", F.lit(1))
    a, b = chat.format_turns(df).orderBy("turn").collect()
    assert a.formatted == f"{chat.TURN}assistant{chat.BODY}<{chat.FILLER}|see <|image:0|><|audio:1|><|document:2|><|other:3|><|other:4|>{chat.END}"
    assert [x.tokens for x in a.attachments] == [4, 38, 1024, 1, 1] and a.attachment_tokens == 1068
    assert [a.formatted[x.at :].startswith(f"<|{n}:{k}|>") for k, (x, n) in enumerate(zip(a.attachments, ("image", "audio", "document", "other", "other")))] == [True] * 5
    assert chat.unescape(a.formatted[a.spans[0].start : a.spans[0].end]) == "<|see "
    assert b.formatted == f"{chat.TURN}user{chat.BODY}{chat.END}" and b.spans == []


def test_overlapping_controls_are_refused(monkeypatch):
    monkeypatch.setattr(chat, "CONTROL", ("ab", "bc"))
    with pytest.raises(ValueError):
        chat._pattern("*")
