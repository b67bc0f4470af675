"""Chat formatting: replayed logs, reversible marks, and whole results against plain Python."""

import random

import brute_new
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from placecount.llm import chat

LOG = "conv_id long, msg long, seq long, kind string, role string, at int, cut int, text string"
MARKS = ("[INST]", "[/INST]", "<s>", "</s>", "[:]", "\\", "[", "<", "/", "]", ">", "INST]", "s>", "a", "\n", "\U0001F600")


def folded(frame):
    found = {}
    for r in chat.fold(frame).collect():
        found.setdefault(r.conv_id, []).append((r.seq, r.role, r.text))
    return {c: [m[1:] for m in sorted(ms)] for c, ms in found.items()}


def test_random_logs(spark):
    rng = random.Random(5)
    rows = []
    for conv in (1, 2, 3, None):
        for msg in range(30):
            seq = msg * 100
            rows.append((conv, msg, seq, "open", rng.choice(["user", "assistant", None]), None, None, None))
            for _ in range(rng.randrange(12)):
                seq += rng.randrange(1, 4)
                kind = rng.choice(["delta", "delta", "delta", "edit", "regenerate", "seen"])
                text = "".join(rng.choices("ab\U0001F600 ", k=rng.randrange(6))) or None
                edit = kind == "edit"
                at, cut = (rng.choice([None, -2, 0, 1, 3, 99]) if edit else None for _ in range(2))
                rows.append((conv, msg, seq, kind, None, at, cut, text))
    want = brute_new.replay(rows)
    rng.shuffle(rows)
    assert folded(spark.createDataFrame(rows, LOG)) == want


def test_odd_logs(spark):
    rows = [
        (1, 1, 5, "delta", None, None, None, "no open event"),
        (1, 2, 1, "open", "assistant", None, None, None),
        (1, 2, 2, "delta", None, None, None, "b"),
        (1, 2, 2, "delta", None, None, None, "a"),
        (1, 2, 2, "delta", None, None, None, "a"),
        (2, 1, None, "regenerate", None, None, None, None),
    ]
    assert folded(spark.createDataFrame(rows, LOG)) == {1: [("assistant", "aab"), ("", "no open event")], 2: [("", "")]}
    assert folded(spark.createDataFrame([], LOG)) == {}
    many = [(1, 1, i, "delta", None, None, None, f"{i} ") for i in range(20_000)]
    assert folded(spark.createDataFrame(many, LOG)) == {1: [("", "".join(f"{i} " for i in range(20_000)))]}


def back(spark, turns):
    """The turns and the learnt text of each conversation, read from what was written."""
    schema = "conv_id long, turn long, role string, text string"
    frame = spark.createDataFrame(turns, schema).withColumns({c: F.lit("clash") for c in ("msg", "seq", "e", "kind", "n")})
    out = chat.format_log(chat.log_of(frame)).select(
        "conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"), chat.under_loss(F.col("segments")).alias("learnt")
    )
    return {r.conv_id: ([tuple(t) for t in r.turns], r.learnt, r.formatted) for r in out.collect()}


def test_texts_of_marks_come_back(spark):
    rng = random.Random(3)
    turns = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 7)):
            role = rng.choice(["user", "assistant", "".join(rng.choices(MARKS, k=4))])
            turns.append((conv, turn, role, "".join(rng.choices(MARKS, k=rng.randrange(40)))))
    found = back(spark, turns)
    for conv, want in brute_new.by_conversation(turns).items():
        got, learnt, formatted = found[conv]
        assert got == want
        assert learnt == "".join(t for r, t in want if r == "assistant")
        assert formatted.count("</s>") == sum(r == "assistant" for r, _ in want)


def test_odd_turns(spark):
    turns = [
        (1, None, "user", "first, as its turn is null"),
        (1, 0, None, None),
        (1, 1, "assistant", "x" * 200_000),
        (1, 1, "assistant", "x" * 200_000),
        (1, 1, "assistant", ""),
        (None, 3, "user", "no id"),
    ]
    found = back(spark, turns)
    assert {c: got for c, (got, *_) in found.items()} == brute_new.by_conversation(turns)
    assert found[1][1] == "x" * 400_000
    assert back(spark, []) == {}


def test_given_conversations(results, tables):
    got = results("op12_chat_format")
    turns = brute_new.by_conversation(tables("conversations", "conv_id", "turn", "role", "text"))
    turns[-1] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"]
    assert sorted(got[columns].itertuples(index=False, name=None)) == sorted(brute_new.chat_rows(turns))
    assert (got.formatted_chars > got.loss_chars).all()


def test_no_python_on_the_way(spark, sf_dir):
    from placecount.llm.queries import op12_chat_format

    plan = op12_chat_format(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


@pytest.fixture(scope="module")
def escaped(spark):
    def run(texts):
        frame = spark.createDataFrame([(t,) for t in texts], "text string")
        both = frame.select("text", chat.escape(F.col("text")).alias("e")).select("text", "e", chat.unescape(F.col("e")).alias("u"))
        return both.collect()

    return run


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from(MARKS), max_size=30).map("".join), min_size=30, max_size=60))
def test_escaping_is_reversible(escaped, texts):
    for text, hidden, shown in escaped(texts):
        assert shown == text
        assert not any(mark in hidden for mark in (chat.OPEN, chat.CLOSE, chat.LOSS_OPEN, chat.LOSS_CLOSE, chat.SAYS))
