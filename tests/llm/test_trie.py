"""The prefix trie against plain Python, over given and odd conversations."""

import random

import brute_new
import pytest
from pyspark.sql import functions as F

from placecount.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def nodes(spark, turns):
    frame = spark.createDataFrame(turns, SCHEMA)
    frame = frame.withColumns({c: F.lit("clash") for c in ("range", "number", "id", "block", "x", "depth", "k", "last")})
    return sorted(map(tuple, trie.trie(frame).select(*COLUMNS).collect()), key=repr)


def expected(turns):
    return sorted(brute_new.trie_rows(turns), key=repr)


def test_given_conversations(results, tables):
    got = results("op13_prefix_trie").astype(object)
    rows = [tuple(None if x != x else int(x) if isinstance(x, float) else x for x in r) for r in got[list(COLUMNS)].itertuples(index=False, name=None)]
    assert sorted(rows, key=repr) == expected(tables("conversations", "conv_id", "turn", "role", "text"))


def test_shared_prefixes(spark, monkeypatch):
    """Few different turns make deep shared paths; chunks are small enough to matter."""
    monkeypatch.setattr(trie, "CHUNK", 2)
    rng = random.Random(11)
    stock = [[("user", f"q{i}"), ("assistant", f"é{i}"), ("system", "")] for i in range(2)]
    turns = []
    for conv in range(120):
        length = rng.choice([1, 3, 8, 9, 16, 17, 40, 75])
        cut = rng.randrange(length + 1)
        for turn in range(length):
            role, text = stock[0 if turn < cut else rng.randrange(2)][turn % 3]
            turns.append((conv, turn, role, text))
    assert nodes(spark, turns) == expected(turns)


def test_odd_rows(spark):
    turns = [
        (0, None, None, None),
        (0, None, None, None),
        (0, 3, "user", "x" * 100_000),
        (0, 3, "assistant", "tie"),
        (1, 3, "user", "a"),
        (7, 1, "user", "its first turns go, and there is no conversation 5"),
        (-3, 1, "user", "below zero"),
        (-5, 1, "user", "the first of the five below zero"),
        (None, 1, "user", "no conversation"),
    ]
    # The remainder of a negative id keeps its sign: -3 takes from conversation 0.
    own = [t for t in turns if t[0] is None or t[0] >= 0]
    assert nodes(spark, own) == expected(own)
    assert sum(r[1] == 0 for r in nodes(spark, turns)) == 1
    assert nodes(spark, []) == []
    assert nodes(spark, [(None, 1, "user", "no conversation")]) == []


def test_only_turnless_conversations(spark):
    # 4 is taken down to nothing: its head of conversation 0 is absent, and h exceeds its turns.
    lost = [c for c in range(1, 60) if c % 5 and __import__("zlib").crc32(str(c).encode()) % 9 > 0][:3]
    turns = [(c, 0, "user", f"gone {c}") for c in lost]
    got = nodes(spark, turns)
    assert got == expected(turns)
    assert [(r[1], r[3], r[5]) for r in got] == [(0, 3, 1)]


@pytest.mark.parametrize("copies", [1, 400])
def test_a_hot_conversation(spark, copies):
    long = [(10, i, "user", f"turn {i % 50}") for i in range(3_000)]
    others = [(c, i, "user", f"turn {i}") for c in range(100, 100 + copies) for i in range(4)]
    assert nodes(spark, long + others) == expected_fast(long + others)


def expected_fast(turns):
    """As ``trie_rows``, for a path too long for its square."""
    rows = brute_new.trie_rows([t for t in turns if t[0] != 10 or t[1] < 60])
    assert rows
    own = brute_new.by_conversation(turns)
    path = own[10]
    short = {(r[0], r[1]): r for r in rows}
    # Beyond the shared part, nodes of conversation 10 are alone.
    empty, whole = brute_new.sha256(""), brute_new.sha256("10")
    end = len(path)
    out = [r for r in rows if not (r[0] == 10 and r[1] >= 30)]
    out += [(10, d, 10, 1, int(d < end), 1, 0, whole if d == end else empty) for d in range(30, end + 1)]
    assert short
    return sorted(out, key=repr)
