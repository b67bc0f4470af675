"""The runs that an encoder remembers."""

import random
import sys

from placecount.llm import pieces
from placecount.llm.queries import MODEL_FILE

TEXTS = ["a  b\tc ▁d \U0001f9ff�", " two  words", "", "plain words and plain words", "▁▁ x", "é"]


def encoded(vocabulary, text):
    runs = vocabulary.runs(text)
    vocabulary.learn([runs])
    return vocabulary.known(runs)


def test_runs_forgotten_and_known_again(monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_RUNS", 3)
    vocabulary = pieces.Vocabulary(MODEL_FILE)
    for text in TEXTS * 3:
        ids = vocabulary.library.encode(text)
        assert encoded(vocabulary, text) == (" ".join(map(str, ids)), len(ids), vocabulary.library.decode(ids))
        assert not vocabulary._runs.keys() & vocabulary._older.keys()


def test_a_run_is_remembered_in_few_bytes():
    vocabulary = pieces.Vocabulary(MODEL_FILE)
    encoded(vocabulary, " ".join(f"w{i}" for i in range(5_000)))

    def size(x):
        return sys.getsizeof(x) + (sum(map(size, x)) if isinstance(x, tuple) else 0)

    held = sum(map(size, vocabulary._runs.values())) + sum(map(size, vocabulary._decoded.values()))
    assert len(vocabulary._runs) == 5_000 and held < 5_000 * 80
    assert 2 * pieces.CACHE_RUNS * 300 < 200e6  # with keys and tables


def test_runs_remembered_are_few():
    vocabulary = pieces.Vocabulary(MODEL_FILE, check=False)
    for start in range(0, 250_000, 10_000):
        vocabulary.learn([[f"▁{i:06d}" for i in range(start, start + 10_000)]])
        assert len(vocabulary._runs) + len(vocabulary._older) <= 150_000


def test_runs_of_equal_length_are_joined_side_by_side(monkeypatch):
    vocabulary = pieces.Vocabulary(MODEL_FILE)
    rng = random.Random(5)
    signs = "aaabeeilnorst.,\n\tÉéêèüß中文\U0001f9ff\u0301\ufffd0189"
    runs = [
        rng.choice(["▁", "▁▁", ""]) + "".join(rng.choices(signs, k=size)) for size in range(1, 46) for _ in range(40)
    ]
    runs += ["▁"] * 9 + ["▁▁▁▁"] * 9 + ["▁" + "a" * 60] * 9 + ["▁<0x41>", "▁"]
    one_by_one = [vocabulary.encode_run(run) for run in runs]
    assert vocabulary.encode_runs(runs) == one_by_one
    in_order = sorted(runs, key=len)
    assert vocabulary.encode_runs(in_order) == [vocabulary.encode_run(run) for run in in_order]
    assert vocabulary.encode_runs([]) == []

    def never(run):
        raise AssertionError("joined alone")

    monkeypatch.setattr(vocabulary, "encode_run", never)
    alike = [f"▁w{i:04d}\U0001f9ff" for i in range(500)]
    vocabulary.learn([alike])
    assert len(vocabulary._runs) == 500


def test_equal_scores_join_the_first_pair():
    vocabulary = pieces.Vocabulary(MODEL_FILE)
    vocabulary.scores = {piece: -float(len(piece) % 3) for piece in vocabulary.scores}
    vocabulary._pair_keys, vocabulary._joined, vocabulary._ranks = vocabulary._pairs()
    rng = random.Random(6)
    runs = ["▁" + "".join(rng.choices("aeinrst", k=9)) for _ in range(300)]
    assert vocabulary.encode_runs(runs) == [vocabulary.encode_run(run) for run in runs]
