"""The Jaccard join against all pairs, and the bounds it rests on."""

import random

import brute
import numpy as np
import pytest
from placecount.llm import components, jaccard
from placecount.llm.text import mix


def texts(seed):
    """Groups of edited copies, many of them near the limit, some sharing a long line."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    line = [r.choice(vocabulary) for _ in range(40)]
    found = []
    for _ in range(25):
        base = [r.choice(vocabulary) for _ in range(r.choice([1, 3, 4, 5, 8, 12, 20, 40, 60, 100, 200, 400]))]
        base += line if r.random() < 0.4 else []
        for _ in range(r.choice([1, 2, 3, 6])):
            words = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, len(base) // 60 + 1, len(base) // 40 + 1])):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            found.append(" ".join(words))
    base = [r.choice(vocabulary) for _ in range(80)]
    for _ in range(40):  # one group whose members often do not link with each other
        words = list(base)
        for _ in range(r.randrange(0, 5)):
            words[r.randrange(len(words))] = r.choice(vocabulary)
        found.append(" ".join(words))
    return list(enumerate(found))


@pytest.mark.parametrize("k,percent,leaders", [(4, 85, 64), (5, 80, 1)])
def test_classes_of_all_pairs(spark, monkeypatch, k, percent, leaders):
    monkeypatch.setattr(jaccard, "LEADERS", leaders)
    monkeypatch.setattr(jaccard, "MEMBERS_PER_TASK_ROW", 5)
    monkeypatch.setattr(jaccard, "COMPARED_PER_LEADER_ROW", 3)
    docs = texts(k)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(tuple(r) for r in jaccard.link_classes(frame, k, percent).collect())
    assert got == brute.jaccard_components(docs, k, percent)


@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_linked_sets_meet_and_sketches_bound(percent):
    r = np.random.default_rng(percent)
    for _ in range(400):
        n = int(r.choice([1, 2, 3, 5, 7, 8, 15, 16, 31, 33, 64, 200, 1000]))
        base = np.unique(mix(r.integers(0, 2**63, n).astype(np.uint64)))
        gone = r.integers(0, max(1, n * (100 - percent) // 100) + 1)
        added = r.integers(0, max(1, n * (100 - percent) // 100) + 1)
        other = np.unique(np.concatenate([r.permutation(base)[gone:], mix(r.integers(0, 2**63, added).astype(np.uint64))]))
        if not len(other):
            continue
        both = len(np.intersect1d(base, other))
        difference = len(base) + len(other) - 2 * both
        assert jaccard.hamming(jaccard.parity_sketch(base), jaccard.parity_sketch(other)) <= difference
        if difference and 100 * both >= percent * (len(base) + len(other) - both):
            assert difference <= jaccard.max_difference(len(base) + len(other), percent)
            assert len(np.intersect1d(jaccard.part_keys(base, percent), jaccard.part_keys(other, percent)))


@pytest.mark.parametrize("edges_of_task", [10, 10**6])
def test_components_of_a_path_and_a_star(spark, monkeypatch, edges_of_task):
    monkeypatch.setattr(components, "EDGES_OF_TASK", edges_of_task)
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (201, 200), (200, 201)]
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    roots = {r.v: r.root for r in found.collect()}
    assert roots == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}
    none = spark.createDataFrame([], "a long, b long")
    assert components.components(none).collect() == []


def test_a_crowd_makes_no_more_pairs_than_rows(spark):
    """Sets that all link under one key, sixteen of them leading."""
    rows = [(7, v, v, 0, 1, True if v < 16 else None) for v in range(400)]
    marked = spark.createDataFrame(rows, "key long, v long, root long, part int, parts int, leads boolean")
    vertices = spark.createDataFrame([(v, 50, bytes(16)) for v in range(400)], "v long, n long, sketch binary")
    pairs = [tuple(r) for r in jaccard._near_pairs(marked, vertices, 85).collect()]
    assert len(pairs) == 399
    joined = spark.createDataFrame(pairs, "a long, b long")
    assert {r.root for r in components.components(joined).collect()} == {0}


@pytest.mark.parametrize("all_lead,most_passes", [(4096, 2), (2, None)])
def test_parts_with_few_sets_take_one_round(spark, monkeypatch, all_lead, most_passes):
    """Two passes settle them however few lead at first; crowds go on in rounds."""
    passes = []
    near_pairs = jaccard._near_pairs

    def counted(marked, vertices, *more):
        keys = marked.select("v").distinct()
        passes.append(vertices.join(keys, "v", "left_anti").isEmpty() or more[-1])
        return near_pairs(marked, vertices, *more)

    monkeypatch.setattr(jaccard, "_near_pairs", counted)
    monkeypatch.setattr(jaccard, "ALL_LEAD", all_lead, raising=False)
    monkeypatch.setattr(jaccard, "LEADERS", 1)
    monkeypatch.setattr(jaccard, "_PAIRS_OF_BATCH", 3, raising=False)
    monkeypatch.setattr(jaccard, "_COMPARED_BYTES", 500, raising=False)
    docs = texts(11)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(tuple(r) for r in jaccard.link_classes(frame, 5, 80).collect())
    assert got == brute.jaccard_components(docs, 5, 80)
    assert passes and all(passes)  # sketches of the sets taken up only
    assert most_passes is None or len(passes) <= most_passes


def test_near_compares_in_steps(monkeypatch):
    r = np.random.default_rng(5)
    rows = [(v, v % 7, 40, r.integers(0, 4, 32, np.uint8).tobytes()) for v in range(60)]
    want = {
        (a[0], b[0])
        for a in rows
        for b in rows
        if a[0] < b[0] and a[1] != b[1] and jaccard.hamming(a[3], b[3]) <= jaccard.max_difference(80, 50)
    }
    for size in (1, 3000, 1 << 20):
        monkeypatch.setattr(jaccard, "_COMPARED_BYTES", size, raising=False)
        assert jaccard._near(rows, rows, 50) == want
    assert 0 < len(want) < 1500
