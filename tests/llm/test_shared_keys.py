"""Keys that several sets have, over batches of any size, against plain Python."""

import random
from collections import defaultdict

import pytest

from placecount.llm import jaccard


@pytest.mark.parametrize("batch", [1, 2, 7, 10_000])
def test_shared_keys(spark, batch):
    r = random.Random(batch)
    rows = [(r.choice([-5, 0, 3, 9, *range(100, 400)]), r.randrange(-40, 40)) for _ in range(600)]
    rows += rows[:50] + [(77, 1)] * 5 + [(78, v % 3) for v in range(30)]
    sets = defaultdict(set)
    for key, v in rows:
        sets[key].add(v)
    want = sorted((key, min(vs), v) for key, vs in sets.items() if len(vs) > 1 for v in vs)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = jaccard._shared(spark.createDataFrame(rows, "key long, v long"))
        assert sorted(map(tuple, got.collect())) == want
        assert jaccard._shared(spark.createDataFrame([], "key long, v long")).collect() == []
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_leaders_of_hot_keys(spark):
    rows = [(k, p, (v * 7) % 5, v) for k in range(3) for v in range(200) for p in [v % 4]]
    got = jaccard._leading(spark.createDataFrame(rows, "key long, part int, size long, v long"), 16)
    best = sorted((s, v) for k, _, s, v in rows if k == 0)[:16]
    assert sorted(map(tuple, got.collect())) == sorted((k, v) for k in range(3) for _, v in best)
