"""The classifier: what it finds on given labels, few labels and none, and its score in plain Python."""

import re
from collections import Counter
from math import exp, isclose

import pytest
from pyspark.sql import functions as F

from placecount.llm import toxicity

#: Least recall of toxic rows and largest share of rejected clean rows, over all labels and those held out.
#: sf0.01 has 45 labels to learn from, and four languages: the words of one are in three or four rows.
FOUND = {"sf0.01": (0.75, 0.0), "sf0.1": (0.9, 0.02)}


@pytest.mark.parametrize("sf", FOUND)
def test_given_labels(spark, sf):
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score(docs, toxicity.fit(docs, labels), keep=("doc_id",)).withColumnRenamed("toxic", "predicted")
    rows = scored.join(labels, "doc_id").select(
        (toxicity.fold(F.col("doc_id")) == 0).alias("held_out"), F.col("toxic"), F.col("predicted").cast("int")
    ).collect()
    least, most = FOUND[sf]
    for part in (rows, [r for r in rows if r[0]]):
        toxic, clean = ([r[2] for r in part if r[1] == y] for y in (1, 0))
        assert len(toxic) >= 5 and len(clean) > 50
        assert sum(toxic) >= (least if part is rows or sf == "sf0.1" else 0.6) * len(toxic)
        assert sum(clean) <= most * len(clean)


def plain_score(text, model):
    words = set(re.findall(r"[^\W\d_]+", (text or "").lower()))
    logit = model.bias
    for feature, weight in model.weights.items():
        beginning = feature.rstrip("*")
        stars = len(feature) - len(beginning)
        sharing = sum(w.startswith(beginning) for w in words)
        logit += weight * (sharing >= stars if stars else feature in words)
    return 1 / (1 + exp(-logit))


def test_scores_in_plain_python(spark, results, tables, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    assert model.weights
    got = results("op2_toxicity").set_index("doc_id")
    for doc_id, text in tables("documents", "doc_id", "text"):
        assert isclose(got.score[doc_id], plain_score(text, model), rel_tol=1e-9)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


@pytest.mark.parametrize("toxic,clean,share", [(3, 5, 0.25), (1, 9, 0.1), (0, 5, toxicity.PRIOR), (5, 0, toxicity.PRIOR), (0, 0, toxicity.PRIOR)])
def test_labels_that_teach_nothing(spark, toxic, clean, share):
    """Texts of the same words: all score the labelled share, and none is rejected."""
    ids = [i for i in range(1, 80) if __import__("zlib").crc32(str(i).encode()) % 5][: toxic + clean]
    rows = frame(spark, [(i, "all alike", int(k < toxic)) for k, i in enumerate(ids)])
    model = toxicity.fit(rows, rows)
    assert model.weights == {}
    assert model.score_all([None, "", "all alike", "other words"]) == pytest.approx([share] * 4)


def test_few_labels_of_one_word(spark):
    rows = frame(spark, [(i, f"plain words n{i} {'vile' if i % 8 == 0 else 'kind'} talk", int(i % 8 == 0)) for i in range(100)])
    model = toxicity.fit(rows, rows)
    assert model.score_all(["so vile"])[0] > 0.5
    assert model.score_all(["", "unknown", "kind talk"]).max() < 0.25


def test_noise_alone_is_no_evidence(spark):
    """Labels drawn at random over texts of many words: next to nothing may be used."""
    import random

    r = random.Random(2)
    rows = [(i, " ".join(f"w{r.randrange(3_000)}" for _ in range(40)), int(r.random() < 0.15)) for i in range(400)]
    model = toxicity.fit(frame(spark, rows), frame(spark, rows))
    assert len(model.weights) <= 4
    assert (model.score_all([t for _, t, _ in rows]) >= 0.5).mean() <= 0.02


def test_false_discoveries():
    assert toxicity.told_apart([], 10) == 0
    assert toxicity.told_apart([40.0, 1.0, 0.5], 1_000) == 1
    assert toxicity.told_apart([11.0] * 5, 10) == 5
    assert toxicity.told_apart([11.0], 10_000) == 0


def test_shared_beginnings():
    found = Counter(toxicity.text_features({"hatred", "hateful", "haze"}))
    assert {"hate*", "hate**", "hatef*", "hatred"} - found.keys() == {"hate*", "hate**"} - found.keys()
    assert "hatr*" in found and "hatr**" not in found
    assert toxicity.text_features({"hatefuls", "hatefully"}) >= {"hate**", "hatef**", "hatefu**"}


def test_words_remembered_are_few():
    model, cache = toxicity.Model({"vile": 1.0}, -2.0), {}
    as_letters = str.maketrans("0123456789", "abcdefghij")
    for start in range(0, 100_000, 10_000):
        words = " ".join(str(i).translate(as_letters) for i in range(start, start + 10_000))
        assert isclose(model.score_all([f"{words} vile"], cache)[0], 1 / (1 + exp(1.0)))
        assert len(cache) <= 50_000
