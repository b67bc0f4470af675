"""Every language has a reference, whatever share of the corpus it has."""

import pytest

from placecount.llm import quality


@pytest.mark.parametrize("sent", [quality.SENT_LANGUAGES, 2])
def test_small_languages_are_judged_in_large_mixes(spark, monkeypatch, sent):
    """The same verdicts and distances alone, in a large mix, and joined instead of sent."""
    small = []
    for k, lang in enumerate(("aa", "bb", None)):
        small += [(100 * k + i, " ".join(["the", "of", "and", f"word{i}"] * 30 + [f"w{k}"]), lang) for i in range(20)]
        small.append((100 * k + 99, " ".join(f"§{i}§{i * 7}§" for i in range(100)), lang))
    large = [(1000 + i, " ".join(f"some{i % 50} many{j % 60} more" for j in range(5000)), f"l{i % 2}") for i in range(800)]

    def judged(rows):
        frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        return {r.doc_id: (r.class_distance, r.word_distance, r.kept) for r in quality.judge(frame).collect()}

    alone = judged(small)
    monkeypatch.setattr(quality, "SENT_LANGUAGES", sent)
    mixed = judged(small + large)
    assert len(mixed) == len(small) + len(large)
    for i, row in alone.items():
        assert mixed[i][:2] == pytest.approx(row[:2]) and mixed[i][2] == row[2]
        assert row[1] is not None and row[0] is not None
    assert not any(mixed[100 * k + 99][2] for k in range(3))
