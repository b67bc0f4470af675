"""Each stage of the pipeline against plain Python, on what the stage before kept."""

from collections import Counter

import brute
import pytest

import corpus_pipeline as cp
from placecount.llm import toxicity
from placecount.session import durable


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = [docs]
    for _, stage in cp.STAGES:
        found.append(durable(stage(spark, found[-1], sf_dir)))
    return found


def as_rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_columns(stages):
    assert all(tuple(s.columns) == cp.COLUMNS for s in stages[:5])


def test_most_documents_stay(stages):
    """No stage compares empty frames: a tenth is toxic or a copy at most."""
    n = [s.count() for s in stages]
    assert n[0] == 200 and n[1] >= 180 and n[2] >= 0.8 * n[1]
    assert n[3] == n[2] and n[4] >= 0.5 * n[3] and n[5] == n[4]


def test_toxic_documents_go(spark, sf_dir, stages):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(stages[0], labels)
    want = [i for i, t in as_rows(stages[0], "doc_id", "text") if model.score_all([t])[0] < 0.5]
    assert sorted(i for (i,) in as_rows(stages[1], "doc_id")) == sorted(want)
    assert len(want) <= stages[0].count()
    clean = {i for i, y in as_rows(labels, "doc_id", "toxic") if y == 0}
    assert len(clean & set(want)) >= 0.98 * len(clean)


def test_one_document_of_each_class(stages):
    classes = brute.jaccard_components(as_rows(stages[1], "doc_id", "text"), 5, 80)
    want = sorted(i for i, _, root in classes if i == root)
    assert sorted(i for (i,) in as_rows(stages[2], "doc_id")) == want


def test_live_secrets_are_masked(stages):
    before = as_rows(stages[2], "doc_id", "source", "text")
    live = brute.live_secrets(before)
    want = sorted((i, t if i not in live else brute.masked(t, live[i])) for i, _, t in before)
    got = as_rows(stages[3], "doc_id", "text", "n_chars")
    assert sorted((i, t) for i, t, _ in got) == want
    assert all(n == len(t) for _, t, n in got)


def test_mix(spark, sf_dir, stages):
    quality = dict(as_rows(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id", "quality"))
    want = brute.mixed(as_rows(stages[3], "doc_id", "source", "text"), quality)
    got = Counter(i for (i,) in as_rows(stages[4], "doc_id"))
    assert got == Counter({i: n for i, n in want.items() if n})


def test_encoding(stages):
    import sentencepiece

    from placecount.llm.queries import MODEL_FILE

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL_FILE.__fspath__())
    texts = dict(as_rows(stages[4], "doc_id", "text"))
    rows = as_rows(stages[5], "doc_id", "n_tokens", "ids_sha256", "ids")
    assert len(rows) == stages[4].count()
    for i, n, digest, ids in rows:
        want = library.encode(texts[i], add_eos=True)
        assert (n, list(ids)) == (len(want), want)
        assert digest == brute.sha256(" ".join(map(str, want)))


def test_run(spark, sf_dir, stages):
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert Counter(as_rows(cp.run(spark, sf_dir), *columns)) == Counter(as_rows(stages[5], *columns))
