"""Every registered query against plain Python over a small table."""

import brute
import numpy as np
import pytest


def rows(frame, *columns):
    cells = zip(*(frame[c].tolist() for c in columns))
    return sorted(tuple(None if x != x else x for x in row) for row in cells)


def test_warc(results, tables):
    got = results("op3_warc")
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert rows(got, *columns) == brute.warc(tables("pages", "page_id", "html"))


def test_edited_texts(results, tables):
    got = results("op5_fingerprint")
    docs = tables("documents", "doc_id", "text")
    assert rows(got, "doc_id", "n_chars", "edited_sha256") == brute.edited(docs)
    text = dict(docs)
    by_print = {}
    for doc_id, fingerprint in rows(got, "doc_id", "fingerprint"):
        by_print.setdefault(text[doc_id], set()).add(fingerprint)
    assert all(len(prints) == 1 for prints in by_print.values())


def test_likeness_follows_jaccard(results, tables):
    got = results("op5_fingerprint").set_index("doc_id")
    docs = sorted(tables("documents", "doc_id", "text"), reverse=True)
    errors, near = [], []
    for (i, text), (_, after) in zip(docs, docs[1:] + docs[:1]):
        cut = len(text) // 3
        a, b = brute.shingles(text, 5), brute.shingles(text[: len(text) - cut] + after[:cut], 5)
        if len(a) >= 200:
            errors.append(got.near_edited[i] - len(a & b) / len(a | b))
            near.append(got.near_next[i])
    assert abs(np.mean(errors)) < 0.03 and np.abs(errors).max() < 0.3
    assert np.mean(near) < 0.1


def test_base_secrets(results, tables):
    got = results("op7_secret_scan")
    want = []
    for doc_id, text in tables("documents", "doc_id", "text"):
        spans = brute.base_spans(text)
        kinds = [sum(kind == k for _, kind, _ in spans) for k in range(3)]
        want.append((doc_id, *kinds, brute.sha256(brute.describe(spans))))
    assert rows(got, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == sorted(want)
    described = {i: brute.describe(brute.base_spans(t)) for i, t in tables("documents", "doc_id", "text")}
    for doc_id, spans in rows(got, "doc_id", "spans"):
        assert set(filter(None, described[doc_id].split(","))) <= set(spans.split(","))


def test_verdicts_on_secrets(results, tables):
    """Owners and repositories of every candidate, and what follows from them."""
    got = results("op7_secret_scan")
    judged = brute.judged_secrets(tables("documents", "doc_id", "source", "text"))
    kinds = ("assign", "access", "hex", "owned")
    for doc_id, spans, live, found in rows(got, "doc_id", "spans", "live_spans", "candidates"):
        want = judged.get(doc_id, [])
        assert found == ",".join(f"{kinds[k]}:{s}:{e}:{n}:{m}:{'live' if y else 'example'}" for s, k, e, n, m, y in want)
        assert live == ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e, *_, y in want if y)
        assert set(live.split(",")) - {""} <= set(spans.split(","))


def test_both_verdicts_on_more_documents(spark):
    """The small table holds no candidate; these do, and a made-up example spread over them."""
    from placecount.llm import secret_scan
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source", "text")
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 50 == 0, F.concat("text", F.lit(" password = changeme99"))).otherwise(F.col("text")))
    judged = brute.judged_secrets([tuple(r) for r in docs.collect()])
    got = secret_scan.scan(docs, F.col("source"), F.col("doc_id")).where("size(candidates) > 0").collect()
    found = {r.doc_id: [(c.start, c.kind, c.end, c.owners, c.repos, c.looks_live) for c in r.candidates] for r in got}
    assert found == judged
    assert {c[5] for cs in found.values() for c in cs} == {True, False}


def test_pieces(results, tables):
    import sentencepiece

    from placecount.llm.queries import MODEL_FILE

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL_FILE.__fspath__())
    want = []
    for doc_id, text in tables("documents", "doc_id", "text"):
        ids = library.encode(text or "", add_eos=True)
        want.append((doc_id, len(ids), brute.sha256(" ".join(map(str, ids))), brute.sha256(library.decode(ids))))
    assert rows(results("op8_sentencepiece"), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want)


def test_quality_base(results, tables):
    got = results("op9_quality_rules")
    want = [(i, *brute.quality(t)) for i, t in tables("documents", "doc_id", "text")]
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert rows(got, "doc_id", *columns) == sorted(want)
    assert not (got.base_failed & got.kept).any()
    assert got.kept[~got.base_failed].mean() > 0.9


def test_mix_meets_targets(results):
    got = results("op1_mix_sources")
    source = got.groupby(["source_size", "target"]).agg(taken=("taken", "sum"), largest=("size", "max")).reset_index()
    assert ((source.taken - source.target).abs() <= source.largest / 2 + 1e-6).all()
    assert (got.taken <= 3 * got["size"]).all()
    assert got["size"].sum() == pytest.approx(source.target.sum())


def test_toxicity_on_the_held_out_rows(results, tables):
    got = results("op2_toxicity").set_index("doc_id")
    labels = dict(tables("labels", "doc_id", "toxic"))
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    assert all(got.held_out[i] == (brute.fold(i) == 0) for i in got.index)
    right = [got.predicted[i] == y for i, y in labels.items() if i in got.index and got.held_out[i]]
    assert np.mean(right) > 0.8


@pytest.mark.parametrize(
    "name",
    ["op1_mix_sources", "op3_warc", "op4_url_filter", "op6_jaccard_join", "op12_chat_format", "op13_prefix_trie"],
)
def test_sql(name, results, sf_dir):
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from compare import canonical, oracle_connection

    from placecount.llm.oracle import oracle_sql

    want = oracle_connection(sf_dir).execute(oracle_sql()[name]).df()
    assert canonical(results(name)) == canonical(want)


def test_jaccard_components(results, tables):
    got = results("op6_jaccard_join")
    want = brute.jaccard_components(tables("documents", "doc_id", "text"))
    assert rows(got, "doc_id", "n_shingles", "component_id") == want


def test_language_model(results, tables):
    got = results("op10_suffix_tree")
    want = brute.unigrams(tables("documents", "doc_id", "text"))
    exact = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    assert rows(got, *exact) == [row[:-1] for row in want]
    assert np.allclose(got.sort_values("doc_id").base_score, [row[-1] for row in want], rtol=1e-9)
    held_out = got[got.held_out]
    assert held_out.score.sum() > held_out.base_score.sum()
