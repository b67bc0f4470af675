"""Token alignment: products of sparse matrices, and whole results against brute force."""

import brute_new
import numpy as np
import pytest
from pyspark.sql import functions as F

from placecount.llm import alignment
from placecount.llm.alignment import Csr
from placecount.llm.queries import BYTE_LEVEL_FILE, MODEL_FILE

FILES = BYTE_LEVEL_FILE.__fspath__(), MODEL_FILE.__fspath__()
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared")
ODD = [
    (1, ""),
    (2, None),
    (3, " "),
    (4, "\U0001F600\U0001F9D1‍\U0001F680 naïve 東京 ÄÖÜ \u0000 x"),
    (5, "a mark ▁ of spaces"),  # B gives a space back
    (6, "<|endoftext|> and </s> <s> <unk> <0x41>"),
    (7, "the same words"),
    (7, "the same words"),
    (None, "the same words twice \n\n\t over"),
    (8, "z" * 5000 + "é" * 3000 + " word" * 20_000),
    (9, "\r\n  leading and trailing \r\n "),
]


def dense(m):
    out = np.zeros((m.height, m.width), np.int64)
    np.add.at(out, (m.rows(), m.columns), m.values)
    return out


@pytest.mark.parametrize("seed", range(20))
def test_products_agree_with_dense_ones(seed):
    rng = np.random.default_rng(seed)
    h, k, w = rng.integers(0, 7, 3)

    def sparse(rows, columns):
        full = rng.integers(0, 3, (rows, columns)) * rng.integers(0, 2, (rows, columns))
        at, column = np.nonzero(full)
        starts = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=rows))])
        return Csr(starts, column, full[at, column], columns)

    left, right = sparse(h, k), sparse(k, w)
    product = left @ right
    assert (dense(product) == dense(left) @ dense(right)).all()
    assert (dense(left.transposed()) == dense(left).T).all()
    assert (left.row_sizes(right) == (dense(left) > 0).astype(int) @ (dense(right) > 0).sum(axis=1)).all()
    for i in range(h):  # columns of a row are sorted and distinct
        row = product.columns[product.starts[i] : product.starts[i + 1]]
        assert (np.diff(row) > 0).all()


def test_links_share_bytes_and_groups_share_tokens():
    both = alignment.tokenizers_of(*FILES)
    found = alignment.Aligned.of(both, [" unbelievable tokenization", " ", " 東京 x"])
    covered = np.bincount(found.links.rows(), found.links.values, len(found.a))
    assert (covered == both.a_length[found.a]).all()
    shared = found.shared()
    assert (np.diff(shared.starts) == found.shared_counts()).all()
    links = set(zip(found.links.rows().tolist(), found.links.columns.tolist()))
    assert links <= set(zip(shared.rows().tolist(), shared.columns.tolist()))


def test_given_documents(results, tables):
    got = results("op11_token_alignment")
    want = brute_new.alignment_rows(tables("documents", "doc_id", "text"), *FILES)
    assert sorted(got[list(COLUMNS)].itertuples(index=False, name=None)) == sorted(want)


@pytest.mark.parametrize("hot_pairs", [1, 40, alignment.HOT_PAIRS])
def test_odd_documents(spark, hot_pairs):
    frame = spark.createDataFrame(ODD, "doc_id long, text string")
    frame = frame.withColumns({c: F.lit("clash") for c in ("_row", "a", "b", "times", "pair", "count", "n_a")})
    got = alignment.align(frame, *FILES, hot_pairs=hot_pairs)
    want = brute_new.alignment_rows(ODD, *FILES)
    assert sorted(map(tuple, got.select(*COLUMNS).collect()), key=repr) == sorted(want, key=repr)
    zeros = {r.doc_id for r in got.collect() if r.groups_sha256 == ""}
    assert zeros == {1, 2, 5}
    assert alignment.align(frame.where("false"), *FILES).collect() == []


def test_runs_are_aligned_alone():
    import random

    r = random.Random(4)
    parts = [" ", "  ", "\n", "\t", "a", "word", "Ü", "é", "9", "'s", "'", ".", "\u00a0", "\u2003", "\u180e", "\u200b", "東", "\U0001F600", "_", "\x1c", "\x85"]
    known = alignment.Runs(alignment.tokenizers_of(*FILES))
    texts = ["".join(r.choices(parts, k=r.randrange(1, 30))) for _ in range(3_000)]
    known.learn([alignment.runs_of(t) for t in texts])
    for text in texts:
        assert "".join(alignment.runs_of(text)) == f" {text}"
        if all(known.totals[known.number[run], 0] for run in alignment.runs_of(text)):
            known.check(text)


def test_forgotten_runs(monkeypatch):
    monkeypatch.setattr(alignment, "CACHE_RUNS", 3)
    known = alignment.Runs(alignment.tokenizers_of(*FILES))
    texts = ["a b c d e f", None, "a b", "", "g h"]
    first = alignment.align_block(known, texts)
    assert alignment.align_block(known, texts).equals(first)
    assert len(known.number) <= 8
    for text in filter(None, texts):
        known.check(text)


def test_hot_pairs_are_bounded():
    assert alignment.least_hot(0) == alignment.least_hot(10) == 1
    counts = [50, 30, 10, 5, 3, 1, 1]
    assert sum(c >= alignment.least_hot(sum(counts), 4) for c in counts) <= 4
