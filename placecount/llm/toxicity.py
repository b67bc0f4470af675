"""A toxicity classifier regularised by counterfactuals.

Logistic regression over which words and word beginnings a text has, and which
beginnings two of its words share. Its loss adds,
for labelled sentences that name a group of people, the squared change of the logit
when the group is swapped for another (counterfactual logit pairing, Garg et al.,
2019). What a classifier picks up from groups merely being mentioned next to abuse
is so unlearnt, and neutral mentions are not rejected.

The fit reads a bounded sample of labelled rows: the ``max_toxic`` and ``max_clean``
rows whose ids hash lowest. Scoring reads every text whole, in one pass over the
table without a shuffle; the model has at most ``MAX_FEATURES`` weights.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placecount.llm.text import blocks
from placecount.session import durable

MAX_TOXIC = 8_000
MAX_CLEAN = 12_000
MAX_FEATURES = 4_096
MIN_DOCS = 2
FALSE_SHARE = 0.05  # of the features used, so many may owe their evidence to chance
PREFIXES = (4, 5, 6)
PENALTY = 4.0
L2 = 1e-4
STEPS = 800
STEPS_OF_FOLDS = 200  # enough to place the cut between the classes
MOST_PRIOR = 0.25  # highest score of a text without evidence, however many labels say toxic
PRIOR = 0.1  # that score where no row of one of the classes is labelled
_FLUSH = 50_000  # features that a task counts, and words it remembers, some 10 MB each
_CACHE = 50_000

# Names of groups of people, by language; a sentence's groups are swapped within a row.
IDENTITY_TERMS = (
    ("women", "men", "muslims", "christians", "jews", "hindus", "atheists", "immigrants", "refugees"),
    ("black", "white", "asian", "african", "european", "american", "arab", "latino"),
    ("gay", "straight", "lesbian", "heterosexual", "transgender", "bisexual", "queer"),
    ("frauen", "männer", "muslime", "christen", "juden", "ausländer", "flüchtlinge"),
    ("femmes", "hommes", "musulmans", "chrétiens", "juifs", "immigrés", "réfugiés"),
    ("mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes", "refugiados"),
)

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def features_of(word: str) -> list[str]:
    """The word itself and its beginnings, which inflected forms share."""
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n)]


def text_features(words: Iterable[str]) -> set[str]:
    """Features of a text with these distinct words: those of the words, and each
    beginning that two of them share, with another star."""
    times = Counter(f for word in words for f in features_of(word))
    return {*times, *(f"{f}*" for f, n in times.items() if n > 1)}


def swapped(sentence: str, terms=IDENTITY_TERMS) -> str | None:
    """The sentence with every group replaced by the next of its row, or None."""
    following = {a: b for row in terms for a, b in zip(row, row[1:] + row[:1])}
    found = words_of(sentence) & following.keys()
    if not found:
        return None
    return _WORD.sub(lambda m: following.get(m[0].lower(), m[0]), sentence)


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float

    def score_all(self, texts, cache: dict[str, tuple] | None = None) -> np.ndarray:
        """Probability of label 1 for each text. ``cache`` keeps words between calls."""
        cache = {} if cache is None else cache
        logits = []
        for text in texts:
            hits: list[str] = []
            for word in words_of(text):
                known = cache.get(word)
                if known is None:
                    if len(cache) >= _CACHE:
                        cache.clear()
                    known = cache[word] = tuple(
                        f for f in features_of(word) if f in self.weights or f"{f}*" in self.weights
                    )
                if known:
                    hits += known
            times = Counter(hits)
            found = sorted(f for f in (*times, *(f"{f}*" for f, n in times.items() if n > 1)) if f in self.weights)
            logits.append(self.bias + sum(self.weights[f] for f in found))
        return _sigmoid(np.array(logits, float))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def labelled_sample(
    docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN
) -> DataFrame:
    """(text, toxic, fold) of at most the given numbers of labelled ids outside fold 0. An
    id labelled twice is toxic if any label is; labels without value or id are left out."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold(F.col("doc_id")) != 0))
        .groupBy(F.col("doc_id").alias("_id"))
        .agg((F.max("toxic") > 0).alias("toxic"))
        .withColumn("fold", fold(F.col("_id")))
    )
    by_hash = [F.xxhash64("_id"), F.col("_id")]
    kept = known.where("toxic").orderBy(*by_hash).limit(max_toxic).unionAll(
        known.where("not toxic").orderBy(*by_hash).limit(max_clean)
    )
    # At most max_toxic + max_clean ids, so small enough to send to every task.
    return docs.select("doc_id", "text").join(F.broadcast(kept), F.col("doc_id") == F.col("_id")).select("text", "toxic", "fold")


def feature_counts(sample: DataFrame) -> DataFrame:
    """Texts of each class that have a feature; the empty feature counts all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flushed():
            rows = [(f, int(n * t), int(n * (not t))) for (f, t), n in counts.items()]
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64()))],
                names=["feature", "toxic", "clean"],
            )

        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                counts.update((f, toxic) for f in text_features(words_of(text)))
                counts[("", toxic)] += 1
                if len(counts) >= _FLUSH:
                    yield flushed()
        if counts:
            yield flushed()

    partial = sample.mapInArrow(count, "feature string, toxic long, clean long")
    return partial.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _evidence(toxic: Column, clean: Column, n_toxic: int, n_clean: int) -> Column:
    """G statistic of a feature against the label."""
    n, total = toxic + clean, n_toxic + n_clean

    def cell(seen: Column, rows: int, share: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / (share * rows / total))).otherwise(0.0)

    return 2 * (
        cell(toxic, n_toxic, n)
        + cell(clean, n_clean, n)
        + cell(n_toxic - toxic, n_toxic, total - n)
        + cell(n_clean - clean, n_clean, total - n)
    )


def told_apart(evidence: list[float], tested: int, false_share: float = FALSE_SHARE) -> int:
    """How many of the strongest features to use, of ``tested`` ones, so that about
    ``false_share`` of them owe their evidence to chance (Benjamini and Hochberg, 1995).
    ``evidence`` are the largest G statistics in falling order."""
    chance = [math.erfc(math.sqrt(max(g, 0.0) / 2)) for g in evidence]
    return max((k for k, p in enumerate(chance, 1) if p <= false_share * k / tested), default=0)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_toxic: int = MAX_TOXIC,
    max_clean: int = MAX_CLEAN,
    penalty: float = PENALTY,
    terms=IDENTITY_TERMS,
) -> Model:
    """Fit on ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic), by id.

    Without a labelled row of either class, or if no feature tells them apart, every
    text has the same score: the labelled share of toxic rows, ``MOST_PRIOR`` at most,
    or ``PRIOR``. So has a text without any evidence, or a lower one. A repeated row
    counts as often as it occurs; of features with equal evidence the first by name is
    taken.
    """
    sample = durable(labelled_sample(docs, labels, max_toxic, max_clean))
    counts = durable(feature_counts(sample))
    totals = counts.where("feature = ''").agg(F.sum("toxic"), F.sum("clean")).first()
    n_toxic, n_clean = (int(n or 0) for n in totals)
    if not n_toxic or not n_clean:
        return Model({}, _logit(PRIOR))
    g = _evidence(F.col("toxic"), F.col("clean"), n_toxic, n_clean)
    tested = counts.where((F.col("feature") != "") & (F.col("toxic") + F.col("clean") >= MIN_DOCS))
    strongest = tested.withColumn("g", g).orderBy(F.col("g").desc(), "feature").limit(MAX_FEATURES).collect()
    names = [row["feature"] for row in strongest]
    names = names[: told_apart([row["g"] for row in strongest], tested.count())]
    number = {name: i for i, name in enumerate(names)}

    def vector(text: str) -> list[int]:
        return sorted(number[f] for f in text_features(words_of(text)) if f in number)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, toxic, part in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "fold"))):
                rows.append((int(toxic), part, vector(text or ""), [], 1))
                pairs = Counter(
                    (tuple(vector(s)), tuple(vector(x)))
                    for s in _SENTENCE.split(text or "")
                    if (x := swapped(s, terms))
                )
                rows += [(-1, part, a, b, n) for (a, b), n in pairs.items()]
            ids = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(zip(*rows), (pa.int32(), pa.int32(), ids, ids, pa.int64()))],
                names=["kind", "fold", "ids", "swapped", "times"],
            )

    # Equal rows count together. Distinct ones are few feature numbers each, of the sample's texts and sentences.
    rows = (
        sample.mapInArrow(vectors, "kind int, fold int, ids array<int>, swapped array<int>, times long")
        .groupBy("kind", "fold", "ids", "swapped")
        .agg(F.sum("times").alias("times"))
        .toArrow()
        .to_pylist()
    )
    weights, bias = _train(rows, len(names), penalty)
    share = min(MOST_PRIOR, n_toxic / (n_toxic + n_clean))
    return Model(dict(zip(names, weights.tolist())), min(bias - _best_cut(rows, len(names), penalty), _logit(share)))


def _logit(share: float) -> float:
    return math.log(share / (1 - share))


def _best_cut(rows: list[dict], n_features: int, penalty: float) -> float:
    """The logit that parts toxic from clean texts with fewest errors, the rarer class
    counting as much as the other, when each fold is scored by a fit of the others; in
    the middle of the widest of equally good gaps. 0 if a fold leaves a class empty."""
    texts = [r for r in rows if r["kind"] >= 0]
    found: list[tuple[float, int, int]] = []
    for part in sorted({r["fold"] for r in texts}):
        others = [r for r in rows if r["fold"] != part]
        if len({r["kind"] for r in others if r["kind"] >= 0}) < 2:
            return 0.0
        weights, bias = _train(others, n_features, penalty, STEPS_OF_FOLDS)
        found += [(bias + float(weights[r["ids"]].sum()), r["kind"], r["times"]) for r in texts if r["fold"] == part]
    found.sort()
    logits, kinds, times = (np.array(c, float) for c in zip(*found))
    n_toxic, n_clean = (times * (kinds == 1)).sum(), (times * (kinds == 0)).sum()
    missed = np.cumsum(times * (kinds == 1)) / n_toxic
    spared = np.cumsum(times * (kinds == 0)) / n_clean
    gaps = np.append(logits[1:] - logits[:-1], 0.0)
    errors = np.where(gaps > 0, missed - spared, np.inf)  # a cut above each text
    if not np.isfinite(errors).any():
        return 0.0
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    at = best[np.argmax(gaps[best])]
    return float(logits[at] + gaps[at] / 2)


def _train(rows: list[dict], n_features: int, penalty: float, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Minimise log loss, L2 and the counterfactual penalty by Adam over all rows. Both
    classes weigh the same, as their numbers only tell what was labelled."""
    texts = sorted((r["kind"], r["ids"], r["times"]) for r in rows if r["kind"] >= 0)
    pairs = sorted((r["ids"], r["swapped"], r["times"]) for r in rows if r["kind"] < 0)
    times = np.array([n for *_, n in texts], float)
    cf_times = np.array([n for *_, n in pairs], float)
    texts, pairs = [t[:2] for t in texts], [p[:2] for p in pairs]
    labels = np.array([kind for kind, _ in texts], float)
    row = np.repeat(np.arange(len(texts)), [len(ids) for _, ids in texts])
    col = np.array([i for _, ids in texts for i in ids], np.int64)
    cf_row = np.repeat(np.arange(len(pairs)), [len(a) + len(b) for a, b in pairs])
    cf_col = np.array([i for a, b in pairs for i in (*a, *b)], np.int64)
    cf_sign = np.array([s for a, b in pairs for s in (*[1.0] * len(a), *[-1.0] * len(b))])
    weight = times * np.where(labels == 1, 0.5 / max(1, times[labels == 1].sum()), 0.5 / max(1, times[labels == 0].sum()))
    theta = np.zeros(n_features + 1)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w = theta[:-1]
        logit = theta[-1] + np.bincount(row, w[col], len(texts))
        error = (_sigmoid(logit) - labels) * weight
        grad = np.append(np.bincount(col, error[row], n_features) + L2 * w, error.sum())
        if len(pairs):
            change = np.bincount(cf_row, cf_sign * w[cf_col], len(pairs)) * cf_times * (2 * penalty / cf_times.sum())
            grad[:-1] += np.bincount(cf_col, cf_sign * change[cf_row], n_features)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] | None = None) -> DataFrame:
    """Adds ``toxic_score``, the probability of label 1, and ``toxic`` (at least 0.5)
    to the named columns (all by default). Null text scores as empty text does."""
    kept = list(keep if keep is not None else [c for c in docs.columns if c not in ("toxic_score", "toxic")])
    rows = docs.select(*kept, *([] if "text" in kept else ["text"]))
    schema = docs.select(*kept).schema.add("toxic_score", "double").add("toxic", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, tuple] = {}
        for batch in batches:
            for start, stop in blocks(batch.column("text")):
                some = batch.slice(start, stop - start)
                scores = model.score_all(some.column("text").to_pylist(), cache)
                yield some.select(kept).append_column("toxic_score", pa.array(scores, pa.float64())).append_column(
                    "toxic", pa.array(scores >= 0.5)
                )

    return rows.mapInArrow(run, schema)
