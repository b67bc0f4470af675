"""Quality rules, among them the divergence of a document from its language.

A document's character classes and its use of the language's commonest words make
two histograms. Each is compared with the same histogram of all documents of the
language by the Jensen-Shannon distance (base 2, 0 to 1). Short texts have unreliable
histograms, so each comparison needs a minimum length.

Two passes over the texts: one for the references, whose counts are merged by one
aggregation, and one that measures documents, without a shuffle. Only documents of
languages beyond the ``SENT_LANGUAGES`` with most text are shuffled, to their references.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from placecount.llm import text as tx
from placecount.session import durable

COMMON_WORDS = 50
MIN_CHARS = 400
MIN_WORDS = 80
# Ordinary prose of 80 words or more stays below 0.24 and 0.39 in all four languages.
MAX_CLASS_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.45
# References of the languages with most text are sent to all tasks; others are joined.
SENT_LANGUAGES = 1_000
MIN_BASE_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW_WORDS = 8

_MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "class_distance double, word_distance double, kept boolean"
)
_CLASSES = 8
_CONTINUES = 8  # bytes that continue a character belong to no class


def _byte_classes() -> np.ndarray:
    table = np.full(256, 5, np.int64)  # other ASCII signs and control characters
    table[ord("a") : ord("z") + 1] = 0
    table[ord("A") : ord("Z") + 1] = 1
    table[ord("0") : ord("9") + 1] = 2
    table[[0x20, *range(0x09, 0x0E)]] = 3
    table[[ord(c) for c in ".,;:!?'\"()-"]] = 4
    table[0xC0:0xE0] = 6  # two-byte characters: accented and other alphabets
    table[0xE0:] = 7
    table[0x80:0xC0] = _CONTINUES
    return table


_CLASS = _byte_classes()
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def class_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Characters of each class in each text."""
    n = len(offsets) - 1
    doc = np.repeat(np.arange(n), np.diff(offsets))
    counts = np.bincount(doc * (_CLASSES + 1) + _CLASS[data], minlength=n * (_CLASSES + 1))
    return counts.reshape(n, _CLASSES + 1)[:, :_CLASSES]


def _hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[tx.Words, np.ndarray]:
    w = tx.words(data, offsets)
    return w, tx.spans_hash(tx.lower_ascii(data), w.start, w.end)


def references(docs: DataFrame) -> DataFrame:
    """(lang, kind, key, n): class counts, and counts of the commonest words by hash,
    of every language. Kind 2 counts all words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        size = 0

        def flushed():
            for lang, parts in held.items():
                keys, where = np.unique(np.concatenate([k for k, _ in parts["words"]]), return_inverse=True)
                sums = np.bincount(where, np.concatenate([n for _, n in parts["words"]]), len(keys)).astype(np.int64)
                kinds = np.concatenate([np.zeros(_CLASSES), np.ones(len(keys)), [2]]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(kinds), pa.string()),
                        pa.array(kinds),
                        pa.array(np.concatenate([np.arange(_CLASSES), keys.view(np.int64), [0]])),
                        pa.array(np.concatenate([parts["classes"], sums, [sums.sum()]]).astype(np.int64)),
                    ],
                    names=["lang", "kind", "key", "n"],
                )
            held.clear()

        for batch in batches:
            langs = pd.Series(batch.column("lang").to_pylist(), dtype=object)
            for start, stop in tx.blocks(batch.column("text")):
                data, offsets = tx.utf8(batch.column("text").slice(start, stop - start))
                classes = class_counts(data, offsets)
                w, hashes = _hashed_words(data, offsets)
                codes, names = pd.factorize(langs.iloc[start:stop], use_na_sentinel=False)
                of_word = codes[w.doc]
                for code, name in enumerate(names):
                    name = None if pd.isna(name) else name
                    keys, n = np.unique(hashes[of_word == code], return_counts=True)
                    entry = held.setdefault(name, {"classes": np.zeros(_CLASSES, np.int64), "words": []})
                    entry["classes"] += classes[codes == code].sum(axis=0)
                    entry["words"].append((keys, n))
                    size += len(keys)
                if size > 2_000_000:
                    yield from flushed()
                    size = 0
        if held:
            yield from flushed()

    counted = (
        docs.select("lang", "text")
        .mapInArrow(count, "lang string, kind int, key long, n long")
        .groupBy("lang", "kind", "key")
        .agg(F.sum("n").alias("n"))
    )
    by_count = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "key")
    top = durable(counted.withColumn("place", F.row_number().over(by_count)).where(F.col("place") <= COMMON_WORDS))
    return top.select("lang", "kind", "key", "n")


class Reference:
    """Shares of character classes and of the commonest words of one language."""

    def __init__(self, rows: list[tuple[int, int, int]]):
        classes = np.zeros(_CLASSES)
        for kind, key, n in rows:
            if kind == 0:
                classes[key] = n
        words = sorted((np.uint64(key % 2**64), n) for kind, key, n in rows if kind == 1)
        total = sum(n for kind, _, n in rows if kind == 2)
        self.classes = classes / max(1.0, classes.sum())
        self.keys = np.array([k for k, _ in words], np.uint64)
        counts = np.array([n for _, n in words], float)
        self.words = np.append(counts, total - counts.sum()) / max(1, total)


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of counts ``p`` to the shares ``q``."""
    p = p / np.maximum(p.sum(axis=1, keepdims=True), 1)
    mean = (p + q) / 2

    def divergence(a):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log2(a / mean), 0.0).sum(axis=1)

    return np.sqrt(np.clip((divergence(p) + divergence(np.broadcast_to(q, p.shape))) / 2, 0, 1))


def _repeats(doc: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Marks the keys that occur more than once within their text."""
    own = tx.mix(keys ^ tx.mix(doc.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(own)
    s = own[order]
    same = s[1:] == s[:-1]
    marked = np.zeros(len(keys), bool)
    marked[order[1:][same]] = True
    marked[order[:-1][same]] = True
    return marked


def repeat_words(w: tx.Words, hashes: np.ndarray, n_docs: int, k: int = WINDOW_WORDS) -> np.ndarray:
    """Words of each text that lie in a window of ``k`` words found twice or more in it."""
    first, h = tx.windows(w, hashes, k)
    first = first[_repeats(w.doc[first], h)]
    steps = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, first + k, -1)
    covered = np.cumsum(steps[:-1]) > 0
    return np.bincount(w.doc[covered], minlength=n_docs)


def dup_lines(data: np.ndarray, offsets: np.ndarray, w: tx.Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    n = len(offsets) - 1
    filled = offsets[:-1] < offsets[1:]
    breaks = np.flatnonzero(data == 0x0A)
    start = np.sort(np.concatenate([offsets[:-1][filled], breaks + 1]))
    end = np.sort(np.concatenate([breaks, offsets[1:][filled]]))
    holds = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, end = start[holds], end[holds]
    doc = np.searchsorted(offsets, start, side="right") - 1
    keys = tx.spans_hash(data, start, end)
    own = tx.mix(keys ^ tx.mix(doc.astype(np.uint64) + np.uint64(1)))
    _, at = np.unique(own, return_index=True)
    return np.bincount(doc, minlength=n) - np.bincount(doc[at], minlength=n)


def measure_block(data: np.ndarray, offsets: np.ndarray, langs: list, known: dict) -> dict[str, np.ndarray]:
    """All measures of a block of texts."""
    n = len(offsets) - 1
    w, hashes = _hashed_words(data, offsets)
    raw = tx.spans_hash(data, w.start, w.end)
    classes = class_counts(data, offsets)

    def per_doc(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    n_words = w.counts
    chars = classes.sum(axis=1)
    out = {
        "n_words": n_words,
        "word_chars": chars - classes[:, 3],
        "n_symbols": per_doc(_SYMBOL[data]),
        "n_dup_lines": dup_lines(data, offsets, w),
        "n_repeat_words": repeat_words(w, raw, n),
        "class_distance": np.full(n, np.nan),
        "word_distance": np.full(n, np.nan),
    }
    out["base_failed"] = (n_words < MIN_BASE_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * n_words)
    for name in {lang for lang in langs if lang in known}:
        ref, rows = known[name], np.array([i for i, lang in enumerate(langs) if lang == name])
        long = rows[chars[rows] >= MIN_CHARS]
        out["class_distance"][long] = js_distance(classes[long], ref.classes)
        wordy = rows[n_words[rows] >= MIN_WORDS]
        if len(wordy) and len(ref.keys):
            number = np.full(n, -1)
            number[wordy] = np.arange(len(wordy))
            row = number[w.doc]
            place = np.minimum(np.searchsorted(ref.keys, hashes), len(ref.keys) - 1)
            place = np.where(ref.keys[place] == hashes, place, len(ref.keys))
            bins = len(ref.keys) + 1
            counts = np.bincount((row * bins + place)[row >= 0], minlength=len(wordy) * bins)
            out["word_distance"][wordy] = js_distance(counts.reshape(len(wordy), bins), ref.words)
    # NaN compares as false, so what was not measured does not fail.
    out["kept"] = ~(
        out["base_failed"]
        | (out["class_distance"] > MAX_CLASS_DISTANCE)
        | (out["word_distance"] > MAX_WORD_DISTANCE)
    )
    return out


def judge(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Measures and verdict of each of ``docs`` (text, lang and the columns to keep).

    Null text is empty, and fails as too short. Null is a language of its own. A text
    below the minimum lengths is judged by the base rules alone; its distances are null.
    Every language has a reference, which holds at least the text that it judges.
    """
    table = references(docs)
    by_size = table.where("kind = 0").groupBy(F.col("lang").alias("_of")).agg(F.sum("n").alias("_size"))
    sent = durable(by_size.orderBy(F.desc("_size"), "_of").limit(SENT_LANGUAGES).select("_of"))
    same = F.col("lang").eqNullSafe(F.col("_of"))
    by_lang: dict = {}
    for row in table.join(F.broadcast(sent), same).collect():  # 59 rows for each language
        by_lang.setdefault(row["lang"], []).append((row["kind"], row["key"], row["n"]))
    known = {lang: Reference(rows) for lang, rows in by_lang.items()}
    names = [part.split()[0] for part in _MEASURES.split(", ")]
    schema = StructType([*docs.select(*keep).schema, *StructType.fromDDL(_MEASURES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = batch.column("_text"), batch.column("_lang").to_pylist()
            own = known
            if "_reference" in batch.schema.names:
                first = {lang: i for i, lang in enumerate(langs)}
                rows = batch.column("_reference")
                own = {
                    lang: Reference([(r["kind"], r["key"], r["n"]) for r in rows[i].as_py() or ()])
                    for lang, i in first.items()
                }
            found = [measure_block(*tx.utf8(texts.slice(a, b - a)), langs[a:b], own) for a, b in tx.blocks(texts)]
            kept = batch.select(list(keep))
            for name in names:
                values = np.concatenate([f[name] for f in found])
                kept = kept.append_column(
                    name, pa.array(values, from_pandas=True) if values.dtype == float else pa.array(values)
                )
            yield kept

    rows = docs.select(*keep, F.col("text").alias("_text"), F.col("lang").alias("_lang"))
    if len(known) < SENT_LANGUAGES:
        return rows.mapInArrow(run, schema)
    # Each of the other languages has less than 1 / SENT_LANGUAGES of the text.
    is_sent = F.col("_lang").eqNullSafe(F.col("_of"))
    others = (
        table.join(F.broadcast(sent), same, "left_anti")
        .groupBy(F.col("lang").alias("_of"))
        .agg(F.collect_list(F.struct("kind", "key", "n")).alias("_reference"))
    )
    joined = rows.join(F.broadcast(sent), is_sent, "left_anti").join(others, is_sent, "left").drop("_of")
    near = rows.join(F.broadcast(sent), is_sent, "left_semi")
    return near.mapInArrow(run, schema).unionByName(joined.mapInArrow(run, schema))
