"""Threshold-scaled document fingerprints.

A fingerprint keeps every five-word shingle hash below a fixed fraction of the hash
range (FracMinHash; Irber et al., 2022). Sets of very unequal size keep the same
fraction, so containment can be estimated between a paragraph and a book, and the
fingerprint of a union is the union of fingerprints. A text none of whose hashes is
that low keeps its lowest one; a merge drops it as soon as a low one joins.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from placecount.llm.text import blocks, text_shingles

SHINGLE_WORDS = 5
FRACTION = 8  # one hash in so many is kept
_LIMIT = np.uint64(2**64 // FRACTION)
MAX_RANGES = 1 << 16
_OUT = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Kept part of a sorted array of distinct hashes."""
    kept = hashes[: np.searchsorted(hashes, _LIMIT)]
    return kept if len(kept) else hashes[:1]


def sketches(texts: pa.Array) -> list[np.ndarray]:
    return [sketch(h) for h in text_shingles(texts, SHINGLE_WORDS, lower=True)]


def encode(kept: np.ndarray) -> str:
    return base64.b64encode(kept.astype(">u8").tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), ">u8").astype(np.uint64)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Fingerprint of both texts' shingles together."""
    return sketch(np.union1d(a, b))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity; texts without words are like each other only."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    either = len(a) + len(b) - both
    return both / either if either else 1.0


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of ``a``'s shingles that ``b`` has too; 1 if ``a`` has none."""
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else 1.0


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every text; null counts as empty."""
    schema = docs.select("doc_id").schema.add("n_chars", "long").add("fingerprint", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            yield batch.select(["doc_id"]).append_column(
                "n_chars", pa.array([len(t or "") for t in texts.to_pylist()], pa.int64())
            ).append_column("fingerprint", pa.array([encode(s) for s in sketches(texts)], pa.string()))

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _ranges(docs: DataFrame, per_partition: int = 4) -> list:
    """Upper ends of ranges of ids with about equal numbers of rows."""
    wanted = per_partition * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = min(MAX_RANGES, max(1, wanted))
    shares = [i / n for i in range(1, n)]
    return docs.approxQuantile("doc_id", shares, 0.25 / n) if shares else []


def _place(value: Column, ends: list[float], step: int = 256) -> Column:
    """How many of the sorted ``ends`` are below a value: among every 256th, then there."""

    def below(among: Column) -> Column:
        return F.size(F.filter(among, lambda end: end < value))

    def array(some: list[float]) -> str:
        return f"cast(array({', '.join(f'{float(end)!r}D' for end in some)}) as array<double>)"

    coarse = below(F.expr(array(ends[step - 1 :: step])))
    fine = [array(ends[i : i + step]) for i in range(0, len(ends), step)] or [array([])]
    return coarse * step + F.coalesce(below(F.get(F.expr(f"array({', '.join(fine)})"), coarse)), F.lit(0))


def beside_next(docs: DataFrame) -> DataFrame:
    """Rows (part, guest, doc_id, tie, text), laid out so that each document's next one
    in descending id order follows it in its partition; after the last comes the first.

    Ids are cut into ranges. The first row of a range is also sent, as a guest, to the
    range before it, whose last row it follows. The driver learns one row per range.
    Null ids come last; equal ids are ordered by a hash of the text.
    """
    ends = sorted(set(_ranges(docs)))
    tie = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), tie.alias("tie")).withColumn(
        "own", F.when(F.col("doc_id").isNull(), -1).otherwise(_place(F.col("doc_id").cast("double"), ends))
    )
    tops = {
        row["own"]: row["top"]
        for row in rows.groupBy("own").agg(F.max(F.struct("doc_id", "tie")).alias("top")).collect()
    }
    order = sorted(tops, reverse=True)
    visits = [
        (after, tops[after]["doc_id"], tops[after]["tie"], before)
        for before, after in zip(order, order[1:] + order[:1])
    ]
    first = docs.sparkSession.createDataFrame(visits, "of int, top_id long, top_tie long, away int")
    is_top = (
        (F.col("own") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("top_id")) & (F.col("tie") == F.col("top_tie"))
    )
    here = F.struct(F.col("own").alias("part"), F.lit(0).alias("guest"))
    there = F.when(F.col("away").isNotNull(), F.struct(F.col("away").alias("part"), F.lit(1).alias("guest")))
    # One row for each range, of which there are at most MAX_RANGES.
    visits = rows.join(F.broadcast(first), is_top, "left").withColumn(
        "visit", F.explode(F.array_compact(F.array(here, there)))
    )
    return (
        visits.select("visit.part", "visit.guest", "doc_id", "tie", "text")
        .repartition("part")
        .sortWithinPartitions("part", "guest", F.desc_nulls_last("doc_id"), F.desc("tie"))
    )


def edited(text: str, following: str) -> str:
    """The last third of ``text`` replaced by as much of the start of ``following``."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def compare_with_edited(docs: DataFrame) -> DataFrame:
    """For each of ``docs`` (doc_id, text): its fingerprint, that of its edited text, and
    their likeness to each other and to the next document's fingerprint.

    A single document is its own next. Texts cross the network once. Other columns
    are left out.
    """
    schema = StructType([*docs.select("doc_id").schema, *StructType.fromDDL(_OUT)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row still waiting for its next one
        for batch in batches:
            for start, stop in blocks(batch.column("text")):
                block = batch.slice(start, stop - start)
                rows = zip(
                    *(block.column(c).to_pylist() for c in ("part", "guest", "doc_id", "text")),
                    sketches(block.column("text")),
                )
                pairs = []
                for row in rows:
                    if last is not None and last[0] == row[0]:
                        pairs.append((last, row))
                    last = None if row[1] else row
                if pairs:
                    yield _compared(pairs, batch.schema.field("doc_id").type)

    return beside_next(docs).mapInArrow(run, schema)


def _compared(pairs: list, id_type: pa.DataType) -> pa.RecordBatch:
    changed = [edited(a[3], b[3]) for a, b in pairs]
    after = sketches(pa.array(changed, pa.string()))
    columns = {
        "doc_id": pa.array([a[2] for a, _ in pairs], id_type),
        "n_chars": pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
        "fingerprint": pa.array([encode(a[4]) for a, _ in pairs]),
        "edited_fingerprint": pa.array([encode(s) for s in after]),
        "near_edited": pa.array([likeness(a[4], s) for (a, _), s in zip(pairs, after)], pa.float64()),
        "near_next": pa.array([likeness(a[4], b[4]) for a, b in pairs], pa.float64()),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
