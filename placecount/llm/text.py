"""Words and shingles of whole Arrow string columns, as numpy arrays.

A word is a run of bytes other than space and 0x09-0x0D. In UTF-8 those bytes never
occur inside a longer character, so bytes give the same words as code points do.
All functions take a block of texts at once; ``blocks`` cuts a batch so that the
arrays of a block stay small. A text is never split: one longer than a block is a
block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_powers = (np.ones(1, _U), np.ones(1, _U))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def mix_one(value: int) -> int:
    return int(mix(np.array([value & (2**64 - 1)], _U))[0])


def blocks(column: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``max_bytes`` of text each, or of one row."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > max_bytes:
            yield start, i
            start, total = i, 0
        total += size
    if len(sizes) > start:
        yield start, len(sizes)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    array = pc.fill_null(column, "")
    wide = pa.types.is_large_string(array.type)
    offsets = np.frombuffer(array.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[array.offset : array.offset + len(array) + 1].astype(np.int64)
    values = array.buffers()[2]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def spans_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range: a polynomial over its bytes and its length."""
    global _powers
    n = len(data)
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        ups, downs = np.full(size, _BASE, _U), np.full(size, _INVERSE, _U)
        ups[0] = downs[0] = 1
        _powers = np.cumprod(ups), np.cumprod(downs)
    ups, downs = _powers
    sums = np.zeros(n + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * ups[:n], out=sums[1:])
    value = (sums[end] - sums[start]) * downs[np.minimum(start, max(n - 1, 0))] if n else sums[start]
    return mix(value + (end - start).astype(_U) * _U(0xD6E8FEB86659FD93))


@dataclass(frozen=True)
class Words:
    """The words of a block: text number, byte range, and words per text."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    counts: np.ndarray

    @property
    def first(self) -> np.ndarray:
        """Number of the first word of each text."""
        return np.concatenate([[0], np.cumsum(self.counts)])[:-1]


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = ~_IS_SPACE[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    filled = offsets[:-1] < offsets[1:]
    edges = offsets[:-1][filled]
    opens[edges] = inside[edges]
    last = offsets[1:][filled] - 1
    closes[last] = inside[last]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    doc = np.searchsorted(offsets, start, side="right") - 1
    return Words(doc, start, end, np.bincount(doc, minlength=len(offsets) - 1))


def windows(w: Words, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every run of ``k`` words within one text."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    first = np.flatnonzero(w.doc[:n] == w.doc[k - 1 :])
    return first, _fold(hashes, first, k)


def _fold(hashes: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    h = np.full(len(first), k, _U)
    for j in range(k):
        h = (h ^ hashes[first + j]) * _U(0xFF51AFD7ED558CCD)
        h ^= h >> _U(32)
    return mix(h)


def shingle_sets(w: Words, hashes: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct ``k``-word shingle hashes of each text. A text of fewer words
    has its whole sequence as one shingle; one without words has none."""
    first, h = windows(w, hashes, k)
    per_doc = np.maximum(w.counts - k + 1, 0)
    stops = np.cumsum(per_doc)
    begin = w.first
    out = []
    for i, (count, n, stop) in enumerate(zip(w.counts.tolist(), per_doc.tolist(), stops.tolist())):
        if n:
            s = np.sort(h[stop - n : stop])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])] if n > 1 else s)
        elif count:
            out.append(_fold(hashes, begin[i : i + 1], count))
        else:
            out.append(np.zeros(0, _U))
    return out


def text_shingles(column: pa.Array, k: int, lower: bool) -> list[np.ndarray]:
    """``shingle_sets`` of every text of a column."""
    out: list[np.ndarray] = []
    for start, stop in blocks(column):
        data, offsets = utf8(column.slice(start, stop - start))
        data = lower_ascii(data) if lower else data
        w = words(data, offsets)
        out += shingle_sets(w, spans_hash(data, w.start, w.end), k)
    return out


@dataclass(frozen=True)
class PublicFile:
    """A vocabulary file of the ``public_tokenizers`` package, looked up by whoever opens
    it, so that every machine finds its own."""

    name: str

    def __fspath__(self) -> str:
        import public_tokenizers

        return public_tokenizers.path(self.name)


def spare(columns: list[str], name: str) -> str:
    """``name``, with as many underscores before it as make it none of ``columns``."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
