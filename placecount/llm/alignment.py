"""Alignment of two tokenizers' tokens, by products of sparse incidence matrices.

Tokens of A and of B each cover the bytes of a text. With A and B the token-byte
incidence matrices (a row for each token, a column for each byte), entry (i, j) of
A Bᵀ is the number of bytes that token i of A and token j of B share, so its non-zero
entries are the overlap links. Offsets where tokens of both end cut a text into groups;
with the token-group incidence matrices, the product holds the shared-group links.

Matrices are in compressed sparse rows, built by hand from token lengths, and are
multiplied row by row (Gustavson, 1978): row i of a product is the sum of those rows of
the right factor that row i of the left one names. As the bytes of a token are
consecutive, the rows come sorted.

Where a space parts two words, tokens of both end. So texts are cut there into runs, and
tokens, groups and links of a text are those of its runs, side by side. The different
runs of a block are one matrix, block-diagonal by run, and a run met before is not
aligned again. One text of each block is compared with what the libraries make of it as
a whole; a difference is an error.

How often two ids are linked is counted over all texts: each text adds one for each pair
that it holds. Texts are encoded once; their pairs are written with how often each
occurs, folded to one entry for a text. Pairs that many texts hold are known to all
tasks: at most ``HOT_PAIRS``, as all texts together hold no more than the counts' sum.
The others meet their counts in a join, where none is a hot key.

Defined results: a null or empty text, or one that either tokenizer does not give back
byte by byte, has no tokens, so zeros and an empty digest. Repeated rows and repeated
ids are texts of their own and count each. An empty table gives no rows. Columns other
than those kept are left out.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain
from os import PathLike

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from placecount.llm.text import blocks, spare
from placecount.session import durable

SPACE = "▁"
HOT_PAIRS = 2_000_000
CACHE_RUNS = 150_000
BLOCK_BYTES = 1 << 19
LEARNT_AT_ONCE = 10_000
JOINED = 256
# Pairs of a text are kept in lists of this length, so that many texts together, or one
# long one, come to a task in small batches.
CHUNK_PAIRS = 64
# A space that may not part two words, and those that do.
_ODD_SPACE = re.compile(r" (?![!-~\w])")
_CUT = re.compile(r"(?<=[^ ])(?= [!-~\w])")
_JOINS = re.compile(r" [!-~\w]")
_WORD_STARTS = frozenset(map(chr, range(0x21, 0x7F)))
_SHIFT = 32
_TOTALS = "n_a long, n_b long, n_groups long, n_links long, n_shared long, groups_sha256 string"
_PAIRS = "chunks array<struct<a:array<int>,b:array<int>,times:array<int>>>"


@dataclass(frozen=True)
class Csr:
    """A sparse matrix by rows: ``columns[starts[i]:starts[i + 1]]`` are those of row i."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @classmethod
    def of_lengths(cls, lengths: np.ndarray) -> Csr:
        """Incidence of tokens and bytes, where tokens follow each other."""
        starts = np.concatenate([[0], np.cumsum(lengths)])
        n = int(starts[-1])
        return cls(starts, np.arange(n), np.ones(n, np.int64), n)

    @classmethod
    def of_labels(cls, labels: np.ndarray, width: int) -> Csr:
        """Incidence of rows and the one column that each has."""
        return cls(np.arange(len(labels) + 1), labels, np.ones(len(labels), np.int64), width)

    @property
    def height(self) -> int:
        return len(self.starts) - 1

    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(self.height), np.diff(self.starts))

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Csr(starts, self.rows()[order], self.values[order], self.height)

    def row_sizes(self, right: Csr) -> np.ndarray:
        """Products that each row of ``self @ right`` sums, without making them."""
        sizes = np.concatenate([[0], np.cumsum(np.diff(right.starts)[self.columns])])
        return sizes[self.starts[1:]] - sizes[self.starts[:-1]]

    def __matmul__(self, right: Csr) -> Csr:
        """Row by row: the rows of ``right`` that the entries of a row name, scaled and
        laid side by side, then summed by column."""
        sizes = np.diff(right.starts)[self.columns]
        ends = np.cumsum(sizes)
        n = int(ends[-1]) if len(ends) else 0
        at = np.arange(n) - np.repeat(ends - sizes, sizes) + np.repeat(right.starts[self.columns], sizes)
        row, column = np.repeat(self.rows(), sizes), right.columns[at]
        value = np.repeat(self.values, sizes) * right.values[at]
        key = row * max(right.width, 1) + column
        if n and (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if n else np.zeros(0, np.int64)
        row, column = key[first] // max(right.width, 1), key[first] % max(right.width, 1)
        value = np.add.reduceat(value, first) if n else np.zeros(0, np.int64)
        starts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=self.height))])
        return Csr(starts, column, value, right.width)


class Tokenizers:
    """A byte-level vocabulary (A) and a vocabulary of pieces (B), with the bytes of each id."""

    def __init__(self, byte_level_file: str | PathLike, pieces_file: str | PathLike):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(os.fspath(byte_level_file))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=os.fspath(pieces_file))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(SPACE in p.lstrip(SPACE) for i, p in enumerate(pieces) if not self.b.is_control(i) and not self.b.is_unknown(i)):
            raise ValueError("a piece goes on past a space mark; texts cannot be cut into runs")
        entries = {i: entry for entry, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.a_bytes = [_byte_level(entries.get(i, "")) for i in range(max(entries) + 1)]
        self.b_bytes = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode()
            for i, piece in enumerate(pieces)
        ]
        self.a_length = np.array([len(x) for x in self.a_bytes])
        self.b_length = np.array([len(x) for x in self.b_bytes])
        # Ids as text with what may follow them, for the digest of groups.
        n, m = len(self.a_bytes), len(self.b_bytes)
        self.marks = np.array(
            [f"{i}," for i in range(n)] + [f"{i}|" for i in range(n)] + [f"{i}," for i in range(m)] + [f"{i};" for i in range(m)],
            object,
        )

    def encode(self, wholes: list[str]) -> tuple[list[list[int]], list[list[int]], list[bytes]]:
        """Ids by A of texts that begin with a space, by B, which adds it itself, and bytes;
        nothing for a text that either does not give back."""
        a = [e.ids for e in self.a.encode_batch_fast(wholes, add_special_tokens=False)]
        b = self.b.encode([whole[1:] for whole in wholes], num_threads=1)
        data = [whole.encode() for whole in wholes]
        if not (self._gives_back(self.a_bytes, a, data) and self._gives_back(self.b_bytes, b, data)):
            for i, whole in enumerate(data):
                if not (self._gives_back(self.a_bytes, a[i : i + 1], [whole]) and self._gives_back(self.b_bytes, b[i : i + 1], [whole])):
                    a[i], b[i], data[i] = [], [], b""
        return a, b, data

    def encode_joined(self, wholes: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids by A, all by B, and the bytes of each text, 0 if it has no tokens. Texts
        that may follow each other are encoded as one, which takes less time."""
        parts: list[list[str]] = []
        open_ = False
        for whole in wholes:
            fits = whole[-1] != " " and _JOINS.match(whole) is not None
            if fits and open_ and len(parts[-1]) < JOINED:
                parts[-1].append(whole)
            else:
                parts.append([whole])
            open_ = fits
        a, b, data = self.encode(["".join(part) for part in parts])
        a_all, b_all, sizes = [], [], []
        for part, ids, others, found in zip(parts, a, b, data):
            if not found and len(part) > 1:  # at least one of them has no tokens
                each = self.encode(part)
                ids, others = ([i for x in lists for i in x] for lists in each[:2])
                sizes += map(len, each[2])
            elif found and len(part) > 1:
                sizes += [len(whole.encode()) for whole in part]
            else:
                sizes.append(len(found))
            a_all += ids
            b_all += others
        return np.array(a_all, np.int64), np.array(b_all, np.int64), np.array(sizes, np.int64)

    @staticmethod
    def _gives_back(bytes_of: list[bytes], ids: list[list[int]], data: list[bytes]) -> bool:
        """Whether the tokens of every text are its bytes."""
        found = list(map(bytes_of.__getitem__, chain.from_iterable(ids)))
        ends = np.cumsum([0, *map(len, found)])[np.cumsum([len(x) for x in ids])]
        return b"".join(found) == b"".join(data) and bool((ends == np.cumsum([len(d) for d in data])).all())


def _byte_level(entry: str) -> bytes:
    """Bytes of a byte-level entry: printable Latin-1 stands for itself, the other bytes
    for the code points from 256 on, in order."""
    return bytes(map(_byte_of_sign().__getitem__, entry))


@lru_cache(maxsize=1)
def _byte_of_sign() -> dict[str, int]:
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=1)
def tokenizers_of(byte_level_file: str | PathLike, pieces_file: str | PathLike) -> Tokenizers:
    """One pair for all tasks of a worker process."""
    return Tokenizers(byte_level_file, pieces_file)


@dataclass(frozen=True)
class Aligned:
    """The tokens of a block of texts. Texts and groups are numbered within the block."""

    a: np.ndarray
    b: np.ndarray
    a_text: np.ndarray
    b_text: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    group_text: np.ndarray
    links: Csr

    @classmethod
    def of(cls, tokenizers: Tokenizers, wholes: list[str]) -> Aligned:
        """Of texts that begin with a space."""
        a, b, sizes = tokenizers.encode_joined(wholes)
        over_bytes, b_over_bytes = Csr.of_lengths(tokenizers.a_length[a]), Csr.of_lengths(tokenizers.b_length[b])
        a_end, b_end = over_bytes.starts[1:], b_over_bytes.starts[1:]
        stops = np.cumsum(sizes)  # a text without tokens stops where the one before it does
        a_text, b_text = np.searchsorted(stops, a_end), np.searchsorted(stops, b_end)
        ends = np.intersect1d(a_end, b_end, assume_unique=True)
        if not np.isin(stops[sizes > 0], ends, assume_unique=True).all():
            raise ValueError("a token goes on past the end of a text")
        a_group, b_group = np.searchsorted(ends, a_end), np.searchsorted(ends, b_end)
        return cls(
            a, b, a_text, b_text, a_group, b_group,
            a_text[np.searchsorted(a_end, ends)] if len(ends) else np.zeros(0, np.int64),
            over_bytes @ b_over_bytes.transposed(),
        )

    def _groups(self) -> tuple[Csr, Csr]:
        n = len(self.group_text)
        return Csr.of_labels(self.a_group, n), Csr.of_labels(self.b_group, n).transposed()

    def shared(self) -> Csr:
        """Shared-group links: tokens of A by tokens of B of the same group."""
        left, right = self._groups()
        return left @ right

    def shared_counts(self) -> np.ndarray:
        """Shared-group links of each token of A."""
        left, right = self._groups()
        return left.row_sizes(right)

    def described(self, tokenizers: Tokenizers, n_texts: int) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for the groups of each text; empty without tokens."""
        n, m = len(tokenizers.a_bytes), len(tokenizers.b_bytes)
        last_a = np.append(self.a_group[1:] != self.a_group[:-1], True)[: len(self.a)]
        last_b = np.append(self.b_group[1:] != self.b_group[:-1], True)[: len(self.b)]
        codes = np.concatenate([self.a + n * last_a, 2 * n + self.b + m * last_b])
        order = np.argsort(np.concatenate([2 * self.a_group, 2 * self.b_group + 1]), kind="stable")
        signs = tokenizers.marks[codes[order]].tolist()
        stops = np.cumsum(
            np.bincount(self.a_text, minlength=n_texts) + np.bincount(self.b_text, minlength=n_texts)
        ).tolist()
        return ["".join(signs[i:j])[:-1] for i, j in zip([0, *stops], stops)]


def runs_of(text: str | None) -> list[str]:
    """Space + ``text``, cut before spaces that part two words. There tokens of A and of B
    begin, as A takes such a space together with the word, and no piece of B has a space
    behind another sign. Spaces beside white space or rare signs are left alone."""
    if not text:
        return []
    if text[0] in _WORD_STARTS and not _ODD_SPACE.search(text):
        return [f" {word}" for word in text.split(" ")]
    return _CUT.split(f" {text}")


class Runs:
    """Runs met so far: their tokens' totals, linked ids and groups."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.width = len(tokenizers.b_bytes)  # a pair of ids is one number: a * width + b
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.totals = np.zeros((0, 5), np.int64)
        self.pairs, self.starts = np.zeros(0, np.int64), np.zeros(1, np.int64)
        self.met = np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keep the runs met most, half as many as there may be; those met once go."""
        kept = np.argsort(-self.met, kind="stable")[: CACHE_RUNS // 2]
        kept = np.sort(kept[self.met[kept] > 1])
        names = list(self.number)
        at, sizes = _spread(self.starts, kept)
        self.number = {names[i]: j for j, i in enumerate(kept.tolist())}
        self.groups = [self.groups[i] for i in kept.tolist()]
        self.totals, self.met, self.pairs = self.totals[kept], self.met[kept] // 2, self.pairs[at]
        self.starts = np.concatenate([[0], np.cumsum(sizes)])

    def learn(self, texts: list[list[str]]) -> None:
        if len(self.number) > CACHE_RUNS:
            self._forget()
        new = list(set().union(*texts) - self.number.keys())
        for i in range(0, len(new), LEARNT_AT_ONCE):
            self._add(new[i : i + LEARNT_AT_ONCE])

    def _add(self, new: list[str]) -> None:
        n, found = len(new), Aligned.of(self.tokenizers, new)
        row = found.links.rows()
        self.number.update(zip(new, range(len(self.number), len(self.number) + n)))
        self.groups += found.described(self.tokenizers, n)
        by_run = (found.a_text, found.b_text, found.group_text, found.a_text[row])
        totals = [np.bincount(of, minlength=n) for of in by_run] + [np.bincount(found.a_text, found.shared_counts(), n)]
        self.met = np.concatenate([self.met, np.zeros(n, np.int64)])
        self.totals = np.concatenate([self.totals, np.column_stack(totals).astype(np.int64)])
        self.pairs = np.concatenate([self.pairs, found.a[row] * self.width + found.b[found.links.columns]])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(totals[3])])

    def check(self, text: str) -> None:
        """Compare the runs of one text with the libraries' tokens of the whole."""
        whole = Aligned.of(self.tokenizers, [f" {text}"])
        if ";".join(self.groups[self.number[run]] for run in runs_of(text)) != whole.described(self.tokenizers, 1)[0]:
            raise ValueError("runs of a text have other tokens than the whole")


@lru_cache(maxsize=1)
def runs_with(byte_level_file: str | PathLike, pieces_file: str | PathLike) -> Runs:
    """One set of runs for all tasks of a worker process."""
    return Runs(tokenizers_of(byte_level_file, pieces_file))


def _spread(starts: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all entries of the rows ``items``, and how many each has."""
    sizes = starts[items + 1] - starts[items]
    ends = np.cumsum(sizes)
    n = int(ends[-1]) if len(ends) else 0
    return np.arange(n) - np.repeat(ends - sizes - starts[items], sizes), sizes


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their weights."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(weights[order], first) if len(first) else np.zeros(0, np.int64)


def align_block(known: Runs, texts: list[str | None]) -> pa.RecordBatch:
    """Totals of each text, and its linked id pairs with how often each occurs."""
    n = len(texts)
    cut = [runs_of(text) for text in texts]
    known.learn(cut)
    number = np.fromiter(map(known.number.__getitem__, chain.from_iterable(cut)), np.int64)
    known.met += np.bincount(number, minlength=len(known.number))
    of = np.repeat(np.arange(n), [len(runs) for runs in cut])
    # A run without tokens is one that is not given back, and with it its whole text.
    lost = np.zeros(n, bool)
    lost[of[known.totals[number, 0] == 0]] = True
    number, of = number[~lost[of]], of[~lost[of]]
    sound = [text for text, gone in zip(texts, lost) if text and not gone]
    if sound:
        known.check(min(sound, key=len))
    totals = [np.bincount(of, known.totals[number, c], n).astype(np.int64) for c in range(5)]
    stops = np.cumsum(np.bincount(of, minlength=n)).tolist()
    groups = list(map(known.groups.__getitem__, number.tolist()))
    described = [";".join(groups[i:j]) for i, j in zip([0, *stops], stops)]
    # Runs of a text that occur again are expanded once.
    runs = len(known.number)
    key, times = _summed(of * runs + number, np.ones(len(of), np.int64))
    at, sizes = _spread(known.starts, key % max(runs, 1))
    pairs = len(known.tokenizers.a_bytes) * known.width
    key, times = _summed(np.repeat(key // max(runs, 1), sizes) * pairs + known.pairs[at], np.repeat(times, sizes))
    of, pair = key // pairs, key % pairs
    return pa.RecordBatch.from_arrays(
        [
            *map(pa.array, totals),
            pa.array([hashlib.sha256(d.encode()).hexdigest() if d else "" for d in described]),
            _chunks(np.bincount(of, minlength=n), pair // known.width, pair % known.width, times),
        ],
        names=[c.split()[0] for c in f"{_TOTALS}, {_PAIRS}".split(", ")],
    )


def _chunks(sizes: np.ndarray, *columns: np.ndarray) -> pa.Array:
    """Lists of lists: the next ``sizes`` entries of the columns, ``CHUNK_PAIRS`` at a time."""
    per_text = -(-sizes // CHUNK_PAIRS)
    text = np.repeat(np.arange(len(sizes)), per_text)
    number = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    starts = np.repeat(np.cumsum(sizes) - sizes, per_text) + number * CHUNK_PAIRS
    inner = pa.array(np.append(starts, int(sizes.sum())), pa.int32())
    lists = [pa.ListArray.from_arrays(inner, pa.array(c.astype(np.int32))) for c in columns]
    outer = pa.array(np.concatenate([[0], np.cumsum(per_text)]), pa.int32())
    return pa.ListArray.from_arrays(outer, pa.StructArray.from_arrays(lists, names=["a", "b", "times"]))


def aligned_pairs(docs: DataFrame, byte_level_file: str | PathLike, pieces_file: str | PathLike, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns of ``docs`` with n_a, n_b, n_groups, n_links, n_shared (shared-group
    links), groups_sha256, and in ``chunks`` the linked ids ``a`` and ``b`` with ``times`` beside them."""
    text = spare(list(keep), "text")
    schema = StructType([*docs.select(*keep).schema, *StructType.fromDDL(f"{_TOTALS}, {_PAIRS}")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = runs_with(byte_level_file, pieces_file)
        for batch in batches:
            column = batch.column(len(keep))
            for start, stop in blocks(column, BLOCK_BYTES):
                found = align_block(known, column.slice(start, stop - start).to_pylist())
                kept = [batch.column(i).slice(start, stop - start) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, *found.columns], schema=_arrow(schema, kept, found))

    return docs.select(*keep, docs["text"].alias(text)).mapInArrow(run, schema)


def _arrow(schema: StructType, kept: list[pa.Array], found: pa.RecordBatch) -> pa.Schema:
    types = [*(k.type for k in kept), *found.schema.types]
    return pa.schema([pa.field(f.name, t) for f, t in zip(schema, types)])


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(pair, count, best): in how many texts the ids of ``pair`` are linked, and whether
    no other pair of its A id is in more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            a, b = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("a", "b"))
            held.append(np.unique(a << _SHIFT | b, return_counts=True))
            size += len(held[-1][0])
            if size > HOT_PAIRS:
                held = [_merged(held)]
                size = len(held[0][0])
                if size > HOT_PAIRS // 2:
                    yield from _rows(held[0])
                    held, size = [], 0
        if held:
            yield from _rows(_merged(held))

    counted = durable(
        pairs.select(F.explode("chunks").alias("c")).select("c.a", "c.b").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("count"))
    )
    a = F.shiftright("pair", _SHIFT)
    # One row for each id of A.
    most = counted.groupBy(a.alias("a")).agg(F.max("count").alias("most"))
    return durable(
        counted.withColumn("a", a).join(F.broadcast(most), "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    )


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def _rows(counts: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(counts[0]), 200_000):
        yield pa.RecordBatch.from_arrays([pa.array(c[i : i + 200_000]) for c in counts], names=["pair", "n"])


@dataclass(frozen=True)
class Hot:
    """Pairs that many texts hold, sorted."""

    pairs: np.ndarray
    counts: np.ndarray
    best: np.ndarray

    @classmethod
    def of(cls, table: DataFrame, least: int) -> Hot:
        rows = table.where(F.col("count") >= least).toArrow()
        pairs = rows.column("pair").to_numpy()
        order = np.argsort(pairs)
        return cls(pairs[order], rows.column("count").to_numpy()[order], rows.column("best").to_numpy().astype(bool)[order])

    def find(self, pairs: np.ndarray) -> np.ndarray:
        """Place of each pair, or -1."""
        if not len(self.pairs):
            return np.full(len(pairs), -1)
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pairs, at, -1)


def least_hot(total: int, most: int = HOT_PAIRS) -> int:
    """Pairs with this count or more are at most ``most``, if all counts sum to ``total``."""
    return max(1, -(-total // most))


def align(
    docs: DataFrame,
    byte_level_file: str | PathLike,
    pieces_file: str | PathLike,
    keep: tuple[str, ...] = ("doc_id",),
    hot_pairs: int = HOT_PAIRS,
) -> DataFrame:
    """The kept columns with n_a, n_b, n_groups, n_links, n_best (links whose count is the
    highest of their A id), count_sum (over links), groups_sha256 and n_shared."""
    written = durable(aligned_pairs(docs, byte_level_file, pieces_file, keep).withColumn("_row", F.monotonically_increasing_id()))
    table = pair_counts(written)
    total = table.agg(F.sum("count")).first()[0] or 0
    least = least_hot(int(total), hot_pairs)
    sent = docs.sparkSession.sparkContext.broadcast(Hot.of(table, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("_row").to_numpy()
            first = np.flatnonzero(np.diff(rows, prepend=-1))
            of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(rows))))
            of = np.repeat(of, np.asarray(batch.column("a").value_lengths()))
            a, b, times = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("a", "b", "times"))
            pairs, n, hot = a << _SHIFT | b, len(first), sent.value
            at = hot.find(pairs)
            known = at >= 0
            place, weight, owner = at[known], times[known], of[known]
            best, sums = np.zeros(n, np.int64), np.zeros(n, np.int64)
            if len(place):
                np.add.at(best, owner, weight * hot.best[place])
                np.add.at(sums, owner, weight * hot.counts[place])
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(of[~known], minlength=n))]), pa.int32())
            rare = [
                pa.ListArray.from_arrays(offsets, pa.array(values[~known].astype(kind)))
                for values, kind in ((pairs, np.int64), (times, np.int32))
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[first]), pa.array(best), pa.array(sums), *rare],
                names=["_row", "best", "sum", "pairs", "times"],
            )

    schema = "_row long, best long, sum long, pairs array<long>, times array<int>"
    chunks = written.select("_row", F.explode("chunks").alias("c")).select("_row", "c.*")
    scored = durable(chunks.mapInArrow(run, schema))
    rare = (
        scored.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
        .select("_row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
        .join(table.where(F.col("count") < least), "pair")
        .select(
            "_row",
            F.when(F.col("best"), F.col("times")).otherwise(0).cast("long").alias("best"),
            (F.col("times") * F.col("count")).alias("sum"),
        )
    )
    summed = scored.select("_row", "best", "sum").unionByName(rare).groupBy("_row").agg(F.sum("best").alias("_best"), F.sum("sum").alias("_sum"))
    return written.join(summed, "_row", "left").select(
        *keep,
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("_best", F.lit(0).cast("long")).alias("n_best"),
        F.coalesce("_sum", F.lit(0).cast("long")).alias("count_sum"),
        "groups_sha256",
        "n_shared",
    )
