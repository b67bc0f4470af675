"""Encoding and decoding with a merge-type SentencePiece vocabulary.

Encoding keeps an agenda of adjacent symbol pairs whose join is a piece, ordered by
the piece's score and then by position. The best pair is joined and its new
neighbours enter the agenda, until it is empty. Symbols that are no pieces fall back
to bytes. The agenda of a long run is a heap; that of a short one is a plain list of
scores, searched for its first largest entry, which takes less time there. Short runs of
equal length are joined side by side: their agendas are rows of one array, and each step
joins the best pair of every row.

No piece of such a vocabulary goes on past a space mark that follows another sign, so
a text is encoded run by run ("▁▁word"), and a run seen before is not encoded again.
Every run that is encoded and decoded is checked against the sentencepiece library, and
so is one whole text of each block; a difference is an error.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from os import PathLike

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from placecount.llm.text import blocks

SPACE = "▁"
CACHE_RUNS = 60_000
SHORT_RUN = 48
_ROWS = 8  # so many runs of a length are worth an array
_NO_RANK = np.iinfo(np.int32).max
_RUN = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_NO_PIECE = float("-inf")
_OUT = "n_tokens long, ids_sha256 string, decoded_sha256 string"


class Vocabulary:
    """Pieces and scores of a model file, and the runs encoded so far."""

    def __init__(self, model_file: str | PathLike, check: bool = True):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=os.fspath(model_file))
        self.check = check
        lib, n = self.library, self.library.get_piece_size()
        self.pieces = [lib.id_to_piece(i) for i in range(n)]
        special = [lib.is_control(i) or lib.is_unknown(i) for i in range(n)]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if lib.is_byte(i)}
        self.ids = {
            p: i for i, p in enumerate(self.pieces) if not special[i] and not lib.is_byte(i)
        }
        self.scores = {p: lib.get_score(i) for p, i in self.ids.items()}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.special = {i for i in range(n) if special[i]}
        self.unknown, self.end = lib.unk_id(), lib.eos_id()
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece goes on past a space mark; texts cannot be cut into runs")
        self._unprinted = self.special | self.byte_of.keys()
        self._decimals = list(map(str, range(n)))
        # A symbol is the id of its piece, or n and the code point of a sign that is no piece.
        self._symbol_of = np.arange(n, n + 0x110000, dtype=np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self._symbol_of[ord(piece)] = i
        self._pair_keys, self._joined, self._ranks = self._pairs()
        # Ids of runs used lately, joined by spaces, and of those used before them; what runs
        # decode to is kept only where it is not the run itself.
        self._runs: dict[str, str] = {}
        self._older: dict[str, str] = {}
        self._decoded: dict[str, str] = {}
        self._older_decoded: dict[str, str] = {}

    def encode_run(self, run: str) -> list[int]:
        """Ids of one run, by the agenda."""
        symbols = self._joined_by_list(run) if len(run) <= SHORT_RUN else self._joined_by_heap(run)
        out: list[int] = []
        for symbol in symbols:
            known = self.ids.get(symbol)
            if known is not None:
                out.append(known)
            elif self.bytes:
                out += [self.bytes[b] for b in symbol.encode()]
            else:
                out.append(self.unknown)
        return out

    def _pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys of all pairs of symbols that join to a piece, the ids of those pieces and
        their ranks by score; last a key that no pair has."""
        keys, joined = [], []
        for piece, i in self.ids.items():
            for k in range(1, len(piece)):
                left, right = (
                    self.ids[s] if s in self.ids else int(self._symbol_of[ord(s)]) if len(s) == 1 else -1
                    for s in (piece[:k], piece[k:])
                )
                if left >= 0 and right >= 0:
                    keys.append(left << 32 | right)
                    joined.append(i)
        order = np.argsort(np.array(keys, np.int64))
        losses = np.array([-self.scores[self.pieces[i]] for i in joined], float)
        _, ranks = np.unique(losses, return_inverse=True)
        return (
            np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max),
            np.append(np.array(joined, np.int32)[order], np.int32(-1)),
            np.append(ranks.astype(np.int32)[order], np.int32(_NO_RANK)),
        )

    def encode_runs(self, runs: list[str]) -> list[list[int]]:
        """Ids of each run, as ``encode_run`` gives them. Takes least time if runs of equal
        length follow each other."""
        found: list[list[int]] = []
        for size, same in groupby(runs, len):
            some = list(same)
            short = size <= SHORT_RUN and len(some) >= _ROWS
            found += self._side_by_side(some, size) if short else map(self.encode_run, some)
        return found

    def _side_by_side(self, runs: list[str], size: int) -> list[list[int]]:
        """Ids of runs of ``size`` signs each. Places number the signs of all runs; a joined
        symbol stands at the place of its first sign."""
        signs = np.frombuffer("".join(runs).encode("utf-32-le"), np.uint32)
        symbols = self._symbol_of[signs]
        places = np.arange(len(symbols))
        column = places % size
        after = np.where(column < size - 1, places + 1, -1)
        before = np.where(column, places - 1, -1)
        pair = np.full(len(symbols), len(self._joined) - 1)
        ranks = np.full(len(symbols), _NO_RANK, np.int32)

        def propose(left: np.ndarray, right: np.ndarray) -> None:
            key = symbols[left].astype(np.int64) << 32 | symbols[right]
            at = np.searchsorted(self._pair_keys, key)
            pair[left] = at
            ranks[left] = np.where(self._pair_keys[at] == key, self._ranks[at], _NO_RANK)

        if size > 1:
            propose(places[after >= 0], places[before >= 0])
        rows = np.arange(len(runs))
        by_row = ranks.reshape(len(runs), size)
        while len(rows):
            left = rows * size + by_row[rows].argmin(axis=1)  # the first of equal ones
            open_ = ranks[left] < _NO_RANK
            rows, left = rows[open_], left[open_]
            right = after[left]
            symbols[left] = self._joined[pair[left]]
            symbols[right] = -1
            ranks[left] = ranks[right] = _NO_RANK
            following = after[left] = after[right]
            more = following >= 0
            before[following[more]] = left[more]
            propose(left[more], following[more])
            previous = before[left]
            more = previous >= 0
            propose(previous[more], left[more])
        stands = symbols >= 0
        row, ids = (places // size)[stands], symbols[stands]
        foreign = ids >= len(self.pieces)
        if foreign.any():
            ids, times = self._fallen_back(ids, foreign)
            row = np.repeat(row, times)
        ends = np.cumsum(np.bincount(row, minlength=len(runs))).tolist()
        ids = ids.tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def _fallen_back(self, symbols: np.ndarray, foreign: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols with the ids of their bytes, or the unknown id, in place of signs that are
        no pieces; and how many ids each symbol has become."""
        signs, which = np.unique(symbols[foreign] - len(self.pieces), return_inverse=True)
        table = np.full((len(signs), 4), -1, np.int32)
        for i, sign in enumerate(signs.tolist()):
            ids = [self.bytes[b] for b in chr(sign).encode()] if self.bytes else [self.unknown]
            table[i, : len(ids)] = ids
        filled = table[which]
        times = np.ones(len(symbols), np.int64)
        times[foreign] = (filled >= 0).sum(axis=1)
        out = np.repeat(symbols, times)
        out[np.repeat(foreign, times)] = filled[filled >= 0]
        return out, times

    def _joined_by_list(self, run: str) -> list[str]:
        score = self.scores.get
        symbols = list(run)
        agenda = [score(a + b, _NO_PIECE) for a, b in zip(symbols, symbols[1:])]
        while agenda:
            best = max(agenda)
            if best == _NO_PIECE:
                break
            i = agenda.index(best)
            symbols[i] += symbols.pop(i + 1)
            del agenda[i]
            if i < len(agenda):
                agenda[i] = score(symbols[i] + symbols[i + 1], _NO_PIECE)
            if i:
                agenda[i - 1] = score(symbols[i - 1] + symbols[i], _NO_PIECE)
        return symbols

    def _joined_by_heap(self, run: str) -> list[str]:
        symbols: list[str | None] = list(run)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[float, int, int, int]] = []
        scores = self.scores

        def propose(left: int, right: int) -> None:
            joined = symbols[left] + symbols[right]
            score = scores.get(joined)
            if score is not None:
                heapq.heappush(agenda, (-score, left, right, len(joined)))

        for i in range(n - 1):
            propose(i, i + 1)
        while agenda:
            _, left, right, size = heapq.heappop(agenda)
            a, b = symbols[left], symbols[right]
            if a is None or b is None or len(a) + len(b) != size:
                continue  # one of the two has been joined meanwhile
            symbols[left], symbols[right] = a + b, None
            following = after[left] = after[right]
            if following >= 0:
                before[following] = left
                propose(left, following)
            if before[left] >= 0:
                propose(before[left], left)
        return [symbol for symbol in symbols if symbol is not None]

    def decode(self, ids: list[int]) -> str:
        """Text of ids: bytes joined as UTF-8, space marks as spaces, the first dropped."""
        return self._decode_run(ids).removeprefix(" ")

    def _decode_run(self, ids: list[int]) -> str:
        if self._unprinted.isdisjoint(ids):
            return "".join([self.pieces[i] for i in ids]).replace(SPACE, " ")
        out, pending = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                pending.append(self.byte_of[i])
                continue
            if pending:
                out.append(pending.decode(errors="replace"))
                pending.clear()
            if i not in self.special:
                out.append(self.pieces[i])
        if pending:
            out.append(pending.decode(errors="replace"))
        return "".join(out).replace(SPACE, " ")

    def runs(self, text: str) -> list[str]:
        return _RUN.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for run in self.runs(text) for i in self.encode_run(run)]

    def learn(self, texts: list[list[str]]) -> None:
        """Encode and decode the runs of texts that are not known yet, and check them."""
        if len(self._runs) > CACHE_RUNS:
            self._older, self._runs = self._runs, {}
            self._older_decoded, self._decoded = self._decoded, {}
        wanted = set().union(*texts) - self._runs.keys()
        again = wanted & self._older.keys()
        for run in again:  # a run is known once
            self._runs[run] = self._older.pop(run)
            if run in self._older_decoded:
                self._decoded[run] = self._older_decoded.pop(run)
        new = sorted(wanted - again, key=len)
        found = self.encode_runs(new)
        if self.check:
            # The library puts the first space mark itself; it has none for an empty text.
            expected = self.library.encode([run[1:].replace(SPACE, " ") for run in new], num_threads=1)
            for run, ids, theirs in zip(new, found, expected):
                if run != SPACE and ids != theirs:
                    raise ValueError(f"encoding differs from the library's: {run!r}")
        decoded = [self._decode_run(ids) for ids in found]
        if self.check:
            for run, text, theirs in zip(new, decoded, self.library.decode(found, num_threads=1) if found else []):
                if text.removeprefix(" ") != theirs:
                    raise ValueError(f"decoding differs from the library's: {run!r}")
        for run, ids, text in zip(new, found, decoded):
            self._runs[run] = " ".join([self._decimals[i] for i in ids])
            if text != run.replace(SPACE, " "):
                self._decoded[run] = text

    def known(self, runs: list[str]) -> tuple[str, int, str]:
        """Of a text whose runs are known: its ids joined by spaces, their number, and the
        text they decode to. No character's bytes lie in two runs, so runs decode alone."""
        if not runs:
            return "", 0, ""
        ids = " ".join(map(self._runs.__getitem__, runs))
        texts = (self._decoded.get(run, run) for run in runs) if self._decoded else runs
        return ids, ids.count(" ") + 1, "".join(texts).replace(SPACE, " ").removeprefix(" ")


@lru_cache(maxsize=1)
def vocabulary_of(model_file: str | PathLike, check: bool) -> Vocabulary:
    """One vocabulary for all tasks of a worker process."""
    return Vocabulary(model_file, check)


def encode_documents(
    docs: DataFrame,
    model_file: str | PathLike,
    keep: tuple[str, ...] = ("doc_id",),
    check: bool = True,
    with_ids: bool = False,
) -> DataFrame:
    """Adds n_tokens, ids_sha256, decoded_sha256 and, if asked for, the ids to the kept
    columns of ``docs``: ids with an end id, and the text they decode to. Null text is
    empty: its end id alone. Repeated rows are encoded one by one."""
    added = StructType.fromDDL(_OUT + ", ids array<int>" * with_ids)
    schema = StructType([*docs.select(*keep).schema, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(model_file, check)
        for batch in batches:
            column = batch.column("_text")
            for start, stop in blocks(column):
                texts = [t or "" for t in column.slice(start, stop - start).to_pylist()]
                yield _encoded(vocabulary, texts, batch.select(list(keep)).slice(start, stop - start), with_ids)

    return docs.select(*keep, docs["text"].alias("_text")).mapInArrow(run, schema)


def _encoded(vocabulary: Vocabulary, texts: list[str], kept: pa.RecordBatch, with_ids: bool) -> pa.RecordBatch:
    runs = [vocabulary.runs(text) for text in texts]
    vocabulary.learn(runs)
    counts, ids_sha, decoded_sha, arrays = [], [], [], []
    for i, text in enumerate(texts):
        joined, n, decoded = vocabulary.known(runs[i])
        whole = f"{joined} {vocabulary.end}" if joined else str(vocabulary.end)
        if i == 0 and vocabulary.check:
            theirs = vocabulary.library.encode(text, add_eos=True)
            if whole != " ".join(map(str, theirs)) or decoded != vocabulary.library.decode(theirs):
                raise ValueError("encoding or decoding of a text differs from the library's")
        counts.append(n + 1)
        if with_ids:
            arrays.append(np.array(whole.split(), np.int32))
        ids_sha.append(hashlib.sha256(whole.encode()).hexdigest())
        decoded_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
    for name, values in (("n_tokens", counts), ("ids_sha256", ids_sha), ("decoded_sha256", decoded_sha)):
        kept = kept.append_column(name, pa.array(values, pa.int64() if name == "n_tokens" else pa.string()))
    return kept.append_column("ids", pa.array(arrays, pa.list_(pa.int32()))) if with_ids else kept
