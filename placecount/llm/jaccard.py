"""Exact Jaccard join of word shingle sets by parity sketches.

Every shingle of a set flips one bit of the set's sketch. A shingle that two sets
share flips the same bit in both, so the Hamming distance of two sketches is at most
the size of the sets' symmetric difference. Sets of similarity t and sizes a and b
differ in at most (1-t)/(1+t)*(a+b) shingles, so their sketches, cut into more parts
than that, agree in some part (pigeonhole). Parts are joined by their hash.

* Size bands: sizes from 2^i to 2^(i+1)-1 share band i and its number of parts. A set
  whose partners may lie in the band below takes part in that band as well.
* A set need not give all its parts. If it has E parts that are not empty and may
  differ in D, it agrees with any partner in E-D of them, so D+1 of its parts are
  enough if all sets order parts alike (the prefix principle). The order puts parts
  with many set bits first; those are the ones that unrelated sets rarely share.
  If E is not above D, the set gives all parts and also takes part under another seed.
* Equal sets are one vertex from the start, named by a hash of the set; that no two
  different sets have the same name is checked.
* Sets that share a part are not paired with each other: each is compared with the
  least of them. Verified links make components; only parts whose sets are still in
  different components are taken up again. Of a part with few sets all lead, so one
  round settles it; of one with many, the sets of the smallest components are leaders
  in turn, as all that the largest one's members lack is a comparison with those. Only
  the sketches of sets that are taken up go into the rounds. Tasks hold a bounded
  number of leaders and pass the other sets by them, so
  pairs that are too far apart are never rows. Of pairs that would join the same
  components a task gives one of the nearest at first, so it gives fewer rows than it
  reads; only if a pair turns out to be no link are all others of the components that
  are still apart tried. So no link is lost, and a group of copies costs one
  comparison each.
* A pair is verified by the Hamming distance of whole sketches, then by the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from placecount.llm.components import components
from placecount.llm.text import blocks, lower_ascii, mix, shingle_sets, spans_hash, spare, utf8, words
from placecount.session import durable

SHINGLE_WORDS = 4
PERCENT = 85
PARTS_PER_DIFFERENCE = 1.5
PART_BITS = 1024
SKETCH_BITS = 2
SEEDS = 4
# Under a key with up to ALL_LEAD sets all lead; else so many at first, and ever more.
ALL_LEAD = 4096
LEADERS = 16
MOST_LEADERS = 4096
MEMBERS_PER_TASK_ROW = 2_000
COMPARED_PER_LEADER_ROW = 64
# Ids of texts or sets are sent to all tasks up to this number, 16 bytes each.
BROADCAST_IDS = 1_000_000
_SEEN = 300_000
_SEEN_PAIRS = 1_000_000
_PAIRS_OF_BATCH = 200_000
_COMPARED_BYTES = 1 << 20

_U = np.uint64
_C1, _C2, _C3 = _U(0xA0761D6478BD642F), _U(0xE7037ED1A0B428DB), _U(0x8EBC6AF09C88C6E3)
_SETS = "v long, w long, n long, sketch binary, keys array<long>"


def max_difference(total: int, percent: int) -> int:
    """Largest symmetric difference of linked sets with ``total`` members together."""
    return (100 - percent) * total // (100 + percent)


def _own_difference(n: int, percent: int) -> int:
    return max_difference(n + n * 100 // percent, percent)


def _parts(band: int, percent: int) -> int:
    return int(PARTS_PER_DIFFERENCE * (_own_difference((2 << band) - 1, percent) + 1)) + 1


def _schemes(n: int, percent: int) -> list[tuple[int, int]]:
    """(band, most differences) of each band that a set of ``n`` takes part in."""
    band = n.bit_length() - 1
    below = (1 << band) - 1
    found = [(band, _own_difference(n, percent))]
    if below and below * 100 >= n * percent:
        found.append((band - 1, max_difference(n + below, percent)))
    return found


def part_keys(hashes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Keys of the sketch parts by which a set meets its partners."""
    keys = []
    for band, most in _schemes(len(hashes), percent):
        if not most:
            continue  # sets without a difference are one vertex already
        parts = _parts(band, percent)
        for seed in range(SEEDS):
            z = mix(hashes ^ mix(np.array([seed * 131 + 17], _U)))
            part = ((z >> _U(32)) * _U(parts)) >> _U(32)
            bits, times = np.unique(part * _U(PART_BITS) + (z & _U(PART_BITS - 1)), return_counts=True)
            bits = bits[times % 2 == 1]  # the bits that are set
            own = bits // _U(PART_BITS)
            at = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(bits) else np.zeros(0, np.int64)
            number = own[at]
            content = np.bitwise_xor.reduceat(mix(bits + _C1), at) if len(bits) else np.zeros(0, _U)
            size = np.diff(np.append(at, len(bits)))
            enough = len(at) > most
            if not enough and seed == SEEDS - 1:
                empty = np.setdiff1d(np.arange(parts, dtype=_U), number)
                number = np.concatenate([number, empty])
                content = np.concatenate([content, np.zeros(len(empty), _U)])
                size = np.concatenate([size, np.zeros(len(empty), np.int64)])
            scheme = np.array([band * SEEDS + seed + 1], _U) * _C3
            key = mix(content ^ mix(number * _C2 + scheme))
            keys.append(key[np.lexsort((key, -size))[: most + 1]] if enough else key)
            if enough:
                break
    return np.concatenate(keys) if keys else np.zeros(0, _U)


def parity_sketch(hashes: np.ndarray) -> bytes:
    """``SKETCH_BITS`` bits for each member or up to twice as many, and at least 64. Few
    members of a difference meet in a bit, so few pairs beyond the limit look within it."""
    bits = max(64, 1 << (SKETCH_BITS * len(hashes) - 1).bit_length())
    at = (mix(hashes ^ _C2) & _U(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits) & 1, bitorder="little").tobytes()


def hamming(a: bytes, b: bytes) -> int:
    """Distance of two sketches; the longer one is folded to the shorter one's length."""
    x, y = (np.frombuffer(s, np.uint8) for s in (a, b))
    size = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(s.reshape(-1, size), axis=0) for s in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def _names(hashes: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit hashes of a set, as signed numbers."""
    n = _U(len(hashes))
    pair = np.array([mix(hashes ^ _C1).sum(dtype=_U) + n, mix(hashes ^ _C3).sum(dtype=_U) ^ n], _U)
    first, second = mix(pair).view(np.int64).tolist()
    return first, second


def _block_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    data, offsets = utf8(column)
    data = lower_ascii(data)
    w = words(data, offsets)
    return shingle_sets(w, spans_hash(data, w.start, w.end), k)


def sketch_sets(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id, v, w, n, sketch, keys) of each text; v is null for a text without words.
    A task gives the keys of a set once, however many of its texts have that set."""
    schema = StructType([*docs.select("doc_id").schema, *StructType.fromDDL(_SETS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            texts = batch.column("text")
            for start, stop in blocks(texts):
                rows, keys = [], []
                for hashes in _block_sets(texts.slice(start, stop - start), k):
                    name, other = _names(hashes) if len(hashes) else (None, None)
                    repeated = name is None or name in seen
                    if not repeated:
                        if len(seen) >= _SEEN:
                            seen.clear()
                        seen.add(name)
                    rows.append((name, other, len(hashes), parity_sketch(hashes) if name is not None else None))
                    keys.append(np.zeros(0, _U) if repeated else part_keys(hashes, percent))
                columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in keys])]), pa.int32())
                values = pa.array(np.concatenate(keys).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, stop - start), *columns, pa.ListArray.from_arrays(offsets, values)],
                    names=["doc_id", "v", "w", "n", "sketch", "keys"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _within_reach(pairs: DataFrame, vertices: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and sketches allow a link."""
    known = ("n", "sketch")
    for side in ("a", "b"):
        pairs = pairs.join(
            vertices.select(F.col("v").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in known]), side
        )
    fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("n_a", "n_b", "sketch_a", "sketch_b"))
            near = [hamming(a, b) <= max_difference(n + m, percent) for n, m, a, b in zip(*columns)]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return pairs.where(fits).mapInArrow(run, "a long, b long")


def _shared(keys: DataFrame) -> DataFrame:
    """(key, lead, v) of each set under a key that another set has too; ``lead`` is the
    least of them. Keys are dealt once and streamed in order, and those of one set are
    dropped on the way."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, lead, waiting = None, None, False  # the row before; whether its key has one set so far
        for batch in batches:
            key, v = (batch.column(c).to_numpy() for c in ("key", "v"))
            if not len(key):
                continue
            starts = np.append(last is None or key[0] != last[0], key[1:] != key[:-1])
            repeated = ~starts & np.append(last is not None and v[0] == last[1], v[1:] == v[:-1])
            key, v, starts = key[~repeated], v[~repeated], starts[~repeated]
            if not len(key):
                continue
            goes_on = not starts[0]
            if goes_on:  # the least set of the key is in an earlier batch
                key, v = np.append(last[0], key), np.append(lead, v)
                starts = np.append(True, starts)
            first = np.flatnonzero(starts)
            of = np.cumsum(starts) - 1
            sizes = np.diff(np.append(first, len(key)))
            kept = sizes[of] > 1
            if goes_on and not waiting:
                kept[0] = False  # given already
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[kept]), pa.array(v[first][of][kept]), pa.array(v[kept])], names=["key", "lead", "v"]
            )
            last, lead, waiting = (key[-1], v[-1]), v[first[-1]], sizes[-1] == 1

    dealt = keys.repartition("key").sortWithinPartitions("key", "v")
    return dealt.mapInArrow(run, "key long, lead long, v long")


def _leading(rows: DataFrame, leaders: int) -> DataFrame:
    """(key, v) of the ``leaders`` sets of the smallest components of each key. The first of
    each part of a key are found before those of the whole, so no task ranks a whole key."""
    by_size = ("size", "v")
    of_part = F.row_number().over(Window.partitionBy("key", "part").orderBy(*by_size))
    of_key = F.row_number().over(Window.partitionBy("key").orderBy(*by_size))
    first = rows.select("key", "part", "size", "v", of_part.alias("rank")).where(F.col("rank") <= leaders)
    return first.select("key", "v", of_key.alias("rank")).where(F.col("rank") <= leaders).select("key", "v")


def _near_pairs(marked: DataFrame, vertices: DataFrame, percent: int, every: bool = False) -> DataFrame:
    """Pairs (a, b), a < b, of a leading set and another one of the same key but another
    component that sizes and sketches allow to link. The rows of a key are split over
    tasks, to each of which its leaders go; there are at most ``MOST_LEADERS``. Without
    ``every`` a task leaves out pairs of components that its other pairs join already.
    """
    columns = ("v", "root", "n", "sketch")
    members = marked.where("leads is null").select("key", "part", F.lit(1).alias("kind"), "v", "root")
    leading = marked.where("leads").select(
        "key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), "v", "root"
    )
    placed = leading.unionAll(members).join(vertices.select("v", "n", "sketch"), "v")
    laid_out = (
        placed.select("key", "part", "kind", *columns)
        .repartition("key", "part")
        .sortWithinPartitions("key", "part", "kind")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, leaders = None, []
        seen: set[tuple[int, int]] = set()  # sets that are alike share many keys
        up: dict[int, int] | None = None if every else {}
        for batch in batches:
            place = list(zip(batch.column("key").to_pylist(), batch.column("part").to_pylist()))
            kinds = batch.column("kind").to_pylist()
            rows = list(zip(*(batch.column(c).to_pylist() for c in columns)))
            pairs: set[tuple[int, int]] = set()
            start = 0
            for stop in range(1, len(rows) + 1):
                if stop < len(rows) and (place[stop], kinds[stop]) == (place[start], kinds[start]):
                    continue
                if place[start] != at:
                    at, leaders = place[start], []
                if kinds[start] == 0:  # the same leaders in every part of a key
                    if place[start][1] == 0:
                        pairs |= _near(rows[start:stop], leaders + rows[start:stop], percent, up)
                    leaders += rows[start:stop]
                else:
                    pairs |= _near(leaders, rows[start:stop], percent, up)
                start = stop
                if len(pairs) < _PAIRS_OF_BATCH and stop < len(rows):
                    continue
                pairs -= seen
                if len(seen) > _SEEN_PAIRS:
                    seen.clear()
                seen |= pairs
                if up and len(up) > _SEEN_PAIRS:
                    up.clear()
                columns_out = zip(*sorted(pairs)) if pairs else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns_out], names=["a", "b"])
                pairs = set()

    return laid_out.mapInArrow(run, "a long, b long").distinct()


def _top(up: dict[int, int], root: int) -> int:
    while (above := up.get(root, root)) != root:
        up[root] = root = up.get(above, above)
    return root


def _near(
    leaders: list[tuple], members: list[tuple], percent: int, up: dict[int, int] | None = None
) -> set[tuple[int, int]]:
    """Pairs of (v, root, n, sketch) rows of different components within reach. Sketches
    of one key have two lengths at most, or three; each is folded once. ``up`` leads from
    components to those that pairs have joined them to: with it, of the pairs of a leader
    and a component only the nearest counts, and only if it joins what is apart."""
    shortest = min(len(row[3]) for row in (*leaders, *members))

    def arrays(rows):
        folded = [
            np.bitwise_xor.reduce(np.frombuffer(row[3], np.uint64).reshape(-1, shortest // 8), axis=0) for row in rows
        ]
        return *(np.array([row[i] for row in rows], np.int64) for i in range(3)), np.array(folded)

    v, root, n, bits = arrays(members)
    lead, lead_root, lead_n, lead_bits = arrays(leaders)
    found = set()
    step = max(1, _COMPARED_BYTES // max(1, bits.nbytes))
    for begin in range(0, len(lead), step):
        some = slice(begin, begin + step)
        n_a, root_a = lead_n[some, None], lead_root[some, None]
        fits = (root != root_a) & (np.minimum(n, n_a) * 100 >= np.maximum(n, n_a) * percent)
        if not fits.any():
            continue
        distance = np.bitwise_count(bits ^ lead_bits[some, None]).sum(axis=2, dtype=np.int64)
        near = fits & (distance <= (100 - percent) * (n + n_a) // (100 + percent))
        for i in np.flatnonzero(near.any(axis=1)).tolist():
            at, a = np.flatnonzero(near[i]), int(lead[begin + i])
            if up is None:
                found |= {(min(a, b), max(a, b)) for b in v[at].tolist()}
                continue
            at = at[np.argsort(distance[i, at], kind="stable")]
            at = at[np.unique(root[at], return_index=True)[1]]
            for b, root_b in zip(v[at].tolist(), root[at].tolist()):
                x, y = _top(up, int(lead_root[begin + i])), _top(up, root_b)
                if x != y:
                    up[max(x, y)] = min(x, y)
                    found.add((min(a, b), max(a, b)))
    return found


def _shingles(text: str, k: int) -> set[tuple[bytes, ...]]:
    """The set itself. Bytes are lower-cased and split in ASCII only, as is wanted here."""
    w = text.encode().lower().split()
    return set(zip(*(w[i:] for i in range(k)))) if len(w) >= k else {tuple(w)}


def _linked(near: DataFrame, vertices: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of the pairs ``near`` (written, within reach) whose texts have the wanted
    similarity, written to the shared folder.

    Texts are brought to the first of a pair, whose own text is repeated for every
    ``COMPARED_PER_LEADER_ROW`` partners; so partners of one set spread over tasks.
    """
    ends = near.select(F.col("a").alias("v")).unionAll(near.select("b")).distinct()
    wanted = durable(ends.join(vertices, "v").select("v", F.col("doc_id").alias("_id")))
    few = wanted.count() <= BROADCAST_IDS
    texts = docs.join(F.broadcast(wanted) if few else wanted, F.col("doc_id").eqNullSafe(F.col("_id"))).select(
        "v", F.coalesce("text", F.lit("")).alias("text")
    )
    degree = near.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / COMPARED_PER_LEADER_ROW).cast("int").alias("rows"))
    partners = near.join(degree, "a").select(
        "a", F.pmod(F.xxhash64("b"), "rows").cast("int").alias("part"), F.col("b").alias("v"), F.lit(1).alias("kind")
    )
    leaders = degree.select(
        "a", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("part"), F.col("a").alias("v"), F.lit(0).alias("kind")
    )
    laid_out = (
        leaders.unionAll(partners)
        .join(texts, "v")
        .repartition("a", "part")
        .sortWithinPartitions("a", "part", "kind")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, members = None, set()
        for batch in batches:
            found = []
            for start, stop in blocks(batch.column("text")):
                some = batch.slice(start, stop - start)
                columns = (some.column(c).to_pylist() for c in ("a", "kind", "v", "text"))
                names = [_names(h)[0] if len(h) else None for h in _block_sets(some.column("text"), k)]
                for a, kind, v, text, name in zip(*columns, names):
                    if name != v:
                        continue  # another text under the same id
                    if kind == 0:
                        leader, members = a, _shingles(text, k)
                    elif leader == a:
                        other = _shingles(text, k)
                        both = len(members & other)
                        if 100 * both >= percent * (len(members) + len(other) - both):
                            found.append((a, v))
            columns = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=["a", "b"])

    return durable(laid_out.mapInArrow(run, "a long, b long").distinct())


def link_classes(docs: DataFrame, k: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each of ``docs`` (doc_id, text): the smallest
    id that links reach. Two texts link if 100 * shared shingles are at least ``percent``
    (50 to 100) * all their shingles. A text of fewer than ``k`` words is one shingle;
    null and empty texts link with nothing. Repeated rows are copies of each other;
    null ids take part but never name a component unless it has no other. Other columns
    are left out.
    """
    docs = docs.select("doc_id", "text")
    sets = durable(sketch_sets(docs, k, percent))
    vertices = durable(
        sets.where(F.col("v").isNotNull())
        .groupBy("v")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.first("n").alias("n"),
            F.first("sketch").alias("sketch"),
            (F.min("w") == F.max("w")).alias("one"),
        )
    )
    if not vertices.where("not one").isEmpty():
        raise ValueError("two different sets have the same name; change the hash constants")
    shared = durable(_shared(sets.select(F.explode("keys").alias("key"), "v")))
    follow = shared.where("v != lead")
    tested = durable(follow.select(F.col("lead").alias("a"), F.col("v").alias("b")).distinct())
    links = _linked(durable(_within_reach(tested, vertices, percent)), vertices, docs, k, percent)
    roots = components(links)
    every_vertex = vertices
    rest, leaders = follow.select("key", "v"), LEADERS
    while True:
        # Parts whose sets lie in several components still hide pairs never compared.
        sizes = roots.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
        sized = roots.join(sizes, "root")
        placed = rest.join(sized, "v", "left").select(
            "key", "v", F.coalesce("root", "v").alias("root"), F.coalesce("size", F.lit(1)).alias("size")
        )
        several = placed.groupBy("key").agg(
            F.min("root").alias("x"),
            F.max("root").alias("y"),
            F.count(F.lit(1)).alias("rows"),
            *[F.bit_xor(F.xxhash64(F.lit(seed), "v")).alias(f"sets{seed}") for seed in (1, 2)],
        )
        # Sets that are alike share many keys; one of those with the same sets is enough.
        alone = several.where("x < y").groupBy("rows", "sets1", "sets2").agg(F.min("key").alias("key"))
        several = alone.select(
            "key", "rows", F.ceil(F.col("rows") / MEMBERS_PER_TASK_ROW).cast("int").alias("parts")
        )
        own = F.pmod(F.xxhash64("v"), "parts").cast("int").alias("part")
        rest = durable(placed.join(several, "key").select("*", own))
        if rest.isEmpty():
            break
        vertices = _taken_up(vertices, rest)
        crowded = F.col("rows") > ALL_LEAD
        marked = rest.where(~crowded).withColumn("leads", F.lit(True))
        crowds = not rest.where(crowded).isEmpty()
        if crowds:
            crowd = rest.where(crowded)
            leads = _leading(crowd, leaders).withColumn("leads", F.lit(True))
            marked = durable(marked.unionByName(crowd.join(leads, ["key", "v"], "left")))
        # Pairs left out are settled if all that stand for them are links.
        rows = marked
        for every in (False, True):
            near = durable(_near_pairs(rows, vertices, percent, every))
            new = durable(near.join(tested, ["a", "b"], "left_anti"))
            if every and new.isEmpty() or near.isEmpty():
                break
            found, before = _linked(new, vertices, docs, k, percent), roots
            links = links.unionAll(found)
            roots = components(links)
            tested = tested.unionAll(new)
            if every or found.count() == near.count():
                break
            rows = _apart(marked, near, before, roots)
        if not crowds:
            break
        rest, leaders = marked.where("leads is null").select("key", "v"), min(leaders * 16, MOST_LEADERS)
    return _classes(sets, every_vertex, roots)


def _taken_up(vertices: DataFrame, rest: DataFrame) -> DataFrame:
    """The ``vertices`` that occur in ``rest``, written, so that no step of a round reads
    or shuffles all others."""
    ids = durable(rest.select("v").distinct())
    few = ids.count() <= BROADCAST_IDS
    return durable(vertices.join(F.broadcast(ids) if few else ids, "v", "left_semi"))


def _apart(marked: DataFrame, near: DataFrame, before: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of the components ``before`` that the pairs ``near`` lie in, of keys that have
    several components as those are now. Pairs left out are of such components only."""
    ends = near.select(F.col("a").alias("v")).unionAll(near.select("b"))
    touched = ends.join(before, "v", "left").select(F.coalesce("root", "v").alias("root")).distinct()
    placed = marked.join(touched, "root", "left_semi").drop("root").join(roots, "v", "left")
    placed = placed.withColumn("root", F.coalesce("root", "v"))
    several = placed.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y")
    return durable(placed.join(several.select("key"), "key"))


def _classes(sets: DataFrame, vertices: DataFrame, roots: DataFrame) -> DataFrame:
    placed = vertices.select("v", "doc_id").join(roots, "v", "left").select("v", "doc_id", F.coalesce("root", "v").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_set = durable(placed.join(smallest, "root").select("v", "component_id"))
    return sets.select("doc_id", "v", F.col("n").alias("n_shingles")).join(of_set, "v", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each class: the one whose id names it. Rows that
    share an id are one document, and those without an id stay."""
    classes = durable(link_classes(docs, k, percent))
    id_ = spare(docs.columns, "id")
    others = durable(classes.where("doc_id != component_id").select(F.col("doc_id").alias(id_)).distinct())
    few = others.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(others) if few else others, F.col("doc_id") == F.col(id_), "left_anti")
