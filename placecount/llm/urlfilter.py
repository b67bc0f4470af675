"""URL filtering by rules and by an exact Bloom filter cascade.

The cascade (Larisch et al., CRLite, 2017) knows every key of the corpus when it is
built. Level 1 holds the listed keys; the keys that it wrongly holds make level 2;
the listed keys that level 2 wrongly holds make level 3, and so on until a level
errs on no key. For keys of that universe the answer is exact, and a page needs no
join: it asks the filter.

Keys are cut by hash into shards of bounded size, each with a cascade of its own, so
no task builds or holds more than one shard. Tasks sort their pages by shard and
read one shard's levels at a time from the shared folder. A host with a third of
all pages costs its tasks one lookup per page, wherever those pages are.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placecount.llm import store
from placecount.llm.text import mix
from placecount.llm.text import spare
from placecount.session import durable, shared_dir

SHARD_KEYS = 100_000
FIRST_RATE = 0.02
LATER_RATE = 0.5
MAX_LEVELS = 64

# The upper-case letters that are lower-cased in hosts.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Fixed values: (host, path, verdict) rules.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

_AFTER_SCHEME = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    """Host of a url, A-Z lower-cased; empty for null or without ``://``."""
    host = F.coalesce(F.regexp_extract(url, _AFTER_SCHEME, 1), F.lit(""))
    return F.translate(host, _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _AFTER_SCHEME, 2), F.lit(""))


def match_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as ``struct(rule, verdict)``, or null."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    fitting = [
        F.when(
            ((host == name) | host.endswith(f".{name}")) & path.startswith(prefix),
            F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for name, prefix, verdict in ordered
    ]
    return F.coalesce(*fitting)


def _bits(keys: int, rate: float) -> int:
    return max(64, math.ceil(-keys * math.log(rate) / math.log(2) ** 2))


def _positions(h1: np.ndarray, h2: np.ndarray, level: int, hashes: int, bits: int) -> np.ndarray:
    """Bit positions of each key at a level; both 64-bit hashes take part."""
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    a, b = mix(h1 + seed), mix(h2 ^ seed) | np.uint64(1)
    steps = np.arange(hashes, dtype=np.uint64)[:, None]
    return (a[None, :] + steps * b[None, :]) % np.uint64(bits)


def _held(level: dict, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    at = _positions(h1, h2, level["level"], level["hashes"], level["bits"])
    data = np.frombuffer(level["data"], np.uint8)
    return ((data[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def build_cascade(h1: np.ndarray, h2: np.ndarray, listed: np.ndarray) -> list[dict]:
    """Levels of one shard. Levels alternate between listed and other keys."""
    inside = (h1[listed], h2[listed])
    outside = (h1[~listed], h2[~listed])
    levels: list[dict] = []
    while len(inside[0]):
        if len(levels) == MAX_LEVELS:
            raise ValueError("two keys of different kind share both hashes")
        rate = FIRST_RATE if not levels else LATER_RATE
        bits = _bits(len(inside[0]), rate)
        hashes = max(1, round(-math.log2(rate)))
        at = _positions(*inside, len(levels), hashes, bits).ravel().astype(np.int64)
        data = np.zeros((bits + 7) // 8, np.uint8)
        np.bitwise_or.at(data, at >> 3, (1 << (at & 7)).astype(np.uint8))
        level = {"level": len(levels), "hashes": hashes, "bits": bits, "data": data.tobytes()}
        levels.append(level)
        wrong = _held(level, *outside) if len(outside[0]) else np.zeros(0, bool)
        inside, outside = (outside[0][wrong], outside[1][wrong]), inside
    return levels


def in_cascade(levels: list[dict], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Membership of known keys: the first level that does not hold a key decides."""
    passed = np.zeros(len(h1), np.int64)
    still = np.arange(len(h1))
    for level in levels:
        still = still[_held(level, h1[still], h2[still])]
        passed[still] += 1
    return passed % 2 == 1


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2")]


def write_cascade(keys: DataFrame, shard_keys: int = SHARD_KEYS) -> tuple[str, int]:
    """Build the cascade of ``keys`` (key, listed) in the shared folder; returns its
    path and number of shards. A key with several rows is listed if any row is."""
    universe = durable(
        keys.where(F.col("key").isNotNull()).groupBy("key").agg(F.max("listed").alias("listed"))
    )
    shards = max(1, math.ceil(universe.count() / shard_keys))
    hashed = universe.select(
        *_hashes(F.col("key")), F.coalesce("listed", F.lit(False)).alias("listed")
    ).withColumn("shard", F.pmod("h1", F.lit(shards)))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        h1, h2 = (pdf[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
        rows = build_cascade(h1, h2, pdf["listed"].to_numpy(bool))
        return pd.DataFrame(rows, columns=["level", "hashes", "bits", "data"]).assign(
            shard=int(pdf["shard"].iloc[0])
        )[["shard", "level", "hashes", "bits", "data"]]

    path = shared_dir(keys.sparkSession)
    hashed.groupBy("shard").applyInPandas(
        build, "shard long, level int, hashes int, bits long, data binary"
    ).write.partitionBy("shard").parquet(path)
    return path, shards


def _shard_levels(path: str, shard: int) -> list[dict]:
    rows: list[dict] = []
    for name in store.names(f"{path}/shard={shard}"):
        if name.endswith(".parquet"):
            rows += pq.read_table(io.BytesIO(store.read(name))).to_pylist()
    return sorted(rows, key=lambda row: row["level"])


def listed(rows: DataFrame, key: str, path: str, shards: int) -> DataFrame:
    """``rows`` with boolean ``listed``: exact for keys of the cascade's universe.
    A null key is never listed; a column of that name is replaced. No shuffle and no
    join: each task sorts its own rows by shard."""
    rows = rows.drop("listed")
    added = first, second, of_shard = [spare(rows.columns, name) for name in ("h1", "h2", "shard")]
    h1, h2 = _hashes(F.col(key))
    local = rows.withColumns(
        {
            first: F.when(F.col(key).isNotNull(), h1),
            second: F.when(F.col(key).isNotNull(), h2),
        }
    ).withColumn(of_shard, F.pmod(first, F.lit(shards)))
    out = rows.select("*").schema.add("listed", "boolean")

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, levels = None, []
        for batch in batches:
            shard = batch.column(of_shard).to_pylist()
            found = np.zeros(batch.num_rows, bool)
            start = 0
            for stop in range(1, len(shard) + 1):
                if stop < len(shard) and shard[stop] == shard[start]:
                    continue
                if shard[start] is not None:
                    if shard[start] != current:
                        current, levels = shard[start], _shard_levels(path, shard[start])
                    h = [
                        np.asarray(batch.column(c).slice(start, stop - start)).view(np.uint64)
                        for c in (first, second)
                    ]
                    found[start:stop] = in_cascade(levels, *h)
                start = stop
            kept = batch.drop_columns(added)
            yield kept.append_column("listed", pa.array(found))

    return local.sortWithinPartitions(of_shard).mapInArrow(look_up, out)


def judge(pages: DataFrame, keys: DataFrame, rules=RULES) -> DataFrame:
    """Verdict on each page: the longest fitting rule's, else block if the host is
    among the listed ``keys`` (key, listed), which must cover the pages' hosts.

    Pages need ``page_id`` and ``url``; other columns are left out. Null urls have
    an empty host and path. Repeated pages are judged one by one.
    """
    hosts = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    path, shards = write_cascade(keys)
    rule = match_rule(F.col("host"), F.col("path"), rules)
    return (
        listed(hosts, "host", path, shards)
        .withColumn("_rule", rule)
        .select(
            "page_id",
            "host",
            "path",
            F.col("_rule.rule").alias("rule"),
            F.coalesce(F.col("_rule.verdict"), F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
            "listed",
        )
    )


def hosts_with(pages: DataFrame, terms: tuple[str, ...]) -> DataFrame:
    """The corpus's hosts as keys, listed where a name of the host holds a term."""
    host = url_host(F.col("url"))
    pattern = "(^|[.-])(" + "|".join(terms) + ")([.-]|[0-9]|$)"
    return pages.select(host.alias("key")).distinct().withColumn("listed", F.col("key").rlike(pattern))
