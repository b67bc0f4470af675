"""Secret scans judged by how widely a candidate is copied.

Patterns find candidates; whether one looks live depends on the corpus. A value that
many owners or repositories have is an example from some manual. A value of one owner
in few repositories looks live. Values are compared by hash only.

Everything is DataFrame functions. Positions come from the texts between matches, as
SQL regular expressions return none. Candidates are counted step by step, by text, then
by owner and repository, so an example that every document has is no hot group; its
counts reach its candidates by broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placecount.llm.text import spare
from placecount.session import durable

# Patterns of the base kinds, in their listed order.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

# Maximal runs, so a length in the pattern finds the same runs as one tested later.
_LONG_ACCESS = ACCESS[:-1] + "{%d,}" % (MIN_ACCESS - 4)
_LONG_HEX = HEX[:-1] + "{%d,}" % MIN_HEX
# What the method adds: long runs of key characters with digits and both cases.
OWNED = r"[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "owned")

HOT_VALUES, HOT_USES = 1_000, 10_000
# Live spans are sent to all tasks up to this number, about 40 bytes each.
BROADCAST_SPANS = 1_000_000
EXAMPLE_OWNERS = 3
EXAMPLE_REPOS = 8
MASK = "[secret]"

_SPANS = "array<struct<start:int,kind:int,end:int,hash:bigint>>"
_JUDGED = "array<struct<start:int,kind:int,end:int,hash:bigint,owners:bigint,repos:bigint,looks_live:boolean>>"


def _matches(text: Column, pattern: str, kind: int, value_group: int = 0, min_value: int = 0) -> Column:
    """Spans of all matches, by start; empty if there is none."""
    pattern_ = F.lit(pattern)
    # One (length of text before, length of match, value) for each match.
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, pattern_, F.lit(0)).alias("match"),
        F.regexp_extract_all(text, pattern_, F.lit(value_group)).alias("value"),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def step(acc: Column, part: Column) -> Column:
        begin = acc["at"] + F.length(part["gap"])
        end = begin + F.length(part["match"])
        span = F.struct(
            begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), F.xxhash64(part["value"]).alias("hash")
        )
        fits = F.length(part["value"]) >= min_value
        return F.struct(
            end.alias("at"), F.when(fits, F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans")
        )

    # The last gap has no match after it.
    found = F.aggregate(F.slice(parts, F.lit(1), F.size(parts) - 1), start, step)["spans"]
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPANS))


def find_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``base`` (assign, access and hex spans by start, then kind) and ``owned``
    (other key-like spans that touch no base span). Null text is empty."""
    t = F.coalesce(text, F.lit(""))
    base = F.concat(
        _matches(t, ASSIGN, 0, 2, MIN_ASSIGN), _matches(t, _LONG_ACCESS, 1), _matches(t, _LONG_HEX, 2)
    )
    mixed = F.lit(r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])")
    with_base = docs.withColumn("base", F.array_sort(base)).withColumn("owned", _matches(t, OWNED, 3))

    def touches(span: Column) -> Column:
        return F.exists("base", lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))

    def random_like(span: Column) -> Column:
        value = F.substring(t, span["start"] + 1, span["end"] - span["start"])
        return F.regexp_like(value, mixed)

    return with_base.withColumn("owned", F.filter("owned", lambda s: ~touches(s) & random_like(s)))


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, owners, repos, uses) of candidates (hash, text_hash, owner, repo). Equal texts
    count once, for the least of their owners and repositories: a copy of a whole text
    makes a value no more of an example. ``uses`` counts every candidate."""
    return (
        candidates.groupBy("hash", "text_hash")
        .agg(F.min(F.struct("owner", "repo")).alias("of"), F.count(F.lit(1)).alias("uses"))
        .groupBy("hash", "of.owner", "of.repo")
        .agg(F.sum("uses").alias("uses"))
        .groupBy("hash", "owner")
        .agg(F.count(F.lit(1)).alias("repos"), F.sum("uses").alias("uses"))
        .groupBy("hash")
        .agg(F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos"), F.sum("uses").alias("uses"))
    )


def _with_counts(candidates: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """Candidates with owners and repos of their hash. Values that many texts have are sent
    to all tasks, ``HOT_VALUES`` at most, as no more can have that share of all uses."""
    hot = counts.where(F.col("uses") * HOT_VALUES >= max(total, HOT_VALUES * HOT_USES)).drop("uses")
    near = candidates.join(F.broadcast(hot), "hash", "left")
    rest = near.where("owners is null").drop("owners", "repos")
    cool = counts.where(F.col("uses") * HOT_VALUES < max(total, HOT_VALUES * HOT_USES)).drop("uses")
    return near.where("owners is not null").unionByName(rest.join(cool, "hash"))


def describe(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])), ","
    )


def scan(docs: DataFrame, owner: Column, repo: Column, min_owners: int = EXAMPLE_OWNERS, min_repos: int = EXAMPLE_REPOS) -> DataFrame:
    """(doc_id, text_hash, base, spans, live, candidates) of each of ``docs`` (doc_id, text).

    ``base`` are the base spans; ``spans`` adds the key-like ones that look live;
    ``live`` are those of ``spans`` that look live; ``candidates`` are all, with owners,
    repos and ``looks_live``. A candidate is an example if at least ``min_owners`` owners
    or ``min_repos`` repositories have it, else it looks live. Null owners and
    repositories are values of their own. Repeated rows are scanned one by one, and
    equal texts count once.
    """
    found = durable(
        find_spans(
            docs.select(
                "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text",
                owner.alias("owner"), repo.alias("repo"),
            )
        ).drop("text")
    )
    candidates = found.select(
        "doc_id", "text_hash", "owner", "repo", F.explode(F.concat("base", "owned")).alias("span")
    ).withColumn("hash", F.col("span.hash"))
    counts = durable(ownership(candidates))
    total = counts.agg(F.sum("uses")).first()[0] or 0
    looks_live = (F.col("owners") < min_owners) & (F.col("repos") < min_repos)
    judged = (
        _with_counts(candidates.select("doc_id", "text_hash", "hash", "span"), counts, int(total))
        .select(
            F.col("doc_id").alias("_id"),
            F.col("text_hash").alias("_hash"),
            F.struct("span.*", "owners", "repos", looks_live.alias("looks_live")).alias("judged"),
        )
        .groupBy("_id", "_hash")
        .agg(F.array_sort(F.collect_set("judged")).alias("candidates"))
    )

    def spans(of: Column) -> Column:
        return F.transform(of, lambda c: F.struct(c["start"], c["kind"], c["end"], c["hash"])).cast(_SPANS)

    none = F.array().cast(_JUDGED)
    return (
        found.join(judged, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
        .withColumn("candidates", F.coalesce("candidates", none))
        .withColumn("live", spans(F.filter("candidates", lambda c: c["looks_live"])))
        .withColumn("spans", F.array_sort(F.concat("base", F.filter("live", lambda s: s["kind"] == 3))))
        .select("doc_id", "text_hash", "base", "spans", "live", "candidates")
    )


def describe_verdicts(candidates: Column) -> Column:
    """``kind:start:end:owners:repos:verdict`` of each candidate, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            candidates,
            lambda c: F.concat_ws(
                ":", F.element_at(kinds, c["kind"] + 1), c["start"], c["end"], c["owners"], c["repos"],
                F.when(c["looks_live"], "live").otherwise("example"),
            ),
        ),
        ",",
    )


def masked(text: Column, spans: Column, mask: str = MASK) -> Column:
    """``text`` with the spans replaced by ``mask``, from the last to the first. Of two
    that overlap, the earlier one ends where the later one begins."""

    def step(acc: Column, s: Column) -> Column:
        end = F.least(s["end"], acc["from"])
        return F.struct(
            F.concat(F.substring(acc["text"], F.lit(1), s["start"]), F.lit(mask), F.substr(acc["text"], end + 1)).alias("text"),
            s["start"].alias("from"),
        )

    begin = F.struct(text.alias("text"), F.lit(2**31 - 2).alias("from"))
    return F.aggregate(F.reverse(F.array_sort(spans)), begin, step)["text"]


def mask_live(docs: DataFrame, owner: Column, repo: Column) -> DataFrame:
    """``docs`` with the live-looking secrets of each text masked and n_chars renewed."""
    id_, hash_, spans = (spare(docs.columns, name) for name in ("id", "hash", "live"))
    live = durable(
        scan(docs, owner, repo)
        .where(F.size("live") > 0)
        .select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_), F.col("live").alias(spans))
        .dropDuplicates([id_, hash_])
    )
    if (live.agg(F.sum(F.size(spans))).first()[0] or 0) <= BROADCAST_SPANS:
        live = F.broadcast(live)  # texts with live spans are few; the others stay where they are
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(hash_))
    clean = F.col(spans).isNull()
    out = docs.join(live, same, "left").withColumn(
        "text", F.when(clean, F.col("text")).otherwise(masked(F.col("text"), F.col(spans)))
    )
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(clean, F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.select(*docs.columns)
