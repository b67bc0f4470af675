"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key whose rate is its quality weight. Documents
of a source are taken in key order, which is a weighted sample without replacement
(Efraimidis and Spirakis, 2006), until the source's token budget is met. A budget
above the source's size first takes whole epochs of it, then samples the rest.

Prefix sums do not sort a source in one task. A key's position between 0 and 1 puts
it in one of ``BUCKETS`` buckets of its source; bucket totals find the bucket in
which the budget runs out, and only that bucket's rows are sorted. What is selected
is then a comparison with one cut-off per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placecount.llm.text import spare
from placecount.session import durable

BUCKETS = 1024
MAX_EPOCHS = 3
CYCLE = (5, 2, 1)
SEED = 7

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(doc_id: Column, seed: int = SEED) -> Column:
    """A number between 0 and 1, the same in every run: 52 bits of a hash of the id."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def water_fill(sizes: DataFrame, cycle: tuple[int, ...] = CYCLE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets of sources (source, source_size): shares by weight of the total size,
    none above ``max_epochs`` sizes, excess reshared among the others by weight.

    Sources rank by code point, null last. Sorted by size per weight, the sources at
    their limit are a prefix: the longest in which each limit is at most its share
    of what the ones before it leave. One row per source, so this is small whatever
    the number of documents.
    """
    every = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*[F.lit(w).cast("long") for w in cycle])
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("rank"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    limit = F.col("source_size") * max_epochs
    return (
        sizes.withColumn("rank", rank)
        .withColumn("weight", F.element_at(weights, (F.col("rank") % len(cycle)).cast("int") + 1))
        .withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum(limit).over(before), F.lit(0)))
        .withColumn("weights", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("capped", limit * F.col("weights") <= F.col("left") * F.col("weight"))
        # The first source below its limit sets the share; all later ones are below too.
        .withColumn(
            "open", F.min(F.when(~F.col("capped"), F.struct(F.col("source_size") / F.col("weight"), "rank", "left", "weights"))).over(every)
        )
        .select(
            "source",
            "source_size",
            F.when(F.col("capped"), limit.cast("double"))
            .otherwise((F.col("weight") * F.col("open.left")).cast("double") / F.col("open.weights"))
            .alias("target"),
        )
    )


# Up to so many sources, what is known of each is sent to all tasks.
BROADCAST_SOURCES = 10_000
# Up to so many ids of documents taken are sent to all tasks, about 30 bytes each.
BROADCAST_IDS = 1_000_000


def _choice() -> Column:
    return F.struct("key", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")).alias("id"), "size")


def mix(sized: DataFrame, cycle: tuple[int, ...] = CYCLE, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, weight, source_size, target, repeats, taken) of rows with
    doc_id, source, size and weight (a document's quality; null or not above 0 is 1).

    Whole documents only: the document at the edge is taken if that brings the
    source nearer to its target. Rows equal in key, id and size go together. Null
    sources are a source; null ids draw the key of an empty id; documents of size 0
    take nothing. Other columns are left out.
    """
    weight = F.coalesce(F.when(F.col("weight") > 0, F.col("weight")), F.lit(1.0))
    key = -F.log(uniform(F.col("doc_id"), seed)) / weight
    keyed = sized.select("doc_id", "source", "size", "weight").withColumn("key", key).withColumn(
        "bucket", F.least(F.floor((1 - F.exp(-F.col("key"))) * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
    )
    sums = durable(keyed.groupBy("source", "bucket").agg(F.sum("size").alias("size")))
    targets = durable(
        water_fill(sums.groupBy("source").agg(F.sum("size").alias("source_size")), cycle, max_epochs)
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    )
    few = targets.count() <= BROADCAST_SOURCES

    def of_source(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if few else df

    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    edges = (
        sums.withColumn("before", F.coalesce(F.sum("size").over(upto), F.lit(0)))
        .join(targets.select(F.col("source").alias("s"), "rest"), F.col("source").eqNullSafe(F.col("s")))
        .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("size")))
        .select(F.col("source").alias("s"), F.col("bucket").alias("edge"), "before", "rest")
    )
    order = Window.partitionBy("source").orderBy(_choice()).rowsBetween(Window.unboundedPreceding, -1)
    in_edge = keyed.join(of_source(edges), F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("edge")))
    taken = in_edge.withColumn("gone", F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0))).where(
        F.col("gone") + F.col("size") / 2 <= F.col("rest")
    )
    cuts = (
        edges.select("s", "edge")
        .join(
            taken.groupBy("source").agg(F.max(_choice()).alias("cut")),
            F.col("s").eqNullSafe(F.col("source")),
            "left",
        )
        .select("s", "edge", "cut")
    )
    plan = targets.select(F.col("source").alias("t"), "source_size", "target", "epochs").join(
        cuts, F.col("t").eqNullSafe(F.col("s")), "left"
    ).drop("s")
    chosen = F.coalesce(
        (F.col("bucket") < F.col("edge")) | ((F.col("bucket") == F.col("edge")) & (_choice() <= F.col("cut"))),
        F.lit(False),
    )
    return (
        keyed.join(of_source(plan), F.col("source").eqNullSafe(F.col("t")))
        .withColumn("repeats", F.when(F.col("size") > 0, F.col("epochs") + chosen.cast("int")).otherwise(0).cast("int"))
        .withColumn("taken", F.col("repeats").cast("long") * F.col("size"))
        .drop("t", "key", "bucket", "epochs", "edge", "cut")
    )


def quality_weights(docs: DataFrame, labels: DataFrame, good: float = 2.0, poor: float = 0.5) -> DataFrame:
    """(doc_id, source, size, weight) of rows with the first three. The weight comes from
    ``labels`` (doc_id, quality): ``good`` for 1, ``poor`` for 0, and 1 for documents
    without a label. The best label of an id counts."""
    docs = docs.select("doc_id", "source", "size")
    best = labels.groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").alias("_quality"))
    weight = F.when(F.col("_quality") == 1, good).when(F.col("_quality") == 0, poor).otherwise(1.0)
    return docs.join(best, docs["doc_id"] == best["_id"], "left").withColumn("weight", weight).drop("_id", "_quality")


def repeat_documents(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """Each document as many times as the mix takes it. Rows of ``mixed`` (doc_id,
    repeats) that share an id count as one, with the most repeats. Texts are shuffled
    only if more than ``BROADCAST_IDS`` documents are taken."""
    id_, times, copy = (spare(docs.columns, name) for name in ("id", "times", "copy"))
    taken = durable(
        mixed.groupBy(F.col("doc_id").alias(id_)).agg(F.max("repeats").alias(times)).where(F.col(times) > 0)
    )
    if taken.count() <= BROADCAST_IDS:
        taken = F.broadcast(taken)
    return (
        docs.join(taken, F.col("doc_id").eqNullSafe(F.col(id_)))
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times))))
        .drop(id_, times, copy)
    )
