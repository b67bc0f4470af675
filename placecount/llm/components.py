"""Connected components of a graph that stays distributed."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from placecount.session import durable

EDGES_OF_TASK = 1_000_000


def _contracted(edges: DataFrame, parts: int) -> DataFrame:
    """(v, root) of the components that the edges of each of ``parts`` tasks make."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[int, int] = {}

        def root(v: int) -> int:
            top = v
            while up.setdefault(top, top) != top:
                top = up[top]
            while up[v] != top:
                up[v], v = top, up[v]
            return top

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                a, b = root(a), root(b)
                up[max(a, b)] = min(a, b)
        found = list(up)
        for i in range(0, len(found), 100_000):
            some = found[i : i + 100_000]
            columns = [pa.array(some, pa.int64()), pa.array([root(v) for v in some], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["v", "root"])

    return edges.select("a", "b").repartition(parts).mapInArrow(run, "v long, root long")


def components(edges: DataFrame) -> DataFrame:
    """(v, root) of every vertex in ``edges`` (a, b): root is the component's least vertex.

    Tasks first contract ``EDGES_OF_TASK`` edges or so each, which settles few edges at
    once. Of more, the contracted ones go on: in each round a vertex takes the least root among its neighbours and then its
    root's root, so roots travel ever farther per round. Each round is written to the
    shared folder. Minima are combined before the shuffle, so a vertex that all others
    link to is no hot key.
    """
    parts = -(-edges.count() // EDGES_OF_TASK) or 1
    contracted = durable(_contracted(edges, parts))
    if parts == 1:
        return contracted
    edges = contracted.select(F.col("v").alias("a"), F.col("root").alias("b"))
    both = durable(
        edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    )
    found = both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("least")).select(
        "v", F.least("v", "least").alias("root")
    )
    while True:
        of_neighbour = found.select(F.col("v").alias("b"), F.col("root").alias("near"))
        nearest = both.join(of_neighbour, "b").groupBy("a").agg(F.min("near").alias("near"))
        hooked = found.join(nearest, F.col("v") == F.col("a")).select(
            "v", F.col("root").alias("before"), F.least("root", "near").alias("root")
        )
        further = hooked.select(F.col("v").alias("at"), F.col("root").alias("next"))
        jumped = hooked.join(further, F.col("root") == F.col("at")).select(
            "v", "before", F.col("next").alias("root")
        )
        seen = Observation()
        found = durable(jumped.observe(seen, F.count_if(F.col("root") != F.col("before")).alias("changed")).drop("before"))
        if not seen.get["changed"]:
            return found
