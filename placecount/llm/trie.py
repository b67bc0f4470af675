"""The prefix trie of conversations, by ROLLUP.

A conversation is cut into blocks of ``WIDTH`` turns. A block is one row: the node that
the block before it ended at, and one column for each of its turns. ``ROLLUP`` over
those columns within (block, prior node) counts every prefix of every block at once;
``grouping_id`` tells how many turns a group has. Since the prior node is in the key,
blocks of all depths take part in the same ROLLUP, and a conversation of any length
needs no more jobs than a short one.

* A turn is a pair of 64-bit hashes of its role and text. A node is named by its depth
  and the XOR of 64-bit hashes, twice, of each of its turns together with their places;
  so the name of the prior node is a running XOR along the conversation, and the parent's
  name is the node's own without its last turn.
* What a node needs of its subtree is a sum over its members. Its leaves are the members
  that represent one. Of the savings, a node counts for its smallest member ``c``; the
  nodes for which ``c`` counts are the end of the path of ``c``, so all other nodes on
  that path have all of them below. A second ROLLUP sums these constants of conversations.
* Nothing gathers by conversation or node. Turns are numbered by ranges of their order,
  each of which knows how many turns the ranges before it hold; running values go by
  chunks of ``CHUNK`` places, then over the chunks; constants meet turns by conversation
  and range; parents meet their children by one of ``SALTS`` shares of them. Only the ids
  that end at one node come together, as their digest is over their sorted list.

Defined results: null roles and texts are empty; turns are ordered by turn (null first),
then role, then text; repeated rows are turns of their own; rows without a conv_id are
left out; an empty table has no nodes. A conversation whose turns were all taken away
still ends at the root. Other columns are left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placecount.session import durable

WIDTH = 8
CHUNK = 4096
SALTS = 64
NAME = ("depth", "x", "y")

_TURN = "struct<a:bigint,b:bigint,bytes:bigint>"


def turn_id(role: Column, text: Column) -> Column:
    """A turn as two hashes, and the bytes of its text. The role's length parts it from the text."""
    said = (F.length(role), role, text)
    return F.struct(
        F.xxhash64(F.lit(1), *said).alias("a"),
        F.xxhash64(F.lit(2), *said).alias("b"),
        F.octet_length(text).cast("long").alias("bytes"),
    )


def at_place(turn: Column, place: Column) -> tuple[Column, Column]:
    """What a turn at ``place`` (from 1) adds to the two parts of a node's name."""
    return (F.xxhash64(F.lit(3), place, turn["a"], turn["b"]), F.xxhash64(F.lit(4), place, turn["b"], turn["a"]))


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, range, number, id) of each turn, numbered from 1 along its conversation;
    ``range`` says which of the ranges of (conv_id, turn, role, text) it lies in."""
    order = ("conv_id", "turn", "role", "text")
    dealt = turns.where("conv_id is not null").select(
        "conv_id", "turn", *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")]
    )
    placed = durable(
        dealt.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "conv_id",
            F.spark_partition_id().alias("range"),
            F.monotonically_increasing_id().alias("at"),  # rises by 1 within a range
            turn_id(F.col("role"), F.col("text")).alias("id"),
        )
    )
    ranges = placed.groupBy("conv_id", "range").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    return placed.join(ranges, ["conv_id", "range"]).select(
        "conv_id", "range", (F.col("before") + F.col("at") - F.col("first") + 1).alias("number"), "id"
    )


def head_turns(conv_id: Column) -> Column:
    """How many turns a rebuilt conversation takes from the first of its five."""
    return F.crc32(conv_id.cast("string").cast("binary")) % 9


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, place, id) of the turns of rebuilt conversations, and (conv_id, length) of
    all of them: the first ``head_turns`` of conversation c - c % 5, as many as it has,
    then the turns of c after as many."""
    own = durable(numbered(turns))
    h = head_turns(F.col("conv_id"))
    heads = (
        own.where((F.col("conv_id") % 5 == 0) & (F.col("number") <= 8))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.array_sort(F.collect_list(F.struct("number", "id")))["id"].alias("head"))  # eight at most
    )
    ranges = own.groupBy("conv_id", "range").agg(F.count(F.lit(1)).alias("n"))
    convs = durable(
        ranges.groupBy("conv_id")
        .agg(F.sum("n").alias("n"))
        .withColumn("base", F.col("conv_id") - F.col("conv_id") % 5)
        .join(heads, "base", "left")
        .withColumn("head", F.slice(F.coalesce("head", F.array().cast(f"array<{_TURN}>")), F.lit(1), h.cast("int")))
        .select(
            "conv_id",
            "head",
            (F.size("head") + F.greatest(F.col("n") - h, F.lit(0))).alias("length"),
        )
    )
    moved = ranges.join(convs, "conv_id").select("conv_id", "range", (F.size("head") - h).alias("shift"))
    kept = own.where(F.col("number") > h).join(moved, ["conv_id", "range"])
    taken = convs.select("conv_id", F.posexplode("head").alias("i", "id"))
    places = kept.select("conv_id", (F.col("number") + F.col("shift")).alias("place"), "id").unionByName(
        taken.select("conv_id", (F.col("i") + 1).cast("long").alias("place"), "id")
    )
    return places, convs.select("conv_id", "length")


def running(rows: DataFrame, key: str, place: str, values: list[str], combine, join) -> DataFrame:
    """Adds ``<value>_before`` for each value: what ``combine`` makes of it over the rows
    of the same key at earlier places, 0 for none. ``join`` combines two such results.
    ``rows`` is read twice."""
    chunk = F.floor(F.col(place) / CHUNK)
    ahead = Window.partitionBy(key, "chunk").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(key).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = (
        rows.groupBy(key, chunk.alias("chunk"))
        .agg(*[combine(v).alias(v) for v in values])
        .select(key, "chunk", *[F.coalesce(combine(v).over(earlier), F.lit(0)).alias(f"{v}_earlier") for v in values])
    )
    near = rows.withColumn("chunk", chunk).withColumns(
        {f"{v}_near": F.coalesce(combine(v).over(ahead), F.lit(0)) for v in values}
    )
    found = near.join(chunks, [key, "chunk"]).withColumns(
        {f"{v}_before": join(F.col(f"{v}_near"), F.col(f"{v}_earlier")) for v in values}
    )
    return found.drop("chunk", *[f"{v}_{part}" for v in values for part in ("near", "earlier")])


def blocks(places: DataFrame) -> DataFrame:
    """(conv_id, block, chunk, t1 .. t8, x, y, x_before, y_before) of each block of turns:
    x and y are what its turns add to the name of the prior node."""
    x, y = at_place(F.col("id"), F.col("place"))
    slot = ((F.col("place") - 1) % WIDTH).alias("slot")
    parts = (
        places.groupBy("conv_id", F.floor((F.col("place") - 1) / WIDTH).alias("block"))
        .agg(
            F.array_sort(F.collect_list(F.struct(slot, "id")))["id"].alias("ids"),
            F.bit_xor(x).alias("x"),
            F.bit_xor(y).alias("y"),
        )
        .select("conv_id", "block", *[F.get("ids", F.lit(j)).alias(f"t{j + 1}") for j in range(WIDTH)], "x", "y")
    )
    chained = running(durable(parts), "conv_id", "block", ["x", "y"], F.bit_xor, Column.bitwiseXOR)
    return durable(chained.withColumn("chunk", F.floor(F.col("block") / CHUNK)))


def rolled_up(rows: DataFrame, measures: str) -> DataFrame:
    """(depth, x, y, x_up, y_up, last) and the measures of each prefix of the blocks in
    ``rows``, which hold one row for each conversation and block."""
    turns = [f"t{j}" for j in range(1, WIDTH + 1)]
    groups = rows.sparkSession.sql(
        f"""
        select block, x_before, y_before, {", ".join(turns)}, {WIDTH} - bit_count(grouping_id()) as k, {measures}
        from {{rows}}
        group by block, x_before, y_before, rollup({", ".join(turns)})
        """,
        rows=rows,
    )
    # A shorter block has no turn at the later levels; at level 0 stands the prior node itself.
    last = F.get(F.array(*turns), F.col("k") - 1)
    groups = groups.withColumn("last", F.when(F.col("k") > 0, last)).where("last is not null")
    first = F.col("block") * WIDTH
    added = [at_place(F.col(t), first + j) for j, t in enumerate(turns, 1)]

    def name(part: int, before: str, levels: Column) -> Column:
        used = [F.when(levels >= j, a[part]).otherwise(0) for j, a in enumerate(added, 1)]
        return reduce(Column.bitwiseXOR, used, F.col(before))

    k = F.col("k")
    columns = [c.split(" as ")[-1].strip() for c in measures.split(",")]
    return groups.select(
        (first + k).alias("depth"),
        name(0, "x_before", k).alias("x"),
        name(1, "y_before", k).alias("y"),
        name(0, "x_before", k - 1).alias("x_up"),
        name(1, "y_before", k - 1).alias("y_up"),
        "last",
        *columns,
    )


def trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie of the rebuilt conversations of ``turns`` (conv_id, turn,
    role, text): conv_id, the smallest member; depth; parent_conv_id; n_convs; n_children;
    n_leaves; saved_tokens; ends_sha256."""
    places, convs = rebuilt(turns)
    rows = blocks(places)
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    found = rolled_up(rows, "min(conv_id) as conv_id, count(1) as n_convs")
    nodes = durable(
        found.select(*NAME, "x_up", "y_up", "conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("last.bytes")).alias("saved"))
        .unionByName(
            root.select(
                *[zero.alias(c) for c in NAME], none.alias("x_up"), none.alias("y_up"), "conv_id", "n_convs", zero.alias("saved")
            )
        )
    )
    parent = [(F.col("depth") - 1).alias("depth"), F.col("x_up").alias("x"), F.col("y_up").alias("y")]
    salt = F.pmod("x", F.lit(SALTS)).alias("salt")
    shares = durable(
        nodes.where("depth > 0").select(*parent, salt).groupBy(*NAME, "salt").agg(F.count(F.lit(1)).alias("n"))
    )
    children = shares.groupBy(*NAME).agg(F.sum("n").alias("n_children"))
    above = running(nodes, "conv_id", "depth", ["saved"], F.sum, Column.__add__)
    full = durable(
        above.join(children, list(NAME), "left").withColumn("n_children", F.coalesce("n_children", zero))
    )

    # Constants of conversations, and their sums over the members of each node.
    ones = full.where("n_children = 0").select("conv_id", F.lit(1).alias("leaf"), zero.alias("saved_by"))
    constants = (
        ones.unionByName(nodes.where("saved > 0").select("conv_id", F.lit(0).alias("leaf"), F.col("saved").alias("saved_by")))
        .groupBy("conv_id")
        .agg(F.sum("leaf").alias("leaf"), F.sum("saved_by").alias("saved_by"))
    )
    constants = durable(constants)
    chunks = rows.select("conv_id", "chunk").distinct().join(constants, "conv_id")
    sums = rolled_up(
        rows.join(chunks, ["conv_id", "chunk"]), "sum(leaf) as n_leaves, sum(saved_by) as saved_below"
    ).select(*NAME, "n_leaves", "saved_below")
    at_root = constants.agg(F.sum("leaf").alias("n_leaves"), F.sum("saved_by").alias("saved_below"))
    sums = sums.unionByName(at_root.select(*[zero.alias(c) for c in NAME], "n_leaves", "saved_below"))

    last = rows.groupBy("conv_id").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    ends = (
        convs.join(last, "conv_id", "left")
        .select("conv_id", F.col("length").alias("depth"), *[F.coalesce(c, zero).alias(c) for c in ("x", "y")])
        .groupBy(*NAME)
        .agg(F.sha2(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ","), 256).alias("ends_sha256"))
    )
    parents = shares.join(nodes.select(*NAME, F.col("conv_id").alias("parent_conv_id")), list(NAME)).select(
        (F.col("depth") + 1).alias("depth"), F.col("x").alias("x_up"), F.col("y").alias("y_up"), "salt", "parent_conv_id"
    )
    return (
        full.withColumn("salt", salt)
        .join(parents, ["depth", "x_up", "y_up", "salt"], "left")
        .join(sums, list(NAME), "left")
        .join(ends, list(NAME), "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            # The smallest member's share of the savings above this node is no part of its subtree.
            (F.coalesce("saved_below", zero) - F.col("saved_before")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
