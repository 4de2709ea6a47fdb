"""Splits that keep related records together.

Connected components by frontier breadth-first search. Edges are kept hash-partitioned by their first node. Many seeds
(every node whose hash is lowest among its neighbours, so every component has one and no two are adjacent) expand at
once; where two seeds meet, their labels become an edge of a smaller graph, which is solved the same way. A level at
least halves the nodes, so the levels grow with the logarithm of the largest component. Nothing is collected; every
round is cut through the shared checkpoint folder.

A value that a third of all records share is first reduced to a star around its smallest record (a partial
aggregation), so no group is ever listed or paired in one task.

Defined results: null and blank keys are dropped; an entity without values is a component of its own; repeated rows
and ties do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkwright.session import cut, hold

BLANKS = r"^[\s\p{Z}]+|[\s\p{Z}]+$"


def _order(node: str) -> Column:
    return F.struct(F.xxhash64(node), F.col(node))


def star_edges(links: DataFrame, entity: str, value: str) -> DataFrame:
    """Undirected edges ``(u, v)``, both ways, from each entity to the smallest entity of each of its values."""
    pairs = links.select(F.col(entity).alias("u"), F.col(value).alias("value")).where(F.col("u").isNotNull() & F.col("value").isNotNull())
    hubs = pairs.groupBy("value").agg(F.min("u").alias("v"))
    one_way = pairs.join(hubs, "value").where(F.col("u") != F.col("v")).select("u", "v")
    return one_way.unionByName(one_way.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()


def _spread(edges: DataFrame) -> DataFrame:
    """``(node, label)``: every node with the label of a seed that reached it first."""
    lowest = edges.groupBy("u").agg(F.min(_order("v")).alias("lowest"))
    seeds = lowest.where(_order("u") < F.col("lowest")).select(F.col("u").alias("node"), F.col("u").alias("label"))
    labels = frontier = cut(seeds)
    waiting = cut(edges.select(F.col("u").alias("node")).distinct().join(labels, "node", "left_anti"))
    while not waiting.isEmpty():
        reached = (
            edges.join(frontier.withColumnRenamed("node", "u"), "u")
            .groupBy(F.col("v").alias("node"))
            .agg(F.min_by("label", _order("label")).alias("label"))
        )
        frontier = cut(reached.join(waiting, "node", "left_semi"))
        waiting = cut(waiting.join(frontier, "node", "left_anti"))
        labels = labels.unionByName(frontier)
    return cut(labels)


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the symmetric edge table ``(u, v)``; the component is its smallest node."""
    levels = []
    current = hold(edges.repartition("u"))
    while not current.isEmpty():
        labels = _spread(current)
        levels.append(labels)
        left = labels.select(F.col("node").alias("u"), F.col("label").alias("a"))
        right = labels.select(F.col("node").alias("v"), F.col("label").alias("b"))
        met = current.join(left, "u").join(right, "v").where(F.col("a") != F.col("b"))
        current = cut(met.select(F.col("a").alias("u"), F.col("b").alias("v")).distinct())
    if not levels:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).limit(0)
    labels = levels[-1]
    for lower in reversed(levels[:-1]):
        upper = labels.select(F.col("node").alias("label"), F.col("label").alias("top"))
        labels = lower.join(upper, "label", "left").select("node", F.coalesce("top", "label").alias("label"))
    first = labels.groupBy("label").agg(F.min("node").alias("component"))
    return labels.join(first, "label").select("node", "component")


def tied_entities(frame: DataFrame, key: str, field: str, pattern: str = r"S[23]-\d+") -> DataFrame:
    """``(entity, group_first, group_size)`` for every entity; ties are values of ``pattern`` held in common."""
    rows = frame.select(F.regexp_replace(key, BLANKS, "").alias("entity"), F.col(field).alias("text")).where(F.col("entity") != "")
    links = rows.select("entity", F.explode(F.regexp_extract_all("text", F.lit(f"({pattern})"), 1)).alias("value")).distinct()
    found = cut(components(star_edges(links, "entity", "value")))
    sizes = found.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    grouped = found.join(sizes, "component").select(F.col("node").alias("entity"), "component", "size")
    return (
        rows.select("entity")
        .distinct()
        .join(grouped, "entity", "left")
        .select("entity", F.coalesce("component", "entity").alias("group_first"), F.coalesce("size", F.lit(1)).alias("group_size"))
    )


def split(groups: DataFrame, shares: dict[str, float], seed: int = 0, buckets: int = 1024) -> DataFrame:
    """Adds ``split`` to ``(entity, group_first, group_size)``.

    Components are put in the order of a seeded hash, their sizes summed in that order, and each goes to the split in
    which its middle record falls, so the shares hold to within one component. The running sum is taken in hash
    ranges: ``buckets`` sums form the only global step.
    """
    if not shares or any(x < 0 for x in shares.values()) or abs(sum(shares.values()) - 1) > 1e-9:
        raise ValueError("shares must be non-negative and add up to 1")
    one = groups.groupBy("group_first").agg(F.max("group_size").alias("size"))
    one = one.withColumn("rank", F.xxhash64(F.lit(seed), "group_first"))
    one = one.withColumn("bucket", F.shiftrightunsigned("rank", 64 - (buckets - 1).bit_length()))
    sums = one.groupBy("bucket").agg(F.sum("size").alias("total"))
    before = sums.select("bucket", (F.sum("total").over(Window.orderBy("bucket")) - F.col("total")).alias("before"), F.sum("total").over(Window.partitionBy()).alias("all"))
    within = Window.partitionBy("bucket").orderBy("rank", "group_first").rowsBetween(Window.unboundedPreceding, 0)
    placed = one.withColumn("upto", F.sum("size").over(within)).join(F.broadcast(before), "bucket")
    middle = (F.col("before") + F.col("upto") - F.col("size") / 2) / F.col("all")
    names, edge = list(shares), 0.0
    label = F.lit(None).cast("string")
    for name in names[:-1]:
        edge += shares[name]
        label = F.coalesce(label, F.when(middle < edge, name))
    placed = placed.select("group_first", F.coalesce(label, F.lit(names[-1])).alias("split"))
    return groups.join(placed, "group_first")
