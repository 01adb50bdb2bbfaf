"""Connected components of a graph given as a table of edges, by alternating stars.

A large-star step links every larger neighbour of a node to the least of its neighbourhood, a small-star step does so
with the smaller ones; the least node of each component ends up in the middle of a star. Each round is written to the
shared folder. A node with very many edges does not gather them in one task: nodes with more than a 500th of all edges
are at most a thousand, and their rows are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rinse.llm.shared import written

_HOT = 500


def join_hot(rows: DataFrame, found: DataFrame, key: str, size: str, total: int, how: str = "inner") -> DataFrame:
    """Join (inner or left) of `rows` with one row of `found` per key; `size` counts the rows of that key among `total`.

    Keys with more than a 500th of the rows, of which there are fewer than 500, meet their rows by broadcast.
    """
    limit = max(1, total // _HOT)
    cold = found.where(F.col(size) <= limit)
    # One join tells which rows are hot. A key that is not stands in its map as well, without a size, so that plans have
    # the same joins whatever the data.
    one = cold.limit(1).withColumn(size, F.lit(None).cast(found.schema[size].dataType))
    hot = found.where(F.col(size) > limit).unionByName(one)
    rest = [name for name in found.columns if name != key]
    about = F.struct(*[F.col(f"`{name}`") for name in rest])
    marked = rows.join(F.broadcast(hot.select(key, about.alias("hot_row"))), key, "left")
    there = marked.where(F.col(f"hot_row.`{size}`").isNotNull())
    there = there.select(*[F.col(f"`{c}`") for c in rows.columns], *[F.col(f"hot_row.`{c}`").alias(c) for c in rest])
    others = marked.where(F.col(f"hot_row.`{size}`").isNull()).drop("hot_row").join(cold, key, how)
    return there.select(*others.columns).unionByName(others)


def may_be_among(rows: DataFrame, key: Column, found: DataFrame, of_found: Column, into: str, bits: int = 25) -> DataFrame:
    """Adds the boolean `into`: false where `key` is surely none of the keys `of_found` of `found`.

    So that rows which a join would leave as they are need not be shuffled for it. Hashes of the keys set bits of a map
    of 2**`bits` bits, which is broadcast as rows of 64 bits, at most 2**(`bits` - 6) however many keys there are.
    """
    places = found.select(F.pmod(F.xxhash64(of_found), F.lit(1 << bits)).alias("at"))
    word, bit = F.expr("at div 64"), F.expr("shiftleft(1L, int(at % 64))")
    words = written(places.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("mask")), "key-bits")
    own = F.pmod(F.xxhash64(key), F.lit(1 << bits))
    names = [F.col(f"`{c}`") for c in rows.columns]
    joined = rows.withColumn(into, own).join(F.broadcast(words), F.expr(f"`{into}` div 64") == F.col("word"), "left")
    hit = F.coalesce(F.expr(f"(mask & shiftleft(1L, int(`{into}` % 64))) != 0"), F.lit(False))
    return joined.select(*names, hit.alias(into))


def _star(edges: DataFrame, total: int) -> DataFrame:
    """(node, neighbour) to (neighbour, least of the node's neighbourhood)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    least = least.withColumn("m", F.least("m", "u"))
    return join_hot(edges, least, "u", "n", total)


def _unfinished(edges: DataFrame) -> tuple[int, int]:
    """How many edges there are (u > v, each once), and how many nodes have more than one smaller neighbour or both a
    smaller and a larger one. Without such nodes, each component is a star around its least node."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    found = nodes.agg(F.coalesce(F.sum("up"), F.lit(0)), F.count_if((F.col("up") > 0) & (F.col("up") + F.col("down") > 1)))
    return tuple(found.first())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of `edges` (u, v); the component is the least node. Loops and repeats are allowed."""
    edges = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = written(edges, name)
    while True:
        total, unfinished = _unfinished(edges)
        if not unfinished:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, 2 * total).where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, name, total)
        small = _star(large, large.count())
        small = small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))
        )
        edges = written(small.distinct(), name, total)
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
