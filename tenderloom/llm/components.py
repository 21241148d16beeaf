"""Connected components of an edge table, by contraction in rounds."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import HOT_KEYS, cut, lookup, prepared_tasks

#: A remainder of so many edges is finished by one task.
FEW = 10_000


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the few edges of one task: each node and the smallest of its component."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = top(a), top(b)
            parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array([top(x) for x in nodes], pa.int64())], ["u", "to"])


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b (longs >= 0).  One row per id in an edge: id, component (its smallest id).

    Each round maps every node to the neighbour (or itself) that comes first
    in an order drawn anew from a hash, then replaces both ends of all edges;
    what has become a loop goes.  The number of edges falls by a constant
    factor a round, on paths, too; the last ``FEW`` are one task's.  Nodes
    with very many neighbours are looked up through ``lookup``.  Loops and
    repeated edges are allowed; without edges the result is empty.
    """
    prepared_tasks(edges.sparkSession)
    edges = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("label", F.col("id"))
    edges = edges.filter("a <> b")
    turn = 0
    while (n := edges.count()) > 0:
        turn += 1
        if n <= FEW:
            to = edges.coalesce(1).mapInArrow(joined, "u long, to long")
        else:
            both = edges.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.*")
            first = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("id"))
            to = cut(both.groupBy("u").agg(F.count("*").alias("n"), F.least(F.min(first("v")), F.min(first("u")))["id"].alias("to")))
            hot = max(1000, n // HOT_KEYS)
            edges = lookup(edges, "a", to.withColumnRenamed("u", "a"), "n", hot, "b").select(F.col("to").alias("x"), "b")
            edges = lookup(edges, "b", to.withColumnRenamed("u", "b"), "n", hot, "x").select(F.least("x", "to").alias("a"), F.greatest("x", "to").alias("b"))
            edges = cut(edges.filter("a <> b").distinct())
        held = labels.groupBy("label").agg(F.count("*").alias("rows"))
        named = held.join(to.select(F.col("u").alias("label"), "to"), "label")
        labels = cut(lookup(labels, "label", named, "rows", max(1000, n // HOT_KEYS), "id").select("id", F.coalesce("to", "label").alias("label")))
        if n <= FEW:
            break
    low = labels.groupBy("label").agg(F.count("*").alias("rows"), F.min("id").alias("component"))
    return lookup(labels, "label", low, "rows", max(1000, labels.count() // HOT_KEYS), "id").select("id", "component")
