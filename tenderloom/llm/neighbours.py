"""Approximate nearest neighbours by cross-polytope hashing.

A unit vector, turned by three sign flips and fast Hadamard transforms, falls
to the nearest of the 2 * d signed axes.  Each of ``TABLES`` turns gives one
table.  A query visits the axes nearest to it, whichever tables they belong to,
and measures all vectors found there exactly, in double precision.  How many it
visits follows from the recall that is asked for: see ``axes_for``.

Equal vectors are one entry that names its smallest ids only: no result can
hold more than k of them.  Buckets are dealt in parts of at most PART entries
and as many queries, so a bucket may hold any share of all rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, prepared_tasks

TABLES = 6
RECALL, SAMPLE = 0.95, 200
PART = 20_000
SEED = 20_240_229


def turned(x: np.ndarray, flips: np.ndarray) -> np.ndarray:
    """Three rounds of sign flips and Hadamard transform; the rows' width is a power of two."""
    n = x.shape[1]
    for signs in flips:
        x, h = x * signs, 1
        while h < n:
            x = x.reshape(len(x), -1, 2, h)
            x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(len(x), n)
            h *= 2
    return x


def placed(vectors: np.ndarray, tables: int) -> np.ndarray:
    """rows x tables x signed axes (2 * axis + sign): how near each axis is to the unit vector; more is nearer."""
    width = 1 << max(0, vectors.shape[1] - 1).bit_length()
    unit = np.zeros((len(vectors), width))
    unit[:, : vectors.shape[1]] = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    flips = np.random.default_rng(SEED).choice([-1.0, 1.0], (tables, 3, width))
    turns = [turned(unit, f) for f in flips]
    return np.stack([np.stack([y, -y], 2).reshape(len(y), -1) for y in turns], 1)


def buckets(vectors: np.ndarray, tables: int) -> np.ndarray:
    """rows x tables: the number of each vector's bucket, counted over all tables."""
    near = placed(vectors, tables)
    return near.argmax(2) + np.arange(tables) * near.shape[2]


def visits(vectors: np.ndarray, tables: int) -> np.ndarray:
    """rows x buckets of all tables: their numbers, in the order in which a query visits them."""
    return np.argsort(-placed(vectors, tables).reshape(len(vectors), -1), 1, kind="stable")


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), -1)


def axes_for(entries: DataFrame, asked: DataFrame, k: int, tables: int, recall: float) -> int:
    """The fewest axes to visit at which a sample of the queries finds the share ``recall`` of its k nearest other vectors.

    The sample (SAMPLE queries with the smallest hashes of their ids, a bound
    of its own) is measured against all entries in one pass; a task sends k
    entries per sampled query.  With 2,000 neighbours the share is known to
    about half a percent, at every size of the table.
    """
    sample = asked.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()
    if not sample:
        return 1
    points = np.array([r["v"] for r in sample])
    order = visits(points, tables)
    place = np.argsort(order, 1)  # of each bucket in a query's order
    squares, rows = (points**2).sum(1)[:, None], np.arange(len(points))[:, None]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, need = np.empty((len(points), 0)), np.empty((len(points), 0), np.int64)
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(0))
                far = np.maximum((x**2).sum(1) + squares - 2 * points @ x.T, 0)
                for q, i in np.argwhere(far <= 1e-9 * squares):
                    far[q, i] = np.inf if np.array_equal(points[q], x[i]) else far[q, i]
                pick = np.argpartition(far, k - 1, 1)[:, :k] if len(x) > k else np.tile(np.arange(len(x)), (len(points), 1))
                first = place[rows[:, :, None], buckets(x, tables)[pick]].min(2)
                best, need = np.hstack([best, far[rows, pick]]), np.hstack([need, first])
                keep = np.argsort(best, 1, kind="stable")[:, :k]
                best, need = best[rows, keep], need[rows, keep]
        q, i = np.nonzero(np.isfinite(best))
        yield pa.record_batch([pa.array(q), pa.array(best[q, i]), pa.array(need[q, i])], ["q", "far", "need"])

    found = entries.select("v").mapInArrow(measured, "q long, far double, need long")
    nearest_ = found.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy("far", "need"))).filter(F.col("r") <= k)
    need = sorted(r["need"] for r in nearest_.select("need").collect())
    return need[math.ceil(recall * len(need)) - 1] + 1 if need else 1


def nearest(vectors: DataFrame, queries, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", tables: int = TABLES, probes: int | None = None, recall: float = RECALL) -> DataFrame:
    """The k nearest rows of each query row: query_id, rank (from 1), vec_id, score (Euclidean distance).

    ``queries`` is a condition on ``vectors`` that picks the query rows;
    candidates are all rows but the query's own.  Ties go to the smaller id.
    Rows whose id or vector is null, whose vector is zero, holds null or
    non-finite components, or has another length than most, take no part.
    Rows that agree in id and vector count once.  A query that finds fewer
    than k rows in its buckets searches all; only if fewer exist is its list
    shorter.  ``probes``: axes to visit over all tables; if not given, as many
    as the ``recall`` needs (``axes_for``).  Other columns are ignored; an empty
    table gives an empty result.
    """
    spark = vectors.sparkSession
    prepared_tasks(spark)
    v = F.col("v")
    rows = vectors.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("q"))
    usable = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))) & F.exists(v, lambda x: x != 0)
    rows = rows.filter(usable)
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    result = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return spark.createDataFrame([], result)
    rows = rows.filter(F.size("v") == common["d"])
    rows = rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))  # one zero, not two

    # equal vectors as one entry with its k + 1 smallest ids; first per part of the table, then over all
    few = lambda c: F.slice(F.array_sort(F.array_distinct(c)), 1, k + 1)
    entries = rows.withColumn("part", F.spark_partition_id()).groupBy("v", "part").agg(few(F.collect_list("id")).alias("ids"))
    entries = cut(entries.groupBy("v").agg(few(F.flatten(F.collect_list("ids"))).alias("ids")))
    asked = rows.filter("q").select("id", "v").distinct()

    def dealt(n_probes: int, only_first: bool):
        """A vector with its bucket in each table, or, as a query, with those that it visits."""

        def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    n = 1 if only_first else tables
                    found = visits(matrix(batch.column(1)), n)[:, :n_probes] if n_probes else buckets(matrix(batch.column(1)), n)
                    for some in np.array_split(found, math.ceil(found.shape[1] / tables), 1):  # records of moderate size
                        of = pa.array(np.repeat(np.arange(len(some)), some.shape[1]))
                        yield pa.record_batch([pa.array(some.reshape(-1)), batch.column(0).take(of), batch.column(1).take(of)], ["key", batch.schema.names[0], "v"])

        return keys

    def searched(asked: DataFrame, n_probes: int, only_first: bool) -> DataFrame:
        base = entries.select("ids", "v").mapInArrow(dealt(0, only_first), "key long, ids array<long>, v array<double>")
        ask = asked.select("id", "v").mapInArrow(dealt(n_probes, only_first), "key long, id long, v array<double>")
        # how many parts each bucket has on either side; a row per bucket, tables * axes rows at most
        n_base = base.groupBy("key").agg(F.ceil(F.count("*") / PART).alias("base_parts"))
        n_ask = ask.groupBy("key").agg(F.ceil(F.count("*") / PART).alias("ask_parts"))
        plan = F.broadcast(cut(n_base.join(n_ask, "key")))
        whole = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        base = base.join(plan, "key").select("key", F.pmod(F.xxhash64(F.col("ids")[0]), "base_parts").alias("i"), whole("ask_parts").alias("j"), "ids", "v")
        ask = ask.join(plan, "key").select("key", whole("base_parts").alias("i"), F.pmod(F.xxhash64("id"), "ask_parts").alias("j"), "id", "v")

        def measured(left: pa.Table, right: pa.Table) -> pa.Table:
            names = ["query_id", "vec_id", "score"]
            if not left.num_rows or not right.num_rows:
                return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
            x, q = matrix(left.column("v").combine_chunks()), matrix(right.column("v").combine_chunks())
            lists = left.column("ids").combine_chunks()
            size = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy()
            owner = np.repeat(np.arange(len(size)), size)
            out = []
            for query, vector in zip(right.column("id").to_pylist(), q):
                near = ((x - vector) ** 2).sum(1)
                # k + 1 entries hold k + 1 ids at least; all entries as near as the last of them stay
                if len(near) > k + 1:
                    some = near <= np.partition(near, k)[k]
                    pick = some[owner]
                else:
                    pick = np.ones(len(owner), bool)
                pick &= flat != query
                ids, d = flat[pick], np.sqrt(near[owner[pick]])
                best = np.lexsort((ids, d))[:k]
                out.append((np.full(len(best), query), ids[best], d[best]))
            return pa.table([pa.array(np.concatenate(c)) for c in zip(*out)], names)

        found = base.groupBy("key", "i", "j").cogroup(ask.groupBy("key", "i", "j")).applyInArrow(measured, "query_id long, vec_id long, score double")
        found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        return found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))).filter(F.col("rank") <= k)

    found = cut(searched(asked, probes or axes_for(entries, asked, k, tables, recall), False))
    full = found.groupBy("query_id").count().filter(F.col("count") >= k)
    short = cut(asked.join(full, F.col("id") == F.col("query_id"), "left_anti"))
    if not short.isEmpty():
        # the first table holds every vector once: visiting all of its buckets is an exact search
        rest = searched(short, 1 << 30, True)
        found = found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(rest)
    return found.select("query_id", "rank", "vec_id", "score")
