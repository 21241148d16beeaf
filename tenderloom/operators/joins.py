"""Lookups and joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

C = F.col
#: A lookup table of literals is code, not data: so many rows at most may be broadcast.
LITERAL_ROWS = 10_000


def lookup_frame(spark, table: dict, key: str, *values: str) -> DataFrame:
    if len(table) > LITERAL_ROWS:
        raise ValueError("a literal lookup table has at most 10,000 rows")
    rows = [(k, *(v if isinstance(v, tuple) else (v,))) for k, v in table.items()]
    kinds = ", ".join(f"{v} {'double' if isinstance(rows[0][i + 1], float) else 'string'}" for i, v in enumerate(values))
    return spark.createDataFrame(rows, f"{key} string, {kinds}")


def looked_up(df: DataFrame, on: Column, table: dict, *values: str) -> DataFrame:
    """df with the values of a literal table; NULL where it has no entry."""
    t = lookup_frame(df.sparkSession, table, "_lookup", *values)
    return df.join(F.broadcast(t), on == C("_lookup"), "left").drop("_lookup")


def left_fill(left: DataFrame, right: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Left join with one row per key of the right side; the left's nulls take the right's values."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    right = right.filter(C(key).isNotNull()).withColumn("_r", rank).filter("_r = 1").drop("_r")
    both = [c for c in left.columns if c in right.columns and c != key]
    right = right.select(key, *[C(c).alias(f"_right_{c}" if c in both else c) for c in right.columns if c != key])
    out = left.join(right, key, "left")
    return out.select(*[F.coalesce(c, f"_right_{c}").alias(c) if c in both else C(c) for c in left.columns], *[c for c in right.columns if c != key and not c.startswith("_right_")])


def matched_or_not(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """All rows of the left side with a status: matched, null_key, unmatched.  One left join instead of three branches."""
    marked = right.filter(C(key).isNotNull()).select(key).distinct().withColumn("_hit", F.lit(True))
    status = F.when(C(key).isNull(), "null_key").when(C("_hit"), "matched").otherwise("unmatched")
    return left.join(marked, key, "left").withColumn("status", status).drop("_hit")


def absent_from_lists(old: DataFrame, new: DataFrame, key: str, lists: str, separator: str = ";") -> DataFrame:
    """Rows of ``old`` whose key is in no list of codes of ``new``."""
    codes = new.select(F.explode(F.split(lists, separator)).alias("_code")).select(F.upper(F.trim("_code")).alias("_code")).filter("_code <> ''").distinct()
    return old.join(codes, F.upper(F.trim(C(key))) == C("_code"), "left_anti")


def keyword_top(df: DataFrame, name: str, keywords: list[str], top: int = 10) -> DataFrame:
    """For each keyword the names that contain it, most frequent first.

    Keywords are a literal list, so each distinct name is tested against all
    of them in one pass over the counts.
    """
    counts = df.filter(C(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n"))
    hit = F.filter(F.array(*[F.lit(k) for k in keywords]), lambda k: F.contains(F.lower(C(name)), F.lower(k)))
    return _most_frequent(counts.withColumn("keyword", F.explode(hit)), name, top)


def keyword_top_in(index, name: str, keywords: list[str], top: int = 10) -> DataFrame:
    """``keyword_top`` in a trigram index over the names with their number of rows, ``n``."""
    return _most_frequent(index.containing(name, keywords), name, top)


def _most_frequent(rows: DataFrame, name: str, top: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("keyword").orderBy(F.desc("n"), name))
    return rows.withColumn("rank", rank).filter(C("rank") <= top).select("keyword", name, "n", "rank")


def compared(df: DataFrame, key: str, a: str, b: str, aggs: list[Column]) -> DataFrame:
    """The same figures of two groups side by side."""
    return df.filter(C(key).isin(a, b)).groupBy(key).agg(*aggs)


def union_aligned(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)


def aliased(df: DataFrame, standard: dict[str, list[str]]) -> DataFrame:
    """Standard columns from the first filled of their candidates that exist; NULL if none does."""
    out = {}
    for name, candidates in standard.items():
        have = [c for c in candidates if c in df.columns]
        out[name] = F.coalesce(*[C(c) for c in have]) if have else F.lit(None).cast("string")
    return df.select(*[v.alias(k) for k, v in out.items()])
