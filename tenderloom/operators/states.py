"""Figures that grow with each feed: mergeable partial states in a table, merged when a report is asked for.

A feed leaves one row per month and keys: counts and decimal sums, extremes,
a HyperLogLog sketch per column whose distinct values are counted, a KLL sketch
per column whose quantiles are asked for.  All of these merge, so a report reads
the states alone, for any months and any coarser keys; rows of past feeds are
not read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

C = F.col
MONEY = "decimal(28,4)"


class States:
    """The states of one set of figures, in a folder.

    keys: columns that reports can be grouped by.  sums, distinct, quantiles:
    columns.  Null keys are kept; null values are not counted.

    Distinct counts have a relative standard error of 1.04 / 2 ** (lg_k / 2)
    (0.6 % by default, 32 KB a state with many values, less with few).  Ranks of
    quantiles are wrong by less than 1.7 / quantile_k ** 0.9 with 99 % confidence
    (0.5 % by default).
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], sums: list[str], distinct: list[str], quantiles: list[str], lg_k: int = 15, quantile_k: int = 800):
        self.spark, self.path, self.keys, self.sums, self.distinct, self.quantiles = spark, path.rstrip("/"), keys, sums, distinct, quantiles
        self.lg_k, self.quantile_k = lg_k, quantile_k

    def partial(self, df: DataFrame, month: str) -> DataFrame:
        figures = [F.count("*").alias("n")]
        for c in self.sums:
            figures += [F.sum(C(c).cast(MONEY)).alias(f"sum_{c}"), F.count(c).alias(f"n_{c}"), F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
        figures += [F.hll_sketch_agg(C(c), F.lit(self.lg_k)).alias(f"kinds_{c}") for c in self.distinct]
        figures += [F.kll_sketch_agg_double(C(c).cast("double"), F.lit(self.quantile_k)).alias(f"ranks_{c}") for c in self.quantiles]
        return df.groupBy(C(month).alias("month"), *self.keys).agg(*figures)

    def add(self, df: DataFrame, month: str, feed: str) -> None:
        """Take in one feed.  The same feed again replaces what it left before; rows of a month may come in several feeds."""
        if not feed or "/" in feed:
            raise ValueError("a feed's name is a folder")
        self.partial(df, month).write.mode("overwrite").parquet(f"{self.path}/feed={feed}")

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def report(self, by: list[str] | None = None, first: str | None = None, last: str | None = None, at: tuple[float, ...] = (0.5,)) -> DataFrame:
        """Merged figures by some of the keys (or ``month``) over the months from first to last: n, sums, means, extremes, distinct counts, quantiles."""
        rows = self.rows()
        if first is not None:
            rows = rows.filter(C("month") >= first)
        if last is not None:
            rows = rows.filter(C("month") <= last)
        figures = [F.sum("n").alias("n")]
        for c in self.sums:
            total = F.sum(f"sum_{c}")
            figures += [F.coalesce(total, F.lit(0).cast(MONEY)).cast("double").alias(f"sum_{c}"), F.try_divide(total.cast("double"), F.sum(f"n_{c}")).alias(f"mean_{c}"), F.min(f"min_{c}").alias(f"min_{c}"), F.max(f"max_{c}").alias(f"max_{c}")]
        figures += [F.hll_sketch_estimate(F.hll_union_agg(f"kinds_{c}")).alias(f"distinct_{c}") for c in self.distinct]
        figures += [F.kll_merge_agg_double(f"ranks_{c}").alias(f"_ranks_{c}") for c in self.quantiles]
        out = rows.groupBy(*(by or [])).agg(*figures)
        for c in self.quantiles:
            empty = F.coalesce(F.kll_sketch_get_n_double(f"_ranks_{c}"), F.lit(0)) == 0
            found = [F.when(~empty, F.kll_sketch_get_quantile_double(f"_ranks_{c}", F.lit(q))) for q in at]
            out = out.withColumn(f"quantiles_{c}", F.array(*found)).drop(f"_ranks_{c}")
        return out
