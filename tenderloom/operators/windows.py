"""Windows, outliers and pivots.

A running total over a whole table would put all rows into one task; here it
runs in ranges of the order (ordering.py).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .metrics import quantiles
from .ordering import Ordered

C = F.col


EXACT = "decimal(28,6)"


def concentration_curve(df: DataFrame, key: str, amount: str) -> DataFrame:
    """Rank, cumulative sum and cumulative percent of keys by falling value (ties: by key), see ``Ordered``.

    Amounts are summed as decimals of six places, so that equal keys tie and
    the order of rows changes nothing; what is no such number (NaN, infinite,
    1e22 and more) is summed as double beside them.
    """
    exact, odd = C(amount).try_cast(EXACT), C(amount).cast("double")
    g = df.filter(C(key).isNotNull()).groupBy(key).agg(F.sum(exact).alias("_exact"), F.sum(F.when(exact.isNull(), odd)).alias("_odd"))
    both = lambda x, y: F.when(C(y).isNull(), C(x).cast("double")).otherwise(F.coalesce(C(x).cast("double"), F.lit(0.0)) + C(y))
    g = g.withColumn("value", both("_exact", "_odd"))
    out = Ordered(g, [F.desc("value"), F.desc("_exact"), C(key)]).running(C("_exact"), "_sum", beside={"_rest": C("_odd")})
    out = out.withColumns({"cumulative": both("_sum", "_rest"), "cumulative_all": both("_sum_all", "_rest_all")})
    return out.select(key, "value", "rank", "cumulative", F.try_divide(C("cumulative") * 100, "cumulative_all").alias("percent"))


def z_outliers(df: DataFrame, value: str, beyond: float = 3.0) -> DataFrame:
    """Rows farther than ``beyond`` sample deviations from the mean."""
    m = df.agg(F.avg(value).alias("_m"), F.stddev_samp(value).alias("_s"))
    z = F.try_divide(C(value) - C("_m"), C("_s"))
    return df.crossJoin(F.broadcast(m)).withColumn("z", z).filter(F.abs("z") > beyond).drop("_m", "_s")


def iqr_outliers(df: DataFrame, value: str, lo: float, hi: float, fence: float = 1.5) -> DataFrame:
    """Rows beyond the fences, which come from the values between lo and hi."""
    q = quantiles(df.filter(C(value).between(lo, hi)), value, [0.25, 0.75])
    q = q.select((C("q")[0] - fence * (C("q")[1] - C("q")[0])).alias("_lo"), (C("q")[1] + fence * (C("q")[1] - C("q")[0])).alias("_hi"))
    return df.crossJoin(F.broadcast(q)).filter((C(value) < C("_lo")) | (C(value) > C("_hi"))).drop("_lo", "_hi")


def pivoted(df: DataFrame, row: str, col: str, values: list, agg: Column) -> DataFrame:
    """Explicit columns, so no pass over the data to find them; empty cells are 0."""
    out = df.groupBy(row).pivot(col, values).agg(agg).fillna(0)
    return out.select(row, *[C(f"`{v}`").alias(f"c{v}") for v in values])


def extremes(df: DataFrame, key: str) -> DataFrame:
    """The most and the least frequent key; ties go to the smaller."""
    g = df.filter(C(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return g.agg(F.max_by(key, F.struct("n", (-C(key)).alias("k"))).alias("most"), F.min_by(key, F.struct("n", key)).alias("least"))
