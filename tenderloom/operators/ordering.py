"""A whole order at any size: rows lie in ranges of it, and a range's offset is what stands before it.

One range shuffle on the full order (so equal leading values part at the rows
behind them), a row number inside each range, and one small sum per range.  As
many ranges as the session's shuffle gives, fewer where its partitions are
small; no task sees more than its range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..streaming.incremental import shared_path

C = F.col
_ROW = (1 << 33) - 1  # monotonically_increasing_id numbers the rows of a partition below this bit


class Ordered:
    """``df`` in its order, written once to the shared folder (or to ``path``), one folder per range.

    ``df`` is read twice (bounds of the ranges, then the rows): store it first
    if it costs much.  Rows equal in the whole order stand in any order.  An
    empty frame has no ranges.  Columns named ``_part``, ``_row`` or ``_n`` are
    not allowed.
    """

    def __init__(self, df: DataFrame, order: list[Column | str], path: str | None = None):
        spark = df.sparkSession
        if clash := {"_part", "_row", "_n"} & set(df.columns):
            raise ValueError(f"columns {sorted(clash)} are taken")
        self.columns, self.path = df.columns, path or shared_path(spark, "ranges")
        out = df.repartitionByRange(*order).sortWithinPartitions(*order)
        out = out.withColumns({"_row": F.monotonically_increasing_id().bitwiseAND(_ROW), "_part": F.spark_partition_id()})
        out.write.partitionBy("_part").parquet(self.path)
        self.rows = spark.read.schema(out.schema).parquet(self.path)

    def ranges(self, **sums: Column) -> DataFrame:
        """One row per range: _part, _n rows, and _n_before; for each named sum ``<name>_before``, and ``<name>_all``."""
        g = self.rows.groupBy("_part").agg(F.count("*").alias("_n"), *[F.sum(c).alias(k) for k, c in sums.items()])
        before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        all_ = Window.partitionBy(F.lit(0))
        out = g.withColumn("_n_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        for k in sums:
            out = out.withColumns({f"{k}_before": F.sum(k).over(before), f"{k}_all": F.sum(k).over(all_)}).drop(k)
        return out

    def numbered(self, name: str = "rank") -> DataFrame:
        """All rows with their place in the order, from 1."""
        out = self.rows.join(F.broadcast(self.ranges().select("_part", "_n_before")), "_part")
        return out.select(*self.columns, (C("_n_before") + C("_row") + 1).alias(name))

    def running(self, value: Column, name: str, rank: str = "rank", beside: dict[str, Column] | None = None) -> DataFrame:
        """``numbered`` with ``name``, the sum of a value up to each row, and ``<name>_all``, that of all rows; and of the values ``beside`` it."""
        sums = {name: value, **(beside or {})}
        ranges = self.ranges(**{f"_s{i}": v for i, v in enumerate(sums.values())})
        own = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
        out = self.rows.withColumns({f"_run{i}": F.sum(v).over(own) for i, v in enumerate(sums.values())}).join(F.broadcast(ranges), "_part")
        until = lambda i: F.when(C(f"_run{i}").isNull(), C(f"_before{i}")).otherwise(C(f"_run{i}") + F.coalesce(f"_before{i}", F.lit(0)))
        out = out.withColumnsRenamed({f"_s{i}_before": f"_before{i}" for i in range(len(sums))})
        return out.select(*self.columns, (C("_n_before") + C("_row") + 1).alias(rank), *[c for i, k in enumerate(sums) for c in (until(i).alias(k), C(f"_s{i}_all").alias(f"{k}_all"))])

    def page(self, page: int, size: int = 50, name: str = "rank") -> DataFrame:
        """Page ``page`` (from 1) in order; only the folders of its ranges are read.

        The ranges' row counts (a row each) come to the driver, and from then
        on a page at any depth costs the same.
        """
        if page < 1 or size < 1:
            raise ValueError("pages and their size start at 1")
        if not hasattr(self, "_counts"):
            self._counts = [(r["_part"], r["_n_before"], r["_n"]) for r in self.ranges().orderBy("_part").collect()]
        first, last = (page - 1) * size, page * size
        hit = [(p, before) for p, before, n in self._counts if before < last and before + n > first]
        place = F.lit(None).cast("long")
        for p, before in hit:
            place = F.when(C("_part") == p, C("_row") + (before + 1)).otherwise(place)
        out = self.rows.filter(C("_part").isin([p for p, _ in hit])).withColumn("_place", place)
        return out.filter((C("_place") > first) & (C("_place") <= last)).orderBy("_place").select(*self.columns, C("_place").alias(name))


def numbered(df: DataFrame, order: list[Column | str], name: str = "rank") -> DataFrame:
    """All rows of ``df`` with their place in the order, from 1.  See ``Ordered``."""
    return Ordered(df, order).numbered(name)
