"""A stored ledger of verdicts by content hash, bucketed by it.

A batch is brought to the ledger, not the ledger to the batch: the files are
bucketed by hash, so a join shuffles the batch's hashes alone into as many
buckets, and reads of the ledger have no exchange, however often it is met.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .dedup import with_verdicts

C = F.col


class Ledger:
    """The ledger in a folder that driver and executors share; ``verdict`` is the DDL of its columns.

    ``buckets`` rules when the ledger is first made: take as many as keep a
    bucket of the expected ledger near 128 MB; later objects go by the folder.
    A hash that two writers recorded at a time, or one writer twice because it
    was tried again, counts once, with the least verdict.
    """

    def __init__(self, spark: SparkSession, path: str, verdict: str, key: str = "hash", buckets: int = 64):
        self.spark, self.key = spark, key
        root = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
        store = root.getFileSystem(spark._jsc.hadoopConfiguration())
        made = [f.getPath().getName() for f in store.listStatus(root)] if store.exists(root) else []
        self.buckets = next((int(m[8:]) for m in made if m.startswith("buckets_")), buckets)
        # the table is a name of the session for the folder, which alone is the ledger
        self.table = f"ledger_{zlib.crc32(str(root).encode()):08x}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({key} STRING, {verdict}) USING parquet CLUSTERED BY ({key}) INTO {self.buckets} BUCKETS LOCATION '{root}/buckets_{self.buckets}'")
        self.verdict = [c for c in spark.table(self.table).columns if c != key]

    def rows(self) -> DataFrame:
        """One row per hash."""
        v = self.spark.table(self.table).groupBy(self.key).agg(F.min(F.struct(*self.verdict)).alias("_v"))
        return v.select(self.key, *[C(f"_v.{c}").alias(c) for c in self.verdict])

    def unseen(self, df: DataFrame) -> DataFrame:
        """Rows whose hash the ledger has not; rows without one, too."""
        return df.join(self.rows().select(self.key), self.key, "left_anti")

    def judged(self, df: DataFrame, judge) -> DataFrame:
        """``df`` with stored verdicts where the ledger has them, and those of ``judge`` elsewhere; ``seen`` tells them apart."""
        return with_verdicts(df, self.rows(), self.key, self.verdict, judge)

    def record(self, judged: DataFrame) -> None:
        """Add the verdicts of rows that were not seen, one per hash (of several, the least); rows without a hash are not kept."""
        new = judged.filter(~C("seen") & C(self.key).isNotNull()).repartition(self.buckets, self.key)
        new = new.groupBy(self.key).agg(F.min(F.struct(*self.verdict)).alias("_v")).select(self.key, *[C(f"_v.{c}").alias(c) for c in self.verdict])
        new.write.insertInto(self.table)
