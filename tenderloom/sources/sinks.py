"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_csv(df: DataFrame, path: str, compress: bool = True) -> None:
    """A folder of CSV parts with a header, gzipped on request; files are written in parallel."""
    df.write.mode("errorifexists").option("header", True).option("compression", "gzip" if compress else "none").csv(path)


def write_table(df: DataFrame, path: str, partition: str = "anno") -> None:
    """Parquet by year, so that readers prune; rows of a year are brought together before, to write few files, and a large year is split again."""
    df.hint("rebalance", partition).write.mode("errorifexists").partitionBy(partition).parquet(path)


def swap_table(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Write beside the table and put it in its place; the table may be one of the frame's sources."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(conf)
    fresh, old = at(path + ".new"), at(path + ".old")
    fs.delete(fresh, True)
    df.write.parquet(path + ".new")
    fs.delete(old, True)
    if fs.exists(at(path)) and not fs.rename(at(path), old):
        raise OSError(f"can't move {path}")
    if not fs.rename(fresh, at(path)):
        raise OSError(f"can't move {path}.new")
    fs.delete(old, True)


def sample_of(df: DataFrame, order: list[str], most: int = 100_000) -> DataFrame:
    """The first rows by an explicit order."""
    return df.orderBy(*order).limit(most)
