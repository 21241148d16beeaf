"""Interim tables: what several passes need is computed once."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..streaming.incremental import shared_path


def stored(df: DataFrame, name: str = "interim") -> DataFrame:
    """Write a frame to the folder of spark.checkpoint.dir and read it back: select the columns that are needed before."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
