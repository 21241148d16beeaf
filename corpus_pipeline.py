"""From raw documents to packed sequences, in five stages that each call one operator.

Each stage reads all that its predecessor kept and returns the columns of
``documents``; the last returns pieces of token ids.  Stages are written as
Parquet in between, so that a lost executor costs one stage at most.

Every stage takes an empty table (none out), nulls in any column, texts of any
length, and further columns whatever their names; all but the last hand those
on.  What a null text, a null id and repeated rows come to stands with each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderloom.llm.exact_dedup import drop_copies
from tenderloom.llm.language_id import drop_rejected, fit_languages
from tenderloom.llm.minhash_dedup import drop_near_copies
from tenderloom.llm.packing import pack
from tenderloom.llm.shared import stored, sweep
from tenderloom.llm.substring_dedup import drop_repeats


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or far from all languages go; the models learn from a bounded labelled sample.

    Null and empty texts go.  Rows without an id or a language, and repeated
    ones, are judged by their texts like all others.  If no language is
    labelled, nothing is learned and every row goes.
    """
    return drop_rejected(docs, fit_languages(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays.

    A null text equals an empty one.  Of repeated rows one stays; a row
    without an id stays only where no equal text has one.
    """
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shingles of five words and a similarity of 0.8 the smallest doc_id stays.

    Null and empty texts are linked with nothing and stay, as do rows without
    an id.  Rows of one id are one document: they stay or go together.
    """
    return drop_near_copies(docs, shingle_words=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words under a window of 13 that an earlier document has go; n_chars follows.

    Every row stays, null and empty texts as they are.  Rows without an id
    keep their words, and rows of one id don't cut each other.
    """
    out = drop_repeats(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids; sequences of one length share a bucket.

    A null or empty text is one piece with the end id alone.  Repeated rows,
    and those without an id, are packed each on its own.
    """
    return pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("packing", packing)]

#: SQL can express neither the language models nor the tokenizer; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = stored(docs, name)
            sweep(spark, [docs])  # what the stage wrote in between
    return docs
