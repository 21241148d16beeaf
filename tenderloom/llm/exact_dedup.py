"""Exact dedup by deterministic block naming, with DataFrame functions only.

A text is cut into blocks of a fixed number of characters.  Equal blocks get
the same integer: blocks are dealt to buckets, each bucket is sorted and its
distinct blocks are numbered (``bucket << RANK_BITS | rank``), so two blocks
share a name only if they are equal - no digest decides.  Then adjacent pairs
of names are named the same way, level by level, until each text has one name.

Cost: every text is shuffled once, to be sorted; what follows are integers.
Blocks that very many rows share are found by a count first; at most
``HOT_KEYS`` of them travel as a broadcast (HOT_KEYS * block size bytes at
most) instead of meeting in one bucket, so every other block belongs to less
than 1 / HOT_KEYS of the rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import HOT_KEYS, cut, lookup, prepared_tasks

RANK_BITS = 36
BUCKETS = 1 << 20
TASK_BYTES = 64 << 20
LEVELS = 64


def lowered(text: Column) -> Column:
    """A-Z to a-z and nothing else; ``lower`` does that for texts of ASCII only."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def with_names(rows: DataFrame, content: list[str], hot: DataFrame, buckets: int, spread: str, tasks: int) -> DataFrame:
    """rows with ``name``, one integer per distinct value of the content columns, instead of those columns.

    ``hot``: the content columns and ``hot_name`` of the most frequent values,
    HOT_KEYS rows at most.  ``spread``: a column that deals rows evenly which
    already have their name.  ``tasks``: how many sort the buckets.
    """
    named = hot.select(*[F.col(c).alias(f"_h_{c}") for c in content], "hot_name")
    match = [F.col(c) == F.col(f"_h_{c}") for c in content]
    out = rows.join(F.broadcast(named), match, "left")
    out = out.select(
        *[c for c in rows.columns if c not in content],
        "hot_name",
        F.pmod(F.when(F.col("hot_name").isNull(), F.xxhash64(*content)).otherwise(F.xxhash64(spread)), F.lit(buckets)).alias("bucket"),
        *[F.when(F.col("hot_name").isNull(), F.col(c)).alias(c) for c in content],
    )
    out = out.repartition(tasks, "bucket")
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy(*content)).cast("long")
    name = F.coalesce("hot_name", F.shiftleft("bucket", RANK_BITS) + rank)
    return out.select(*[c for c in rows.columns if c not in content], name.alias("name"))


def hot_names(counted: DataFrame, content: list[str], buckets: int) -> DataFrame:
    """The most frequent values, numbered in the order of their content above all bucket names."""
    top = counted.filter(F.col("count") > 1).orderBy(F.desc("count"), *content).limit(HOT_KEYS)
    return top.select(*content, (F.shiftleft(F.lit(buckets).cast("long"), RANK_BITS) + F.row_number().over(Window.orderBy(*content))).alias("hot_name"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = 4096) -> DataFrame:
    """One row per document: id_col, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty, and the empty text is a text like any other.  Of equal texts the
    row with the largest id stays (a null id counts as smallest).  Rows that
    agree in id and text are one document and come back once; rows with one id
    and different texts are different documents.  Other columns of ``docs``
    are ignored whatever their names.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    raw = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_raw"))
    # enough tasks that each sorts about TASK_BYTES of text, whatever the session's setting
    size = raw.agg(F.sum(F.octet_length("_raw"))).first()[0] or 0
    tasks = max(prepared_tasks(spark), -(-size // TASK_BYTES))
    buckets = min(BUCKETS, tasks * 16)
    group = block_chars * 64  # two steps, so that substring() doesn't start anew for each block of a very long text

    def blocks(df: DataFrame, text: str, *keep: str) -> DataFrame:
        """One row per block: pos, n_blocks, block; an empty text has one empty block."""
        length = F.char_length(text)
        last = lambda n, size: F.greatest(F.lit(0), F.floor((n - 1) / size)).cast("int")
        df = df.select(*keep, (last(length, block_chars) + 1).alias("n_blocks"), F.posexplode(F.transform(F.sequence(F.lit(0), last(length, group)), lambda i: F.substring(text, i * group + 1, F.lit(group)))).alias("_g", "_part"))
        df = df.select(*keep, "n_blocks", "_g", F.posexplode(F.transform(F.sequence(F.lit(0), last(F.char_length("_part"), block_chars)), lambda i: F.substring("_part", i * block_chars + 1, F.lit(block_chars)))).alias("_p", "block"))
        return df.select(*keep, "n_blocks", (F.col("_g") * 64 + F.col("_p")).alias("pos"), "block")

    # which blocks are frequent: equal blocks agree in this number, so the most frequent numbers hold them
    numbered = blocks(raw, "_raw").withColumn("route", F.xxhash64(F.lower("block")))
    frequent = [r["route"] for r in numbered.groupBy("route").count().filter("count > 1").orderBy(F.desc("count"), "route").limit(HOT_KEYS).collect()]
    counted = numbered.filter(F.col("route").isin(frequent)) if frequent else numbered.filter(F.lit(False))
    hot = cut(hot_names(counted.select(lowered(F.col("block")).alias("block")).groupBy("block").count(), ["block"], buckets))

    texts = raw.select("_id", lowered(F.col("_raw")).alias("_text"))
    rows = blocks(texts.withColumn("sha", F.sha2("_text", 256)), "_text", "_id", "sha")
    named = cut(with_names(rows, ["block"], hot, buckets, "_id", tasks))

    one = named.filter("n_blocks = 1").select("_id", "sha", (F.col("name") * LEVELS).alias("identity")).distinct()
    open_ = named.filter("n_blocks > 1").groupBy("_id", "sha").agg(F.transform(F.array_sort(F.collect_set(F.struct("pos", "name"))), lambda x: x["name"]).alias("names"))
    most = named.agg(F.max("n_blocks")).first()[0] or 1
    level, done = 0, [one]
    while 1 << level < most:
        level += 1
        last = F.ceil(F.size("names") / 2).cast("int") - 1
        pairs = open_.select("_id", "sha", (last + 1).alias("n"), F.posexplode(F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(F.get("names", i * 2).alias("a"), F.coalesce(F.get("names", i * 2 + 1), F.lit(-1).cast("long")).alias("b")))).alias("pos", "pair"))
        pairs = pairs.select("_id", "sha", "n", "pos", "pair.a", "pair.b")
        hot = hot_names(pairs.groupBy("a", "b").count(), ["a", "b"], buckets)
        named = cut(with_names(pairs, ["a", "b"], hot, buckets, "_id", tasks))
        done.append(named.filter("n = 1").select("_id", "sha", (F.col("name") * LEVELS + level).alias("identity")))
        open_ = named.filter("n > 1").groupBy("_id", "sha").agg(F.transform(F.array_sort(F.collect_set(F.struct("pos", "name"))), lambda x: x["name"]).alias("names"))
    ids = done[0]
    for more in done[1:]:
        ids = ids.unionByName(more)
    ids = cut(ids)
    groups = ids.groupBy("identity").agg(F.count("*").alias("group_size"), F.max("_id").alias("keep_id"))
    out = lookup(ids, "identity", groups, "group_size", max(2, ids.count() // HOT_KEYS), "_id")
    return out.select(F.col("_id").alias(id_col), "keep_id", "group_size", F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that agree in id and text, one.

    A row without an id stays only where no equal text has one.
    """
    out = exact_dedup(docs, id_col, text_col)
    kept = cut(out.select(F.col(id_col).alias("_kept_id"), F.col("text_sha256").alias("_kept_sha"), "kept"))
    keyed = docs.withColumn("_sha", F.sha2(lowered(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), 256))
    keyed = keyed.join(kept.filter("kept"), F.col(id_col).eqNullSafe(F.col("_kept_id")) & (F.col("_sha") == F.col("_kept_sha")), "left_semi")
    if kept.count() < docs.count():
        keyed = keyed.dropDuplicates([id_col, "_sha"])
    return keyed.drop("_sha")
