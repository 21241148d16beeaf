"""Substring dedup: Rabin-Karp hashes of every window of words, counted in Spark, merged into removal intervals.

Documents are dealt to blocks of neighbouring ids, so that of two blocks the
one with the smaller number has the smaller ids.  Each block hashes all its
windows and sends each distinct hash once, to the bucket of that hash; a
passage that fills a third of all documents is thus counted once per block.  A
bucket tells every block but the first that has a hash that it was seen
before.  Inside a block, the smallest id of a hash is known without that.

A window is told apart by 64 hash bits and those of its bucket, which come
from a second polynomial.  With about a million windows a bucket the expected
number of false matches among n windows is n * 1e6 / 2**65: 3e-4 for 10**10.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import BASES, slices, string_buffers, prepared_tasks, trim, window_hashes, word_hashes, words

BLOCK_BYTES = 4 << 20
WEIGHED = 1 << 16  # bytes of text that count as one document when blocks are cut
RANK = 20  # blocks whose numbers agree beyond these bits hold one id
BUCKET_BYTES = 6 << 20  # of text, about a million windows


def windows_of(texts: pa.ChunkedArray, width: int, buckets: int):
    """Per slice of rows: word starts, ends, rows, and for each window its first word, hash and bucket."""
    data, offsets = string_buffers(texts)
    for lo, hi in slices(offsets):
        starts, ends, rows = words(data, offsets, lo, hi)
        n = len(starts) - width + 1
        if n > 0:
            first = np.flatnonzero(rows[:n] == rows[width - 1 :])
            h, g = (window_hashes(word_hashes(data, starts, ends, seed), rows, width, base)[first] for seed, base in enumerate(BASES))
            bucket = (g % np.uint64(buckets)).astype(np.int64)
        else:
            first, h, bucket = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        yield data, lo, hi, starts, ends, rows, first, h, bucket


def packed(hashes: np.ndarray) -> bytes:
    """Ascending uint64 by byte planes; the leading planes of sorted numbers compress well."""
    planes = np.ascontiguousarray(hashes.astype(">u8").view(np.uint8).reshape(-1, 8).T)
    lead = pa.compress(planes[:3].tobytes(), codec="zstd", asbytes=True)
    return len(hashes).to_bytes(4, "little") + len(lead).to_bytes(4, "little") + lead + planes[3:].tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    n, k = int.from_bytes(raw[:4], "little"), int.from_bytes(raw[4:8], "little")
    planes = np.frombuffer(pa.decompress(raw[8 : 8 + k], decompressed_size=3 * n, codec="zstd", asbytes=True) + raw[8 + k :], np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view(">u8").reshape(-1).astype(np.uint64)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 13) -> DataFrame:
    """``docs`` with n_words, n_removed, removed (list of [start, end) word intervals) and kept_text.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  A word goes if a window of
    ``width`` words covers it whose word sequence also starts in a document
    with a smaller id; windows are judged on the input.  kept_text joins the
    words that stay by one blank.  Null or empty text: no words, kept_text is
    empty.  Rows with the same id don't make each other's words go.  A row
    whose id is null keeps everything and is no other row's origin.  Columns
    of ``docs`` named like a new column are replaced.  Repeats inside one
    document stay.  Very long texts are read whole; an empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    new = {"n_words": "long", "n_removed": "long", "removed": "array<struct<start:int,end:int>>", "kept_text": "string"}
    docs = docs.drop(*new)
    size = docs.agg(F.sum(F.octet_length(text_col)), F.max(id_col)).first()
    total = size[0] or 0
    n_blocks = max(prepared_tasks(spark), math.ceil(total / BLOCK_BYTES))
    n_buckets = max(prepared_tasks(spark), math.ceil(total / BUCKET_BYTES))
    # bounds of the blocks: n_blocks - 1 numbers, whatever the number of documents; long texts count several times
    weight = F.greatest(F.lit(1), F.ceil(F.octet_length(text_col) / WEIGHED)).cast("int")
    ids = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.explode(F.array_repeat(F.col(id_col).cast("long"), weight)).alias("id"))
    cuts = ids.agg(F.percentile_approx("id", [i / n_blocks for i in range(1, n_blocks)] or [0.5], 20 * n_blocks)).first()[0] or []
    values, times = np.unique(np.array(cuts, np.int64), return_counts=True)
    # an id with several blocks' worth of rows has blocks of its own, of equal rank
    hot, times = values[times > 1], times[times > 1] + 1
    bounds = np.unique(np.concatenate([values, hot - 1]))

    @F.pandas_udf("long")
    def block_of(ids: pd.Series, texts: pd.Series) -> pd.Series:
        ids, texts = ids.to_numpy(np.int64), texts.to_numpy(np.int64)
        out = np.searchsorted(bounds, ids, "left").astype(np.int64) << RANK
        if len(hot):
            at = np.minimum(np.searchsorted(hot, ids), len(hot) - 1)
            out += np.where(hot[at] == ids, texts % times[at], 0)
        return pd.Series(out)

    nameless = docs.filter(F.col(id_col).isNull())
    dealt = docs.filter(F.col(id_col).isNotNull()).withColumn("_block", block_of(F.col(id_col).cast("long"), F.xxhash64(text_col)))

    def ordered(table: pa.Table) -> pa.Table:
        return table.take(pa.compute.sort_indices(table.column(id_col)))

    def first_rows(table: pa.Table):
        """Of each window of the block: slice data, and whether its hash starts in an earlier id of the block."""
        parts = list(windows_of(table.column(text_col), width, n_buckets))
        ids = table.column(id_col).to_numpy(zero_copy_only=False)
        h = np.concatenate([p[7] for p in parts]) if parts else np.zeros(0, np.uint64)
        bucket = np.concatenate([p[8] for p in parts]) if parts else np.zeros(0, np.int64)
        at = np.concatenate([p[5][p[6]] for p in parts]) if parts else np.zeros(0, np.int64)
        return parts, ids, h, bucket, at

    def hashes(table: pa.Table) -> pa.Table:
        block = table.column("_block")[0].as_py()
        _, _, h, bucket, _ = first_rows(table)
        h, where = np.unique(h, return_index=True)
        bucket = bucket[where]
        order = np.argsort(bucket.astype(np.uint16) if n_buckets <= 65536 else bucket, kind="stable")
        h, bucket = h[order], bucket[order]
        edges = np.flatnonzero(np.diff(bucket, prepend=-1)) if len(bucket) else np.zeros(0, np.int64)
        ends = np.append(edges[1:], len(bucket))
        trim()
        return pa.table({"_block": pa.array([block] * len(edges), pa.int64()), "bucket": pa.array(bucket[edges], pa.int32()), "hashes": pa.array([packed(h[a:b]) for a, b in zip(edges, ends)], pa.binary())})

    def seen(table: pa.Table) -> pa.Table:
        """For each block of this bucket: its hashes that a block of smaller rank has, too."""
        blocks = table.column("_block").to_numpy()
        lists = [unpacked(x.as_py()) for x in table.column("hashes")]
        order = np.argsort(blocks)
        owner = np.repeat(blocks[order], [len(lists[i]) for i in order])
        h = np.concatenate([lists[i] for i in order]) if lists else np.zeros(0, np.uint64)
        del lists
        by = np.argsort(h, kind="stable")  # blocks stay ascending within a hash
        h, owner = h[by], owner[by]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        first = owner[new][np.cumsum(new) - 1]
        again = owner >> RANK > first >> RANK
        h, owner = h[again], owner[again]
        by = np.argsort(owner, kind="stable")
        h, owner = h[by], owner[by]
        edges = np.flatnonzero(np.diff(owner, prepend=-1)) if len(owner) else np.zeros(0, np.int64)
        ends = np.append(edges[1:], len(owner))
        trim()
        return pa.table({"_block": pa.array(owner[edges], pa.int64()), "hashes": pa.array([packed(h[a:b]) for a, b in zip(edges, ends)], pa.binary())})

    out_schema = T.StructType([*docs.schema.fields, *[T.StructField(k, T._parse_datatype_string(v)) for k, v in new.items()]])

    def removed(table: pa.Table, told: pa.Table) -> pa.Table:
        if table.num_rows == 0:
            return None_table
        table = ordered(table)
        known = [unpacked(x.as_py()) for x in told.column("hashes")]
        known = np.sort(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        parts, ids, h, _, at = first_rows(table)
        _, where, which = np.unique(h, return_index=True, return_inverse=True)
        gone = ids[at] > ids[at[where]][which]
        if len(known):
            gone |= known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h
        return finished(table.drop_columns(["_block"]), parts, gone)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows that lose nothing."""
        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch])
                parts = list(windows_of(table.column(text_col), width, n_buckets))
                yield from finished(table, parts, np.zeros(sum(len(p[7]) for p in parts), bool)).cast(None_table.schema).to_batches()

    def finished(table: pa.Table, parts: list, gone: np.ndarray) -> pa.Table:
        """The new columns, from the windows that go."""
        n_words, n_removed, spans, kept, done = [], [], [], [], 0
        for data, lo, hi, starts, ends, rows, first, own, _ in parts:
            flags = gone[done : done + len(own)]
            done += len(own)
            edge = np.zeros(len(starts) + 1, np.int32)
            np.add.at(edge, first[flags], 1)
            np.add.at(edge, first[flags] + width, -1)
            cover = np.cumsum(edge[:-1]) > 0
            limits = np.searchsorted(rows, np.arange(lo, hi + 1))
            for k in range(hi - lo):
                a, b = int(limits[k]), int(limits[k + 1])
                n_words.append(b - a)
                if a == b:
                    n_removed.append(0), spans.append([]), kept.append("")
                    continue
                text = data[starts[a] : ends[b - 1]].tobytes().split()
                mask = cover[a:b]
                if mask.any():
                    turn = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
                    spans.append([{"start": int(x), "end": int(y)} for x, y in turn.reshape(-1, 2)])
                    text = [w for w, m in zip(text, mask.tolist()) if not m]
                else:
                    spans.append([])
                n_removed.append(b - a - len(text))
                kept.append(b" ".join(text).decode())
        for name, values, kind in (("n_words", n_words, pa.int64()), ("n_removed", n_removed, pa.int64()), ("removed", spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept_text", kept, pa.string())):
            table = table.append_column(name, pa.array(values, kind))
        del parts, gone
        trim()
        return table

    from pyspark.sql.pandas.types import to_arrow_schema

    None_table = to_arrow_schema(out_schema).empty_table()
    sent = dealt.groupBy("_block").applyInArrow(hashes, "_block long, bucket int, hashes binary")
    told = sent.groupBy("bucket").applyInArrow(seen, "_block long, hashes binary")
    out = dealt.groupBy("_block").cogroup(told.groupBy("_block")).applyInArrow(removed, out_schema)
    return out.unionByName(nameless.mapInArrow(whole, out_schema)).select(*docs.columns, *new)


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 13) -> DataFrame:
    """``docs`` without repeated passages; texts that lose nothing stay as they are, of others kept_text stays."""
    out = substring_dedup(docs, id_col, text_col, width)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col(text_col))
    return out.withColumn(text_col, text).select(*docs.columns)
