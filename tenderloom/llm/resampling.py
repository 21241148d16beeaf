"""Importance resampling towards a target distribution, by bucketed counts of word runs.

A feature is a run of 1 to ``most`` consecutive words, joined by one blank; its
bucket is the CRC-32 of its bytes modulo ``buckets``.  CRC-32 is linear over
XOR: a byte contributes a value that only its own bits and its distance from
the end of the message decide, and the length adds a constant.  So one table of
distance by byte gives the checksums of all features of a batch with one
gather and one ``bitwise_xor.reduceat``.  Features longer than the table are
folded: blocks of the table's length, counted from the end, are reduced each,
and the blocks before are pushed on by a whole block of zero bytes.

Two passes over the texts: the first sends each task's counts by bucket, at
most ``buckets`` rows a task; the second weighs documents by gains, a table of
``buckets`` numbers.  Ranks come from the whole order (ordering.py).
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import numbered
from .shared import LOWER, expand, prepared_tasks, slices, stored, string_buffers, trimmed, words

# What stands between words: ASCII but for digits and letters (texts are lower-cased before).
BETWEEN = np.ones(256, bool)
BETWEEN[ord("0") : ord("9") + 1] = BETWEEN[ord("a") : ord("z") + 1] = False
BETWEEN[0x80:] = False
REACH = 64  # distances from the end that the table holds
SLICE = 1 << 20


@functools.cache
def position_table() -> np.ndarray:
    """[distance from the end, byte]: what the byte contributes to the checksum's register; 64 KB.

    A register moves by one zero byte as x -> T[x & 255] ^ x >> 8, where T is the
    row for distance 0: zlib's checksum of one byte, without what the length adds.
    """
    first = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)
    rows = [first]
    for _ in range(REACH - 1):
        rows.append(first[rows[-1] & 255] ^ rows[-1] >> np.uint32(8))
    return np.stack(rows)


@functools.cache
def block_step() -> np.ndarray:
    """[byte of the register, its value]: the register after ``REACH`` zero bytes."""
    first = position_table()[0]
    x = np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32)
    for _ in range(REACH):
        x = first[x & 255] ^ x >> np.uint32(8)
    return x


@functools.cache
def length_constants() -> np.ndarray:
    """The checksum of n zero bytes, for n up to 16 blocks."""
    return np.array([zlib.crc32(bytes(n)) for n in range(16 * REACH + 1)], np.uint32)


def length_constant(n: int) -> int:
    out, zeros = 0, bytes(1 << 16)
    while n:
        out, n = zlib.crc32(zeros[: min(n, len(zeros))], out), n - min(n, len(zeros))
    return out


def checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of data[start:end] of all spans, none of them empty; spans may overlap.  Works on ``SLICE`` bytes at a time."""
    table, size = position_table().ravel(), ends - starts
    out = np.zeros(len(starts), np.uint32)
    short = np.flatnonzero(size <= REACH)
    until = np.append(0, np.cumsum(size[short]))
    for lo, hi in slices(until, SLICE):
        n = size[short[lo:hi]]
        first = until[lo:hi] - until[lo]
        left = np.repeat(first + n - 1, n) - np.arange(int(n.sum()))  # bytes to the end of the span
        out[short[lo:hi]] = np.bitwise_xor.reduceat(table[left << 8 | expand(data, starts[short[lo:hi]], n)], first)
    for i in np.flatnonzero(size > REACH).tolist():
        out[i] = folded(data[starts[i] : ends[i]])
    known = length_constants()
    constant = known[np.minimum(size, len(known) - 1)]
    for i in np.flatnonzero(size >= len(known)).tolist():
        constant[i] = length_constant(int(size[i]))
    return out ^ constant


def folded(span: np.ndarray) -> int:
    """The register after a long span: blocks of ``REACH`` bytes from its end are reduced, then folded from its start."""
    table, (s0, s1, s2, s3) = position_table().ravel(), block_step().tolist()
    head = len(span) % REACH
    register = 0
    for lo, hi in [(0, head)] * (head > 0) + [(k, k + SLICE) for k in range(head, len(span), SLICE)]:
        part = span[lo:hi]
        left = (len(span) - 1 - lo - np.arange(len(part))) % REACH
        for block in np.bitwise_xor.reduceat(table[left << 8 | part], np.arange(0, len(part), REACH)).tolist():
            register = s0[register & 255] ^ s1[register >> 8 & 255] ^ s2[register >> 16 & 255] ^ s3[register >> 24] ^ block
    return register


def features(data: np.ndarray, offsets: np.ndarray, lo: int, hi: int, most: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows lo..hi: the bucket and the row (from 0) of every feature, and the number of words of each row."""
    a, b = int(offsets[lo]), int(offsets[hi])
    own, local = LOWER[data[a:b]], offsets[lo : hi + 1] - a
    starts, ends, rows = words(own, local, 0, hi - lo, BETWEEN)
    many = np.bincount(rows, minlength=hi - lo)
    size = ends - starts
    tight = np.full(int(size.sum()) + len(size), 0x20, np.uint8)  # words, each with one blank behind it
    begin = np.cumsum(size + 1) - size - 1
    tight[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))] = expand(own, starts, size)
    found, where = [], []
    for k in range(min(most, len(starts))):
        first = np.flatnonzero(rows[: len(rows) - k] == rows[k:])
        found.append(checksums(tight, begin[first], begin[first + k] + size[first + k]) % np.uint32(buckets))
        where.append(rows[first])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), many
    return np.concatenate(found).astype(np.int64), np.concatenate(where), many


def bucket_counts(texts: DataFrame, text_col: str = "text", most: int = 2, buckets: int = 10_000) -> DataFrame:
    """Rows (bucket, n) of the features of all texts.  Null texts have none; an empty table has no rows."""
    prepared_tasks(texts.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            data, offsets = string_buffers(batch.column(0))
            for lo, hi in slices(offsets, SLICE):
                total += np.bincount(features(data, offsets, lo, hi, most, buckets)[0], minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.record_batch([pa.array(hit), pa.array(total[hit])], ["bucket", "n"])

    out = texts.select(F.col(text_col).cast("string")).mapInArrow(lambda batches: trimmed(counted(batches)), "bucket long, n long")
    return out.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, most: int = 2, buckets: int = 10_000) -> np.ndarray:
    """floor(1000 * ln of target against raw frequency) by bucket, both smoothed by one; both frames have a column ``text``."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for counts, frame in ((s, raw), (t, target)):
        for r in bucket_counts(frame, "text", most, buckets).collect():  # at most ``buckets`` rows
            counts[r["bucket"]] = r["n"]
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", most: int = 2) -> DataFrame:
    """Per row: id_col, n_features, n_words, weight: the floored mean gain of its features, 0 without any."""
    prepared_tasks(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_buffers(batch.column(1))
            for lo, hi in slices(offsets, SLICE):
                bucket, rows, many = features(data, offsets, lo, hi, most, len(gain))
                n = np.bincount(rows, minlength=hi - lo)
                total = np.zeros(hi - lo, np.int64)
                order = np.argsort(rows, kind="stable")
                held = np.flatnonzero(n)
                if len(held):
                    total[held] = np.add.reduceat(gain[bucket[order]], (np.cumsum(n) - n)[held])
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), pa.array(n), pa.array(many.astype(np.int64)), pa.array(total // np.maximum(n, 1))], [id_col, "n_features", "n_words", "weight"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(lambda batches: trimmed(weights(batches)), f"`{id_col}` {kind}, n_features long, n_words long, weight long")


def noise(id_col: str, seed: int) -> Column:
    """A Gumbel variate in thousandths, floored, from the id's digest: the highest sums of log weight and noise are a sample by weight without replacement."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", percent: int = 25, least_words: int = 20, most: int = 2, buckets: int = 10_000, seed: int = 7) -> DataFrame:
    """One row per row of ``docs``: id_col, n_features, n_words, weight, score, rank (null if not drawn).

    Of the N documents with at least ``least_words`` words, the
    floor(percent * N / 100) highest scores are drawn, ties to the smaller id.
    Null texts count as empty.  A row without id counts among the features of
    all, but its score is null and it is neither drawn nor part of N.  Rows of
    one id share their noise; equal rows are ranked in any order, each drawn
    on its own.  Very long texts and words take time in proportion to their
    length.  Empty ``docs`` give an empty result, an empty ``target`` the gains
    of no counts.  Other columns are ignored.
    """
    gain = gains(docs.select(F.col(text_col).alias("text")), target.select(F.col(target_col).alias("text")), most, buckets)
    out = weighed(docs, gain, id_col, text_col, most).withColumn("score", F.col("weight") + noise(id_col, seed))
    out = stored(out, "weighed")
    fit = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    drawn = out.filter(fit).count() * percent // 100
    placed = numbered(out.filter(fit), [F.desc("score"), F.col(id_col), F.col("n_features")])
    rest = out.filter(~F.coalesce(fit, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).unionByName(rest)
