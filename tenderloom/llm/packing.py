"""Packing by power-of-two decomposition.

A document of n tokens becomes pieces whose lengths are powers of two: full
sequences first, then the binary digits of the rest.  A piece is a sequence of
its own and sequences of one length form a bucket, so that batches need no
padding and no sequence crosses documents.  Nothing is shuffled.

Encoding: byte-level BPE never joins what lies on both sides of a step from a
non-space to a space, so texts are cut there and a bounded cache, keyed by the
bytes themselves, keeps the ids of cuttings.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import SpanCache, edges, slices, string_buffers, prepared_tasks, trimmed

SLICE = 1 << 21
_caches: dict[str, SpanCache] = {}


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def units(data: np.ndarray, offsets: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans that can be encoded apart, and their rows; together they are the rows' texts."""
    a, b = int(offsets[lo]), int(offsets[hi])
    raw = data[a:b]
    space = (raw == 0x20) | (raw == 0x0A) | (raw == 0x09) | (raw == 0x0D)
    before = np.zeros(len(raw), np.uint8)
    before[1:] = raw[:-1]
    lead = np.zeros(len(raw), np.uint8)
    lead[2:] = raw[:-2]
    # what stands before is surely no white space: ASCII beyond the blank, or a code point of two bytes from U+00C0 on
    cut = space & (((before > 0x20) & (before < 0x7F)) | ((before >= 0x80) & (lead >= 0xC3) & (lead <= 0xDF)))
    edge = offsets[lo:hi] - a
    cut[edge[(edge < len(raw)) & (offsets[lo + 1 : hi + 1] > offsets[lo:hi])]] = True
    starts = np.flatnonzero(cut) + a
    ends = np.append(starts[1:], b)
    return starts, ends, np.searchsorted(offsets[lo : hi + 1], starts, "right") - 1 + lo


def encoded(texts: pa.Array, path: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per slice of rows lo..hi: all token ids, and where each row's ids begin and end."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _caches:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        _caches[path] = SpanCache(lambda new: [e.ids for e in tokenizer.encode_batch_fast(new, add_special_tokens=False)])
    data, offsets = string_buffers(texts)
    for lo, hi in slices(offsets, SLICE):
        a, b = int(offsets[lo]), int(offsets[hi])
        own, local = np.append(data[a:b], np.zeros(16, np.uint8)), offsets[lo : hi + 1] - a
        starts, ends, rows = units(own, local, 0, hi - lo)
        ids, many = _caches[path].ids(own, starts, ends)
        yield lo, hi, ids, edges(rows, many, 0, hi - lo)


def lengths(n: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Full sequences, then the binary digits of the rest from the highest: the lengths of all pieces, and how many each document has."""
    digits = 1 << np.arange(longest.bit_length() - 2, -1, -1, dtype=np.int64)
    many = np.column_stack([n // longest, (n % longest)[:, None] & digits != 0])
    return np.repeat(np.tile(np.append(longest, digits), len(n)), many.ravel()), many.sum(1)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, longest: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece: id_col, start, length, ids (little-endian unsigned 32-bit), doc_tokens, bucket, sequence_id, offset.

    ``longest`` is a power of two.  Null text counts as empty; an empty text
    is one piece with ``end_id`` alone.  Repeated rows are packed each on its
    own.  Each sequence holds one piece, from offset 0, and has its length: a
    power of two, named by ``bucket`` (its exponent).  Other columns of
    ``docs`` are left out.  An empty table gives no pieces.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    prepared_tasks(docs.sparkSession)
    path = path or tokenizer_path()
    kind = docs.schema[id_col].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            for lo, hi, ids, edge in encoded(batch.column(1), path):
                own = np.insert(ids, edge[1:], np.uint32(end_id))  # documents with their end, one after the other
                total = np.diff(edge) + 1
                length, many = lengths(total, longest)
                until = np.cumsum(length)
                doc = np.repeat(np.arange(hi - lo), many)
                raw = pa.Array.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(np.append(0, until) * 4), pa.py_buffer(own)])
                start = until - length - (np.cumsum(total) - total)[doc]
                yield pa.record_batch([batch.column(0).take(pa.array(lo + doc)), pa.array(start), pa.array(length), raw.cast(pa.binary()), pa.array(total[doc])], [id_col, "start", "length", "ids", "doc_tokens"])

    out = docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(lambda batches: trimmed(pieces(batches)), f"`{id_col}` {kind}, start long, length long, ids binary, doc_tokens long")
    return out.withColumns({"bucket": F.log2("length").cast("int"), "sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def write_packed(packed: DataFrame, path: str) -> None:
    """One folder per sequence length, so that a reader forms batches of one length."""
    packed.write.partitionBy("bucket").parquet(path)
