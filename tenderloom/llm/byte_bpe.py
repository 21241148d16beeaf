"""Byte-level BPE by merge ranks, and back.

Pre-tokens start as their bytes, held as linked lists.  Every neighbouring pair
whose joint bytes have a rank waits in the bucket of that rank; a hierarchical
bitmap over the ranks (words of 64 bits, above them a bit for each word that is
not empty, and so on) gives the next rank by a find-first-set on each level, however
many positions wait.  Of one bucket the leftmost position comes first; an entry
whose pair has changed since is stale and skipped.  So n bytes cost about n
steps, which suits pre-tokens of millions of bytes.  Short ones are mostly found
in a bounded cache under their own bytes; those of a batch that are not share
one run of the queue, since lists don't touch.

Texts are split by classes of characters instead of a pattern: the pattern's
matches cover every character, and their borders follow from the classes of
neighbouring characters alone.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import SpanCache, edges, prepared_tasks, string_buffers, trimmed, windows

SLICE = 1 << 21
SLOTS = 1 << 20
LETTER, NUMBER, SPACE, OTHER = range(4)
# What an apostrophe joins to itself.
SHORTENED = ("s", "t", "re", "ve", "m", "ll", "d")
# Between an ASCII character that is no white space and a blank or line feed a pre-token ends, whatever stands around.
VISIBLE, GAP = np.zeros(256, bool), np.zeros(256, bool)
VISIBLE[0x21:0x7F] = GAP[[0x20, 0x0A]] = True


class RankQueue:
    """Positions by rank."""

    def __init__(self, ranks: int):
        self.levels: list[list[int]] = []  # from single ranks up to one word
        while ranks > 1 or not self.levels:
            ranks = -(-ranks // 64)
            self.levels.append([0] * ranks)
        self.buckets: dict[int, list[int]] = {}

    def open(self, rank: int, positions: list[int]) -> None:
        """A new bucket; its bit, and those above it up to a word that had one."""
        self.buckets[rank] = positions
        for words in self.levels:
            bit, rank = 1 << (rank & 63), rank >> 6
            had = words[rank]
            words[rank] = had | bit
            if had:
                return

    def take(self) -> tuple[int, list[int]] | None:
        """The least rank with all its positions from left to right, or None; the bucket is closed."""
        at = 0
        for words in reversed(self.levels):
            word = words[at]
            if not word:
                return None
            at = at << 6 | (word & -word).bit_length() - 1
        rank = at
        for words in self.levels:
            at, bit = at >> 6, 1 << (at & 63)
            words[at] ^= bit
            if words[at]:
                break
        positions = self.buckets.pop(rank)
        positions.sort()
        return rank, positions


class RankCache(SpanCache):
    """A vocabulary: ids of pre-tokens by the queue, those seen before from the cache."""

    def __init__(self, ranks: dict[bytes, int], slots: int = SLOTS):
        super().__init__(None, slots)
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        self.ranks, most = ranks, max(ranks.values()) + 1
        self.bytes_of: list[bytes | None] = [None] * most
        for raw, i in ranks.items():
            self.bytes_of[i] = raw
        self.first = np.array([ranks[bytes([b])] for b in range(256)])
        self.pairs = np.array([ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)])
        self.queue = RankQueue(most)

    def fresh(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all spans, and how many each has: a span with a rank is that, another what is left when no pair has one."""
        size = ends - starts
        if not len(size):
            return np.zeros(0, np.uint32), size
        raw = b"".join([data[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())])
        begin = np.cumsum(size) - size
        ids, alive = self.merged(np.frombuffer(raw, np.uint8), begin, begin + size)
        many = np.add.reduceat(alive, begin, dtype=np.int64)
        get, whole = self.ranks.get, []
        for k, a, b in zip(range(len(size)), begin.tolist(), (begin + size).tolist()):
            if many[k] > 1 and (rank := get(raw[a:b])) is not None:  # no merges lead there
                whole.append(a)
                ids[a], alive[a], alive[a + 1 : b], many[k] = rank, True, False, 1
        return ids[alive].astype(np.uint32), many

    def merged(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids by position and which positions are left, once no pair inside [begin, end) has a rank."""
        n, rank_of, bytes_of, queue = len(data), self.ranks.get, self.bytes_of, self.queue
        pair = np.full(n, -1)
        pair[:-1] = self.pairs[data[:-1].astype(np.int64) << 8 | data[1:]]
        pair[end - 1] = -1
        order = np.flatnonzero(pair >= 0)
        order = order[np.argsort(pair[order], kind="stable")]
        kinds, first = np.unique(pair[order], return_index=True)
        for rank, positions in zip(kinds.tolist(), np.split(order, first[1:])):
            queue.open(rank, positions.tolist())
        following, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        following[end - 1], before[begin] = -1, -1
        following, before, waits = following.tolist(), before.tolist(), pair.tolist()
        ids, gone, buckets, open_ = self.first[data].tolist(), bytearray(n), queue.buckets, queue.open
        while (least := queue.take()) is not None:
            rank, positions = least
            own, lower = bytes_of[rank], False
            for k, i in enumerate(positions):
                if waits[i] != rank:
                    continue
                j, h = following[i], before[i]
                after = following[j]
                ids[i], following[i], waits[j], gone[j] = rank, after, -1, 1
                new = -1
                if after >= 0:
                    before[after] = i
                    new = rank_of(own + bytes_of[ids[after]], -1)
                    if new >= 0:
                        if new in buckets:
                            buckets[new].append(i)
                        else:
                            open_(new, [i])
                            lower = new < rank
                waits[i] = new
                if h >= 0:
                    waits[h] = new = rank_of(bytes_of[ids[h]] + own, -1)
                    if new >= 0:
                        if new in buckets:
                            buckets[new].append(h)
                        else:
                            open_(new, [h])
                            lower = lower or new < rank
                if lower:  # a lower rank has come up: it is next
                    if k + 1 < len(positions):
                        open_(rank, positions[k + 1 :])
                    break
        return np.array(ids), np.frombuffer(gone, np.uint8) == 0


@functools.cache
def classes() -> np.ndarray:
    """Letter, number, white space or other, by code point."""
    import regex

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\p{White_Space}")):
        out[np.frombuffer("".join(regex.findall(f"{pattern}+", every)).encode("utf-32-le"), np.uint32)] = kind
    return out


def pre_tokens(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of the rows begin (byte positions); ``offsets`` are the rows' bounds, from 0 to len(data).

    Runs of letters, of numbers, of others; a blank before a run belongs to it.
    Of white space before a run the last character stands alone or, if it is a
    blank, begins the run; the rest of it, and white space at a text's end, is
    one pre-token.  Shortened words split off where an apostrophe begins a run.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    lead = np.flatnonzero(data & 0xC0 != 0x80)
    code = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    kind = classes()[code]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    edge = edge[lead]  # first characters of rows
    last = np.append(edge[1:], True)
    start = edge.copy()
    start[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    tail = space & ~last  # the last white space before a run
    tail[:-1] &= ~space[1:]
    tail[-1] = False
    blank = tail & (code == 0x20)
    start |= tail
    after = np.flatnonzero(blank) + 1
    start[after] = False
    quote = np.flatnonzero(start & (code == 0x27))
    if len(quote):
        padded = np.append(code, [0, 0]).astype(np.int64)
        row = np.append(np.cumsum(edge), [-1, -1])
        one, two = (np.where(row[quote + k] == row[quote], padded[quote + k], 0) for k in (1, 2))
        for text in SHORTENED:
            hit = (one == ord(text[0])) & ((two == ord(text[1])) if len(text) > 1 else True)
            stop = quote[hit] + 1 + len(text)
            start[quote[hit] + 1] = False
            start[stop[stop < len(start)]] = True
    return lead[start]


_vocabularies: dict[str, RankCache] = {}


def vocabulary(path: str) -> RankCache:
    """The vocabulary of a rank file (base64 bytes and rank per line); one per worker."""
    if path not in _vocabularies:
        with open(path, "rb") as f:
            _vocabularies[path] = RankCache({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})
    return _vocabularies[path]


def encoded(texts: pa.Array, ranks: RankCache, limit: int = SLICE) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts in order, and how many each has."""
    data, offsets = string_buffers(texts)
    bounds, own = windows(data, offsets, VISIBLE, GAP, limit)
    lo, parts, many = 0, [], [np.zeros(1, np.int64)]
    while lo < len(bounds) - 1:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + limit, "right")) - 1)
        a, b = int(bounds[lo]), int(bounds[hi])
        raw, local = np.append(data[a:b], np.zeros(16, np.uint8)), bounds[lo : hi + 1] - a
        starts = pre_tokens(raw[: b - a], local)
        ids, size = ranks.ids(raw, starts, np.append(starts[1:], b - a))
        rows = np.searchsorted(local, starts, "right") - 1
        parts.append(ids)
        many.append(np.diff(edges(rows, size, 0, hi - lo)))
        lo = hi
    until = np.cumsum(np.concatenate(many))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32), np.diff(until[own])


def vocabulary_path(name: str = "byte_bpe_multi_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_ranks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """One row per row of ``docs``: id_col, n_tokens, ids (little-endian unsigned 32-bit).

    Pre-tokens are the matches of ``public_tokenizers.PATTERN``, each encoded
    separately; there are no special tokens: their strings are ordinary text.
    Of pairs with equal ranks the leftmost is merged first.  Null and empty
    texts have no ids.  Repeated rows are encoded each; other columns are
    ignored; an empty table gives an empty result.  Very long texts are taken
    in windows, a very long pre-token as a whole, in time about in proportion to
    its length.  ``path`` is read where tasks run.  No shuffle.
    """
    prepared_tasks(docs.sparkSession)
    path = path or vocabulary_path()
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = vocabulary(path)
        for batch in batches:
            if batch.num_rows:
                ids, many = encoded(batch.column(1), ranks)
                raw = pa.Array.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer(np.append(0, np.cumsum(many)) * 4), pa.py_buffer(ids.astype("<u4"))])
                yield pa.record_batch([batch.column(0), pa.array(many), raw.cast(pa.binary())], [id_col, "n_tokens", "ids"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(lambda batches: trimmed(rows(batches)), f"`{id_col}` {kind}, n_tokens long, ids binary")


def decode_ranks(encoded: DataFrame, path: str | None = None, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the bytes that the ids stand for; null ids give null, an unknown id is an error."""
    prepared_tasks(encoded.sparkSession)
    path = path or vocabulary_path()

    @F.pandas_udf("binary")
    def bytes_of(column):
        table = vocabulary(path).bytes_of
        return column.map(lambda raw: b"".join([table[i] for i in np.frombuffer(raw, "<u4").tolist()]), na_action="ignore")

    return encoded.withColumn("decoded", bytes_of(F.col(ids_col)))
