"""What several operators of this subpackage need: word spans, hashing, tables in the shared folder."""

from __future__ import annotations

import ctypes
import hashlib
import itertools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import shared_root, ship

# Word separators of the contracts: blank and \x09-\x0D.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

BATCH_ROWS = 1000

# Odd multipliers, modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on uint64, so that every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept and grown by doubling."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1024, 1 << (max(1, n) - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if size > 1 << 22:  # an odd very long text; not worth keeping
            return have
        _powers[base] = have
    return have


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls count as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data, offsets


def slices(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``limit`` bytes each, one row at least."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def windows(data: np.ndarray, offsets: np.ndarray, before: np.ndarray, behind: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows' bounds with further ones inside rows of more than ``limit`` bytes, and which of the bounds are the rows' own.

    A further bound lies where the tables (by byte) allow the byte before it
    and the one behind; a row without such a place stays whole.
    """
    more, long = [], np.flatnonzero(np.diff(offsets) > limit)
    for a, b in zip(offsets[long].tolist(), offsets[long + 1].tolist()):
        at = a + limit
        while at < b:
            part = data[at - 1 : min(b, at + (1 << 16))]
            near = np.flatnonzero(before[part[:-1]] & behind[part[1:]])
            if len(near):
                more.append(at + int(near[0]))
                at = more[-1] + limit
            else:
                at += 1 << 16
    every = np.concatenate([offsets, np.array(more, np.int64)])
    order = np.argsort(every, kind="stable")
    return every[order], np.argsort(order, kind="stable")[: len(offsets)]


def words(data: np.ndarray, offsets: np.ndarray, lo: int, hi: int, separator: np.ndarray = SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (in ``data``) and row of every word of rows lo..hi."""
    a, b = int(offsets[lo]), int(offsets[hi])
    if a == b:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~separator[data[a:b]]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edge = offsets[lo:hi][offsets[lo:hi] < b] - a
    start[edge] = inside[edge]
    edge = offsets[lo + 1 : hi + 1][offsets[lo + 1 : hi + 1] > a] - a - 1
    end[edge] = inside[edge]
    starts = np.flatnonzero(start) + a
    ends = np.flatnonzero(end) + (a + 1)
    rows = np.searchsorted(offsets[lo : hi + 1], starts, "right") - 1 + lo
    return starts, ends, rows


SHORT = 15  # bytes that fit two machine words beside their number
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def short_keys(data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of up to ``SHORT`` bytes as two words that hold the bytes and their number: equal words mean equal bytes.

    ``data`` has 16 bytes more than the spans reach.
    """
    eights = np.lib.stride_tricks.as_strided(data[:8].view(np.uint64), (len(data) - 7,), (1,))
    low = eights[starts] & _LOW_BYTES[np.minimum(size, 8)]
    high = eights[starts + 8] & _LOW_BYTES[np.maximum(size - 8, 0)]
    return low, high | size.astype(np.uint64) << np.uint64(56)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0, lower: bool = False) -> np.ndarray:
    """A hash of each byte span: two rounds of ``mix`` over the bytes themselves, a keyed BLAKE2 of long spans.

    No polynomial: those give one value to some pairs of long words, whatever
    the base.  Spans are ascending and disjoint.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    a, b = int(starts[0]), int(ends[-1])
    raw = np.zeros(b - a + 16, np.uint8)
    raw[: b - a] = LOWER[data[a:b]] if lower else data[a:b]
    starts, size = starts - a, ends - starts
    low, high = short_keys(raw, starts, np.minimum(size, SHORT))
    out = mix(mix(low + np.uint64(BASES[0] + seed & MASK)) ^ (high + np.uint64(BASES[1] - seed)) * np.uint64(BASES[1]))
    long = np.flatnonzero(size > SHORT)
    key = seed.to_bytes(8, "little") + b"tenderloom"
    for i, x, y in zip(long.tolist(), starts[long].tolist(), (starts + size)[long].tolist()):
        out[i] = int.from_bytes(hashlib.blake2b(raw[x:y], digest_size=8, key=key).digest(), "little")
    return out


def window_hashes(tokens: np.ndarray, rows: np.ndarray, width: int, base: int) -> np.ndarray:
    """Rolling (Rabin-Karp) hashes of all runs of ``width`` tokens, from prefix sums; the caller drops runs that cross rows."""
    n = len(tokens)
    if n < width:
        return np.zeros(0, np.uint64)
    inverse = pow(base, -1, 1 << 64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(tokens * powers(base, n)[:n], out=total[1:])
    return mix((total[width:] - total[:-width]) * powers(inverse, n)[: n - width + 1])


class SpanCache:
    """Ids of byte spans; a span is encoded again only when it has left the cache.

    Short spans lie in a table of ``slots`` places under their own bytes, a
    newcomer in place of the one before, so that frequent ones are mostly
    there.  Long spans are encoded once a call.  Bytes decide in both cases.
    encode: list of strings to list of lists of ids, at most one a byte.
    """

    def __init__(self, encode, slots: int = 1 << 19):
        self.encode, self.shift = encode, np.uint64(64 - (slots.bit_length() - 1))
        self.low, self.high = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64)
        self.begin, self.size = np.zeros(slots, np.int32), np.zeros(slots, np.uint8)  # SHORT ids at most
        self.flat, self.used = np.empty((SHORT + 1) * slots, np.uint32), 0

    def fresh(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        got = self.encode([data[a:b].tobytes().decode() for a, b in zip(starts.tolist(), ends.tolist())])
        size = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(itertools.chain.from_iterable(got), np.uint32, int(size.sum())), size

    def tidy(self) -> None:
        """Drop the ids that no place holds any more, once they fill most of the room."""
        if self.used > len(self.flat) * 3 // 4:
            live = np.flatnonzero(self.size)
            size = self.size[live].astype(np.int64)
            flat = expand(self.flat, self.begin[live].astype(np.int64), size)
            self.begin[live], self.used = np.cumsum(size) - size, len(flat)
            self.flat[: self.used] = flat

    def ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the spans in order, and how many each has; ``data`` has 16 bytes more than the spans reach."""
        self.tidy()
        size, n = ends - starts, len(starts)
        begin, many = np.zeros(n, np.int64), np.zeros(n, np.int64)
        short = np.flatnonzero((size <= SHORT) & (size > 0))
        low, high = short_keys(data, starts[short], size[short])
        slot = mix(low ^ high * np.uint64(BASES[0])) >> self.shift
        slot = slot.astype(np.int64)
        hit = (self.low[slot] == low) & (self.high[slot] == high)
        begin[short[hit]], many[short[hit]] = self.begin[slot[hit]], self.size[slot[hit]]
        miss = np.flatnonzero(~hit)
        order = miss[np.lexsort((low[miss], high[miss]))]
        head = np.ones(len(order), bool)
        head[1:] = (low[order[1:]] != low[order[:-1]]) | (high[order[1:]] != high[order[:-1]])
        kinds = order[head]
        new, sizes = self.fresh(data, starts[short[kinds]], ends[short[kinds]])
        base = np.cumsum(sizes) - sizes
        which = np.cumsum(head) - 1
        begin[short[order]], many[short[order]] = self.used + base[which], sizes[which]
        extra = []
        long = np.flatnonzero(size > SHORT)
        if len(long):
            seen: dict[bytes, int] = {}
            own = np.array([seen.setdefault(data[a:b].tobytes(), len(seen)) for a, b in zip(starts[long].tolist(), ends[long].tolist())])
            _, first = np.unique(own, return_index=True)
            ids, counts = self.fresh(data, starts[long[first]], ends[long[first]])
            begin[long], many[long] = self.used + len(new) + (np.cumsum(counts) - counts)[own], counts[own]
            extra = [ids]
        if extra or self.used + len(new) > len(self.flat):
            out = expand(np.concatenate([self.flat[: self.used], new, *extra]), begin, many)
        if self.used + len(new) <= len(self.flat):
            self.flat[self.used : self.used + len(new)] = new
            if not extra:
                out = expand(self.flat, begin, many)
            at = slot[kinds]
            self.low[at], self.high[at] = low[kinds], high[kinds]
            # of several newcomers for one place the last stays in all four columns
            self.begin[at], self.size[at] = self.used + base, sizes
            self.used += len(new)
        return out, many


def expand(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """flat[begin : begin + size] of all spans, one after the other."""
    until = np.cumsum(size)
    return flat[np.arange(until[-1] if len(until) else 0) + np.repeat(begin - (until - size), size)]


def edges(rows: np.ndarray, many: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Where the ids of rows lo..hi begin, and where the last end, from each span's row and number of ids."""
    return np.append(0, np.cumsum(many))[np.searchsorted(rows, np.arange(lo, hi + 1))]


def trim() -> None:
    """Give freed memory back to the system: workers live on between stages, and an executor has several."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, and ``trim`` after the last."""
    yield from batches
    trim()


_stored: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share."""
    folder = shared_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage, survives lost executors.  See ``sweep``."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{name}-{uuid.uuid4().hex}"
    _stored.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession, keep: list[DataFrame] = []) -> int:  # noqa: B006
    """Delete the interim tables that operators of this process have written, but those that frames in ``keep`` read.

    A result reads interim tables until it is written: call this after that.
    Returns how many went.
    """
    files = {f for df in keep for f in df.inputFiles()}
    gone = [p for p in _stored if not any(f"/{p.rsplit('/', 1)[1]}/" in f for f in files)]
    for path in gone:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        _stored.remove(path)
    return len(gone)


def cut(df: DataFrame) -> DataFrame:
    """A small interim table.  Not checkpoint(): its result carries the constraints of all plans before, which grow from round to round."""
    return stored(df, "cut")


def prepared_tasks(spark: SparkSession) -> int:
    """Prepare the session for Python tasks; its shuffle partitions.

    Workers can import this package from then on, and Arrow batches of the
    session hold ``BATCH_ROWS`` rows at most (it stays so: results are lazy):
    texts are large, and a worker holds some copies of a batch.
    """
    ship(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


#: Most rows that a lookup may send to every executor (each a key and a few numbers).
HOT_KEYS = 64


def lookup(left: DataFrame, key: str, counted: DataFrame, rows: str, hot_from: int, unique: str) -> DataFrame:
    """left joined with one row per key of ``counted``, safe for keys that hold a large share of left.

    ``counted`` has the key, a long column ``rows`` (how many rows of left have
    it) and further columns.  Keys with at least ``hot_from`` rows - at most
    total / hot_from of them, a proven bound - are broadcast; all others join
    through a shuffle.  ``unique`` names a long column of left that spreads
    the rows that already found their match.
    """
    extra = [c for c in counted.columns if c != key]
    hot = counted.filter(F.col(rows) >= hot_from).select(F.col(key).alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in extra])
    cold = counted.filter(F.col(rows) < hot_from).select(F.col(key).alias("_cold"), *[F.col(c).alias(f"_cold_{c}") for c in extra])
    out = left.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
    # keys are never negative, so what is already matched meets nothing and is dealt evenly
    out = out.withColumn("_deal", F.when(F.col("_hot").isNull(), F.col(key)).otherwise(-1 - F.abs(F.xxhash64(unique)) % (1 << 40)))
    out = out.join(cold, F.col("_deal") == F.col("_cold"), "left")
    return out.select(*left.columns, *[F.coalesce(f"_hot_{c}", f"_cold_{c}").alias(c) for c in extra])
