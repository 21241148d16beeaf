"""Release packages of any size: one JSON document, read by as many tasks as Spark cuts its bytes into.

Spark's text reader takes the closing brace as the end of a line, so it splits a
file anywhere, through whatever file system it can open, and tells for each row
which byte range it came from.  A range always begins behind a brace, never
inside an escape.

Where in the document a range begins is found by a prefix sum.  What a range
does to that place depends on one bit only, whether it begins inside a string.
So the first pass notes for both cases: parity of quotes, change of depth,
lowest depth, which arrays opened near that depth.  These effects are summed
per file by a window over its ranges (one row each).  The second pass then
starts every range at its true place and cuts out the releases; those that lie
across ranges come as fragments, at most two a range, and are joined in a third.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.interim import stored
from ..shipping import ship

C = F.col
RELEASES = re.compile(rb'"releases"\s*:\s*\[')
_STEP = np.zeros(256, np.int8)
_STEP[[0x7B, 0x5B]] = 1
_STEP[[0x7D, 0x5D]] = -1
_EFFECT = ", ".join(f"d{s} int, m{s} int, f{s} array<boolean>, g{s} array<boolean>, c{s} array<int>" for s in (0, 1))


def chunks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows (value, file, block): the bytes between closing braces, in the order of each byte range."""
    text = spark.read.option("lineSep", "}").text(path)
    return text.select("value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def files_of(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows (file, path, source_file, length), one per file; contents are not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.xxhash64("_metadata.file_path").alias("file"), "path", F.substring_index("path", "/", -1).alias("source_file"), "length")


def structure(raw: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of quotes that are not escaped; of all brackets the place, the step, whether an odd number of quotes stands before, and whether it begins the array ``releases``.

    The key of an array and its bracket lie in one chunk.
    """
    quotes = np.flatnonzero(raw == 0x22)
    slashes = np.flatnonzero(raw == 0x5C)
    if len(slashes) and len(quotes):
        at = np.searchsorted(slashes, quotes) - 1  # the last backslash before each quote
        run = np.arange(len(slashes)) - np.maximum.accumulate(np.where(np.diff(slashes, prepend=-2) != 1, np.arange(len(slashes)), 0)) + 1
        escaped = (at >= 0) & (slashes[at] == quotes - 1) & (run[at] % 2 == 1)
        quotes = quotes[~escaped]
    step = _STEP[raw]
    at = np.flatnonzero(step)
    begins = np.isin(at, [m.end() - 1 for m in RELEASES.finditer(raw.tobytes())])
    return len(quotes), at, step[at].astype(np.int64), np.searchsorted(quotes, at) & 1, begins


class Effect:
    """What bytes do to the place in the document, if they begin outside or inside a string.

    For both: change of depth, lowest depth; for that depth and the two above
    it, whether the last bracket opened there begins ``releases``, whether any
    does, and how many close down to it.
    """

    def __init__(self, raw: np.ndarray):
        quotes, at, step, odd, begins = structure(raw)
        self.bytes, self.parity, self.cases = len(raw), quotes & 1, []
        for inside in (0, 1):
            own = odd == inside
            change, first = step[own], begins[own]
            depth = np.cumsum(change)
            low = min(0, int(depth.min(initial=0)))
            last, some, closed = {}, {}, {}
            for level in range(low, low + 3):
                hit = first[(change == 1) & (depth == level + 1)]
                if len(hit):
                    last[level], some[level] = bool(hit[-1]), bool(hit.any())
                closed[level] = int(((change == -1) & (depth == level)).sum())
            self.cases.append((int(change.sum()), low, last, some, closed))

    def then(self, later: Effect) -> Effect:
        """The effect of both, one behind the other."""
        out = object.__new__(Effect)
        out.bytes, out.parity, out.cases = self.bytes + later.bytes, self.parity ^ later.parity, []
        for inside in (0, 1):
            change, low, last, some, closed = self.cases[inside]
            change2, low2, last2, some2, closed2 = later.cases[inside ^ self.parity]
            lowest = min(low, change + low2)
            last2, some2 = ({change + k: v for k, v in x.items()} for x in (last2, some2))
            levels = range(lowest, lowest + 3)
            last = {k: v for k, v in (last | last2).items() if k in levels}
            some = {k: some.get(k, False) or some2.get(k, False) for k in levels if k in some or k in some2}
            out.cases.append((change + change2, lowest, last, some, {k: closed.get(k, 0) + closed2.get(k - change, 0) for k in levels}))
        return out

    def row(self) -> list:
        out = [self.bytes, self.parity]
        for change, low, last, some, closed in self.cases:
            out += [change, low, *[[x.get(low + k) for k in range(3)] for x in (last, some)], [closed[low + k] for k in range(2)]]
        return out


def runs(batch: pa.RecordBatch, keys: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows that share all key columns."""
    new = np.zeros(batch.num_rows, bool)
    new[:1] = True
    for k in keys:
        x = batch.column(k).to_numpy(zero_copy_only=False)
        new[1:] |= x[1:] != x[:-1]
    edges = [*np.flatnonzero(new).tolist(), batch.num_rows]
    yield from zip(edges, edges[1:])


def joined(values: pa.Array) -> np.ndarray:
    """The rows' bytes with their closing braces, one after the other."""
    values = values.fill_null("").cast(pa.large_binary())
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    out = np.full(int(offsets[-1] - offsets[0]) + len(values), 0x7D, np.uint8)
    if data is not None:
        own = np.ones(len(out), bool)
        own[offsets[1:] - offsets[0] + np.arange(len(values))] = False
        out[own] = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return out


def effects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per byte range with rows: file, block, and its effect."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, whole = None, None
        for batch in batches:
            for lo, hi in runs(batch, [1, 2]):
                own = Effect(joined(batch.column(0).slice(lo, hi - lo)))
                here = (batch.column(1)[lo].as_py(), batch.column(2)[lo].as_py())
                if here != key and key is not None:
                    yield shown(key, whole)
                    whole = None
                key, whole = here, own if whole is None else whole.then(own)
        if key is not None:
            yield shown(key, whole)

    names = ["file", "block", "n", "parity", *[f"{c}{k}" for k in (0, 1) for c in "dmfgc"]]
    kinds = [pa.int64()] * 3 + [pa.int32()] + [pa.int32(), pa.int32(), pa.list_(pa.bool_()), pa.list_(pa.bool_()), pa.list_(pa.int32())] * 2

    def shown(key, effect: Effect) -> pa.RecordBatch:
        return pa.record_batch([pa.array([v], t) for v, t in zip([*key, *effect.row()], kinds)], names)

    return chunks(spark, path).mapInArrow(measured, f"file long, block long, n long, parity int, {_EFFECT}")


def places(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Where each range begins (file, block, inside, depth, listed), and each file's kind (file, path, source_file, kind).

    Kinds: ``package``, ``bare`` (one value without releases), ``lines``
    (anything else: several values, or brackets or quotes that don't close).
    The effects are stored, a row a range, so that files are read for them once.
    """
    own = Window.partitionBy("file").orderBy("block")
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    e = stored(effects(spark, path), "effects").withColumn("inside", F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2)
    for c in "dmfgc":
        e = e.withColumn(c, F.when(C("inside") == 0, C(f"{c}0")).otherwise(C(f"{c}1")))
    e = e.withColumn("depth", F.coalesce(F.sum("d").over(before), F.lit(0)))
    low = C("depth") + C("m")  # -1 only by the brace that the last chunk of a file is given
    at_top = lambda c: F.when(low == 1, C(c)[0]).when(low == 0, C(c)[1]).when(low == -1, C(c)[2])
    e = e.withColumns({"opened": at_top("f"), "some": at_top("g")})
    e = e.withColumn("closes", F.when(low == 0, C("c")[0]).when(low == -1, C("c")[1]).otherwise(0))
    e = e.withColumn("listed", F.coalesce(F.last("opened", True).over(before), F.lit(False)))
    total = e.groupBy("file").agg(F.sum("n").alias("n"), (F.sum("parity") % 2).alias("parity"), F.sum("d").alias("depth"), F.sum("closes").alias("tops"), F.max("some").alias("package"), F.min(low).alias("low"))
    files = files_of(spark, path).join(total, "file", "left")
    packed = F.lower("source_file").rlike(r"\.(gz|bz2|deflate|lz4|snappy|zst)$")  # their length tells nothing
    given = F.when(packed, C("depth")).otherwise(F.when(C("n") > C("length"), -1).otherwise(0))
    # the brace given to the last chunk closes nothing: it stands outside, one level below the document
    closed = (C("parity") == 0) & (C("depth") == given) & (C("tops") == 1) & (C("low") >= given)
    kind = F.when(closed & C("package"), "package").when(closed, "bare").otherwise("lines")
    return e.select("file", "block", "inside", "depth", "listed"), files.select("file", "path", "source_file", kind.alias("kind"))


class Cutter:
    """Cuts the releases out of one range, batch by batch."""

    def __init__(self, inside: int, depth: int, listed: bool, level: int):
        self.inside, self.depth, self.listed, self.level = inside, depth, listed, level
        self.open = depth >= level and (listed or level == 1)
        self.part, self.held = 3, []  # begun in an earlier range

    def cut(self, raw: np.ndarray) -> list[tuple[int, bytes]]:
        """Releases that end here: (0, whole) or (2, what belongs to one begun in an earlier range)."""
        quotes, at, step, odd, begins = structure(raw)
        own = odd == self.inside
        at, step, begins = at[own], step[own], begins[own]
        depth = self.depth + np.cumsum(step)
        edge = ((depth == self.level) & (step == 1) & (raw[at] == 0x7B)) | ((depth == self.level - 1) & (step == -1) & (raw[at] == 0x7D))
        if self.level > 1:
            arrays = np.flatnonzero((depth == 2) & (step == 1))
            listed = np.append(self.listed, begins[arrays])
            edge &= listed[np.searchsorted(arrays, np.arange(len(at)), "right")]
            self.listed = bool(listed[-1])
        out, last = [], 0
        for k in np.flatnonzero(edge).tolist():
            if step[k] == 1:
                self.open, self.part, self.held, last = True, 0, [], int(at[k])
            elif self.open:
                self.held.append(raw[last : at[k] + 1].tobytes())
                out.append((0 if self.part == 0 else 2, b"".join(self.held)))
                self.open, self.held = False, []
        if self.open:
            self.held.append(raw[last:].tobytes())
        self.inside ^= quotes & 1
        self.depth += int(step.sum())
        return out

    def rest(self) -> list[tuple[int, bytes]]:
        """What the range's end leaves: (1, the beginning of a release) or (3, a range inside one release)."""
        return [(1 if self.part == 0 else 3, b"".join(self.held))] if self.open else []


def pieces(spark: SparkSession, path: str | list[str], at: DataFrame, files: DataFrame) -> DataFrame:
    """Rows (file, block, place, part, text) of all packages and bare values: whole releases and fragments.

    What a range needs to know is broadcast: about 40 bytes a range of
    ``spark.sql.files.maxPartitionBytes``, and rows must stay in their order.
    """
    start = at.join(files.filter(C("kind") != "lines").select("file", F.when(C("kind") == "package", 3).otherwise(1).alias("level")), "file")
    known = chunks(spark, path).join(F.broadcast(start), ["file", "block"]).select("value", "file", "block", "inside", "depth", "listed", "level")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, cutter, n = None, None, 0

        def shown(found):
            nonlocal n
            n += len(found)
            columns = [[key[0]] * len(found), [key[1]] * len(found), range(n - len(found), n), [p for p, _ in found], [t for _, t in found]]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "block", "place", "part", "text"])

        for batch in batches:
            for lo, hi in runs(batch, [1, 2]):
                here = tuple(batch.column(c)[lo].as_py() for c in (1, 2))
                if here != key:
                    if cutter:
                        yield shown(cutter.rest())
                    key, cutter, n = here, Cutter(*[batch.column(c)[lo].as_py() for c in range(3, 7)]), 0
                yield shown(cutter.cut(joined(batch.column(0).slice(lo, hi - lo))))
        if cutter:
            yield shown(cutter.rest())

    return known.mapInArrow(cut, "file long, block long, place long, part int, text binary")


def documents_of(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(source_file, kind, text) of every release of packages and bare values; and the table of files.

    Files are read twice, for the effects and for whole releases, and a third
    time for fragments where a file has several ranges.  A release is one row;
    a file is as many tasks as its ranges.
    """
    ship(spark)
    at, files = places(spark, path)
    text = pieces(spark, path, at, files).filter("part = 0").select("file", "text")
    several = at.groupBy("file").agg(F.count("*").alias("ranges")).filter("ranges > 1").select("file")
    if not several.isEmpty():
        parts = pieces(spark, path, at.join(several, "file"), files).filter("part > 0")
        parts = parts.withColumn("own", F.sum((C("part") == 1).cast("int")).over(Window.partitionBy("file").orderBy("block", "place")))
        glued = parts.groupBy("file", "own").agg(F.array_sort(F.collect_list(F.struct("block", "place", "text"))).alias("p"))
        text = text.unionByName(glued.select("file", F.aggregate("p", F.lit(b""), lambda x, p: F.concat(x, p["text"])).alias("text")))
    text = text.select("file", C("text").cast("string").alias("text"))
    return text.join(F.broadcast(files.select("file", "source_file", "kind")), "file").select("source_file", "kind", "text"), files
