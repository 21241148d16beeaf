"""Phrase mining: ids ranked by frequency, pairs counted in tiles, frequent pairs ranked again.

Texts become blocks of word sequences.  A block knows its own distinct words;
their counts are summed by parts of all words, and each block is told which of
its words are frequent, with their ids and frequencies.  It ranks those by
frequency.  A pair of neighbouring ranks is a cell of a matrix that is cut into
square tiles: the few tiles where frequent ranks meet are dense and counted by
``bincount``, what falls into the others as sorted coordinates.  A block sends
each cell once, sorted and packed, to the part of its hash, where the sorted
lists of all blocks are merged; so no pair is hot.  Frequent pairs get ids in
turn and take the place of the words: two neighbouring pairs that overlap are a
phrase of three words, two of those a phrase of four.  A phrase can only be
frequent if both halves are, so sequences thin out from level to level.

No table of all words or pairs is ever in one place: blocks get by a join what
they have themselves.
"""

from __future__ import annotations

import contextlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import BASES, LOWER, SHORT, lookup, mix, prepared_tasks, short_keys, slices, stored, string_buffers, trim, windows, words

BLOCK = 8 << 20  # bytes of text
BAND = 1024  # ids along a side of a tile
DENSE = BAND * BAND // 8  # pairs from which a tile is counted cell by cell
PART_BYTES = 8 << 20  # of text, about a million words, whose words or pairs meet in one part
BLOCKS_AT_ONCE = 4  # in one Arrow batch

# What ends a piece, and what stands between words.
BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
BETWEEN = BREAK.copy()
BETWEEN[[0x20, 0x09]] = True
ANY = np.ones(256, bool)


def shut(*columns: np.ndarray, text: bytes = b"") -> bytes:
    """Numbers of equal count by byte planes, the higher of which are mostly zero, and bytes; compressed."""
    planes = [np.ascontiguousarray(np.asarray(x, "<i8").view(np.uint8).reshape(-1, 8).T).tobytes() for x in columns]
    raw = b"".join([*planes, text])
    return len(columns[0]).to_bytes(8, "little") + len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def opened(raw: bytes, columns: int) -> tuple[list[np.ndarray], bytes]:
    n, size = int.from_bytes(raw[:8], "little"), int.from_bytes(raw[8:16], "little")
    plain = pa.decompress(raw[16:], decompressed_size=size, codec="zstd", asbytes=True)
    planes = np.frombuffer(plain, np.uint8, 8 * n * columns).reshape(columns, 8, n)
    return [np.ascontiguousarray(x.T).view("<i8").ravel() for x in planes], plain[8 * n * columns :]


def shut_sequence(sequence: np.ndarray, many: np.ndarray) -> bytes:
    """A sequence of numbers (-1 between pieces) by their ranks, which are small for frequent ones, and the numbers by rank."""
    order = np.argsort(-many, kind="stable")
    rank = np.zeros(len(many) + 1, np.int64)  # the last place is what -1 reads
    rank[order] = np.arange(1, len(many) + 1)
    ranks = shut(rank[sequence])
    return len(ranks).to_bytes(8, "little") + ranks + shut(order)


def opened_sequence(raw: bytes) -> np.ndarray:
    n = 8 + int.from_bytes(raw[:8], "little")
    return np.append(-1, opened(raw[n:], 1)[0][0])[opened(raw[8:n], 1)[0][0]]


def distinct(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of byte spans: the place of one of each kind, each span's kind, and the kinds' counts.  Bytes decide; ``raw`` has 16 more than the spans reach."""
    size = ends - starts
    low, high = short_keys(raw, starts, np.minimum(size, SHORT))
    long, seen = np.flatnonzero(size > SHORT), {}
    for i, a, b in zip(long.tolist(), starts[long].tolist(), ends[long].tolist()):
        low[i] = seen.setdefault(raw[a:b].tobytes(), len(seen))
    high[long] = np.uint64(0xFF << 56)
    _, first, kind, many = np.unique(mix(low ^ high * np.uint64(BASES[0])), return_index=True, return_inverse=True, return_counts=True)
    if (low[first[kind]] != low).any() or (high[first[kind]] != high).any():  # two kinds of one hash
        _, first, kind, many = np.unique(np.stack([high, low], 1), axis=0, return_index=True, return_inverse=True, return_counts=True)
    return first, kind.ravel(), many


def block_of(data: np.ndarray, bounds: np.ndarray, parts: int = 1, seed: int = 0) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """Lower-cased words of rows as numbers with -1 between pieces; the words in the order of their parts, their counts and parts."""
    a, b = int(bounds[0]), int(bounds[-1])
    raw = np.append(LOWER[data[a:b]], np.zeros(16, np.uint8))
    starts, ends, rows = words(raw[: b - a], bounds - a, 0, len(bounds) - 1, BETWEEN)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, [], none, none
    first, kind, many = distinct(raw, starts, ends)
    own = [raw[x:y].tobytes() for x, y in zip(starts[first].tolist(), ends[first].tolist())]
    part = np.fromiter((zlib.crc32(w, seed) % parts for w in own), np.int64, len(own))
    order = np.array(sorted(range(len(own)), key=lambda k: (part[k], own[k])), np.int64)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    piece = np.cumsum(BREAK[raw[: b - a]], dtype=np.int32)[starts]
    parted = np.append(False, (piece[1:] != piece[:-1]) | (rows[1:] != rows[:-1]))
    sequence = np.full(len(starts) + int(parted.sum()), -1, np.int64)
    sequence[np.arange(len(starts)) + np.cumsum(parted)] = place[kind]
    return sequence, [own[k] for k in order.tolist()], many[order], part[order]


def by_part(part: np.ndarray) -> list[tuple[int, int, int]]:
    """(part, from, to) of an ascending column of parts."""
    edges = np.flatnonzero(np.diff(part, prepend=-1))
    return list(zip(part[edges].tolist(), edges.tolist(), [*edges[1:].tolist(), len(part)]))


def pair_cells(x: np.ndarray, y: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of ids below m: both ids, the count, and the number of each given pair among them."""
    bands = -(-m // BAND)
    tile = (x // BAND) * bands + y // BAND
    kinds, load = np.unique(tile, return_counts=True)
    index, left, right, many, done = np.empty(len(x), np.int64), [], [], [], 0
    rest = np.ones(len(x), bool)
    for t in kinds[load >= DENSE].tolist():
        own = np.flatnonzero(tile == t)
        rest[own] = False
        cell = (x[own] % BAND) * BAND + y[own] % BAND
        count = np.bincount(cell, minlength=BAND * BAND)
        held = np.flatnonzero(count)
        index[own] = (done + np.cumsum(count > 0) - 1)[cell]
        left.append(t // bands * BAND + held // BAND)
        right.append(t % bands * BAND + held % BAND)
        many.append(count[held])
        done += len(held)
    own = np.flatnonzero(rest)
    cell, inverse, count = np.unique(x[own] * m + y[own], return_inverse=True, return_counts=True)
    index[own] = done + inverse
    return np.concatenate([*left, cell // m]), np.concatenate([*right, cell % m]), np.concatenate([*many, count]), index


def next_block(sequence: np.ndarray, at: np.ndarray, ids: np.ndarray, frequency: np.ndarray, parts: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """From a block's sequence and its frequent numbers, their ids and magnitudes: the sequence of pairs, and the pairs (both ids, count, part) by part and ids."""
    order = np.lexsort((ids, -frequency))  # the most frequent first, so that they share tiles
    own = np.full(int(sequence.max(initial=-1)) + 2, -1, np.int64)  # the last place is what -1 reads
    own[at[order]] = np.arange(len(order))
    s = own[sequence]
    first = np.flatnonzero((s[:-1] >= 0) & (s[1:] >= 0))
    if not len(first):
        return (np.zeros(0, np.int64),) * 5
    a, b, many, index = pair_cells(s[first], s[first + 1], len(order))
    ids = ids[order]
    a, b = ids[a], ids[b]
    part = (mix(a.astype(np.uint64) * np.uint64(BASES[0]) ^ mix(b.astype(np.uint64))) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((b, a, part))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    parted = np.append(False, np.diff(first) > 1)
    out = np.full(len(first) + int(parted.sum()), -1, np.int64)
    out[np.arange(len(first)) + np.cumsum(parted)] = place[index]
    return out, a[order], b[order], many[order], part[order]


@contextlib.contextmanager
def few_rows(spark: SparkSession, rows: int):
    """Arrow batches of few rows while something is written: blocks are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


_CELLS = pa.list_(pa.struct([("part", pa.int32()), ("start", pa.int64()), ("cells", pa.binary())]))
CELLS = "cells array<struct<part:int,start:long,cells:binary>>"


def word_blocks(docs: DataFrame, text_col: str, lang_col: str, parts: int, block: int = BLOCK) -> DataFrame:
    """Rows (block, lang, words, sequence, cells): texts of one language, about ``block`` bytes at most; the distinct words and their counts by part."""

    def rows_of(texts: pa.Table, fresh) -> Iterator[pa.RecordBatch]:
        for lang in pc.unique(texts.column(1)).to_pylist():
            data, offsets = string_buffers(texts.filter(pc.equal(texts.column(1), lang)).column(0))
            bounds, _ = windows(data, offsets, BREAK, ANY, block)
            for lo, hi in slices(bounds, block):
                sequence, own, many, part = block_of(data, bounds[lo : hi + 1], parts, zlib.crc32(lang.encode()))
                if len(own):
                    cells = [{"part": p, "start": x, "cells": shut(many[x:y], text=b"\n".join(own[x:y]))} for p, x, y in by_part(part)]
                    yield pa.record_batch([pa.array([next(fresh)]), pa.array([lang]), pa.array([int(many.sum())]), pa.array([shut_sequence(sequence, many)]), pa.array([cells], _CELLS)], ["block", "lang", "words", "sequence", "cells"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh = iter(range(TaskContext.get().partitionId() << 32, 1 << 62))
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column(0).nbytes
            if size >= block:
                yield from rows_of(pa.Table.from_batches(held), fresh)
                held, size = [], 0
        if held:
            yield from rows_of(pa.Table.from_batches(held), fresh)
        trim()

    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang")
    out = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), lang)
    return out.mapInArrow(blocks, f"block long, lang string, words long, sequence binary, {CELLS}")


def pair_blocks(blocks: DataFrame, answers: DataFrame, parts: int, last: bool) -> DataFrame:
    """Rows (block, sequence, cells) of the blocks that have answers (block, answers); the last level needs no sequence."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                at, ids, frequency = (np.concatenate(x) for x in zip(*[told(x, parts) for x in batch.column(2)[k].as_py()]))
                sequence, a, b, many, part = next_block(opened_sequence(batch.column(1)[k].as_py()), at, ids, frequency, parts)
                if len(a):
                    cells = [{"part": p, "start": x, "cells": shut(np.diff(a[x:y], prepend=0), b[x:y], many[x:y])} for p, x, y in by_part(part)]
                    yield pa.record_batch([batch.column(0).slice(k, 1), pa.array([b"" if last else shut_sequence(sequence, many)]), pa.array([cells], _CELLS)], ["block", "sequence", "cells"])
        trim()

    joined = blocks.select("block", "sequence").join(answers, "block").select("block", "sequence", "answers")
    return joined.mapInArrow(pairs, f"block long, sequence binary, {CELLS}")


def tell(at: np.ndarray, number: np.ndarray, frequency: np.ndarray, part: int) -> bytes:
    """Ascending places and numbers inside a part, by their steps; of frequencies the binary magnitude is enough to rank by."""
    size = np.frexp(frequency.astype(float))[1]
    return shut(np.diff(at, prepend=0), np.diff(number, prepend=0), size, text=part.to_bytes(8, "little"))


def told(raw: bytes, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, ids and magnitudes of ``tell``."""
    (at, number, size), part = opened(raw, 3)
    return np.cumsum(at), np.cumsum(number) * parts + int.from_bytes(part, "little"), size


FOUND = "block long, answer binary, lang array<string>, phrase array<string>, a array<long>, b array<long>, f array<long>, id array<long>"
_FOUND = [pa.int64(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.string()), *[pa.list_(pa.int64())] * 4]


def frequent(blocks: DataFrame, least: int, parts: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Sums of the blocks' cells by part: what each block is told (block, answers: see ``tell``), and the frequent words or pairs.

    A part holds about ``PART_BYTES`` of text's cells, each block's at most
    once.  ids are numbers below the number of frequent ones, but for uneven
    parts.
    """
    with_words = "lang" in blocks.columns

    def merged(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        sizes, many, keys = [], [], []
        for raw, lang in zip(table.column("cells").to_pylist(), table.column("lang").to_pylist()):
            columns, text = opened(raw, 1 if with_words else 3)
            sizes.append(len(columns[0]))
            many.append(columns[-1])
            keys.append(pa.array([f"{lang}\n{w}" for w in text.decode().split("\n")]) if with_words else (np.cumsum(columns[0]), columns[1]))
        many = np.concatenate(many)
        if with_words:
            coded = pa.chunked_array(keys).combine_chunks().dictionary_encode()
            kind, kinds = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        else:
            a, b = (np.concatenate(x) for x in zip(*keys))
            order = np.lexsort((b, a))
            new = np.append(True, (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0))
            kind = np.empty(len(order), np.int64)
            kind[order] = np.cumsum(new) - 1
            heads = order[new]
        total = np.zeros(int(kind.max()) + 1, np.int64)
        np.add.at(total, kind, many)
        hot = np.flatnonzero(total >= least)
        if with_words:  # in the order in which blocks list them
            hot = np.array(sorted(hot.tolist(), key=kinds.__getitem__), np.int64)
        number = np.full(len(total), -1, np.int64)
        number[hot] = np.arange(len(hot))
        rows, lo = [], 0
        for block, start, n in zip(table.column("block").to_pylist(), table.column("start").to_pylist(), sizes):
            own = kind[lo : lo + n]
            held = np.flatnonzero(number[own] >= 0)
            lo += n
            if len(held):
                rows.append((block, tell(start + held, number[own[held]], total[own[held]], part), *[None] * 6))
        if len(hot):
            named = [x.rsplit("\n", 1) for x in (kinds[k] for k in hot.tolist())] if with_words else []
            found = [[x for x, _ in named], [x for _, x in named], None, None] if with_words else [None, None, a[heads[hot]], b[heads[hot]]]
            rows.append((None, None, *found, total[hot], number[hot] * parts + part))
        trim()
        columns = zip(*rows) if rows else [[]] * len(_FOUND)
        return pa.table([pa.array(list(c), t) for c, t in zip(columns, _FOUND)], [x.split()[0] for x in FOUND.split(", ")])

    lang = F.col("lang") if with_words else F.lit(None).cast("string").alias("lang")
    dealt = blocks.select("block", lang, F.explode("cells").alias("z")).select("block", "lang", "z.part", "z.start", "z.cells")
    found = stored(dealt.groupBy("part").applyInArrow(merged, FOUND), name)
    answers = found.filter(F.col("block").isNotNull()).groupBy("block").agg(F.collect_list("answer").alias("answers"))
    columns = ["lang", "phrase", "f", "id"] if with_words else ["a", "b", "f", "id"]
    heads = found.filter(F.col("block").isNull()).select(F.explode(F.arrays_zip(*columns)).alias("z")).select("z.*")
    return answers, heads


def with_parts(pairs: DataFrame, parts: DataFrame, side: str, names: dict[str, str]) -> DataFrame:
    """Pairs with columns of the part on one side; a part that very many pairs share is broadcast."""
    rows = pairs.groupBy(F.col(side).alias("id")).agg(F.count("*").alias("_rows"))
    counted = parts.join(rows, "id").select(F.col("id").alias("_id"), "_rows", *[F.col(c).alias(n) for c, n in names.items()])
    hot = max(1, pairs.count() // 64)
    return lookup(pairs.withColumn("_id", F.col(side)), "_id", counted, "_rows", hot, "id").drop("_id", "_rows")


def candidates(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30, most_words: int = 4) -> DataFrame:
    """All frequent phrases of 2 to ``most_words`` words, one row each: lang, phrase, words, a, l, r, cut, score, n, within.

    Everything is counted per language, null counts as ``und``.  a is the
    number of the phrase's occurrences inside pieces, n that of all words; l
    and r are those of its two parts at the cut of the lowest score
    floor(2000000 a / (l + r)), ties to the shortest first part.  ``within``
    is the largest count of a longer frequent phrase around it, or null.

    Null and empty texts have no words; repeated rows count each; other
    columns are ignored; an empty table has no phrases.  Long texts are cut
    between pieces; a long piece or word is taken whole.
    """
    spark = docs.sparkSession
    tasks = prepared_tasks(spark)
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    parts = max(tasks, math.ceil(size / PART_BYTES))
    blocks = stored(word_blocks(docs, text_col, lang_col, parts), "word-blocks")
    totals = blocks.groupBy("lang").agg(F.sum("words").alias("n"))
    answers, found = frequent(blocks, least, parts, "words")
    level = found.select("id", "lang", "phrase", F.col("phrase").alias("tail"), "f", F.array("f").alias("heads"), F.array("f").alias("tails"))
    levels = []
    for k in range(2, most_words + 1):
        with few_rows(spark, BLOCKS_AT_ONCE):
            blocks = stored(pair_blocks(blocks, answers, parts, k == most_words), f"blocks-{k}")
        answers, pairs = frequent(blocks, least, parts, f"pairs-{k}")
        inner = pairs.select(F.col("a").alias("id"), "f").unionByName(pairs.select(F.col("b").alias("id"), "f")).groupBy("id").agg(F.max("f").alias("within"))
        if k > 2:
            levels.append(level.join(inner, "id", "left"))
        out = with_parts(pairs, level, "a", {"lang": "lang", "phrase": "_front", "heads": "_heads"})
        out = with_parts(out, level, "b", {"tail": "_tail", "tails": "_tails"})
        phrase = F.concat_ws(" ", "_front", F.col("_tail"))
        level = stored(out.select("id", "lang", phrase.alias("phrase"), F.col("_tail").alias("tail"), "f", *[F.concat(F.col(f"_{c}"), F.array("f")).alias(c) for c in ("heads", "tails")]), f"level-{k}")
    levels.append(level.withColumn("within", F.lit(None).cast("long")))
    return with_scores(levels).join(totals, "lang")


def with_scores(levels: list[DataFrame]) -> DataFrame:
    """Phrases of 2 words, of 3, ... with their worst cut, in exact decimals."""
    out = None
    for k, level in enumerate(levels, 2):
        score = "(CAST(2000000 AS DECIMAL(19,0)) * CAST(f AS DECIMAL(19,0))) div (CAST(heads[{0}] AS DECIMAL(19,0)) + CAST(tails[{1}] AS DECIMAL(19,0)))"
        cuts = [F.struct(F.expr(score.format(c - 1, k - c - 1)).cast("long").alias("score"), F.lit(c).alias("cut"), F.col("heads")[c - 1].alias("l"), F.col("tails")[k - c - 1].alias("r")) for c in range(1, k)]
        own = level.select("lang", "phrase", F.lit(k).alias("words"), F.col("f").alias("a"), F.array_min(F.array(*cuts)).alias("_c"), "within")
        out = own if out is None else out.unionByName(own)
    return out.select("lang", "phrase", "words", "a", "_c.l", "_c.r", "_c.cut", "_c.score", "within")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30, most_words: int = 4, top: int = 2000, within_percent: int = 80) -> DataFrame:
    """The first ``top`` phrases of each language by score, count and phrase: lang, rank, phrase, a, l, r, n, score.

    Phrases inside a longer frequent one that is nearly as frequent
    (``within_percent``) are left out.  See ``candidates`` for nulls, ties,
    repeated rows and empty tables.
    """
    out = candidates(docs, text_col, lang_col, least, most_words)
    inside = F.col("within").cast("decimal(19,0)") * 100 >= F.col("a").cast("decimal(19,0)") * within_percent
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = out.filter(~F.coalesce(inside, F.lit(False))).withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
