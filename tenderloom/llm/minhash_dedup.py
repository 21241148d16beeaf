"""MinHash near-dedup by a signature-coordinate inverted join.

A signature has ``COORDINATES`` values, each formed from ``MINIMA`` minima of
the shingle set, so two sets of similarity s agree in one with s**MINIMA.
Documents are posted under each coordinate-value pair.  Candidates must agree
in ``MATCHES`` coordinates at least: at s = 0.8 all but 1.3e-4 of pairs do, and
above s = 0.85 all but 1e-6.  Hence the first COORDINATES - MATCHES + 1
coordinates suffice for posting (prefix), and collisions are counted by merging
a document's sorted lists, the longest of which are only probed (skip).
Candidates are confirmed on full sets.

What keeps the work in proportion to the documents:

* equal sets are one node, named by their smallest id;
* a list is first compared with one member only, its leader (two rounds with
  leaders drawn anew); the links found are merged into components;
* a list whose members are all in one component is skipped; in the others only
  pairs of different components are counted, each pair in the first list that
  both are in, and only those whose sketches (``SKETCH`` more minima, a byte
  each) agree in SKETCH_MATCHES places go on: at s = 0.8 all but 3e-5 do, at
  s = 0.7 one in 4000 does;
* a list of more than ``BLOCK`` members is dealt to cells of two blocks each.
  Counting inside such a list is quadratic in its open members, but what it
  emits is not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import BASES, HOT_KEYS, cut, lookup, mix, powers, slices, stored, string_buffers, prepared_tasks, trimmed, word_hashes, words

COORDINATES, MINIMA, MATCHES = 20, 3, 3
SKETCH, SKETCH_MATCHES = 1024, 768  # 0.8 * 1024 less four deviations
BLOCK = 2000
LEADER_ROUNDS = 2

_multipliers = mix(np.arange(1, COORDINATES * MINIMA + SKETCH + 1, dtype=np.uint64) * np.uint64(BASES[0])) | np.uint64(1)


def shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """Per slice of rows lo..hi: of each row the ascending distinct hashes of its shingles."""
    data, offsets = string_buffers(texts)
    weight = powers(BASES[1], width + 1)
    for lo, hi in slices(offsets):
        starts, ends, rows = words(data, offsets, lo, hi)
        token = word_hashes(data, starts, ends, lower=True)
        n = max(0, len(token) - width + 1)
        value = np.zeros(n, np.uint64)
        for j in range(width):
            value += token[j : j + n] * weight[j]
        value = mix(value + np.uint64(width))
        limits = np.searchsorted(rows, np.arange(lo, hi + 1)).tolist()
        sets = []
        for a, b in zip(limits, limits[1:]):
            if b - a >= width:
                s = np.sort(value[a : b - width + 1])
                sets.append(s[np.append(True, s[1:] != s[:-1])])
            elif b > a:
                sets.append(mix((token[a:b] * weight[: b - a]).sum(keepdims=True, dtype=np.uint64) + np.uint64(b - a)))
            else:
                sets.append(np.zeros(0, np.uint64))
        yield lo, hi, sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Rows of COORDINATES non-negative longs; the coordinate's number is part of the value.  No set is empty."""
    flat = np.concatenate(sets)
    begin = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    out = np.empty((len(sets), COORDINATES), np.uint64)
    for c in range(COORDINATES):
        value = np.full(len(sets), c, np.uint64)
        for m in range(MINIMA):
            value = mix(value + np.minimum.reduceat(flat * _multipliers[c * MINIMA + m], begin))
        out[:, c] = value
    return (out >> np.uint64(1)).astype(np.int64)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Rows of SKETCH bytes, each a byte of a minimum.  No set is empty."""
    flat = np.concatenate(sets)
    begin = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    out = np.empty((len(sets), SKETCH), np.uint8)
    for k in range(SKETCH):
        out[:, k] = mix(np.minimum.reduceat(flat * _multipliers[COORDINATES * MINIMA + k], begin)) & np.uint64(255)
    return out


def postings(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per coordinate (column) the places sorted by its value, and where the list of each place's own value begins and ends there."""
    order = np.argsort(code, 0, kind="stable")
    ranked = np.take_along_axis(code, order, 0)
    new = np.ones(code.shape, bool)
    new[1:] = ranked[1:] != ranked[:-1]
    at = np.arange(len(code))[:, None]
    start = np.maximum.accumulate(np.where(new, at, 0), 0)
    last = np.ones(code.shape, bool)
    last[:-1] = new[1:]
    end = np.minimum.accumulate(np.where(last, at + 1, len(code))[::-1], 0)[::-1]
    begin, until = np.empty_like(start), np.empty_like(end)
    np.put_along_axis(begin, order, start, 0)
    np.put_along_axis(until, order, end, 0)
    return order, begin, until


def collisions(lists: list[np.ndarray], least: int) -> np.ndarray:
    """The places that at least ``least`` of the ascending lists hold, by skip merging.

    The least - 1 longest lists are set aside: what they alone hold can't
    reach the threshold.  The others are merged and counted; only what that
    leaves is looked up in the long ones, by binary search, longest last.
    """
    lists = sorted(lists, key=len)
    aside = max(0, least - 1)
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
    found, count = np.unique(np.concatenate(short), return_counts=True) if short else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    for k, one in enumerate(long):
        open_ = count + len(long) - k >= least  # still within reach
        found, count = found[open_], count[open_]
        at = np.minimum(np.searchsorted(one, found), len(one) - 1)
        count = count + (one[at] == found)
    return found[count >= least]


def cell_pairs(pos: int, side: np.ndarray, component: np.ndarray, n: np.ndarray, code: np.ndarray, sketch: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Candidate pairs (places) of one cell of a list: in different components, first together in this list, alike enough."""
    inside = not side.any()
    kinds, which = np.unique(component, return_inverse=True)
    if len(kinds) < 2 or pos + MATCHES > COORDINATES:
        return []
    usual = which == np.bincount(which).argmax()
    # all agree in coordinate pos; MATCHES - 1 further agreements come after it
    order, begin, until = postings(code[:, pos + 1 :])
    out = []
    left = np.flatnonzero(~usual) if inside else np.flatnonzero(side == 0)
    for i in left.tolist():
        b = collisions([order[x:y, c] for c, (x, y) in enumerate(zip(begin[i].tolist(), until[i].tolist()))], MATCHES - 1)
        keep = (which[b] != which[i]) & ((usual[b] | (b > i)) if inside else (side[b] == 1))
        keep &= np.minimum(n[b], n[i]) * 100 >= np.maximum(n[b], n[i]) * percent
        b = b[keep]
        if len(b):
            b = b[(code[b, :pos] != code[i, :pos]).all(1)]
            b = b[(sketch[b] == sketch[i]).sum(1) >= SKETCH_MATCHES]
            out += [(i, j) for j in b.tolist()]
    return out


def linked(a: Column, b: Column, percent: int) -> Column:
    """100 * intersection >= percent * union, on full sets."""
    common = F.size(F.array_intersect(a, b)).cast("long")
    return common * 100 >= (F.size(a) + F.size(b) - common) * percent


def minhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: id_col, n_shingles, component_id, kept.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z.  A document's set
    holds its distinct runs of ``shingle_words`` words; with fewer words, all
    of them as one; null, empty and blank texts have an empty set and no link.
    Two documents are linked if 100 * intersection >= percent * union;
    component_id is the smallest id reachable.  kept: id = component_id.  Ids
    are longs >= 0 (a negative one is an error); rows with one id are one node, and a row without id has no
    component, and is kept.  Other columns are ignored; an empty table gives
    an empty result.
    """
    spark = docs.sparkSession
    prepared_tasks(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            if pc.min(batch.column(0)).as_py() is not None and pc.min(batch.column(0)).as_py() < 0:
                raise ValueError("ids must not be negative")
            for lo, hi, sets in shingle_sets(batch.column(1), shingle_words):
                some = [i for i, s in enumerate(sets) if len(s)]
                codes = signatures([sets[i] for i in some]) if some else np.zeros((0, COORDINATES), np.int64)
                lists = iter(codes.tolist())
                yield pa.record_batch(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                        pa.array([next(lists) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    ["id", "n", "set", "code"],
                )

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for lo, hi, sets in shingle_sets(batch.column(1), shingle_words):
                    edge = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                    values = np.concatenate(sets).view(np.int64)
                    yield pa.record_batch([batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(values))], ["id", "items"])

    signs = stored(docs.mapInArrow(lambda batches: trimmed(signed(batches)), "id long, n long, set binary, code array<long>"), "signatures")
    some = signs.filter("n > 0 and id is not null")
    nodes = cut(some.groupBy("set").agg(F.count("*").alias("rows"), F.min("id").alias("node"), F.first("n").alias("n"), F.first("code").alias("code")))

    # lists of two and more, under the prefix
    posts = nodes.select("node", "n", "code", F.posexplode(F.slice("code", 1, COORDINATES - MATCHES + 1)).alias("pos", "key"))
    shared = posts.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    posts = cut(lookup(posts, "key", shared, "members", max(1000, nodes.count() * (COORDINATES - MATCHES + 1) // HOT_KEYS), "node").filter("members > 1"))

    wanted = posts.select(F.col("node").alias("id")).distinct()
    sets = stored(docs.join(wanted, "id", "left_semi").mapInArrow(lambda batches: trimmed(full(batches)), "id long, items array<long>"), "sets")

    def sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                items = batch.column(1)
                edge, flat = items.offsets.to_numpy(), items.values.to_numpy().view(np.uint64)
                for lo in range(0, batch.num_rows, 1000):
                    some = [flat[a:b] for a, b in zip(edge[lo : lo + 1000], edge[lo + 1 : lo + 1001])]
                    keep = [k for k, x in enumerate(some) if len(x)]
                    if keep:
                        rows = sketches([some[k] for k in keep])
                        yield pa.record_batch([batch.column(0).take(pa.array([lo + k for k in keep])), pa.array([r.tobytes() for r in rows], pa.binary())], ["node", "sketch"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell; a cell may go on in the next batch."""
        held: list[pa.RecordBatch] = []

        def cells_of(table: pa.Table, last: bool):
            key = np.stack([table.column(c).to_numpy() for c in ("key", "i", "j")], 1)
            turn = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            edge = [0, *turn.tolist(), len(key)]
            node, n, component, side, pos = (table.column(c).to_numpy() for c in ("node", "n", "component", "side", "pos"))
            code = table.column("code").combine_chunks()
            code = (code.flatten() if isinstance(code, pa.Array) else pa.concat_arrays([c.flatten() for c in code.chunks])).to_numpy().reshape(len(key), COORDINATES)
            sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(key), SKETCH)
            end = len(edge) - 1 if last else len(edge) - 2
            found = []
            for a, b in zip(edge[:end], edge[1:]):
                if b - a > 1:
                    found += [(node[a + x], node[a + y]) for x, y in cell_pairs(int(pos[a]), side[a:b], component[a:b], n[a:b], code[a:b], sketch[a:b], percent)]
            return found, table.slice(edge[end])

        def out(found):
            return pa.record_batch([pa.array([min(x) for x in found], pa.int64()), pa.array([max(x) for x in found], pa.int64())], ["a", "b"])

        for batch in batches:
            if batch.num_rows:
                found, rest = cells_of(pa.Table.from_batches([*held, batch]), False)
                held = rest.to_batches()
                yield out(found)
        if held:
            yield out(cells_of(pa.Table.from_batches(held), True)[0])

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Of distinct candidate pairs a, b those that are linked."""
        one, two = (sets.select(F.col("id").alias(x), F.col("items").alias(f"items_{x}")) for x in "ab")
        pairs = pairs.join(one, "a").join(two, "b")
        return cut(pairs.filter(linked(F.col("items_a"), F.col("items_b"), percent)).select("a", "b"))

    def ordered(a: str, b: str) -> list[Column]:
        return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]

    # each list against its leader
    n_posts = posts.count()
    pairs = None
    for turn in range(LEADER_ROUNDS):
        first = F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", "n", "code"))
        leader = posts.groupBy("key").agg(F.count("*").alias("rows"), first.alias("leader"))
        star = lookup(posts, "key", leader, "rows", max(1000, n_posts // HOT_KEYS), "node").filter("node <> leader.node")
        alike = (F.least("n", "leader.n") * 100 >= F.greatest("n", "leader.n") * percent) & (F.size(F.array_intersect("code", "leader.code")) >= MATCHES)
        star = star.filter(alike).select(*ordered("node", "leader.node"))
        pairs = star if pairs is None else pairs.unionByName(star)
    edges = confirmed(pairs.distinct())
    found = cut(components(edges))

    # pairs between components, in lists that are still open
    open_ = posts.join(found.withColumnRenamed("id", "node"), "node", "left").select("key", "pos", "node", "n", "code", F.coalesce("component", "node").alias("component"))
    state = open_.groupBy("key").agg(F.count("*").alias("rows"), F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    open_ = cut(lookup(open_, "key", state, "rows", max(1000, n_posts // HOT_KEYS), "node").filter("rows is not null").select("key", "pos", "node", "n", "code", "component", "rows"))
    sketched = stored(sets.join(open_.select(F.col("node").alias("id")).distinct(), "id", "left_semi").mapInArrow(lambda batches: trimmed(sketch_rows(batches)), "node long, sketch binary"), "sketches")
    parts = F.ceil(F.col("rows") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node", F.lit(7)), parts).cast("int")
    cells = open_.withColumns({"block": block, "other": F.explode(F.sequence(F.lit(0), parts - 1))})
    cells = cells.select("key", "pos", "node", "n", "code", "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), F.when(F.col("block") > F.col("other"), 1).otherwise(0).alias("side"))
    cells = cells.join(sketched, "node")
    cells = cells.repartition(prepared_tasks(spark), "key", "i", "j").sortWithinPartitions("key", "i", "j").select("key", "i", "j", "pos", "node", "n", "component", "side", "code", "sketch")
    more = cells.mapInArrow(lambda batches: trimmed(counted(batches)), "a long, b long")
    edges = edges.unionByName(confirmed(more))

    # sets of one id are one node; then from nodes to all rows with that set
    same = some.select("set", "id").distinct()
    twice = same.groupBy("id").agg(F.count("*").alias("k")).filter("k > 1").select("id")
    named = cut(nodes.select("set", "node", "rows"))
    ties = same.join(twice, "id", "left_semi").join(named, "set").select(*ordered("id", "node"))
    found = components(edges.unionByName(ties)).withColumnRenamed("id", "node")
    named = named.join(found, "node", "left").select(F.col("set").alias("set"), "rows", F.coalesce("component", "node").alias("component_id"))
    # sets that very many rows share come by broadcast, HOT_KEYS at most; such rows are then dealt by their id
    hot = named.filter(F.col("rows") >= max(1000, signs.count() // HOT_KEYS)).select(F.col("set").alias("hot_set"), F.col("component_id").alias("hot_component"))
    rows = signs.join(F.broadcast(hot), F.col("set") == F.col("hot_set"), "left")
    cold = named.select(F.col("set").alias("cold_set"), F.col("component_id").alias("cold_component"))
    rows = rows.withColumn("deal", F.when(F.col("hot_set").isNull() & F.col("set").isNotNull(), F.col("set")).otherwise(F.concat(F.lit("-").cast("binary"), F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary"))))
    rows = rows.join(cold, F.col("deal") == F.col("cold_set"), "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("hot_component", "cold_component", "id"))
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each group the document with the smallest id.

    Rows of one id are one document and stay or go together; rows without an id stay.
    """
    gone = minhash_dedup(docs, id_col, text_col, **options).filter("not kept").select(F.col(id_col).alias("_gone"))
    return docs.join(gone, F.col(id_col) == F.col("_gone"), "left_anti")
