"""Fuzzy names: each rare name to the most similar frequent one.

Similarity is a weighted ratio over longest common subsequences: the full
ratio, the best-window ratio and the ratios of sorted and of shared words,
each scaled by how far the lengths differ.  Candidates share a key with the
name (blocking).  The keys lose no pair that a full scan finds: each way in
which two names can reach the threshold leaves something rare in common, which
``weighted_pairs`` and ``gram_keys`` derive.  The names of a common key are dealt
over a grid of cells.  Where one side has few names, all pairs are bounded
instead, a batch of the other side at a time (``few_best``).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R
from ..shipping import ship
from .interim import stored

C = F.col
#: About so many names a side meet in one cell of a block; a block with more is dealt over several cells.
CELL = 256
#: Thresholds that are tried before a lower one; the word and part keys of these say most.
STEPS = (95, 90)
#: So many names on one side at most meet all of the other side without keys: the work grows with the other side alone.
FEW = 10_000
#: From this threshold on a much longer text must hold the shorter one whole.
WHOLE = 90


def comparable(c: Column) -> Column:
    """Lower case without company forms, punctuation and spare blanks."""
    forms = "|".join(s.replace(".", r"\.") for s in sorted(R.SUFFIXES, key=len, reverse=True))
    t = F.regexp_replace(F.lower(F.trim(c)), rf"\s+(?:{forms})(?=\s|$)", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"[.,;:\-_'\"()\[\]{}]", " "), r"\s+", " "))


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit vectors."""
    if not a or not b:
        return 0
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & places.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    return 200.0 * common_length(a, b) / (len(a) + len(b)) if a or b else 100.0


def window_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter text against a part of the longer one of its length."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 0.0
    return max(ratio(a, b[max(0, i) : i + len(a)]) for i in range(1 - len(a), len(b)))


def words_ratio(a: str, b: str, compare=ratio) -> float:
    """The better of comparing sorted words, and shared words against each side's words."""
    x, y = sorted(a.split()), sorted(b.split())
    shared = sorted({*x} & {*y})
    left, right = sorted({*x} - {*shared}), sorted({*y} - {*shared})
    if shared and (not left or not right):
        return 100.0
    if shared and compare is window_ratio:  # the shared words are a part of either side
        return 100.0
    base, one, two = " ".join(shared), " ".join(shared + left), " ".join(shared + right)
    best = max(compare(" ".join(x), " ".join(y)), compare(one, two))
    return max(best, compare(base, one), compare(base, two)) if shared else best


def weighted_ratio(a: str, b: str, least: float = 0.0) -> float:
    """The weighted ratio; 0 as soon as a bound shows that it is under ``least``."""
    if not a or not b:
        return 0.0
    if least and most_ratio(a, b) < least - 1e-6:
        return 0.0
    far = max(len(a), len(b)) / min(len(a), len(b))
    best = ratio(a, b)
    if far < 1.5:
        return max(best, words_ratio(a, b) * 0.95)
    scale = 0.9 if far <= 8 else 0.6
    return max(best, window_ratio(a, b) * scale, words_ratio(a, b, window_ratio) * 0.95 * scale)


@lru_cache(1 << 12)
def parts_of(a: str) -> tuple[Counter, frozenset[str], bool]:
    """Characters, words, and whether a word comes twice or spare blanks do."""
    words = frozenset(a.split())
    return Counter(a), words, sum(map(len, words)) + len(words) - 1 != len(a)


def most_ratio(a: str, b: str) -> float:
    """A bound of the weighted ratio from lengths, characters in common and shared words.

    A common subsequence has no more characters than the texts have in common.
    Of the texts that words_ratio compares, the shared words are a prefix of
    the others, so their ratio follows from lengths.
    """
    small, large = sorted((len(a), len(b)))
    (chars, words, again), (c_chars, c_words, c_again) = parts_of(a), parts_of(b)
    shared = words & c_words
    if large / small >= 1.5:
        if shared or again or c_again:
            return 100.0
        common = (chars & c_chars).total()
        scale = 0.9 if large / small <= 8 else 0.6
        return max(200.0 * small / (small + large), 200.0 * common / (small + common) * scale)
    if again or c_again:
        return 100.0
    best = 0.0
    if shared:
        if len(shared) in (len(words), len(c_words)):
            return 100.0
        base = sum(map(len, shared)) + len(shared) - 1
        best = 95.0 * 2 * base / (base + small)
    full = 200.0 * small / (small + large)
    return max(best, 200.0 * (chars & c_chars).total() / (small + large) if full > best else full)


def similarity(least: float = 0.0):
    """The weighted ratio as a column function; 0 where it is under ``least``."""

    @F.pandas_udf(T.DoubleType())
    def similarity_(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([weighted_ratio(x, y, least) for x, y in zip(a, b)], dtype=float)

    return similarity_


def levenshtein_ratio(a: Column, b: Column) -> Column:
    """100 * (1 - distance / longer length): the form SQL can check."""
    return F.round(100.0 * (1 - F.levenshtein(a, b) / F.greatest(F.char_length(a), F.char_length(b), F.lit(1))), 4)


def meetings(left: DataFrame, right: DataFrame, near: Column | None = None) -> DataFrame:
    """Pairs of left (name, keys, size) and right (candidate, c_keys, c_size) that share a key, once for each; ``near`` may ask for both sizes.

    A row per key carries its hash (equal hashes of other keys only add pairs),
    the name and its size, nothing else.  The names of a frequent key are dealt
    over rows of cells, its candidates over columns, and each side goes to all
    cells of its row or column, so that no task holds a whole common key.
    """
    spark = left.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    hashed = lambda c: F.explode(F.array_distinct(F.transform(c, lambda k: F.xxhash64(k)))).alias("key")
    x, y = left.select("name", "size", hashed("keys")), right.select("candidate", "c_size", hashed("c_keys"))
    sizes = x.groupBy("key").agg(F.count("*").alias("k")).join(y.groupBy("key").agg(F.count("*").alias("c_k")), "key")
    grid = sizes.filter((C("k") > CELL) | (C("c_k") > CELL)).select("key", F.ceil(C("k") / CELL).alias("rows"), F.ceil(C("c_k") / CELL).alias("columns"))
    part = lambda c, of: F.coalesce(F.pmod(F.xxhash64(c), C(of)), F.lit(0))
    every = lambda of: F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(C(of), F.lit(1)) - 1))
    x = x.join(grid, "key", "left").withColumns({"_i": part("name", "rows"), "_j": every("columns")}).drop("rows", "columns")
    y = y.join(grid, "key", "left").withColumns({"_j": part("candidate", "columns"), "_i": every("rows")}).drop("rows", "columns")
    pairs = x.repartition(n, "key", "_i", "_j").join(y.repartition(n, "key", "_i", "_j"), ["key", "_i", "_j"])
    return (pairs if near is None else pairs.filter(near)).select("name", "candidate")


def block_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of left (name, keys, ...) and right (candidate, c_keys, ...) that share a key, each once, see ``meetings``."""
    spark = left.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    met = meetings(left.select("name", "keys", F.lit(0).alias("size")), right.select("candidate", "c_keys", F.lit(0).alias("c_size")))
    return met.repartition(n, "name", "candidate").distinct().join(left.drop("keys"), "name").join(right.drop("c_keys"), "candidate")


def gram_keys(names: DataFrame, norm: str, threshold: float) -> DataFrame:
    """``names`` with ``keys``: any two whose Levenshtein ratio reaches the threshold share one (threshold above 50).

    With L the longer length, at most (1 - threshold) * L edits lie between
    them, each of which touches two of the L - 1 places of letter pairs, so
    that some places with the same pairs survive.  The rarest of those pairs
    comes first on both sides: a name needs only its rarest pairs, until fewer
    places are left than must survive.  Where none must (short names), single
    letters are keys too, and all pairs are.
    """
    if threshold <= 50:
        raise ValueError("below half of the letters in common, no letter pair need survive")
    edits = 1 - threshold / 100
    length = F.char_length(norm)
    survive = F.ceil(length * (1 - 2 * edits) - 1 - 1e-9)
    places = F.when(length > 1, F.transform(F.sequence(F.lit(1), length - 1), lambda i: F.substring(C(norm), i, F.lit(2)))).otherwise(F.array().cast("array<string>"))
    one = names.select("name", norm, F.explode(places).alias("gram"), survive.alias("survive")).groupBy("name", norm, "gram", "survive").agg(F.count("*").alias("k"))
    frequency = one.groupBy("gram").agg(F.count("*").alias("f"))
    w = Window.partitionBy("name").orderBy(F.desc("f"), F.desc("gram"))  # a name's letter pairs
    one = one.join(frequency, "gram").withColumn("left", F.sum("k").over(w))
    pairs = one.filter(C("left") >= C("survive")).groupBy("name").agg(F.collect_set("gram").alias("pairs"))
    letters = F.when(survive <= 0, F.transform(F.split(C(norm), ""), lambda x: F.concat(F.lit("."), x))).otherwise(F.array().cast("array<string>"))
    keys = F.array_distinct(F.concat(F.coalesce("pairs", F.array().cast("array<string>")), letters))
    return names.join(pairs, "name", "left").withColumn("keys", keys).drop("pairs")


PART = 4  # letters of a part of the shorter name that must lie in the longer one


def _length(c: str) -> Column:
    return F.char_length(c)


def _grams(text: Column, n: int) -> Column:
    """All runs of n characters."""
    return F.when(F.char_length(text) >= n, F.transform(F.sequence(F.lit(1), F.char_length(text) - (n - 1)), lambda i: F.substring(text, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def _inside_words(words: Column, n: int) -> Column:
    return F.flatten(F.transform(words, lambda x: _grams(x, n)))


def _rarest(items: DataFrame, item: str, weight: str, spared: Column, by: list[str]) -> DataFrame:
    """``by`` and ``own``: of each row's items the rarest, but for so many frequent ones as weigh less than ``spared``.

    Frequency is the number of rows with an item, and of equally frequent ones
    the greater goes first, alike in all rows.
    """
    frequency = items.groupBy(item).agg(F.count("*").alias("_f"))
    w = Window.partitionBy(*by).orderBy(F.desc("_f"), F.desc(item))
    kept = items.join(frequency, item).withColumn("_until", F.sum(weight).over(w)).filter(C("_until") >= spared)
    return kept.groupBy(*by).agg(F.collect_set(item).alias("own"))


def _chosen(items: str, n: int) -> Column:
    """Hashes of all choices of n of an array's items, in their order."""
    if n == 1:
        return F.transform(C(items), lambda x: F.xxhash64(x))
    behind = lambda i: F.filter(F.transform(C(items), lambda y, j: F.when(j > i, F.struct(j.alias("j"), y.alias("y")))), lambda z: z.isNotNull())
    if n == 2:
        return F.flatten(F.transform(C(items), lambda x, i: F.transform(behind(i), lambda z: F.xxhash64(x, z["y"]))))
    return F.flatten(F.transform(C(items), lambda x, i: F.flatten(F.transform(behind(i), lambda z: F.transform(behind(z["j"]), lambda u: F.xxhash64(x, z["y"], u["y"]))))))


def order_keys(names: DataFrame, threshold: float) -> DataFrame:
    """(name, norm, side) with ``keys``: pairs whose texts reach the threshold as a whole, in whatever order of words, share one.

    With lengths a and b and a common subsequence of l letters, a - l letters
    of the first go and b - l come in.  One that goes touches two letter pairs,
    one that comes in parts one; pairs inside words don't depend on the words'
    order.  l >= (a + b) * threshold / 200, so a bounded part of a's pairs
    goes, whatever b is, and the rest is in common.  The rarest m of what is in
    common are among each side's rarest pairs, but for so many frequent ones as
    must be in common beyond m; every choice of m of those is a key.  Names
    whose bound leaves less than m have single pairs as keys as well, and with
    so short words that none need be left, their length.
    """
    t = threshold / 200
    m = 3 if threshold >= 93 else 2
    least, most = t / (1 - t), (1 - t) / t
    lost = (2 - 3 * t) + least * (1 - 3 * t)
    none = F.array().cast("array<string>")
    words = F.split("form", " ")
    forms = names.select("name", "norm", "side", F.explode(F.array_distinct(F.array("norm", F.array_join(F.array_distinct(F.split("norm", " ")), " ")))).alias("form"))
    forms = forms.withColumn("pairs", _inside_words(words, 2)).withColumn("left", F.ceil(F.size("pairs") - _length("form") * lost - 1e-9))
    one = forms.select("name", "form", "left", F.size("pairs").alias("all"), F.explode("pairs").alias("gram")).groupBy("name", "form", "left", "all", "gram").agg(F.count("*").alias("k"))
    one = one.select("name", "form", "left", "all", F.explode(F.transform(F.sequence(F.lit(1).cast("long"), C("k")), lambda i: F.concat(C("gram"), i.cast("string")))).alias("item"))
    own = one.join(one.groupBy("item").agg(F.count("*").alias("f")), "item").groupBy("name", "form", "left", "all").agg(F.sort_array(F.collect_list(F.struct("f", "item"))).alias("own"))
    first = lambda k: F.slice("own", F.lit(1), F.greatest(F.lit(1), F.least(C("all"), C("all") - C("left") + k)).cast("int"))["item"]
    own = own.select("name", "form", first(m).alias("several"), F.when(C("left") < m, first(1)).alias("single"))
    own = own.select("name", "form", F.concat(_chosen("several", m), F.coalesce(_chosen("single", 1), F.array().cast("array<long>"))).alias("own"))
    out = forms.join(own, ["name", "form"], "left")
    band = lambda n: F.floor(F.log(n) / F.log(F.lit(most)) + 1e-9)
    near = F.when(C("side") == 0, F.array(band(_length("form")))).otherwise(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda i: band(_length("form")) + i))
    # names without pairs that must be left: by length, against all names of the other side
    span = F.sequence(F.ceil(_length("form") * least - 1e-9), F.floor(_length("form") * most + 1e-9))
    tags = [F.when(C("side") == 0, F.lit(x)).otherwise(F.lit(y)) for x, y in (("s", "t"), ("t", "s"))]
    short = F.when(C("left") <= 0, F.transform(span, lambda n: F.concat(tags[0], n.cast("string")))).otherwise(none)
    by_length = F.transform(F.concat(short, F.array(F.concat(tags[1], _length("form").cast("string")))), lambda k: F.xxhash64(k))
    by_pairs = F.flatten(F.transform(near, lambda b: F.transform(F.coalesce("own", F.array().cast("array<long>")), lambda g: F.xxhash64(b, g))))
    return out.withColumn("keys", F.concat(by_pairs, by_length)).groupBy("name", "norm", "side").agg(F.array_distinct(F.flatten(F.collect_list("keys"))).alias("keys"))


def word_keys(names: DataFrame, threshold: float) -> DataFrame:
    """``names`` with ``keys``: two names whose shared words make up enough of one of them share one.

    Shared words against those and the rest of a name: their ratio follows
    from lengths, and says which part of the name's letters and blanks may be
    missing.  A name's rarest words beyond that part are looked up among all words
    of the other, both ways.
    """
    t = threshold / 200
    missing = 1 - t / (1 - t)
    one = names.select("name", F.explode(F.array_distinct(F.split("norm", " "))).alias("word")).withColumn("weight", _length("word") + 1)
    total = one.groupBy("name").agg(F.sum("weight").alias("total"))
    # frequent words are spared as long as they, with all rarer ones missing, would not be enough
    rare = _rarest(one.join(total, "name"), "word", "weight", C("total") * (1 - missing) - 1e-9, ["name"])
    words = F.array_distinct(F.split("norm", " "))
    tags = [F.when(C("side") == 0, F.lit(x)).otherwise(F.lit(y)) for x, y in (("u", "v"), ("v", "u"))]
    tag = lambda k, c: F.transform(c, lambda x: F.concat(tags[k], x))
    out = names.join(rare, "name", "left")
    return out.withColumn("keys", F.concat(tag(0, F.coalesce("own", F.array().cast("array<string>"))), tag(1, words))).drop("own")


def part_keys(names: DataFrame, text: Column, threshold: float) -> DataFrame:
    """``names`` with ``keys``: a text and a much longer one, a window of which reaches the threshold against it, share one.

    No more than 2 * length * (1 - threshold / 100) letters go or come in, each
    in one of as many parts of the shorter text and one more, so that a part
    lies unchanged in the longer one.  Of each part its rarest run of letters is
    looked up among all runs of the other's, both ways.
    """
    t = names.withColumn("_t", text)
    parts = F.floor(2 * _length("_t") * (1 - threshold / 100) + 1e-9) + 1
    at = lambda k: F.floor(_length("_t") * k / parts)
    pieces = F.transform(F.sequence(F.lit(0).cast("long"), parts - 1), lambda k: F.struct(k.alias("k"), F.substring(C("_t"), (at(k) + 1).cast("int"), (at(k + 1) - at(k)).cast("int")).alias("piece")))
    runs = F.array_distinct(F.concat(*[_grams(C("_t"), n) for n in range(1, PART + 1)]))
    frequency = t.select(F.explode(runs).alias("gram")).groupBy("gram").agg(F.count("*").alias("f"))
    one = t.filter(_length("_t") > 0).select("name", F.explode(pieces).alias("p")).select("name", "p.k", "p.piece")
    own = F.when(_length("piece") <= PART, F.array("piece")).otherwise(_grams(C("piece"), PART))
    rare = one.select("name", "k", F.explode(own).alias("gram")).join(frequency, "gram").groupBy("name", "k").agg(F.min_by("gram", F.struct("f", "gram")).alias("gram"))
    rare = rare.groupBy("name").agg(F.collect_set("gram").alias("own"))
    tags = [F.when(C("side") == 0, F.lit(x)).otherwise(F.lit(y)) for x, y in (("s", "l"), ("l", "s"))]
    tag = lambda k, c: F.transform(c, lambda x: F.concat(tags[k], x))
    return t.join(rare, "name", "left").withColumn("keys", F.concat(tag(0, F.coalesce("own", F.array().cast("array<string>"))), tag(1, runs))).drop("own", "_t")


def weighted_pairs(counts: DataFrame, min_occurrences: int, threshold: float) -> DataFrame:
    """All pairs of a rare name and the frequent name that is best for it under the weighted ratio, and others, each with (name, norm, candidate, c_n, c_norm).

    Below 1.5 times the length: texts as a whole (``order_keys``), or shared
    words (``word_keys``).  From there to 8 times: the window ratio
    (``part_keys``), of texts or of their sorted words; and a shared word
    alone, which is worth the same in all names, so that of those with
    one word and length only the most frequent one can be best.  Beyond
    8 times nothing reaches a threshold above 80.
    """
    if threshold <= 80:
        raise ValueError("the weighted ratio has keys for thresholds above 80")
    names = counts.filter(C("norm") != "").withColumn("side", (C("n") >= min_occurrences).cast("int"))

    numbered = "id" in counts.columns  # numbers take less room than names
    names = names if numbered else names.withColumn("id", C("name"))
    by = names.select("name", "id")

    def met(keyed: DataFrame, near: Column) -> DataFrame:
        keyed = keyed.select("name", "side", "keys", _length("norm").alias("size"))
        left = keyed.filter("side = 0").join(by, "name").select(C("id").alias("name"), "keys", "size")
        right = keyed.filter("side = 1").join(by, "name").select(C("id").alias("candidate"), C("keys").alias("c_keys"), C("size").alias("c_size"))
        return meetings(*(stored(x, "keys") for x in (left, right)), near)

    far = F.greatest("size", "c_size") / F.least("size", "c_size")
    like, long = far < 1.5, (far >= 1.5) & (far <= 8)
    out = [met(order_keys(names, threshold), like)]
    if threshold <= 95:
        out.append(met(word_keys(names, threshold / 0.95), like))
    if threshold <= 90:
        out.append(met(part_keys(names, C("norm"), threshold / 0.9), long))
    if threshold <= 85.5:
        ordered = F.array_join(F.array_sort(F.split("norm", " ")), " ")
        out.append(met(part_keys(names, ordered, threshold / 0.855), long))
        words = F.array_distinct(F.split("norm", " "))
        one = names.filter("side = 1").select("name", "n", "norm", F.explode(words).alias("word"))
        best = one.groupBy("word", _length("norm").alias("size")).agg(F.min(F.struct((-C("n")).alias("m"), "name", "norm")).alias("b"))
        best = best.groupBy(C("b.name").alias("name"), (-C("b.m")).alias("n"), C("b.norm").alias("norm")).agg(F.collect_set("word").alias("keys")).withColumn("side", F.lit(1))
        rare = names.filter("side = 0").select("name", "n", "norm", words.alias("keys"), "side")
        out.append(met(rare.unionByName(best), long))
    pairs = reduce(DataFrame.unionByName, out).distinct()
    left = names.filter("side = 0").select(C("id").alias("_l"), "name", "norm")
    right = names.filter("side = 1").select(C("id").alias("_r"), C("name").alias("candidate"), C("n").alias("c_n"), C("norm").alias("c_norm"))
    pairs = pairs.select(C("name").alias("_l"), C("candidate").alias("_r"))
    return pairs.join(left, "_l").join(right, "_r").select("name", "norm", "candidate", "c_n", "c_norm")


def canonical(df: DataFrame, name: str, threshold: float = 90, min_occurrences: int = 2, blocked: bool | str = True, score=None) -> DataFrame:
    """name -> canonical, one row per distinct name.

    Names that occur ``min_occurrences`` times are their own canonical form
    and the candidates for the rest.  Best score wins, then count, then name.
    Under the weighted ratio thresholds are taken from above: at each all pairs
    that reach it are found, so that a name with one has its best, and only the
    others meet candidates at the next, where keys say less.  Where rare or
    frequent names are ``FEW``, all pairs are bounded instead, see ``few_best``.
    blocked: True for ``weighted_pairs`` (loses nothing under the weighted
    ratio above 80; below, words and leading parts are the keys, which can miss
    pairs), "grams" for ``gram_keys`` (the same for
    ``levenshtein_ratio``), False for all pairs of small tables.
    """
    ship(df.sparkSession)
    steps = [t for t in STEPS if t > threshold] if score is None and blocked is True and threshold > 80 else []
    direct = score is None and blocked is True and threshold >= WHOLE
    score = score or similarity(threshold)
    counts = df.filter(C(name).isNotNull() & (F.trim(name) != "") & ~F.lower(name).isin("nan", "none")).groupBy(C(name).alias("name")).agg(F.count("*").alias("n"))
    counts = stored(counts.withColumns({"norm": comparable(C("name")), "id": F.monotonically_increasing_id()}), "names")  # keys ask for it many times
    frequent = counts.filter(C("n") >= min_occurrences)
    rare = counts.filter(C("n") < min_occurrences)
    if direct:
        sizes = counts.filter(C("norm") != "").agg(F.count_if(C("n") < min_occurrences), F.count_if(C("n") >= min_occurrences)).first()
        if min(sizes) <= FEW:
            few, many = (rare, frequent) if sizes[0] <= sizes[1] else (frequent, rare)
            tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-max(sizes) // (4 * FEW)))
            best = few_best(few.filter(C("norm") != ""), many.filter(C("norm") != "").repartition(tasks), few is rare, threshold)
            return _with_canonical(counts, best)
    f = frequent.select(C("name").alias("candidate"), C("n").alias("c_n"), C("norm").alias("c_norm"))
    if blocked == "grams":
        keyed = gram_keys(counts, "norm", threshold)
        near = F.abs(F.char_length("norm") - F.char_length("c_norm")) <= (1 - threshold / 100 + 1e-9) * F.greatest(F.char_length("norm"), F.char_length("c_norm"))
        f = keyed.filter(C("n") >= min_occurrences).select(C("name").alias("candidate"), C("n").alias("c_n"), C("norm").alias("c_norm"), C("keys").alias("c_keys"))
        pairs = block_pairs(keyed.filter(C("n") < min_occurrences).select("name", "norm", "keys"), f).filter(near)
    elif blocked and threshold > 80:
        open_, found = counts, []
        for step in steps:
            found.append(stored(_best(weighted_pairs(open_, min_occurrences, step), similarity(step), step), "best"))
            open_ = stored(open_.join(found[-1], "name", "left_anti"), "names")
        best = _best(weighted_pairs(open_, min_occurrences, threshold), score, threshold)
        return _with_canonical(counts, reduce(DataFrame.unionByName, [*found, best]))
    elif blocked:
        keys = lambda c: F.array_distinct(F.concat(F.filter(F.split(c, " "), lambda w: F.length(w) > 2), F.array(F.concat(F.lit("^"), F.substring(c, 1, 4)))))
        pairs = block_pairs(rare.select("name", "norm", keys(C("norm")).alias("keys")), f.withColumn("c_keys", keys(C("c_norm"))))
    else:
        pairs = rare.join(f, F.lit(True))
    return _with_canonical(counts, _best(pairs, score, threshold))


class Texts:
    """Names in arrays, so that one name is bounded against all of them at once.

    Characters are told apart by 64 buckets, white space by none: a common
    subsequence of buckets is as long as one of characters at least.
    """

    def __init__(self, texts: list[str]):
        words = [t.split() for t in texts]
        self.texts, self.words = texts, [frozenset(w) for w in words]
        self.ordered = [" ".join(sorted(w)) for w in words]
        once = [sum(map(len, w)) + max(0, len(w) - 1) for w in self.words]
        #: lengths: as given, with single blanks, with each word once
        self.lengths = np.array([*zip(map(len, texts), map(len, self.ordered), once)], np.int64).reshape(-1, 3)
        self.again = self.lengths[:, 1] != self.lengths[:, 2]
        self.turned = np.array([o != t for o, t in zip(self.ordered, texts)], bool)
        self.kinds, self.kind = np.unique(self.lengths, axis=0, return_inverse=True)
        self.kind = self.kind.reshape(-1)
        self.given, self.sorted = self.buckets(texts), self.buckets(self.ordered)
        n, (flat, start) = len(texts), self.given
        row = np.repeat(np.arange(n), np.diff(start))
        self.counts = np.bincount(flat[:-1].astype(np.int64) * n + row, minlength=64 * n).reshape(64, n)
        self.counts = self.counts.astype(np.uint16 if self.lengths.max(initial=0) < 1 << 16 else np.int64)

    @staticmethod
    def buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All characters' buckets, behind them one that none has; where each text begins, and the end."""
        codes = np.frombuffer(re.sub(r"\s", " ", "".join(texts)).encode("utf-32-le"), np.uint32)
        return np.append(codes % 64, 64).astype(np.uint8), np.cumsum([0, *map(len, texts)])

    def holding(self, wanted: frozenset[str]) -> dict[str, np.ndarray]:
        """The rows that have each wanted word."""
        found: dict[str, list[int]] = {}
        for k, words in enumerate(self.words):
            for w in words & wanted:
                found.setdefault(w, []).append(k)
        return {w: np.array(rows) for w, rows in found.items()}


def _common_lengths(one: np.ndarray, flat: np.ndarray, start: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """``common_length`` of a text of 64 characters at most and many others, in buckets."""
    places = np.zeros(65, np.uint64)
    for i, b in enumerate(one.tolist()):
        places[b] |= np.uint64(1 << i)
    full = np.uint64((1 << len(one)) - 1)
    begin, size = start[rows], start[rows + 1] - start[rows]
    row = np.full(len(rows), full)
    for j in range(int(size.max(initial=0))):
        mask = places[flat[np.where(j < size, begin + j, len(flat) - 1)]]
        hit = row & mask
        row = ((row + hit) | (row - hit)) & full
    return len(one) - np.bitwise_count(row).astype(np.int64)


def reaching(few: Texts, k: int, many: Texts, holding: dict[str, np.ndarray], least: float) -> np.ndarray:
    """Rows of ``many`` whose weighted ratio with name k of ``few`` may reach ``least`` (``WHOLE`` or more): none that does is missing.

    As in ``most_ratio`` the bounds follow from lengths, characters in common
    and shared words; then from common subsequences, of the texts as they are
    and of their sorted words.
    """
    least -= 1e-6
    own = few.lengths[k]
    small, large = np.minimum(own, many.kinds), np.maximum(own, many.kinds)
    like = large[:, 0] < 1.5 * small[:, 0]
    scaled = least / np.array([200, 190, 190]) * (own + many.kinds)
    scaled[scaled > small] = np.inf
    # of a longer text: that it has all characters of the shorter one
    long = np.where((large[:, 0] <= 8 * small[:, 0]) & (least <= WHOLE), small[:, 0], np.inf)
    needed = np.minimum(np.where(like, scaled.min(axis=1), long), 1 << 30)
    common = np.zeros(len(many.texts), many.counts.dtype)
    held = few.counts[:, k]
    for b in np.flatnonzero(held).tolist():
        common += np.minimum(many.counts[b], many.counts.dtype.type(min(held[b], np.iinfo(many.counts.dtype).max)))
    rows = np.flatnonzero(common >= np.ceil(needed - 1e-9).astype(np.int64)[many.kind])
    near = like[many.kind[rows]]
    far, rows = rows[~near], rows[near]
    text = few.texts[k]
    far = far[[text in many.texts[r] or many.texts[r] in text for r in far.tolist()]] if len(far) else far
    base = None
    if least <= 95 and (shared := [(w, holding[w]) for w in few.words[k] if w in holding]):
        base, times = np.zeros(len(many.texts), np.int64), np.zeros(len(many.texts), np.int64)
        for w, at in shared:
            base[at] += len(w) + 1
            times[at] += 1
    if len(rows) and max(own[0], own[1]) <= 64:
        lengths = many.lengths[rows]
        best = 200.0 / (own[0] + lengths[:, 0]) * _common_lengths(few.given[0][few.given[1][k] : few.given[1][k + 1]], *many.given, rows)
        turned = np.flatnonzero(many.turned[rows] | few.turned[k])
        if len(turned):
            ratio_ = 190.0 / np.maximum(own[1] + lengths[turned, 1], 1) * _common_lengths(few.sorted[0][few.sorted[1][k] : few.sorted[1][k + 1]], *many.sorted, rows[turned])
            best[turned] = np.maximum(best[turned], np.where(own[1] + lengths[turned, 1] == 0, 100, ratio_))
        again = many.again[rows] | few.again[k] | (False if base is None else base[rows] > 0)
        loose = 190.0 / np.maximum(own[2] + lengths[:, 2], 1) * np.minimum(common[rows], np.minimum(own[2], lengths[:, 2]))
        rows = rows[np.maximum(best, np.where(again, loose, 0)) >= least]
    if base is not None:
        at = np.flatnonzero(base)
        at = at[like[many.kind[at]]]
        count = np.array([len(many.words[r]) for r in at.tolist()], np.int64)
        whole = (times[at] == len(few.words[k])) | (times[at] == count)
        b, less = base[at] - 1, np.minimum(own[2], many.lengths[at, 2])
        rows = np.concatenate([rows, at[np.where(whole, 95.0, 190.0 * b / (b + less)) >= least]])
    return np.unique(np.concatenate([rows, far]))


def few_best(few: DataFrame, many: DataFrame, rare_few: bool, threshold: float) -> DataFrame:
    """``_best`` of all pairs of a few names and many, each (name, n, norm): name, canonical, score.  ``rare_few``: the few are the rare names.

    The few go to all tasks, the others stay where they are, and meet them in
    batches; a pair whose bound is too low is not scored.
    """
    given = few.select("name", "n", "norm").collect()
    names, ns, norms = ([r[c] for r in given] for c in ("name", "n", "norm"))

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= FEW:
                yield pa.Table.from_batches(held)
                held = []
        if held:
            yield pa.Table.from_batches(held)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, least = Texts(norms), [threshold] * len(norms)
        wanted = frozenset().union(*own.words)
        for table in gathered(batches):
            name, n, norm = (table.column(c).to_pylist() for c in ("name", "n", "norm"))
            texts = Texts(norm)
            holding, best = texts.holding(wanted), {}
            for k, text in enumerate(norms):
                for r in reaching(own, k, texts, holding, least[k]).tolist():
                    rare, candidate = (names[k], (-n[r], name[r])) if rare_few else (name[r], (-ns[k], names[k]))
                    score = weighted_ratio(text, norm[r], least[k]) if rare_few else weighted_ratio(norm[r], text, threshold)
                    if score >= least[k]:
                        best[rare] = min(best.get(rare, (0.0,)), (-score, *candidate))
                        if rare_few:  # what scores less can't be its best
                            least[k] = score
            rows = [[rare for rare in best], *zip(*best.values())] if best else [[]] * 4
            yield pa.record_batch([pa.array(x, t) for x, t in zip(rows, (pa.string(), pa.float64(), pa.int64(), pa.string()))], ["name", "s", "m", "candidate"])

    found = many.select("name", "n", "norm").mapInArrow(met, "name string, s double, m long, candidate string")
    best = found.groupBy("name").agg(F.min(F.struct("s", "m", "candidate")).alias("b"))
    return best.select("name", C("b.candidate").alias("canonical"), (-C("b.s")).alias("score"))


def _best(pairs: DataFrame, score, threshold: float) -> DataFrame:
    """name, canonical, score of the best candidate that reaches the threshold."""
    scored = pairs.withColumn("score", score(C("norm"), C("c_norm"))).filter(C("score") >= threshold)
    best = scored.groupBy("name").agg(F.min(F.struct((-C("score")).alias("s"), (-C("c_n")).alias("n"), "candidate")).alias("b"))
    return best.select("name", C("b.candidate").alias("canonical"), (-C("b.s")).alias("score"))


def _with_canonical(counts: DataFrame, best: DataFrame) -> DataFrame:
    return counts.select("name", "n").join(best, "name", "left").select("name", "n", F.coalesce("canonical", "name").alias("canonical"), "score")
