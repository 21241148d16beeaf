"""Text search through an inverted index of trigrams, with the exact pattern behind it.

A feed's rows are written in their order, in ranges (``ordering.Ordered``), and
each trigram of their texts gets one sorted list of places per block of BLOCK
rows, so no list grows with the table.  Lists lie sorted by trigram: readers
ask for a few of them and skip the other row groups by statistics.

A search takes from its pattern what every match must contain, intersects the
lists of those trigrams block by block, reads the ranges that hold candidates,
and keeps the rows that the pattern itself matches.  A pattern with an
alternative of which no trigram is known is a scan: same rows, by rule.

Trigrams are of ASCII characters only, so a pattern's other characters ask for
nothing.  The few letters that become ASCII under some change of case are
folded as each kind of search does, so that no row is lost.
"""

from __future__ import annotations

import re
import uuid
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classify import literals
from ..shipping import ship
from .interim import stored
from .ordering import Ordered
from .search import text_search

C = F.col
BATCH, TEXTS_AT_ONCE = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000  # whole texts go to Python workers, so few at a time
BLOCK = 8192  # rows of a range whose places share a list
AT = ["_segment", "_part", "_row"]
# fixed values: letters beyond ASCII that match an ASCII one whatever the case, and that one
NEAR_ASCII = ("ſ\u212aıİ", "skii")
# escapes and flags under which a letter does not stand for itself
CODED = re.compile(r"\\[xuNcQE0-9k]|\(\?[a-zA-Z]*-?[a-zA-Z]*x")


def alternatives(pattern: str) -> list[str]:
    """The parts of a pattern between the bars at its top."""
    out, own, depth, i = [], "", 0, 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\":
            own += pattern[i : i + 2]
            i += 2
            continue
        if ch == "[":
            end = i + 2 if pattern[i + 1 : i + 2] != "^" else i + 3
            while pattern[end] != "]":
                end += 1 + (pattern[end] == "\\")
            own += pattern[i : end + 1]
            i = end + 1
            continue
        depth += (ch == "(") - (ch == ")")
        if ch == "|" and not depth:
            out.append(own)
            own = ""
        else:
            own += ch
        i += 1
    return [*out, own]


def trigrams(text: str) -> set[str]:
    """Of a piece that a text must contain, in any case: its trigrams of ASCII characters."""
    return {run[i : i + 3].lower() for run in re.findall(r"[\x01-\x7f]{3,}", text) for i in range(len(run) - 2)}


def needed(pattern: str) -> list[set[str]] | None:
    """Trigrams that a match must have, per alternative; None if some alternative asks for none."""
    if CODED.search(pattern):
        return None
    need = [set().union(*map(trigrams, literals(a))) for a in alternatives(pattern)]
    return need if all(need) else None


def folded(columns: list[str]) -> Column:
    """The texts of some columns under each folding that a search may use, parted by a character that no trigram has."""
    out = []
    for c in map(C, columns):
        raised = F.when(F.octet_length(c) != F.char_length(c), F.translate(F.upper(c), ascii_uppercase, ascii_lowercase))  # lower(upper) would be planned as lower
        out += [F.lower(F.translate(c, *NEAR_ASCII)), raised]
    return F.concat_ws("\u00a0", *out)


def codes(texts: pd.Series) -> pd.Series:
    """The distinct trigrams of each text, as numbers of three times seven bits.

    Bytes of other characters are above 127, so no trigram runs across them.
    """

    def of(text: str) -> np.ndarray:
        b = np.frombuffer(text.encode(), np.uint8)
        ok = (b > 0) & (b < 128)
        n = b.astype(np.int32)
        return np.unique(((n[:-2] << 14) | (n[1:-1] << 7) | n[2:])[ok[:-2] & ok[1:-1] & ok[2:]])

    return texts.map(of)


class TrigramIndex:
    """An index in a folder that driver and executors share; feeds are added one by one.

    Null texts match nothing; equal rows are rows of their own; an empty feed
    adds nothing.  Columns named ``_segment``, ``_part``, ``_row`` or ``_n`` are not
    allowed.  A feed counts once its lists are written; one that breaks off is
    never read.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, *below: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *below)))
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def add(self, df: DataFrame, key: list[str], columns: list[str]) -> None:
        """Index the texts of ``columns``; rows lie in the order of ``key``, and searches give all columns of ``df``."""
        if "_segment" in df.columns:
            raise ValueError("column _segment is taken")
        segment = f"_segment=s{uuid.uuid4().hex}"
        rows = Ordered(df, key, f"{self.path}/rows/{segment}").rows
        ship(self.spark)
        kept = self.spark.conf
        kept.set(BATCH, min(int(kept.get(BATCH)), TEXTS_AT_ONCE))
        texts = F.pandas_udf(codes, "array<int>")(folded(columns))
        at = rows.select("_part", F.expr(f"_row - _row % {BLOCK}").alias("_block"), F.expr(f"CAST(_row % {BLOCK} AS INT)").alias("place"), F.explode(texts).alias("code"))
        letter = lambda shift: F.chr(F.shiftright("code", shift).bitwiseAND(127).cast("long"))
        lists = at.groupBy("code", "_part", "_block").agg(F.sort_array(F.collect_list("place")).alias("places"))
        lists = lists.select(F.concat(letter(14), letter(7), letter(0)).alias("gram"), "_part", "_block", "places")
        by = ["gram", "_part", "_block"]
        lists.repartitionByRange(*by).sortWithinPartitions(*by).write.parquet(f"{self.path}/lists/{segment}")

    def _read(self, kind: str) -> DataFrame | None:
        store, folder = self._folder("lists")
        done = [f.getPath().getName() for f in store.listStatus(folder) if store.exists(self._folder("lists", f.getPath().getName(), "_SUCCESS")[1])] if store.exists(folder) else []
        paths = [f"{self.path}/{kind}/{name}" for name in sorted(done)]
        # a feed without rows has no files
        paths = [p for p in paths if any(f.getPath().getName().startswith("_part=") or f.getPath().getName().endswith(".parquet") for f in store.listStatus(self.spark._jvm.org.apache.hadoop.fs.Path(p)))]
        return self.spark.read.option("basePath", f"{self.path}/{kind}").parquet(*paths) if paths else None

    def rows(self) -> DataFrame:
        rows = self._read("rows")
        if rows is None:
            raise ValueError(f"nothing was added to {self.path}")
        return rows

    def candidates(self, need: list[set[str]]) -> DataFrame:
        """Places of the rows that have all trigrams of an alternative: _segment, _part, _row, alternative (its number).

        A block's lists meet in one group: one list per trigram asked for, BLOCK places each at most.
        """
        asked = F.array(*[F.struct(F.lit(g).alias("g"), F.lit(k).alias("alternative"), F.lit(len(n)).alias("n")) for k, n in enumerate(need) for g in sorted(n)])
        lists = self._read("lists").filter(C("gram").isin(sorted(set().union(*need))))
        lists = lists.select("_segment", "_part", "_block", "places", F.inline(F.filter(asked, lambda a: a["g"] == C("gram"))))
        met = lists.groupBy("_segment", "_part", "_block", "alternative").agg(F.collect_list("places").alias("lists"), F.first("n").alias("n")).filter(F.size("lists") == C("n"))
        common = F.aggregate(F.slice("lists", 2, F.greatest(C("n") - 1, F.lit(0))), C("lists")[0], F.array_intersect)
        return met.select("_segment", "_part", "_block", "alternative", F.explode(common).alias("place")).select("_segment", "_part", (C("_block") + C("place")).alias("_row"), "alternative")

    def _at(self, found: DataFrame) -> DataFrame:
        """Rows at the candidates' places, from the ranges that hold some; of those, a row each comes to the driver."""
        found = stored(found)
        parts = found.select("_segment", "_part").distinct().collect()
        rows = self.rows().filter(C("_segment").isin(sorted({p["_segment"] for p in parts})) & C("_part").isin(sorted({p["_part"] for p in parts})))
        return rows.join(found, AT)

    def search(self, pattern: str, columns: list[str]) -> DataFrame:
        """Rows in which any of the columns matches the pattern, whatever the case: those of ``text_search``."""
        need = needed(pattern)
        rows = self.rows() if need is None else self._at(self.candidates(need).select(*AT).distinct())
        return text_search(rows, columns, pattern).drop(*AT)

    def containing(self, column: str, terms: list[str]) -> DataFrame:
        """A row for each term that a row's text contains, compared in lower case, with the term as ``keyword``."""
        known = [t for t in terms if trigrams(t.lower())]
        others = [t for t in terms if t not in known]
        out = []
        if known:
            word = F.array(*map(F.lit, known))[C("alternative")]
            out.append(self._at(self.candidates([trigrams(t.lower()) for t in known])).withColumn("keyword", word).filter(F.contains(F.lower(column), F.lower("keyword"))).drop("alternative"))
        if others or not terms:
            hit = F.filter(F.array(*map(F.lit, others)).cast("array<string>"), lambda k: F.contains(F.lower(C(column)), F.lower(k)))
            out.append(self.rows().withColumn("keyword", F.explode(hit)))
        return (out[0] if len(out) == 1 else out[0].unionByName(out[1])).drop(*AT)

    def containing_upper(self, column: str, term: str) -> DataFrame:
        """Rows whose text contains the term, compared in upper case."""
        need = trigrams(term.upper().lower())
        rows = self._at(self.candidates([need]).select(*AT)) if need else self.rows()
        return rows.filter(F.contains(F.upper(column), F.upper(F.lit(term)))).drop(*AT)
