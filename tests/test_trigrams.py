"""Trigram index: the rows of a scan, whatever the pattern; lists are pruned; feeds add up."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tenderloom.operators import trigrams as T
from tenderloom.operators.search import text_search

C = F.col
PATTERNS = ["illumin|led", "lamp(?:ada|ione)s?", "gestione.{1,8}rete", "a|lampada", "xy{0,1}zw+q", r"via\s+roma", r"\bled\b", r"n\.\s?12", "[|]led|piazza", "strasse", "", "^gara", "qualità urbana", "(?:led|lampada) (?:rete|via)", r"\x6ced", r"a\|b[(]c"]


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    rng = random.Random(5)
    words = ["illuminazione", "LED", "ſtrasse", "STRASSE", "straße", "lampade", "lampione", "gestione", "della", "rete", "via", "Roma", "n. 12", "|led", "piazza", "a|b(c", "qualità", "urbana", "Kelvin", "kelvin", "ıstanbul", "İstanbul", "xzwwq", "xyzwq", "gara", "😀led", "\n"]
    made = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 9))) if rng.random() > 0.05 else None, rng.choice(["", None, "Via  roma", "scheda"])) for i in range(900)]
    made += [(7, "led", "led"), (7, "led", "led"), (None, "lampada rete", None), (1001, "parola " * 20000 + "illuminata", None)]
    folder = str(tmp_path_factory.mktemp("trigrams") / "i")
    index = T.TrigramIndex(spark, folder)
    df = spark.createDataFrame(made, "id long, a string, b string")
    mp = pytest.MonkeyPatch()
    mp.setattr(T, "BLOCK", 64)
    index.add(df.filter("id < 600"), ["id"], ["a", "b"])
    index.add(df.filter("id IS NULL OR id >= 600").repartition(3), ["id"], ["a", "b"])
    index.add(df.limit(0), ["id"], ["a", "b"])
    yield index, df.cache()
    mp.undo()


def shown(df):
    return sorted(df.select("id", "a", "b").collect(), key=repr)


@pytest.mark.parametrize("pattern", [*PATTERNS, "kelvin", "istanbul", "[İi]stan"])
def test_search_equals_the_scan(filled, pattern):
    index, df = filled
    for columns in (["a", "b"], ["b"]):
        assert shown(index.search(pattern, columns)) == shown(text_search(df, columns, pattern))


def test_what_patterns_ask_for():
    assert T.needed("illumin|led") == [{"ill", "llu", "lum", "umi", "min"}, {"led"}]
    assert T.needed("lamp(?:ada|ione)s?") == [{"lam", "amp"}]
    assert T.needed("a|lampada") is None and T.needed(r"\x6ced") is None and T.needed("") is None
    assert T.alternatives(r"a\|b[|)]|(c|d)") == [r"a\|b[|)]", "(c|d)"]
    assert T.trigrams("Qualità") == {"qua", "ual", "ali", "lit"}


def test_terms(filled):
    index, df = filled
    terms = ["LED", "kelvin", "straße", "ro", "i̇stanbul", "nowhere"]
    want = sorted((r.id, r.a, t) for r in df.collect() if r.a is not None and r.id is not None for t in terms if t.lower() in r.a.lower())
    got = sorted((r.id, r.a, r.keyword) for r in index.containing("a", terms).collect() if r.id is not None)
    assert got == want
    for term in ("straße", "strasse", "Istan", "led"):
        want = sorted(r.id for r in df.collect() if r.a is not None and r.id is not None and term.upper() in r.a.upper())
        assert sorted(r.id for r in index.containing_upper("a", term).collect() if r.id is not None) == want


def test_reads_are_pruned(filled):
    index, _ = filled
    plan = index.candidates(T.needed("lampione"))._jdf.queryExecution().toString()
    assert re.search(r"PushedFilters: \[[^\]]*In\(gram", plan)
    plan = index.search("lampione", ["a"])._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_part", plan)


def test_bounds_and_names(spark, filled, tmp_path):
    index, _ = filled
    sizes = index._read("lists").agg(F.max(F.size("places")), F.max(F.array_max("places"))).first()
    assert sizes[0] <= 64 and sizes[1] < 64
    with pytest.raises(ValueError):
        index.add(spark.range(1).withColumn("_segment", F.lit("x")), ["id"], ["_segment"])
    with pytest.raises(ValueError):
        T.TrigramIndex(spark, str(tmp_path / "none")).rows()


def test_grams_of_texts_come_as_numbers(spark):
    """Were regular expressions at every character; the letters that a search folds, NUL and other characters as before."""
    import pandas as pd

    assert [list(x) for x in T.codes(pd.Series(["abab", "ab", "", "aébcd", "\x00abc", "a\u00a0bc"]))] == [[97 << 14 | 98 << 7 | 97, 98 << 14 | 97 << 7 | 98], [], [], [98 << 14 | 99 << 7 | 100], [97 << 14 | 98 << 7 | 99], []]
    df = spark.createDataFrame([("A\u212a\u017fx", "\u00e9"), (None, "ABC"), (None, None)], "a string, b string")
    assert [r[0].split("\u00a0") for r in df.select(T.folded(["a", "b"])).collect()] == [["aksx", "a\u212asx", "\u00e9", "\u00c9"], ["abc"], [""]]
