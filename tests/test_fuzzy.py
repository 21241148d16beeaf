"""Keys of the weighted ratio lose no match that a full scan finds."""

import random

import pytest
from pyspark.sql import functions as F

from tenderloom.operators import fuzzy as Z

C = F.col
FIRST = "comune provincia regione azienda ministero consorzio unione istituto ente societa".split()
SECOND = "di dei del energia servizi luce verde acqua rifiuti pubblica integrata sanitaria".split()


def many_names(n, seed):
    """Names of shared and own words, and turned, cut, misspelt, shortened, lengthened and doubled forms of them."""
    rng = random.Random(seed)
    letters = "abcdefghilmnoprstuvz"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(1, 9)))
    base = [" ".join([rng.choice(FIRST), rng.choice(SECOND), *[word() for _ in range(rng.randint(0, 3))]][rng.randint(0, 1) :]) for _ in range(n // 3)]
    out = [(b, rng.randint(1, 4)) for b in base]
    while len(out) < n:
        b = rng.choice(base)
        w, k = b.split(), rng.randrange(len(b))
        form = rng.randrange(9)
        if form == 0:
            b = " ".join(rng.sample(w, len(w)))
        elif form == 1:
            b = b[:k] + rng.choice(letters) + b[k:]
        elif form == 2:
            b = b[:k] + b[k + 1 :]
        elif form == 3:
            b = " ".join(w[: max(1, len(w) - 1)])
        elif form == 4:
            b = f"{b} {word()} {word()} {rng.choice(SECOND)}"
        elif form == 5:
            b = b[: max(1, len(b) // 2)]
        elif form == 6:
            b = f"{word()}{b}{word()}"
        elif form == 7:
            b = f"{b} {rng.choice(w)}"
        else:
            b = rng.choice([" ".join(b[: rng.randint(1, 7)]), word(), b.upper() + " S.R.L.", b[k:] + b[:k]])
        out.append((b, 1))
    return [(name,) for name, times in out for _ in range(times)]


@pytest.mark.parametrize("threshold", [82, 85, 90, 96])
def test_weighted_keys_equal_the_full_scan(spark, threshold):
    df = spark.createDataFrame(many_names(700, threshold), "name string").repartition(4)
    got, want = ({r["name"]: (r.canonical, r.score) for r in Z.canonical(df, "name", threshold, 2, blocked=b).collect()} for b in (True, False))
    assert {k for k in want if want[k] != got.get(k)} == set()
    assert sum(s is not None for _, s in want.values()) > 30


def test_no_key_emits_all_its_pairs(spark):
    """Many names of the same first words: less than half of all pairs are scored."""
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghilmnoprstuvz") for _ in range(9))
    names = [(f"comune di {word()} {word()}", 1 + k % 2) for k in range(1200)]
    counts = spark.createDataFrame(names, "name string, n int").withColumn("norm", Z.comparable(C("name")))
    pairs = Z.weighted_pairs(counts, 2, 90)
    assert pairs.select("name", "candidate").distinct().count() < 600 * 600 / 2
    with pytest.raises(ValueError):
        Z.weighted_pairs(counts, 2, 80)


def test_frequent_pairs_of_letters_alone_are_no_key(spark):
    """Names of common words and an own code: under 2 % of all pairs are scored, each once."""
    rng = random.Random(2)
    code = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(6))
    names = [(f"azienda servizi {code()} {code()}", 1 + k % 2) for k in range(1200)]
    counts = spark.createDataFrame(names, "name string, n int").withColumn("norm", Z.comparable(C("name")))
    pairs = Z.weighted_pairs(counts, 2, 95).select("name", "candidate")
    got = pairs.agg(F.count("*"), F.countDistinct("name", "candidate")).first()
    assert got[0] == got[1] < 600 * 600 / 50


ODD = ["a\u00a0b c", "a b c", "\u00a0", "\u2003", "abc abc def", "abc def", "def abc", "x" * 70 + " y", "x" * 69 + " y", "é" * 5 + "à", "é" * 6, "ab", "ab cd", "zab cdz", "a", "città 🙂 nuova", "citta 🙂 nuova"]


def odd_names(n, seed):
    """``many_names``, a few odd ones, and numbered ones that differ in two digits."""
    rng = random.Random(seed)
    numbered = [(f"Customer#{rng.randrange(150):09d}",) for _ in range(130)]
    return many_names(n, seed) + [(x,) for x in ODD for _ in range(rng.randint(1, 2))] + numbered


@pytest.mark.parametrize("threshold,few", [(90, 10_000), (94, 10_000), (90, -1)])
def test_few_names_and_keys_equal_the_full_scan(spark, monkeypatch, threshold, few):
    """All pairs bounded, where a side has few names, and keys where it hasn't."""
    monkeypatch.setattr(Z, "FEW", few)
    for least in (2, 3) if few > 0 else (2,):  # the rare names are more, or fewer
        df = spark.createDataFrame(odd_names(150, threshold), "name string").repartition(4)
        got, want = ({r["name"]: (r.canonical, r.score) for r in Z.canonical(df, "name", threshold, least, blocked=b).collect()} for b in (True, False))
        assert {k: (want[k], got.get(k)) for k in want if want[k] != got.get(k)} == {}
        assert sum(s is not None for _, s in want.values()) > 10


def test_bounds_of_a_batch_lose_no_pair():
    """What may reach a threshold holds all that does, and of numbered names little else."""
    rng = random.Random(3)
    names = [f"customer#{rng.randrange(100_000):09d}" for _ in range(300)] + ODD + ["comune di " + n for n, in many_names(30, 4)]
    many, few = Z.Texts(names), Z.Texts(names[:5] + ODD + names[-5:])
    holding = many.holding(frozenset().union(*few.words))
    for k, name in enumerate(few.texts):
        scores = [Z.weighted_ratio(name, other) for other in names]
        for least in (90, 94, 97):
            found = set(Z.reaching(few, k, many, holding, least).tolist())
            assert found >= {r for r, score in enumerate(scores) if score >= least}
            assert len(found) < 30 or k >= 5


def test_few_rare_names_need_no_keys(spark):
    """A few rare names among many: the many get no keys, and nothing but the names is stored."""
    from pathlib import Path

    keys = lambda: {p.name for p in Path(spark.conf.get("spark.checkpoint.dir")).rglob("keys-*")}
    before = keys()
    df = spark.range(4000).selectExpr("format_string('Customer#%09d', id div 2) AS name").union(spark.createDataFrame([("Customer#000001799x",), ("Nobody",)], "name string"))
    got = {r["name"]: (r.canonical, r.score) for r in Z.canonical(df, "name").filter("n = 1").collect()}
    assert got == {"Customer#000001799x": ("Customer#000001799", pytest.approx(100 * 36 / 37)), "Nobody": ("Nobody", None)}
    assert keys() == before
