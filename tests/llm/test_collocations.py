"""op11: blocks, tiles and phrases against brute force and SQL."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from compare import duck_rows, spark_rows

from tenderloom.llm import collocations as K
from tenderloom.llm import queries
from tenderloom.llm.shared import string_buffers

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
HARD = "über-lange-wörter-die-kein-fach-fassen"


def brute(rows, least, most=4, top=2000):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in range(1, most + 1) for i in range(len(w) - k + 1))
    own = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    gone = {(p[0], *p[i:j]) for p, a in own.items() for i in range(1, len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) - 1 and 100 * a >= 80 * f[p[0], *p[i:j]]}
    out = collections.defaultdict(list)
    for (lang, *w), a in own.items():
        cuts = [(f[lang, *w[:k]], f[lang, *w[k:]]) for k in range(1, len(w))]
        score, k = min((2_000_000 * a // (x + y), k) for k, (x, y) in enumerate(cuts))
        if (lang, *w) not in gone:
            out[lang].append((-score, -a, " ".join(w).encode(), *cuts[k]))
    return {(lang, k, p.decode(), -a, x, y, n[lang], -s) for lang, rows in out.items() for k, (s, a, p, x, y) in enumerate(sorted(rows)[:top], 1)}


def tuples(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def texts(seed, many):
    rng = random.Random(seed)
    pool = ["of", "the", "The", "new", "york", "city", "hall", "x", "é", HARD, HARD + "2", "a-b", "\x00"]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\x0b", "\xa0", ""]
    out = []
    for _ in range(many):
        t = "".join(rng.choice(pool) + rng.choice(gaps) for _ in range(rng.randint(0, 30)))
        out.append((t + rng.choice(["", " New York City Hall.", " in spite of it", " in spite of"]), rng.choice(["en", "de", None, "und", "en"])))
    return out + [(None, "en"), ("", "fr"), ("...", "fr"), (" word " * 5, "es"), (" ".join(["same"] * 300), "es")]


@pytest.mark.parametrize("band,dense", [(1024, 1024 * 128), (4, 2), (4, 10**9)])
def test_cells_of_tiles(monkeypatch, band, dense):
    monkeypatch.setattr(K, "BAND", band)
    monkeypatch.setattr(K, "DENSE", dense)
    rng = np.random.default_rng(3)
    for m, n in ((1, 50), (9, 400), (33, 5000)):
        x, y = (np.minimum(rng.geometric(0.2, n) - 1, m - 1) for _ in range(2))
        a, b, many, index = K.pair_cells(x, y, m)
        assert dict(zip(zip(a.tolist(), b.tolist()), many.tolist())) == collections.Counter(zip(x.tolist(), y.tolist()))
        assert (a[index] == x).all() and (b[index] == y).all()


def test_packed_columns_come_back():
    rng = np.random.default_rng(2)
    for n in (0, 1, 70):
        x, y = rng.integers(0, 1 << 62, n), rng.integers(0, 9, n)
        (a, b), text = K.opened(K.shut(x, y, text="é\nz".encode()), 2)
        assert (a == x).all() and (b == y).all() and text == "é\nz".encode()


def test_sequences_and_answers_come_back():
    sequence, many = np.array([2, 0, -1, 2, 1, 2, -1, 0]), np.array([2, 1, 3])
    assert K.opened_sequence(K.shut_sequence(sequence, many)).tolist() == sequence.tolist()
    assert K.opened_sequence(K.shut_sequence(sequence[:0], many[:0])).tolist() == []
    at, ids, size = K.told(K.tell(np.array([3, 4, 9]), np.array([0, 5, 6]), np.array([30, 1 << 40, 31]), 2), 7)
    assert at.tolist() == [3, 4, 9] and ids.tolist() == [2, 37, 44] and size[1] > size[0] == size[2]


def test_words_of_one_hash_stay_apart(monkeypatch):
    monkeypatch.setattr(K, "mix", lambda x: x & np.uint64(3))
    data, bounds = string_buffers(pa.array(["b a a c d e", HARD, f"{HARD} a f. g"]))
    sequence, words, many, part = K.block_of(data, bounds, 3)
    words = [w.decode() for w in words]
    shown = [words[i] if i >= 0 else "|" for i in sequence]
    assert (np.diff(part) >= 0).all() and [p for p, _, _ in K.by_part(part)] == sorted(set(part.tolist()))
    assert shown == ["b", "a", "a", "c", "d", "e", "|", HARD, "|", HARD, "a", "f", "|", "g"]
    assert dict(zip(words, many.tolist())) == collections.Counter(w for w in shown if w != "|")


@pytest.mark.parametrize("block", [1 << 23, 300])
def test_phrases_equal_brute_force(spark, monkeypatch, block):
    """With small blocks, long texts are cut between pieces."""
    rows = texts(1, 400) + [(". ".join(t or "" for t, _ in texts(2, 60)), "de")]
    docs = spark.createDataFrame([(t, lang, 1, "x") for t, lang in rows], "text string, lang string, n int, phrase string").repartition(3)
    blocks = K.word_blocks
    monkeypatch.setattr(K, "word_blocks", lambda *a: blocks(*a, block))
    monkeypatch.setattr(K, "PART_BYTES", block * 10)
    for least, most, top in ((5, 4, 2000), (3, 2, 10), (8, 5, 7)):
        want = brute(rows, least, most, top)
        assert tuples(K.collocations(docs, least=least, most_words=most, top=top)) == want and want


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "text string, lang string")
    assert K.collocations(docs).count() == 0
    assert K.collocations(spark.createDataFrame([(None, None), ("a b", "x")], "text string, lang string")).count() == 0


def test_exact_scores_beyond_64_bits(spark):
    f = 9 * 10**17
    level = spark.createDataFrame([("x", "a b", f, [f + 1, f], [f + 3, f], None)], "lang string, phrase string, f long, heads array<long>, tails array<long>, within long")
    assert K.with_scores([level]).first().score == 2_000_000 * f // (2 * f + 4)


def test_op11(spark):
    folder = "/root/testdata/sf0.001"
    got = spark_rows(queries.op11_collocations(spark, folder))
    assert got == duck_rows(queries.ORACLE["op11_collocations"], folder) and got[1]
