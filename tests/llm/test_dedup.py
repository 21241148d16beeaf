"""op1, op4, op8 against brute force on hand-made documents: nulls, empty, very long, ties, repeats, hot groups."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from tenderloom.llm import components as components_module
from tenderloom.llm import minhash_dedup as near
from tenderloom.llm.components import components
from tenderloom.llm.exact_dedup import drop_copies, exact_dedup
from tenderloom.llm.minhash_dedup import drop_near_copies, minhash_dedup
from tenderloom.llm.substring_dedup import drop_repeats, substring_dedup

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCABULARY = [f"w{i}" for i in range(400)]


def text_of(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def corpus():
    rng = random.Random(5)
    rows, base = [(100, None), (101, ""), (102, " \n\t "), (103, "One"), (104, "one"), (105, "É à"), (106, "é à"), (107, "a b c"), (108, "A B c")], text_of(rng, 60)
    for i in range(90):  # a family: some edits each, so that some link and some do not
        words = base.split()
        for _ in range(rng.choice([0, 0, 1, 2, 3, 6, 12])):
            words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
        rows.append((i, " ".join(words)))
    passage = text_of(rng, 30)
    for i in range(200, 260):
        rows.append((i, f"{text_of(rng, rng.randint(1, 40))} {passage}\n{text_of(rng, rng.randint(0, 40))}"))
    rows.append((300, text_of(rng, 30_000)))
    rows.append((301, dict(rows)[300].upper()))
    rows.append((302, dict(rows)[300] + " tail"))
    rows.append((150, dict(rows)[0]))
    rng.shuffle(rows)
    return rows


ROWS = corpus()


def shingles(text, width):
    w = WORD.findall((text or "").translate(LOW))
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def brute_components(rows, width, percent=80):
    sets = {i: shingles(t, width) for i, t in rows}
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            x, y = top(a), top(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), top(i)) for i, s in sets.items()}


@pytest.mark.parametrize("width", [4, 5])
def test_near_dedup_equals_brute_force(docs_of, width):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup(docs_of(ROWS), shingle_words=width).collect()}
    assert got == brute_components(ROWS, width)


def test_collisions_equal_counting():
    rng = np.random.default_rng(8)
    for _ in range(300):
        lists = [np.sort(rng.choice(30, rng.integers(1, 20), replace=False)) for _ in range(rng.integers(1, 8))]
        for least in (1, 2, 3, 5):
            count = np.bincount(np.concatenate(lists), minlength=30)
            assert near.collisions(lists, least).tolist() == np.flatnonzero(count >= least).tolist()


def test_pairs_of_a_cell_equal_all_pairs(monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(near, "SKETCH_MATCHES", 0)
    for inside in (True, False):
        for pos in (0, 5, 17):
            code = rng.integers(0, 3, (40, near.COORDINATES))
            code[:, pos] = 7
            code[:, :pos] += np.arange(40)[:, None] * rng.integers(0, 2, (40, 1)) * 5
            component, n = rng.integers(0, 6, 40), rng.integers(90, 130, 40)
            side = np.zeros(40, int) if inside else np.arange(40) % 2
            got = {(min(p), max(p)) for p in near.cell_pairs(pos, side, component, n, code, np.zeros((40, 4), np.uint8), 80)}
            want = set()
            for i, j in itertools.combinations(range(40), 2):
                same = code[i] == code[j]
                if component[i] != component[j] and (inside or side[i] != side[j]) and min(n[i], n[j]) * 100 >= max(n[i], n[j]) * 80 and same.argmax() == pos and same.sum() >= near.MATCHES:
                    want.add((i, j))
            assert got == want and want


@pytest.mark.parametrize("n", [1024, 2048])
def test_words_that_polynomial_hashes_confuse(docs_of, n):
    """A Thue-Morse word and its complement have one value under every polynomial hash modulo 2**64 with an odd base."""
    one, two = ("".join("ab"[(bin(i).count("1") + turned) % 2] for i in range(n)) for turned in (0, 1))
    rows = [(1, one), (2, two), (3, f"{one} " * 13), (4, f"{two} " * 13)]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup(docs_of(rows), shingle_words=4).collect()} == brute_components(rows, 4)
    assert {r.doc_id: r.n_removed for r in substring_dedup(docs_of(rows)).collect()} == {1: 0, 2: 0, 3: 0, 4: 0}


def test_near_dedup_in_small_cells(docs_of, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 20)
    got = {r.doc_id: r.component_id for r in minhash_dedup(docs_of(ROWS), shingle_words=4).collect()}
    assert got == {i: c for i, (_, c) in brute_components(ROWS, 4).items()}


def test_near_dedup_edge_rows(docs_of, spark):
    out = minhash_dedup(docs_of([(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (2, "A b c d e")])).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in out if r.doc_id) == [(1, 1, True), (1, 1, True), (2, 1, False)]
    assert [r.kept for r in out if r.doc_id is None] == [True]
    assert minhash_dedup(docs_of(ROWS).limit(0)).count() == 0
    with pytest.raises(Exception, match="negative"):
        minhash_dedup(docs_of([(-1, "a b c d e"), (2, "x")]))
    assert {r.doc_id for r in drop_near_copies(docs_of([(1, "a b c d e f"), (3, "a b c d e f"), (2, None)])).collect()} == {1, 2}


@pytest.mark.parametrize("few", [10, 10_000])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(components_module, "FEW", few)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(40)] + [(7, 7), (200, 201), (201, 200), (200, 201)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_exact_dedup_equals_brute_force(docs_of):
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup(docs_of(ROWS), block_chars=16).collect()}
    groups = collections.defaultdict(list)
    for i, t in ROWS:
        groups[(t or "").translate(LOW)].append(i)
    want = {i: (max(ids), len(ids), i == max(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids}
    assert got == want


def test_exact_dedup_edge_rows(docs_of):
    rows = [(1, "x"), (1, "x"), (1, "y"), (None, "x"), (2, "")]
    out = exact_dedup(docs_of(rows)).collect()
    assert len(out) == 4 and sum(r.kept for r in out) == 3
    assert exact_dedup(docs_of(rows).limit(0)).count() == 0
    kept = drop_copies(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(1, "x"), (1, "y"), (2, "")]
    assert kept.count() == drop_copies(kept).count()


def brute_removal(rows, width=13):
    words = {i: WORD.findall(t or "") for i, t in rows}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - width + 1):
            first.setdefault(tuple(words[i][k : k + width]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < i:
                gone.update(range(k, k + width))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def test_substring_dedup_equals_brute_force(docs_of):
    out = substring_dedup(docs_of(ROWS)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in out} == brute_removal(ROWS)
    for r in out:
        assert sum(s.end - s.start for s in r.removed) == r.n_removed
        assert all(a.end < b.start for a, b in zip(r.removed, r.removed[1:]))


def test_substring_dedup_edge_rows(docs_of):
    same = " ".join(VOCABULARY[:20])
    rows = [(5, same), (5, same), (None, same), (7, f"x {same} y"), (8, same + " " + same), (9, None)]
    got = [(r.doc_id, r.n_removed) for r in substring_dedup(docs_of(rows)).collect()]
    assert sorted(got, key=str) == sorted([(5, 0), (5, 0), (None, 0), (7, 20), (8, 40), (9, 0)], key=str)
    assert substring_dedup(docs_of(rows).limit(0)).count() == 0
    out = {r.doc_id: r.text for r in drop_repeats(docs_of(rows)).collect()}
    assert out[7] == "x y" and out[8] == "" and out[9] is None


def test_substring_dedup_of_one_hot_id(docs_of):
    """Very many rows of one id, which never count against each other, and rows without an id."""
    rng = random.Random(9)
    passages = [text_of(rng, 15) for _ in range(3)]
    hot = [(50, f"{text_of(rng, 3)} {rng.choice(passages)} {text_of(rng, 14)}") for _ in range(300)]
    rows = [(3, passages[0]), (49, passages[1]), *hot, (51, passages[2]), (70, hot[7][1]), *[(None, hot[k][1]) for k in range(20)]]
    earlier = {tuple(w[k : k + 13]) for i, t in rows[:2] for w in [t.split()] for k in range(3)}
    every = earlier | {tuple(w[k : k + 13]) for _, t in hot for w in [t.split()] for k in range(len(w) - 12)}

    def left(text, seen):
        w = text.split()
        gone = {k + j for k in range(len(w) - 12) if tuple(w[k : k + 13]) in seen for j in range(13)}
        return " ".join(x for k, x in enumerate(w) if k not in gone)

    got = sorted((r.doc_id or 0, r.text, r.kept_text) for r in substring_dedup(docs_of(rows)).collect())
    seen = {3: set(), 49: set(), 50: earlier, 51: every, 70: every, None: set()}
    assert got == sorted((i or 0, t, left(t, seen[i])) for i, t in rows)


def test_sweep_deletes_interim_tables(docs_of, tmp_path):
    import os

    from tenderloom.llm.shared import shared_folder, stored, sweep

    spark = docs_of([]).sparkSession
    kept = stored(exact_dedup(docs_of([(1, "a"), (2, "a"), (3, "b")])), "kept")
    assert sweep(spark, [kept]) > 0
    left = os.listdir(f"{shared_folder(spark).removeprefix('file://')}/tables")
    assert [f.split("-")[0] for f in left] == ["kept"] and kept.count() == 3
    assert sweep(spark) == 1
