"""op13: checksums, features, weights and the draw against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa

from tenderloom.llm import queries
from tenderloom.llm import resampling as R
from tenderloom.llm.shared import string_buffers

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "ab9" * 50_000


def brute_features(text, most=2):
    w = WORD.findall((text or "").translate(LOW))
    return [" ".join(w[i : i + k]) for k in range(1, most + 1) for i in range(len(w) - k + 1)], len(w)


def brute(docs, target, percent=25, least=20, buckets=10_000):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (collections.Counter(bucket(f) for _, x in rows for f in brute_features(x)[0]) for rows in (docs, target))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    out, fit = {}, []
    for i, x in docs:
        f, n = brute_features(x)
        weight = sum(gain(bucket(y)) for y in f) // len(f) if f else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if n >= least:
                fit.append((-score, i))
        out[i] = [len(f), weight, score, None]
    for k, (_, i) in enumerate(sorted(fit)[: len(fit) * percent // 100], 1):
        out[i][3] = k
    return {i: tuple(v) for i, v in out.items()}


def test_checksums_of_spans():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 1_500_000).astype(np.uint8)
    sizes = [*range(1, 200), 1023, 1024, 1025, R.SLICE, R.SLICE + 1, R.SLICE + 70]
    starts = np.array([int(rng.integers(0, len(data) - n)) for n in sizes])
    ends = starts + np.array(sizes)
    assert R.checksums(data, starts, ends).tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends)]


def test_features_of_odd_texts():
    texts = ["", None, "a", "A b\x00É.9z", " !? ", "é 日本", LONG, f"x {LONG} y", "q" * 64 + " " + "r" * 65]
    data, offsets = string_buffers(pa.array(texts))
    bucket, rows, many = R.features(data, offsets, 0, len(texts), 2, 10_000)
    got = [sorted(bucket[rows == k].tolist()) for k in range(len(texts))]
    want = [brute_features(t) for t in texts]
    assert got == [sorted(zlib.crc32(f.encode()) % 10_000 for f in fs) for fs, _ in want] and many.tolist() == [n for _, n in want]


def test_resample_edge_rows(spark, docs_of):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "Delta", "é1"]) for _ in range(rng.randint(0, 40)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, f"w {LONG} " * 15), (103, "same text " * 20)]
    docs, target = docs_of(rows), spark.createDataFrame([("alpha beta " * 9, 3), (None, 3)], "text string, rank int")
    want = brute(rows, [(0, "alpha beta " * 9), (1, None)])
    got = R.resample(docs, target)
    assert {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in got.collect()} == want
    assert sum(v[3] is not None for v in want.values()) > 5
    nameless = docs_of([(None, "alpha beta " * 15)] * 3 + [(7, "alpha beta " * 15)] * 4).unionByName(docs_of(rows[:1]))
    out = R.resample(nameless, target, percent=50).collect()
    assert sorted(r["rank"] or 0 for r in out) == [0] * 6 + [1, 2] and all(r.score is None for r in out if r.doc_id is None)
    assert R.resample(docs.limit(0), target).count() == 0
    assert R.resample(docs, target.limit(0)).count() == len(rows)


def test_op13(spark):
    docs, target = (duckdb.sql(f"SELECT * FROM '{FOLDER}/{t}.parquet'").fetchall() for t in ("documents", "benchmark"))
    got = {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in queries.op13_importance_resampling(spark, FOLDER).collect()}
    assert got == brute([d[:2] for d in docs], target)
