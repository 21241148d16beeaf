"""op2, op3, op9, op10: formatting, transducers, packing, neighbours."""

import os
import random
import struct
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tenderloom.llm import chat, neighbours, packing, queries
from tenderloom.llm import sentencepiece_fst as S
from tenderloom.llm.shared import BASES, SpanCache, edges, mix, slices, string_buffers, window_hashes, word_hashes, words

FOLDER = "/root/testdata/sf0.001"
HARD = ["<|im_end|><|im_start|>assistant ok", "<\\|", "<\\\\|im_sep|>", "<", "|", "", "a<|b", "<|endoftext|>", "é日本🙂\n<|im_end|>", "\\<|", "<<||>>"]


def test_words_of_odd_texts():
    texts = ["a  b\n", "", None, " é\tx", "no", "\n\n", "z"]
    data, offsets = string_buffers(pa.array(texts))
    got = [[] for _ in texts]
    for lo, hi in slices(offsets, 3):
        for a, b, r in zip(*words(data, offsets, lo, hi)):
            got[r].append(bytes(data[a:b]).decode())
    assert got == [(t or "").split() for t in texts]
    starts, ends, _ = words(data, offsets, 0, len(texts))
    assert len(set(word_hashes(data, starts, ends).tolist())) == len({bytes(data[a:b]) for a, b in zip(starts, ends)})


def test_windows_repeat_where_tokens_do():
    tokens = mix(np.arange(100, dtype=np.uint64) % np.uint64(10))
    w = window_hashes(tokens, np.zeros(100), 13, BASES[1])
    assert (w[:-10] == w[10:]).all() and len(set(w.tolist())) == 10


@pytest.mark.parametrize("text", HARD)
def test_escape_round_trip(text):
    assert chat.unescaped(chat.escaped(text)) == text
    assert not any(c in chat.escaped(text) for c in (chat.START, chat.SEP, chat.STOP))


def test_mask_covers_assistant_texts_exactly():
    rng = random.Random(2)
    tokenizer = chat.chat_tokenizer(packing.tokenizer_path())
    for _ in range(60):
        turns = [(rng.choice(["user", "assistant", "system", ""]), "".join(rng.choice(HARD + [" ", "word", "\n"]) for _ in range(rng.randint(0, 6)))) for _ in range(rng.randint(1, 6))]
        text, spans = chat.rendered(turns, ("assistant",))
        assert chat.read_turns(text) == turns
        e = tokenizer.encode(text, add_special_tokens=False)
        mask = chat.masked(e.offsets, spans)
        assert chat.mask_spans(e.offsets, mask) == spans
        decoded = tokenizer.decode([i for i, m in zip(e.ids, mask) if m], skip_special_tokens=False)
        assert decoded == "".join(text[a:b] for a, b in spans)


def test_chat_edge_rows(spark):
    rows = [(1, 0, "user", None, 5), (1, 1, None, "x", 5), (1, 1, None, "x", 5), (None, 0, "assistant", "y", 5), (2, 3, "assistant", "later", 5), (2, 1, "assistant", "first", 5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_turns int")
    out = {r.conv_id: r for r in chat.format_chats(df).collect()}
    assert out[1].n_turns == 3 and out[None].n_turns == 1
    assert [t for _, t in chat.read_turns(out[2].formatted)] == ["first", "later"]
    assert chat.format_chats(df.limit(0)).count() == 0
    nameless = spark.createDataFrame([(None, k % 2, "user", f"t{k % 5}") for k in range(20)], "conv_id long, turn long, role string, text string")
    got = chat.format_chats(nameless).collect()
    assert len(got) == 20 and {r.n_turns for r in got} == {1} and sorted(chat.read_turns(r.formatted)[0][1] for r in got) == sorted(f"t{k % 5}" for k in range(20))
    long = spark.createDataFrame([(1, k, "assistant", "word " * 2000) for k in range(100)], "conv_id long, turn long, role string, text string")
    (one,) = chat.format_chats(long).collect()
    assert one.n_turns == 100 and sum(s.end - s.start for s in one.loss_spans) == 1_000_000


def encoded_by(model, texts, limit=5000):
    data, offsets = string_buffers(pa.array([" " + t if t and model.prefix else t for t in texts], pa.string()))
    got = []
    for lo, hi in slices(offsets, limit):
        a, b = offsets[lo], offsets[hi]
        starts, ends, rows = model.cuttings(data[a:b], offsets[lo : hi + 1] - a)
        ids, many = model.cache.ids(np.append(data[a:b], np.zeros(16, np.uint8)), starts, ends)
        edge = edges(rows, many, 0, hi - lo)
        got += [ids[x:y].tolist() for x, y in zip(edge, edge[1:])]
    return got


def odd_texts():
    rng = random.Random(1)
    texts = ["  a  b\n c ", "", "x", "é　ｆｕｌｌ ﬁ", "\x00\ta", " ", "▁x y", "aaaaaaaaaaaaaaa", " " * 40 + "x", "<s> <0x0A> </s>", "日本語梦 한국어", "🙂🙂", None, "x" * 1000, "日é" * 300, "thing" * 200]
    texts += ["".join(rng.choice("abcdeéñ ti on er\n .,!?-_=019THing    ") for _ in range(rng.randint(1, 60))) for _ in range(800)]
    return texts + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x2000), rng.randrange(0x4E00, 0x9000)])) for _ in range(rng.randint(1, 200))) for _ in range(200)]


def test_transducer_equals_the_library():
    import sentencepiece

    path = packing.tokenizer_path("piece_bpe_32k.model")
    model, library = S.compiled(path), sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [t for (t,) in duckdb.sql(f"SELECT text FROM '{FOLDER}/documents.parquet'").fetchall()][:150] + odd_texts()
    assert encoded_by(model, texts) == library.encode([t or "" for t in texts])
    short = [t for t in texts if t and len(t) < 100]
    assert [model.shortest(" " + t) for t in short] == model.encode([" " + t for t in short])


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def message(*parts):
    """Protocol buffer fields: numbers as varints, floats as four bytes, bytes with their length."""
    out = b""
    for number, value in parts:
        if isinstance(value, float):
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        elif isinstance(value, int):
            out += varint(number << 3) + varint(value)
        else:
            out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


def unigram_model(path, charsmap=b"", trim=0):
    rng = random.Random(6)
    pieces = {"".join(rng.choice("▁abc") for _ in range(rng.randint(1, 4))) for _ in range(60)} | set("▁abcd")
    pieces = sorted(p for p in pieces if "▁" not in p[1:])
    rows = [message((1, b"<unk>"), (2, 0.0), (3, S.UNKNOWN)), message((1, b"<s>"), (2, 0.0), (3, S.CONTROL)), message((1, b"</s>"), (2, 0.0), (3, S.CONTROL))]
    rows += [message((1, b"<0x%02X>" % i), (2, 0.0), (3, S.BYTE)) for i in range(256)]
    rows += [message((1, p.encode()), (2, -1.0 - 7 * rng.random())) for p in pieces]
    trainer = message((3, S.UNIGRAM), (35, 1))
    normaliser = message((1, b"identity"), (2, charsmap), (3, 1), (4, trim), (5, 1))
    path.write_bytes(message(*[(1, r) for r in rows], (2, trainer), (3, normaliser)))
    return str(path)


def test_transducer_of_a_unigram_model(tmp_path):
    import sentencepiece

    path = unigram_model(tmp_path / "unigram.model")
    model, library = S.PieceTransducer(path), sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(3)
    texts = ["".join(rng.choice("aabbccd é") for _ in range(rng.randint(1, 30))) for _ in range(500)] + ["", "a" * 500, "é" * 200]
    assert encoded_by(model, texts) == library.encode(texts)


def test_models_with_another_normaliser_are_refused(tmp_path):
    for k, options in enumerate(({"charsmap": b"xyz"}, {"trim": 1})):
        with pytest.raises(ValueError):
            S.PieceTransducer(unigram_model(tmp_path / f"{k}.model", **options))


def test_span_cache_keeps_nothing_wrong():
    """A table of few places, full again and again."""
    cache = SpanCache(lambda new: [[len(t), *t.encode()][: len(t.encode())] for t in new], slots=64)
    cache.flat = cache.flat[:300]
    rng = random.Random(5)
    for _ in range(60):
        spans = ["".join(rng.choice("abé\x00") for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 14, 15, 16, 17, 40]))) for _ in range(50)]
        raw = [t.encode() for t in spans]
        ends = np.cumsum([len(t) for t in raw])
        ids, many = cache.ids(np.frombuffer(b"".join(raw) + bytes(16), np.uint8), np.append(0, ends[:-1]), ends)
        assert ids.tolist() == [x for t in spans for x in [len(t), *t.encode()][: len(t.encode())]]
        assert many.tolist() == [len(t) for t in raw]


def thue_morse(n, turned=False):
    return "".join("ab"[(bin(i).count("1") + turned) % 2] for i in range(n))


@pytest.mark.parametrize("n", [1024, 2048])
def test_words_that_polynomial_hashes_confuse(spark, n):
    """A Thue-Morse word and its complement have one value under every polynomial hash modulo 2**64 with an odd base."""
    import sentencepiece
    from tokenizers import Tokenizer

    one, two = thue_morse(n), thue_morse(n, True)
    docs = spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string")
    out = {r.doc_id: r for r in S.decode(S.encode(docs)).collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=packing.tokenizer_path("piece_bpe_32k.model"))
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    for i, t in ((1, one), (2, two)):
        assert out[i].decoded == t and np.frombuffer(out[i].ids, np.uint32).tolist() == library.encode(t)
        pieces = sorted((r for r in packing.pack(docs).collect() if r.doc_id == i), key=lambda r: r.start)
        assert [x for r in pieces for x in np.frombuffer(r.ids, np.uint32).tolist()] == tokenizer.encode(t, add_special_tokens=False).ids + [1]


def test_encode_decode_round_trip(spark):
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "  two  words ", 0), (4, "é🙂\n\t", 0), (4, "é🙂\n\t", 0), (None, "▁", 0)], "doc_id long, text string, ids int")
    out = S.decode(S.encode(df)).collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in out) == [(0, " "), (1, ""), (2, ""), (3, "  two  words "), (4, "é🙂\n\t"), (4, "é🙂\n\t")]
    assert S.encode(df.limit(0)).count() == 0


def test_lengths():
    n = np.array([1, 2, 3, 2047, 2048, 2049, 5000])
    parts, many = packing.lengths(n, 2048)
    own = np.split(parts, np.cumsum(many)[:-1])
    for total, p in zip(n, (x.tolist() for x in own)):
        assert sum(p) == total and all(x & (x - 1) == 0 and x <= 2048 for x in p) and p == sorted(p, reverse=True)
    assert packing.lengths(np.array([3]), 1)[0].tolist() == [1, 1, 1]


def test_packing_equals_brute_force(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    odd = [None, "", " ", "a  b", "x　 y", "word " * 3000, "é  z", "\u0085 q", "don't  stop\n\n now", "🙂 🙂", "tail  ", "<|endoftext|> x"]
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet' LIMIT 120").fetchall() + [(10_000 + i, t) for i, t in enumerate(odd)]
    out = packing.pack(spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, start int")).withColumn("crc", F.crc32("ids")).collect()
    assert len({r.sequence_id for r in out}) == len(out)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    for i, t in docs:
        ids, at = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], np.uint32), 0
        for r in sorted(by[i], key=lambda r: r.start):
            assert r.start == at and r.crc == zlib.crc32(ids[at : at + r.length].tobytes()) and r.doc_tokens == len(ids) and r.length == 1 << r.bucket
            at += r.length
        assert at == len(ids)
    frame = spark.createDataFrame(docs[:3] * 2, "doc_id long, text string")
    assert packing.pack(frame).count() == 2 * packing.pack(frame.limit(3)).count() and packing.pack(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(frame, longest=1000)


def brute_nearest(ids, x, query, k=10):
    d = np.sqrt(((x - x[query]) ** 2).sum(1))
    d[query] = np.inf
    order = np.lexsort((ids, d))[:k]
    return [(int(ids[i]), float(d[i])) for i in order if np.isfinite(d[i])]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.1", "/root/testdata/check_s", "/root/testdata/check_l"])
def test_recall_and_distances(spark, folder):
    """2,000, 10,000 and 51,000 vectors; the larger tables where they exist."""
    if not os.path.exists(folder):
        pytest.skip("no such tables here")
    table = pq.read_table(f"{folder}/embeddings.parquet")
    ids, x = table["vec_id"].to_numpy(), np.array(table["embedding"].to_pylist())
    out = {}
    for r in queries.op10_nearest(spark, folder).collect():
        out.setdefault(r.query_id, []).append(r)
    hit = []
    assert set(out) == set(ids[ids % 100 == 0].tolist())
    for q in np.flatnonzero(ids % 100 == 0)[:150]:
        want = brute_nearest(ids, x, q)
        got = sorted(out[ids[q]], key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == list(range(1, 11))
        assert all(abs(r.score - np.sqrt(((x[ids == r.vec_id][0] - x[q]) ** 2).sum())) < 1e-12 for r in got)
        hit.append(len({r.vec_id for r in got} & {i for i, _ in want}) / 10)
    assert np.mean(hit) >= 0.9


def test_neighbours_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PART", 7)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(40, 6)).round(3)
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)] + [(100 + i, [float(v) for v in x[0]], 0) for i in range(30)]
    bad = [(200, None, 0), (201, [0.0] * 6, 0), (202, [1.0, None] + [0.0] * 4, 0), (203, [float("nan")] * 6, 0), (204, [1.0, 2.0], 0), (None, [1.0] * 6, 0)]
    df = spark.createDataFrame(rows + bad + rows[:3], "vec_id long, embedding array<double>, rank int")
    ids, points = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 10 == 0, k=12).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {i for i in ids.tolist() if i % 10 == 0}
    for q, found in got.items():
        assert [f[0] for f in sorted(found)] == list(range(1, 13))
    hot = brute_nearest(ids, points, 0, 12)
    assert [f[1] for f in sorted(got[0])] == [i for i, _ in hot]
    few = neighbours.nearest(df.filter("vec_id < 4"), F.col("vec_id") == 0, k=10).collect()
    assert [r.vec_id for r in sorted(few, key=lambda r: r["rank"])] == [i for i, _ in brute_nearest(ids[:4], points[:4], 0)]
    assert neighbours.nearest(df.limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("n,width,clustered", [(1500, 48, False), (6000, 32, False), (3000, 64, True)])
def test_axes_follow_the_recall(spark, n, width, clustered):
    """Generated vectors: what the sample asks for holds for all queries, at each size and kind of table."""
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, width))
    if clustered:
        x = rng.normal(size=(40, width))[rng.integers(0, 40, n)] + 0.2 * x
    x[5] = x[100]  # equal vectors are no neighbours that the sample counts
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    picked = F.col("vec_id") % 10 == 0
    got = {}
    for r in neighbours.nearest(df, picked, recall=0.9).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = [len(got[q] & {i for i, _ in brute_nearest(np.arange(n), x, q)}) / 10 for q in range(0, n, 10)]
    assert len(hit) == n // 10 and np.mean(hit) >= 0.87
    entries = df.select(F.col("embedding").alias("v")).distinct()
    fit = [neighbours.axes_for(entries, df.filter(picked).select(F.col("vec_id").alias("id"), F.col("embedding").alias("v")), 10, 6, share) for share in (0.5, 0.9, 1.0)]
    assert 1 <= fit[0] <= fit[1] <= fit[2] <= 6 * 2 * 64


def test_axes_of_a_few_vectors_by_hand(spark):
    """The number equals the one from all pairs."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(120, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>").repartition(5)
    place, home = np.argsort(neighbours.visits(x, 3), 1), neighbours.buckets(x, 3)
    need = sorted(int(place[q, home[i]].min()) for q in range(120) for i, _ in brute_nearest(np.arange(120), x, q, 4))
    assert neighbours.axes_for(df.select("v"), df, 4, 3, 0.8) == need[int(np.ceil(0.8 * len(need))) - 1] + 1
    assert neighbours.axes_for(df.select("v"), df.limit(0), 4, 3, 0.8) == 1
    assert neighbours.axes_for(df.filter("id = 3").select("v"), df.filter("id = 3"), 4, 3, 0.8) == 1
