"""op12: splitting, the rank queue and decoding against the library."""

import hashlib
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tenderloom.llm import byte_bpe as B
from tenderloom.llm import queries

tiktoken = pytest.importorskip("tiktoken")
FOLDER = "/root/testdata/sf0.001"


def library(name="byte_bpe_multi_50k.tiktoken"):
    import public_tokenizers as P

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=B.vocabulary(P.path(name)).ranks, special_tokens={})


def split(ids, many):
    return [x.tolist() for x in np.split(ids, np.cumsum(many)[:-1])]


def odd_texts():
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzéèñ日本語🙂'’'''  \n\t\x1c\x85 　²½Ⅷ 0123456789.,;!?AAaastmd"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 200))) for _ in range(1500)]
    texts += ["a" * k for k in range(60)] + ["ab" * k for k in range(60)] + ["".join(rng.choice("aab") for _ in range(3000)) for _ in range(10)]
    texts += [" " * k + "x" + " " * k for k in range(30)] + ["".join(rng.choice("qwertzuiopasdf") for _ in range(3_000))]
    return texts + ["it'll we'd 'll'lll's<|endoftext|>", "'", "'s", "''s", "'l", " 's", "  's", "\n's", "x's's'sa'lll", "", "word " * 3000]


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
@pytest.mark.parametrize("limit", [1 << 21, 50])
def test_ids_equal_the_library(name, limit):
    import public_tokenizers as P

    texts, ranks = odd_texts()[:: 1 if limit > 50 else 15], B.RankCache(B.vocabulary(P.path(name)).ranks, slots=1 << 10)
    got = split(*B.encoded(pa.array([*texts, None]), ranks, limit))
    own = library(name)
    assert got == [own.encode_ordinary(t) for t in texts] + [[]]


def test_ranks_that_fall_while_merging():
    """Vocabularies in which a merge opens a pair of lower rank, or whole words that no merges reach."""
    rng = random.Random(5)
    for _ in range(20):
        parts = list({"".join(rng.choice("abc") for _ in range(rng.randint(2, 4))).encode() for _ in range(25)})
        rng.shuffle(parts)
        ranks = {bytes([b]): b for b in range(256)} | {p: 256 + k for k, p in enumerate(parts)}
        own = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
        texts = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 30))) for _ in range(200)]
        assert split(*B.encoded(pa.array(texts), B.RankCache(ranks, slots=256))) == [own.encode_ordinary(t) for t in texts]


def test_a_vocabulary_without_bytes_is_refused():
    with pytest.raises(ValueError, match="bytes"):
        B.RankCache({b"a": 0})


def test_encode_edge_rows(spark, docs_of):
    texts = [*odd_texts()[-80:], None]
    out = B.decode_ranks(B.encode_ranks(docs_of(list(enumerate(texts)) + [(5, "again")] * 2))).collect()
    assert len(out) == len(texts) + 2 and out[-1].ids == out[-2].ids
    own = library()
    for r, t in zip(out, texts):
        ids = own.encode_ordinary(t or "")
        assert (r.n_tokens, bytes(r.ids), bytes(r.decoded)) == (len(ids), np.array(ids, "<u4").tobytes(), (t or "").encode())
    assert B.encode_ranks(docs_of([]).limit(0)).count() == 0
    assert B.decode_ranks(spark.createDataFrame([(1, None)], "doc_id long, ids binary")).first().decoded is None


def test_op12(spark):
    own, want = library(), {}
    for i, t in duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall():
        ids = own.encode_ordinary(t or "")
        want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in queries.op12_byte_bpe(spark, FOLDER).collect()} == want
