"""The registered queries, as they stand, against brute force over a whole small table."""

import collections
import hashlib
import zlib

import duckdb
import numpy as np
import sentencepiece
from test_dedup import LOW, WORD, brute_components, brute_removal
from tokenizers import Tokenizer

import __spark_entry__
from tenderloom.llm import chat, packing, queries
from tenderloom.llm import language_id as L

FOLDER = "/root/testdata/sf0.001"


def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()


def pieces(rows):
    """(doc_id, start, length, crc32, tokens) of each piece."""
    tokenizer, out = Tokenizer.from_file(packing.tokenizer_path()), []
    for i, t in rows:
        ids, at = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], np.uint32), 0
        while at < len(ids):
            n = min(2048, 1 << ((len(ids) - at).bit_length() - 1))
            out.append((i, at, n, zlib.crc32(ids[at : at + n].tobytes()), len(ids)))
            at += n
    return sorted(out)


def test_op1(spark):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.op1_minhash_dedup(spark, FOLDER).collect()}
    assert got == {i: (n, c, i == c) for i, (n, c) in brute_components(documents(), 4).items()}


def test_op2(spark):
    """Turns, texts of the assistant and lengths from an independent reading of the table."""
    conversations = collections.defaultdict(list)
    for conv, turn, role, text in duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{FOLDER}/conversations.parquet' ORDER BY conv_id, turn").fetchall():
        conversations[conv].append((role, text or ""))
    hard = "<|im_end|><|im_start|>assistant ok"
    conversations[-1] = [("user", hard), ("assistant", hard)]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {}
    for conv, turns in conversations.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        marked = sum(len(chat.START) + len(r) + len(chat.SEP) + len(t.replace("<|", "<\\|")) + len(chat.STOP) + 1 for r, t in turns)
        want[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), marked)
    rows = queries.op2_chat_formatting(spark, FOLDER).collect()
    assert {r.conv_id: tuple(r)[1:] for r in rows} == want and len(rows) == len(want)


def test_op3(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=packing.tokenizer_path("piece_bpe_32k.model"))
    want = {}
    for i, t in documents():
        ids = library.encode(t or "")
        want[i] = (len(ids), zlib.crc32(np.array(ids, np.uint32).tobytes()), len(t or ""), hashlib.sha256((t or "").encode()).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in queries.op3_sentencepiece(spark, FOLDER).collect()} == want


def test_op9(spark):
    rows = queries.op9_packing(spark, FOLDER).collect()
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == pieces(documents())
    assert len({r.sequence_id for r in rows}) == len(rows) and {r.offset for r in rows} == {0}


def test_pipeline(spark):
    """Each stage's rule over what the one before it kept; only the language stage's verdicts come from its operator."""
    models = L.fit_languages(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    gone = {r.doc_id for r in L.identify(spark.read.parquet(f"{FOLDER}/documents.parquet"), models).collect() if r.rejected}
    rows = [(i, t) for i, t in documents() if i not in gone]
    last = {(t or "").translate(LOW): i for i, t in sorted(rows)}
    rows = [(i, t) for i, t in rows if last[(t or "").translate(LOW)] == i]
    kept = {i for i, (_, c) in brute_components(rows, 5).items() if i == c}
    rows = [(i, t) for i, t in rows if i in kept]
    left = brute_removal(rows)
    rows = [(i, left[i][2] if left[i][1] else t) for i, t in rows]
    out = __spark_entry__.queries()["pipeline"](spark, FOLDER).collect()
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out) == pieces(rows)
    assert any(n for _, n, _ in left.values()) and all(WORD.findall(t or "") for _, t in rows)
