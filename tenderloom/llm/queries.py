"""The thin queries of this subpackage: tables in, digest columns out; and their SQL where SQL can say it."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .byte_bpe import decode_ranks, encode_ranks
from .chat import format_chats, read_turns, unescaped
from .collocations import collocations
from .exact_dedup import exact_dedup
from .html_text import extract, learn_weights
from .language_id import fit_languages, fold, identify
from .minhash_dedup import minhash_dedup
from .neighbours import nearest
from .packing import pack
from .quality import score_quality
from .resampling import resample
from .sentencepiece_fst import decode, encode
from .substring_dedup import substring_dedup


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle_words=4, percent=80)


@F.pandas_udf(T.StructType().add("turns_sha256", "string").add("loss_chars", "long").add("loss_sha256", "string").add("formatted_chars", "long"))
def chat_digest(formatted: pd.Series, spans: pd.Series) -> pd.DataFrame:
    """Read back from the output: turns from the formatted text, loss texts from the masked tokens' spans."""
    out = []
    for text, own in zip(formatted, spans):
        turns = "".join(f"{role}\n{body}\n" for role, body in read_turns(text))
        loss = "".join(unescaped(text[s["start"] : s["end"]]) for s in own)
        out.append((hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
    return pd.DataFrame(out, columns=["turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], rows.schema)
    out = format_chats(rows.unionByName(extra)).withColumn("d", chat_digest("formatted", "loss_spans"))
    return out.select("conv_id", "n_turns", "d.turns_sha256", "d.loss_chars", "d.loss_sha256", "d.formatted_chars")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decode(encode(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return out.select("doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"), F.char_length("decoded").cast("long").alias("decoded_chars"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    models = fit_languages(docs.filter(fold("doc_id", 5) != 0))
    out = identify(docs.select("doc_id", "text"), models)
    return out.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "rejected", "cross_entropy")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages.select("page_id", "url", "html"), learn_weights(pages)).select("page_id", "url", "text", "n_chars")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score_quality(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    return out.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decode_ranks(encode_ranks(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("text"))
    return out.select("doc_id", "n_features", "weight", "score", "rank", "n_words")


QUERIES = {f.__name__: f for f in (op1_minhash_dedup, op2_chat_formatting, op3_sentencepiece, op4_exact_dedup, op5_html_text, op6_quality, op7_language_id, op8_substring_dedup, op9_packing, op10_nearest, op11_collocations, op12_byte_bpe, op13_importance_resampling)}

LOWER_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op4_exact_dedup": f"""
        WITH d AS (SELECT DISTINCT doc_id, {LOWER_AZ} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
        FROM d WINDOW g AS (PARTITION BY t)
    """,
    "op8_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 12], ' ')) AS h
              FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
        f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS lo FROM s),
        g AS (SELECT DISTINCT doc_id, i + j AS p FROM f, range(13) AS r(j) WHERE lo < doc_id),
        r AS (SELECT doc_id, list(p) AS ps FROM g GROUP BY doc_id)
        SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
               sha256(array_to_string(CASE WHEN ps IS NULL THEN w ELSE
                   list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(ps, x[2])), lambda x: x[1]) END, ' ')) AS kept_sha256
        FROM d LEFT JOIN r USING (doc_id)
    """,
    "op11_collocations": rf"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array({LOWER_AZ}, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM documents),
        g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM p, range(1, 5) AS r(k) WHERE len(w) >= k)),
        f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
        n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
        c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
        s AS (SELECT c.lang, c.phrase, c.k, c.a, x.cut, h.a AS l, t.a AS r, ((2000000::HUGEINT * c.a) // (h.a::HUGEINT + t.a))::BIGINT AS score
              FROM c JOIN range(1, 4) AS x(cut) ON x.cut < c.k
              JOIN f h ON h.lang = c.lang AND h.k = x.cut AND h.phrase = array_to_string(c.w[1:x.cut], ' ')
              JOIN f t ON t.lang = c.lang AND t.k = c.k - x.cut AND t.phrase = array_to_string(c.w[x.cut + 1:], ' ')),
        b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        i AS (SELECT lang, array_to_string(w[y.i:y.i + z.m - 1], ' ') AS phrase, max(a) AS longer
              FROM c JOIN range(2, 4) AS z(m) ON z.m < c.k JOIN range(1, 4) AS y(i) ON y.i + z.m - 1 <= c.k GROUP BY 1, 2),
        q AS (SELECT b.lang, b.phrase, b.a, b.l, b.r, b.score, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank
              FROM b LEFT JOIN i USING (lang, phrase) WHERE i.longer IS NULL OR 100::HUGEINT * i.longer < 80::HUGEINT * b.a)
        SELECT lang, rank, phrase, a, l, r, n, score FROM q JOIN n USING (lang) WHERE rank <= 2000
    """,
}
