"""CLS and EXT: classification of notices and extraction from their texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classify as K
from ..functions import extract as X
from ..functions import rules as R
from ..operators.interim import stored
from ..plans.bindings import notices, spread, table
from ..streaming.incremental import shared_path
from .registry import query
from .scalars import _date_sql  # noqa: F401  the date SQL is shared

C = F.col
_names = list(R.CATEGORIES)
_conf = ", ".join(f"{K.sql_confidence('text', ps)} AS c{i}" for i, ps in enumerate(R.CATEGORIES.values()))
_struct = "[" + ", ".join(f"{{'o': -c{i}, 'p': {i}, 'n': '{n}', 'c': c{i}}}" for i, n in enumerate(_names)) + "]"
#: Notices repeat a few texts' words; labels are checked on all of them.
_LABELS = f"""q AS (SELECT id, text, {K.sql_vetoed('text')} AS bad, {_conf} FROM n),
    l AS (SELECT id, CASE WHEN bad THEN [] ELSE list_sort(list_filter({_struct}, lambda x: x.c IS NOT NULL)) END AS ls FROM q)"""


def labelled(spark, d):
    """Notices with their label array, computed once: filters on it can't be moved below ``explode`` and into the scan's few tasks."""
    return spread(notices(spark, d)).select("id", "text", K.folded(C("text")).alias("t")).select("id", "text", F.explode(F.array(K.labels(C("t")))).alias("found"))


@query(f"n: WITH {_LABELS} SELECT id, array_to_string(list_transform(ls, lambda x: x.n || '=' || CAST(x.c AS VARCHAR)), ';') AS labels FROM l")
def cls01_labels_with_confidence(spark, d):
    return labelled(spark, d).select("id", F.coalesce(F.array_join(F.transform("found", lambda x: F.concat(x["category"], F.lit("="), x["confidence"].cast("string"))), ";"), F.lit("")).alias("labels"))


@query(f"n: WITH {_LABELS} SELECT u.n AS category, count(*) AS n FROM (SELECT unnest(ls) AS u FROM l) GROUP BY 1")
def cls02_all_labels(spark, d):
    return labelled(spark, d).select(F.explode(K.label_names(C("found"))).alias("category")).groupBy("category").agg(F.count("*").alias("n"))


@query(f"n: WITH {_LABELS} SELECT id, CASE WHEN len(ls) > 0 THEN ls[1].n END AS category FROM l")
def cls03_primary_label(spark, d):
    return labelled(spark, d).select("id", K.primary(C("found")).alias("category"))


@query(f"n: WITH {_LABELS} SELECT id FROM l WHERE len(ls) > 0")
def cls04_keep(spark, d):
    return labelled(spark, d).filter(F.size("found") > 0).select("id")


@query(f"n: SELECT id, {K.sql_vetoed('text')} AS vetoed FROM n")
def cls05_veto_with_rescue(spark, d):
    return spread(notices(spark, d)).select("id", K.folded(C("text")).alias("t")).select("id", K.vetoed(C("t")).alias("vetoed"))


_fw = "CASE WHEN " + K.sql_match("subject", R.FRAMEWORK_HINT) + " AND NOT " + K.sql_match("subject", R.FRAMEWORK_VETO) + " THEN " + K.sql_first([(K.sql_match("subject", p), f"{K.quoted(a)} || '/' || {K.quoted(e)} || '/' || '{c}'") for p, a, e, c in R.FRAMEWORKS], "NULL") + " END"


@query(f"n: SELECT id, {_fw} AS framework FROM n")
def cls06_framework(spark, d):
    f = K.framework(C("subject"))
    return notices(spark, d).select("id", f.alias("f")).select("id", F.when(C("f").isNotNull(), F.concat_ws("/", "f.agreement", "f.edition", C("f.confidence").cast("string"))).alias("framework"))


for _name, _rules in (("cls07_fifteen_rules", R.FIFTEEN_RULES), ("cls08_broad_twelve", R.BROAD_TWELVE), ("cls09_broad_fifteen", R.BROAD_FIFTEEN)):

    @query(f"n: SELECT id, {K.sql_passes('text', _rules)} AS kept FROM n", name=_name)
    def _filter(spark, d, rules=_rules):
        return notices(spark, d).select("id", K.passes(C("text"), rules).alias("kept"))


@query("n: SELECT id, " + ", ".join(f"{K.sql_passes('text', rs)} AS {name}" for name, rs in R.STRATEGIES.items()) + " FROM n")
def cls10_strategies(spark, d):
    return notices(spark, d).select("id", *[K.strategy(name)(C("text")).alias(name) for name in R.STRATEGIES])


@query("n: SELECT id FROM n WHERE contains(lower(concat_ws(' ', subject, procedure_raw, kind_raw)), 'servizio luce') OR contains(lower(concat_ws(' ', subject, procedure_raw, kind_raw)), 'accordo quadro')")
def cls11_any_column_keyword(spark, d):
    return notices(spark, d).filter(K.any_keyword([C("subject"), C("procedure_raw"), C("kind_raw")], ["servizio luce", "accordo quadro"])).select("id")


@query("n: SELECT id, TRY_CAST(nullif(regexp_extract(lower(subject), 'servizio luce ([1-4])', 1), '') AS INTEGER) AS edition FROM n")
def cls12_edition(spark, d):
    return notices(spark, d).select("id", K.edition(C("subject")).alias("edition"))


@query(f"n: SELECT id, {K.sql_procedure('procedure_raw')} AS procedure FROM n")
def cls13_procedure(spark, d):
    return notices(spark, d).select("id", K.procedure(C("procedure_raw")).alias("procedure"))


@query("n: SELECT id, regexp_matches(upper(concat_ws(' ', procedure_raw, subject)), 'MINOR|PREZZO') AS minor FROM n")
def cls14_minor_price(spark, d):
    return notices(spark, d).select("id", K.minor_price(C("procedure_raw"), C("subject")).alias("minor"))


@query(f"""n: WITH {_LABELS}, s AS (SELECT l.id, n.text, CASE WHEN len(ls) > 0 THEN ls[1].c ELSE 0.0e0 END AS score FROM l JOIN n USING (id))
    SELECT id, score, nullif(regexp_extract(text, '(?i)CIG[:\\s]+([A-Z0-9]{{10}})', 1), '') AS code FROM s WHERE score > 0.7""")
def cls15_relevance_gate(spark, d):
    """The cheap score first; the expensive extraction only for what passes."""
    df = labelled(spark, d).select("id", "text", F.coalesce(F.try_element_at("found", F.lit(1))["confidence"], F.lit(0.0)).alias("score")).filter("score > 0.7")
    return df.select("id", "score", X.lot_code_in(C("text")).alias("code"))


@query("""WITH h AS (SELECT doc_id, sha256(text) AS h FROM documents), done AS (SELECT DISTINCT h FROM h WHERE doc_id % 3 = 0)
    SELECT doc_id, h AS hash FROM h WHERE h NOT IN (SELECT h FROM done)""")
def cls16_result_cache(spark, d):
    """Texts whose content hash is not in the ledger of processed ones."""
    from ..operators.dedup import not_in_ledger

    hashed = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("hash"))
    return not_in_ledger(hashed, hashed.filter("doc_id % 3 = 0"), "hash")


_numbers = r"list_filter(list_transform(regexp_extract_all(text, '\d{1,3}(?:\.\d{3})*(?:,\d+)?|\d+(?:,\d+)?'), lambda x: TRY_CAST(replace(replace(x, '.', ''), ',', '.') AS DOUBLE)), lambda x: x IS NOT NULL)"


@query(f"""WITH h AS (SELECT doc_id, sha256(text) AS hash, list_max(list_filter({_numbers}, lambda x: x > 100)) AS own FROM documents), l AS (SELECT hash, CAST(min(-doc_id) AS DOUBLE) AS old FROM h WHERE doc_id % 3 = 0 AND hash IS NOT NULL GROUP BY hash)
    SELECT doc_id, CASE WHEN l.hash IS NULL THEN own ELSE old END AS highest, l.hash IS NOT NULL AS seen, (SELECT count(DISTINCT hash) FROM h) AS ledger FROM h LEFT JOIN l USING (hash)""")
def cls17_cached_verdicts(spark, d):
    """Texts met before carry the ledger's verdict (here one that judging again would not give); new ones are judged and recorded."""
    from ..operators import dedup as D

    hashed = table(spark, d, "documents").select("doc_id", "text", F.sha2("text", 256).alias("hash"))
    ledger = hashed.filter("doc_id % 3 = 0 and hash is not null").groupBy("hash").agg(F.min(-C("doc_id")).cast("double").alias("highest"))
    out = D.with_verdicts(hashed, ledger, "hash", ["highest"], lambda new: new.withColumn("highest", X.highest_number_in(C("text"))))
    size = D.record(ledger, out, "hash", ["highest"]).agg(F.count("*").alias("ledger"))
    return out.select("doc_id", "highest", "seen").crossJoin(F.broadcast(size))


@query("""WITH h AS (SELECT doc_id, sha256(text) AS hash, CAST(length(text) AS BIGINT) AS size FROM documents), done AS (SELECT DISTINCT hash FROM h WHERE doc_id % 3 = 0 AND hash IS NOT NULL)
    SELECT doc_id, size, CASE WHEN done.hash IS NULL THEN 2 ELSE 1 END AS run, done.hash IS NOT NULL AS seen, (SELECT count(DISTINCT hash) FROM h) AS ledger FROM h LEFT JOIN done USING (hash)""")
def cls18_stored_ledger(spark, d):
    """Two runs over a stored, bucketed ledger: texts that the first one judged keep its verdict in the second."""
    from ..operators.ledger import Ledger

    path = shared_path(spark, "ledger")
    hashed = table(spark, d, "documents").select("doc_id", "text", F.sha2("text", 256).alias("hash"))
    for run, rows in ((1, hashed.filter("doc_id % 3 = 0")), (2, hashed)):
        ledger = Ledger(spark, path, "size long, run int", buckets=16)
        out = ledger.judged(rows, lambda new, run=run: new.withColumns({"size": F.char_length("text").cast("long"), "run": F.lit(run)}))
        out = stored(out.select("doc_id", "hash", "size", "run", "seen"))  # the answer is of the ledger as it was
        ledger.record(out)
    return out.drop("hash").crossJoin(F.broadcast(ledger.rows().agg(F.count("*").alias("ledger"))))


@query(r"""n: SELECT id, coalesce(nullif(regexp_extract(text, '(?i)CIG[:\s]+([A-Z0-9]{10})', 1), ''), list_filter(regexp_extract_all(text, '\b[A-Z0-9]{10}\b'), lambda x: regexp_matches(x, '^(?:[0-9]|Z0|Y0|X0)'))[1]) AS code FROM n""")
def ext01_lot_code(spark, d):
    return notices(spark, d).select("id", X.lot_code_in(C("text")).alias("code"))


@query(r"n: SELECT id, TRY_CAST(replace(replace(regexp_extract(text, '(?i)euro\s*([\d.,]+)', 1), '.', ''), ',', '.') AS DOUBLE) AS amount FROM n")
def ext02_amount(spark, d):
    return notices(spark, d).select("id", X.amount_in(C("text")).alias("amount"))


_it = "lower(regexp_extract(text, '(?i)(\\d{1,2}\\s+(?:" + "|".join(R.MONTHS) + ")\\s+\\d{4})', 1))"
for _i, _m in enumerate(R.MONTHS, 1):
    _it = rf"regexp_replace({_it}, '\s+{_m}\s+', '/{_i:02d}/')"


@query(f"n: SELECT id, strftime(try_strptime({_it}, '%d/%m/%Y'), '%Y-%m-%d') AS day FROM n")
def ext03_date(spark, d):
    return notices(spark, d).select("id", X.date_in(C("text")).alias("day"))


@query(r"n: SELECT id, trim(regexp_replace(regexp_extract(text, '(?i)comune\s+di\s+([^,\n]+)', 1), '\s+', ' ', 'g')) AS entity FROM n")
def ext04_entity(spark, d):
    return notices(spark, d).select("id", X.entity_in(C("text")).alias("entity"))


@query(rf"""n: SELECT id, substr(text, 1, 500) AS head, sha256(text) AS hash, CAST(length(text) AS INTEGER) AS length, nullif(regexp_extract(text, '(?i)CIG[:\s]+([A-Z0-9]{{10}})', 1), '') AS code,
    TRY_CAST(replace(replace(regexp_extract(text, '(?i)euro\s*([\d.,]+)', 1), '.', ''), ',', '.') AS DOUBLE) AS amount, strftime(try_strptime({_it}, '%d/%m/%Y'), '%Y-%m-%d') AS date,
    trim(regexp_replace(regexp_extract(text, '(?i)comune\s+di\s+([^,\n]+)', 1), '\s+', ' ', 'g')) AS entity FROM n""")
def ext05_batch_row(spark, d):
    return X.notice_fields(spread(notices(spark, d)).select("id", "text"), "text").drop("text")




@query(rf"""n: SELECT id, list_max({_numbers}) AS highest, nullif(trim(regexp_extract(text, '[Aa]ggiudicat[oa].{{0,40}}?\b([A-Z][\w&''.-]+(?:\s+[A-Z][\w&''.-]+){{0,6}})', 1)), '') AS winner FROM n""")
def ext06_regex_lot(spark, d):
    return notices(spark, d).select("id", F.array_max(X.numbers_in(C("text"))).alias("highest"), X.winner_in(C("text")).alias("winner"))


_pats = X.DISCOUNT_PATTERNS


@query("n: SELECT id, coalesce(" + ", ".join(f"(SELECT CASE WHEN v BETWEEN 0 AND 100 THEN v END FROM (SELECT TRY_CAST(replace(nullif(regexp_extract(discount_raw, {K.quoted(p)}, 1), ''), ',', '.') AS DOUBLE) AS v))" for p in _pats) + ") AS discount FROM n")
def ext07_discount(spark, d):
    return notices(spark, d).select("id", X.discount_in(C("discount_raw")).alias("discount"))


@query(f"n: SELECT id, {_numbers}[1] AS first_number, len({_numbers}) AS n_numbers FROM n")
def ext08_numbers(spark, d):
    found = X.numbers_in(C("text"))
    return notices(spark, d).select("id", X.first_number_in(C("text")).alias("first_number"), F.size(found).cast("long").alias("n_numbers"))


@query(f"SELECT doc_id, list_max(list_filter({_numbers}, lambda x: x > 100)) AS highest FROM documents")
def ext09_highest_number(spark, d):
    return table(spark, d, "documents").select("doc_id", X.highest_number_in(C("text")).alias("highest"))


@query(r"n: SELECT id, regexp_replace(discount_raw, '\D', '', 'g') AS digits FROM n")
def ext10_digits(spark, d):
    return notices(spark, d).select("id", X.digits_of(C("discount_raw")).alias("digits"))


@query("""n: WITH s AS (SELECT id, 'Lotto 1: ' || subject || ' Lotto 2: ' || procedure_raw AS txt, subject, procedure_raw FROM n WHERE procedure_raw IS NOT NULL)
    SELECT id, sha256(txt) AS group_hash, CAST(k AS INTEGER) AS lot_no, 2 AS n_lots, CASE k WHEN 1 THEN trim(subject) ELSE trim(procedure_raw) END AS lot_text FROM s, range(1, 3) AS r(k)""")
def ext11_multi_lot_rows(spark, d):
    df = notices(spark, d).filter("procedure_raw is not null").select("id", F.concat(F.lit("Lotto 1: "), "subject", F.lit(" Lotto 2: "), "procedure_raw").alias("txt"))
    return X.lot_rows(df, "txt").drop("txt")
