"""PL: the composed pipelines on the raw notices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classify as K
from ..functions import rules as R
from ..functions.extract import DISCOUNT_PATTERNS
from ..plans import pipelines as P
from ..plans.bindings import notices
from .nested import _base, lot_code_records, releases
from .registry import query
from ..operators import nested as N

C = F.col


def _sentinel(e: str) -> str:
    return f"CASE WHEN lower(trim({e})) NOT IN ('', 'nan', 'none', 'null') THEN trim({e}) END"


def _first(e: str) -> str:
    return f"upper({_sentinel(f'string_split({e}, chr(59))[1]')})"


def _framework(name: str, rows: str) -> str:
    """The framework table of some notices, as SQL."""
    first = lambda k: K.sql_first([(K.sql_match("subject", x[0]), f"{x[3]}e0" if k == 3 else K.quoted(x[k])) for x in R.FRAMEWORKS], "NULL")
    hint = f"{K.sql_match('subject', R.FRAMEWORK_HINT)} AND NOT {K.sql_match('subject', R.FRAMEWORK_VETO)}"
    return f"""{name} AS (SELECT * FROM (SELECT id, {_first('code_raw')} AS code, code_raw AS codes, subject, entity_raw AS buyer, award, award_date, {first(1)} AS agreement, {first(2)} AS edition, {first(3)} AS confidence, source
        FROM {rows} AND {hint}) WHERE agreement IS NOT NULL QUALIFY code IS NULL OR row_number() OVER (PARTITION BY code ORDER BY CASE source WHEN 'OCDS' THEN 0 ELSE 1 END, id) = 1)"""


_discount = "coalesce(" + ", ".join(f"(SELECT CASE WHEN v BETWEEN 0 AND 100 THEN v END FROM (SELECT TRY_CAST(replace(nullif(regexp_extract(discount_raw, {K.quoted(x)}, 1), ''), ',', '.') AS DOUBLE) AS v))" for x in DISCOUNT_PATTERNS) + ")"
_section = "CASE upper(trim(section_raw)) WHEN 'SEZIONE REGIONALE LOMBARDIA' THEN 'Lombardia' WHEN 'SEZIONE REGIONALE EMILIA ROMAGNA' THEN 'Emilia-Romagna' END"
_method = "CASE method_raw " + " ".join(f"WHEN {K.quoted(k)} THEN {K.quoted(v)}" for k, v in R.METHOD_LABELS.items()) + " ELSE method_raw END"
_title = "CASE WHEN o_orderkey % 2 = 0 THEN 'Procedura ' || substr(o_orderpriority, 1, 2) || upper(substr(o_orderpriority, 3, 1)) || lower(substr(o_orderpriority, 4)) ELSE o_orderpriority END"
#: The four sources in the canonical columns, as SQL.
_SOURCES = f"""{_framework('fw', 'n WHERE true')}, u AS (
    SELECT 'Gazzetta' AS fonte, {_sentinel('code_raw')} AS cig, NULL AS ocid, {_sentinel('subject')} AS oggetto, round(award, 2) AS importo, round({_discount}, 4) AS sconto, award_date AS day, {_sentinel('town_raw')} AS comune,
        {_sentinel('entity_raw')} AS ente, NULL AS regione, NULL AS aggiudicatario, {_sentinel('procedure_raw')} AS procedura, NULL AS cpv, NULL AS accordo, NULL AS edizione FROM n WHERE source = 'Gazzetta'
    UNION ALL SELECT 'OCDS', NULL, 'ocds-' || o_orderkey, 'Gara ' || any_value(o_orderstatus), round(sum(l_extendedprice), 2), CASE WHEN sum(l_extendedprice) > 0 THEN 0.0e0 END, CAST(any_value(o_orderdate) AS DATE), NULL, any_value(c_name),
        CASE any_value(o_orderkey % 3) WHEN 0 THEN 'Lombardia' WHEN 1 THEN 'Lazio' END, any_value(coalesce(s_name, 'nessuno')), any_value({_title}), '45000000', NULL, NULL {_base} GROUP BY o_orderkey
    UNION ALL SELECT 'CIG_JSON', {_first('code_raw')}, NULL, {_sentinel('subject')}, round(award, 2), round(CASE WHEN base > 0 AND award > 0 AND award <= base THEN (base - award) / base * 100 END, 4), award_date, NULL, {_sentinel('entity_raw')},
        {_section}, NULL, {_sentinel(_method)}, CAST(id AS VARCHAR), NULL, NULL FROM n
    UNION ALL SELECT 'CONSIP', code, NULL, {_sentinel('subject')}, round(award, 2), NULL, award_date, NULL, {_sentinel('buyer')}, NULL, NULL, NULL, NULL, {_sentinel('agreement')}, {_sentinel('edition')} FROM fw)"""


def sources(spark, d):
    n = notices(spark, d)
    return [
        P.from_gazette(notices(spark, d, by_place=True).filter("source = 'Gazzetta'")),
        P.from_releases(N.flat_release(releases(spark, d)).withColumnsRenamed({"title": "subject", "full_text": "text"})),
        P.from_releases(N.flat_lot_code(lot_code_records(spark, d)), "CIG_JSON"),
        P.from_frameworks(P.framework_table(n)),
    ]


@query()
def pl01_standardised(spark, d):
    """All sources in the canonical columns."""
    from ..operators.joins import union_aligned

    return union_aligned(sources(spark, d))


@query(f"n: WITH {_SOURCES} SELECT * FROM u")
def pl09_standardised_golden(spark, d):
    """pl01 in the columns that say most, as SQL derives them from the raw tables."""
    df = pl01_standardised(spark, d)
    kept = {"oggetto": "oggetto", "comune": "comune", "ente": "ente_appaltante", "regione": "regione", "aggiudicatario": "aggiudicatario", "cpv": "cpv_code", "accordo": "tipo_accordo", "edizione": "edizione"}
    return df.select("fonte", "cig", "ocid", F.round("importo_aggiudicazione", 2).alias("importo"), F.round("sconto", 4).alias("sconto"), C("data_aggiudicazione").cast("date").alias("day"), F.regexp_replace("procedura", "Not Specified", "Not specified").alias("procedura"), *[C(v).alias(k) for k, v in kept.items()])


@query(f"""n: WITH {_SOURCES}, k AS (SELECT fonte, {_first('cig')} AS key, CASE fonte WHEN 'Gazzetta' THEN 0 WHEN 'CONSIP' THEN 1 WHEN 'OCDS' THEN 2 ELSE 3 END AS prio FROM u)
    SELECT key AS cig, arg_min(fonte, prio) AS fonte, 1 AS n FROM k WHERE key IS NOT NULL GROUP BY key UNION ALL SELECT NULL, fonte, count(*) FROM k WHERE key IS NULL GROUP BY fonte""")
def pl10_unified_keys(spark, d):
    """Which source's row stays for each code, and how many rows without a code, of the unified table."""
    return P.unify(sources(spark, d), years=(1990, 2030)).groupBy("cig", "fonte").agg(F.count("*").alias("n"))


@query()
def pl02_unified(spark, d):
    return P.unify(sources(spark, d), fuzzy=True, years=(1990, 2030))


@query(f"""n: WITH {_framework('f', 'n WHERE id % 2 = 1')}, {_framework('h', 'n WHERE id % 2 = 0')}, codes AS (SELECT DISTINCT upper(trim(unnest(string_split(codes, ';')))) AS k FROM f)
    SELECT * FROM f UNION ALL SELECT NULL, code, NULL, subject, NULL, NULL, NULL, agreement, edition, NULL, NULL FROM h WHERE code IS NULL OR upper(trim(code)) NOT IN (SELECT k FROM codes WHERE k IS NOT NULL AND k <> '')""")
def pl03_framework_table(spark, d):
    n = notices(spark, d)
    history = P.framework_table(n.filter("id % 2 = 0")).select("code", "subject", "agreement", "edition")
    return P.framework_table(n.filter("id % 2 = 1"), history)


@query("""n: WITH m AS (SELECT id, lpad(CAST(id // 3 AS VARCHAR), 10, '0') AS code, award_date AS d FROM n), r AS (SELECT lpad(CAST(id // 3 AS VARCHAR), 10, '0') AS code, min(subject) AS subject FROM n GROUP BY 1),
    a AS (SELECT lpad(CAST(id // 3 AS VARCHAR), 10, '0') AS code, round(award, 2) AS award FROM n)
    SELECT id, code, strftime(d, '%d/%m/%Y') AS data_verbale, subject, award FROM m LEFT JOIN r USING (code) LEFT JOIN a USING (code)""")
def pl04_minutes_table(spark, d):
    """All notices as minutes; neighbours share a code, whose award rows multiply."""
    n = notices(spark, d).withColumn("code", F.lpad(F.floor(C("id") / 3).cast("string"), 10, "0"))
    registry = n.groupBy("code").agg(F.min("subject").alias("subject"))
    return P.minutes_table(registry, n.select("id", "code", C("award_date").alias("data_verbale")), n.select("code", F.round("award", 2).alias("award")))


@query("""n: WITH m AS (SELECT id, lpad(CAST(id // 2 AS VARCHAR), 10, '0') AS code, award_date AS d FROM n), r AS (SELECT code, min(s) AS subject FROM (SELECT lpad(CAST(id // 2 AS VARCHAR), 10, '0') AS code, CASE WHEN id % 5 = 0 THEN subject END AS s FROM n) GROUP BY 1),
    a AS (SELECT lpad(CAST(id // 2 AS VARCHAR), 10, '0') AS code, CASE WHEN id % 7 = 0 THEN round(award, 2) END AS award FROM n)
    SELECT id, code, strftime(d, '%d/%m/%Y') AS data_verbale, subject, award FROM m LEFT JOIN r USING (code) LEFT JOIN a USING (code)""")
def pl08_minutes_of_all_notices(spark, d):
    """As pl04; registry and awards have gaps in their columns."""
    n = notices(spark, d).withColumn("code", F.lpad(F.floor(C("id") / 2).cast("string"), 10, "0"))
    registry = n.groupBy("code").agg(F.min(F.when(C("id") % 5 == 0, C("subject"))).alias("subject"))
    awards = n.select("code", F.when(C("id") % 7 == 0, F.round("award", 2)).alias("award"))
    return P.minutes_table(registry, n.select("id", "code", C("award_date").alias("data_verbale")), awards)


@query("""n: WITH r AS (SELECT id, lpad(CAST(id AS VARCHAR), 10, '0') AS code, subject, text, base FROM n WHERE contains(lower(concat_ws(' ', subject, text)), 'servizio luce') OR contains(lower(concat_ws(' ', subject, text)), 'illuminazione pubblica') OR contains(lower(concat_ws(' ', subject, text)), 'pubblica illuminazione')),
    a AS (SELECT lpad(CAST(id AS VARCHAR), 10, '0') AS code, award, award_date, CAST(award_date + to_days(CAST(id % 400 AS INTEGER)) AS DATE) AS expiry FROM n WHERE id % 2 = 0)
    SELECT id, code, TRY_CAST(nullif(regexp_extract(lower(concat_ws(' ', subject, text)), 'servizio luce ([1-4])', 1), '') AS INTEGER) AS edition, round(CASE WHEN award > 0 AND award <= base THEN (base - award) / base * 100 END, 4) AS discount,
        CASE WHEN date_diff('day', award_date, expiry) BETWEEN 1 AND 10949 THEN CAST(date_diff('day', award_date, expiry) AS INTEGER) END AS days, 'https://portale.example/' || code AS url FROM r LEFT JOIN a USING (code)""")
def pl05_lighting_table(spark, d):
    n = notices(spark, d).withColumn("code", F.lpad(C("id").cast("string"), 10, "0"))
    gaps = lambda c, name: F.when(C("id") % 2 == 0, c).alias(name)
    awards = n.select("code", gaps(C("award"), "award"), gaps(C("award_date"), "award_date"), gaps(F.date_add("award_date", (C("id") % 400).cast("int")), "expiry_date"))
    out = P.lighting_table(n.select("id", "code", "subject", "text", "base"), awards, "https://portale.example/")
    return out.select("id", "code", "edition", F.round("discount", 4).alias("discount"), "days", "url")


@query("""n: WITH k AS (SELECT *, CASE WHEN lower(trim(string_split(code_raw, ';')[1])) NOT IN ('', 'nan', 'none', 'null') THEN upper(trim(string_split(code_raw, ';')[1])) END AS code FROM n)
    SELECT id, code, upper(trim(regexp_replace(subject, '\\s+', ' ', 'g'))) AS subject, id % 9 = 0 AS flag, regexp_matches(upper(concat_ws(' ', procedure_raw, subject)), 'MINOR|PREZZO') AS minor FROM k QUALIFY code IS NULL OR row_number() OVER (PARTITION BY code ORDER BY id) = 1""")
def pl06_final_transform(spark, d):
    n = notices(spark, d)
    return P.final_transform(n, n.filter("id % 9 = 0").select("id")).select("id", "code", "subject", "flag", "minor")


@query("n: SELECT id, CASE WHEN lower(trim(code_raw)) NOT IN ('', 'nan', 'none', 'null') THEN 'https://portale.example/doc/' || trim(code_raw) END AS url FROM n")
def pl07_document_urls(spark, d):
    return P.with_urls(notices(spark, d), "code_raw", "https://portale.example/doc/").select("id", "url")
