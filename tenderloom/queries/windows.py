"""WN, SL, SO: windows, search, sampling, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import dedup as D
from ..operators import joins as J
from ..operators import metrics as M
from ..operators import search as Q
from ..operators import windows as W
from ..operators.ordering import Ordered, numbered
from ..operators.trigrams import TrigramIndex
from ..plans.bindings import notices, table, tenders
from ..streaming.incremental import shared_path
from .registry import query

C = F.col


@query("""t: WITH g AS (SELECT supplier, sum(amount) AS v FROM t GROUP BY 1) SELECT supplier, round(v, 2) AS value, row_number() OVER w AS rank, round(sum(v) OVER w, 2) AS cumulative, round(sum(v) OVER w * 100 / sum(v) OVER (), 4) AS percent
    FROM g WINDOW w AS (ORDER BY v DESC, supplier ROWS UNBOUNDED PRECEDING)""")
def wn01_concentration_curve(spark, d):
    out = W.concentration_curve(tenders(spark, d), "supplier", "amount")
    return out.select("supplier", F.round("value", 2).alias("value"), "rank", F.round("cumulative", 2).alias("cumulative"), F.round("percent", 4).alias("percent"))


@query("""WITH e AS (SELECT event_id, user_id, ts, CASE WHEN event_id % 3 = 0 THEN value END AS v FROM events)
    SELECT event_id, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS v FROM e""")
def wn02_fill_within_group(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "ts", F.when(C("event_id") % 3 == 0, C("value")).alias("v"))
    return D.filled(e, "v", ["user_id"], [C("ts"), C("event_id")]).select("event_id", "v")


@query("""n: WITH k AS (SELECT id, nullif(code_raw, '') AS code, CASE WHEN id % 7 <> 0 THEN text END AS text, subject, town_raw, award_date FROM n),
    a AS (SELECT id, text, subject, town_raw, award_date, CASE WHEN text IS NOT NULL THEN coalesce(last_value(code IGNORE NULLS) OVER (PARTITION BY text ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        first_value(code IGNORE NULLS) OVER (PARTITION BY text ORDER BY id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) ELSE code END AS code FROM k)
    SELECT id, CASE WHEN subject IS NOT NULL AND town_raw IS NOT NULL AND award_date IS NOT NULL THEN coalesce(last_value(code IGNORE NULLS) OVER (PARTITION BY subject, town_raw, award_date ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        first_value(code IGNORE NULLS) OVER (PARTITION BY subject, town_raw, award_date ORDER BY id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) ELSE code END AS code FROM a""")
def wn11_fill_by_two_keys(spark, d):
    """Codes filled from rows of the same text, then from those of the same subject, town and date; rows without a key stay as they are."""
    n = notices(spark, d).select("id", F.nullif("code_raw", F.lit("")).alias("code"), F.when(C("id") % 7 != 0, C("text")).alias("text"), "subject", "town_raw", "award_date")
    return D.filled_by(n, "code", [["text"], ["subject", "town_raw", "award_date"]], [C("id")]).select("id", "code")


@query("t: WITH g AS (SELECT region, category, sum(amount) AS v FROM t GROUP BY 1, 2) SELECT region, category, round(v * 100 / sum(v) OVER (PARTITION BY region), 4) AS share FROM g")
def wn03_share_of_total(spark, d):
    return M.shares(tenders(spark, d), ["region"], "category", "amount").select("region", "category", F.round("share", 4).alias("share"))


@query("""t: WITH g AS (SELECT supplier, sum(amount) AS v, coalesce(sum(amount) FILTER (year = 1996), 0) AS v0, coalesce(sum(amount) FILTER (year = 1999), 0) AS v1, count(*) FILTER (year = 1996) AS n0, count(*) FILTER (year = 1999) AS n1 FROM t GROUP BY 1 ORDER BY v DESC, supplier LIMIT 10)
    SELECT supplier, round(v, 2) AS total, round(CASE WHEN v0 > 0 THEN (v1 - v0) * 100.0 / v0 WHEN v1 > 0 THEN 100.0 ELSE 0.0 END, 1) AS value_growth,
        round(CASE WHEN n0 > 0 THEN (n1 - n0) * 100.0e0 / n0 WHEN n1 > 0 THEN 100.0e0 ELSE 0.0e0 END, 1) AS count_growth FROM g""")
def wn04_growth(spark, d):
    return M.growth(tenders(spark, d), "supplier", "year", "amount", 1996, 1999)


@query("t: WITH s AS (SELECT supplier FROM t GROUP BY 1 ORDER BY sum(amount) DESC, supplier LIMIT 5) SELECT supplier, year, count(*) AS n, round(sum(amount), 2) AS total FROM t WHERE supplier IN (SELECT supplier FROM s) GROUP BY 1, 2")
def wn05_series_of_top(spark, d):
    df = tenders(spark, d)
    top = df.groupBy("supplier").agg(F.sum("amount").alias("v")).orderBy(F.desc("v"), "supplier").limit(5)
    return df.join(F.broadcast(top.select("supplier")), "supplier", "left_semi").groupBy("supplier", "year").agg(F.count("*").alias("n"), F.round(F.sum("amount"), 2).alias("total"))


@query("WITH m AS (SELECT avg(o_totalprice) AS a, stddev_samp(o_totalprice) AS s FROM orders) SELECT o_orderkey AS id, round((o_totalprice - a) / s, 6) AS z FROM orders, m WHERE abs((o_totalprice - a) / s) > 1.5")
def wn06_z_outliers(spark, d):
    return W.z_outliers(table(spark, d, "orders").select(C("o_orderkey").alias("id"), "o_totalprice"), "o_totalprice", 1.5).select("id", F.round("z", 6).alias("z"))


@query("""WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events WHERE value BETWEEN 0 AND 100)
    SELECT event_id, value FROM events, q WHERE value < a - 0.5 * (b - a) OR value > b + 0.5 * (b - a)""")
def wn07_iqr_outliers(spark, d):
    return W.iqr_outliers(table(spark, d, "events").select("event_id", "value"), "value", 0, 100, 0.5)


@query("t: SELECT count(*) FILTER (discount > 8) AS high, count(*) FILTER (discount BETWEEN 0 AND 2) AS low, count(*) FILTER (amount > 50000) AS large, count(*) FILTER (amount > 90000) AS very_large FROM t")
def wn08_threshold_anomalies(spark, d):
    return tenders(spark, d).agg(F.count_if(C("discount") > 8).alias("high"), F.count_if(C("discount").between(0, 2)).alias("low"), F.count_if(C("amount") > 50_000).alias("large"), F.count_if(C("amount") > 90_000).alias("very_large"))


_years = list(range(1995, 2002))


@query("t: SELECT category, " + ", ".join(f"count(*) FILTER (year = {y}) AS c{y}" for y in _years) + " FROM t GROUP BY category")
def wn09_pivot(spark, d):
    return W.pivoted(tenders(spark, d), "category", "year", _years, F.count("key"))


@query("n: WITH g AS (SELECT CAST(month(award_date) AS INTEGER) AS m, count(*) AS n FROM n GROUP BY 1) SELECT (SELECT m FROM g ORDER BY n DESC, m LIMIT 1) AS most, (SELECT m FROM g ORDER BY n, m LIMIT 1) AS least")
def wn10_busiest_month(spark, d):
    return W.extremes(notices(spark, d).select(F.month("award_date").alias("m")), "m")


@query("n: SELECT id, date_raw FROM n")
def sl01_sort_nulls_last(spark, d):
    """All rows in order; sl10 has the order as ranks."""
    return notices(spark, d).select("id", "date_raw").orderBy(F.desc_nulls_last("date_raw"), "id")


@query("n: SELECT id, date_raw, row_number() OVER (ORDER BY date_raw DESC NULLS LAST, id) AS rank FROM n")
def sl10_sort_all_nulls_last(spark, d):
    """The sort of sl01 over all rows, with ranks."""
    return numbered(notices(spark, d).select("id", "date_raw"), [F.desc_nulls_last("date_raw"), C("id")]).orderBy("rank")


@query("(SELECT o_orderkey AS id, o_totalprice AS v, 'top' AS side FROM orders ORDER BY v DESC, id LIMIT 10) UNION ALL (SELECT o_orderkey, o_totalprice, 'bottom' FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10)")
def sl02_top_k(spark, d):
    o = table(spark, d, "orders").select(C("o_orderkey").alias("id"), C("o_totalprice").alias("v"))
    return o.orderBy(F.desc("v"), "id").limit(10).withColumn("side", F.lit("top")).unionByName(o.orderBy("v", "id").limit(10).withColumn("side", F.lit("bottom")))


@query("SELECT o_orderkey AS id, o_totalprice AS v FROM orders ORDER BY v DESC, id LIMIT 50 OFFSET 100")
def sl03_page(spark, d):
    return Q.page(table(spark, d, "orders").select(C("o_orderkey").alias("id"), C("o_totalprice").alias("v")), [F.desc("v"), C("id")], 3)


@query("SELECT o_orderkey AS id, o_totalprice AS v, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders ORDER BY v DESC, id LIMIT 10 OFFSET 1000")
def sl11_deep_page(spark, d):
    """Page 101 of all orders, from the ranges that hold it."""
    return Ordered(table(spark, d, "orders").select(C("o_orderkey").alias("id"), C("o_totalprice").alias("v")), [F.desc("v"), C("id")]).page(101, 10)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY sha256(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 2000")
def sl04_seeded_sample(spark, d):
    """2,000 rows, the same each time: those with the smallest hash of their key."""
    return Q.sample(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 2000)


@query("t: SELECT key, lot, amount, supplier FROM t WHERE region = 'ASIA' AND year = 1997 AND method = '1-URGENT'")
def sl05_faceted_filter(spark, d):
    return Q.faceted(tenders(spark, d), region="ASIA", year=1997, category=None, method="1-URGENT", buyer=None, supplier=None, town=None).select("key", "lot", "amount", "supplier")


@query("t: SELECT DISTINCT town FROM t WHERE region = 'EUROPE'")
def sl06_facet_values(spark, d):
    return Q.facet_values(tenders(spark, d), "town", region="EUROPE")


@query("n: SELECT id FROM n WHERE regexp_matches(subject, 'illumin|led', 'i') OR regexp_matches(coalesce(procedure_raw, ''), 'illumin|led', 'i') OR regexp_matches(coalesce(entity_raw, ''), 'illumin|led', 'i')")
def sl07_text_search(spark, d):
    return Q.text_search(notices(spark, d), ["subject", "procedure_raw", "entity_raw"], "illumin|led").select("id")


@query("t: (SELECT supplier, round(sum(amount), 2) AS total, count(*) AS n, 'found' AS how FROM t WHERE contains(upper(supplier), '#00000') OR contains(upper(supplier), '0001') GROUP BY 1 HAVING contains(upper(supplier), '0001') ORDER BY supplier LIMIT 50) UNION ALL (SELECT supplier, round(sum(amount), 2), count(*), 'top' FROM t GROUP BY 1 ORDER BY sum(amount) DESC, supplier LIMIT 100)")
def sl08_supplier_search(spark, d):
    df = tenders(spark, d)
    out = Q.name_search(df, "supplier", "amount", "0001").withColumn("how", F.lit("found")).unionByName(Q.name_search(df, "supplier", "amount", "0").withColumn("how", F.lit("top")))
    return out.withColumn("total", F.round("total", 2)).select("supplier", "total", "n", "how")


_searched = ["worthless|data.{1,4}set", "aux? (?:ou|la)|thet[ht]e", "qu[ei] .n"]


@query("SELECT pattern, doc_id FROM documents, (VALUES " + ", ".join(f"('{p}')" for p in _searched) + ") AS p(pattern) WHERE " + " OR ".join(f"(pattern = '{p}' AND regexp_matches(text, '{p}', 'i'))" for p in _searched))
def sl12_indexed_text_search(spark, d):
    """Text search over all documents through the trigram index, filled by two feeds; the second and third patterns have no trigram to ask for in some part, and scan."""
    index = TrigramIndex(spark, shared_path(spark, "trigrams"))
    documents = table(spark, d, "documents").select("doc_id", "text", "source")
    for feed in ("source < 'src5'", "source >= 'src5' OR source IS NULL"):
        index.add(documents.filter(feed), ["doc_id"], ["text"])
    found = [index.search(p, ["text"]).select(F.lit(p).alias("pattern"), "doc_id") for p in _searched]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("t: SELECT supplier, round(sum(amount), 2) AS total, count(*) AS n FROM t WHERE supplier IS NOT NULL GROUP BY 1 HAVING contains(upper(supplier), 'R#00000') ORDER BY supplier LIMIT 50")
def sl13_indexed_name_search(spark, d):
    """The supplier search of sl08, through the trigram index of the names with their totals."""
    index = TrigramIndex(spark, shared_path(spark, "trigrams"))
    index.add(Q.names_with_totals(tenders(spark, d), "supplier", "amount"), ["supplier"], ["supplier"])
    return Q.name_search_in(index, "supplier", "r#00000").select("supplier", F.round("total", 2).alias("total"), "n")


@query("t: SELECT key, lot, amount FROM t WHERE amount >= 20000 AND amount <= 50000 AND award_date >= DATE '1996-01-01' AND award_date <= DATE '1996-06-30' AND discount >= 3")
def sl09_ranges(spark, d):
    return Q.ranged(tenders(spark, d), {"amount": (20_000, 50_000), "award_date": (F.lit("1996-01-01").cast("date"), F.lit("1996-06-30").cast("date")), "discount": (3, None)}).select("key", "lot", "amount")


@query("n: SELECT source, count(*) AS n, count(code_raw) AS codes, count(procedure_raw) AS procedures FROM (SELECT id, source, code_raw, NULL AS procedure_raw FROM n WHERE source = 'OCDS' UNION ALL SELECT id, source, NULL, procedure_raw FROM n WHERE source = 'CONSIP' UNION ALL SELECT id, source, code_raw, procedure_raw FROM n WHERE source = 'Gazzetta') GROUP BY source")
def so01_union_aligned(spark, d):
    n = notices(spark, d)
    frames = [n.filter("source = 'OCDS'").select("id", "source", "code_raw"), n.filter("source = 'CONSIP'").select("id", "source", "procedure_raw"), n.filter("source = 'Gazzetta'").select("id", "source", "code_raw", "procedure_raw")]
    return J.union_aligned(frames).groupBy("source").agg(F.count("*").alias("n"), F.count("code_raw").alias("codes"), F.count("procedure_raw").alias("procedures"))


@query("n: SELECT id, coalesce(code_raw, vat_raw) AS code, coalesce(town_raw, entity_raw) AS place, CAST(NULL AS VARCHAR) AS missing FROM n")
def so02_aliases(spark, d):
    out = J.aliased(notices(spark, d), {"id": ["id"], "code": ["CIG", "code_raw", "vat_raw"], "place": ["town_raw", "entity_raw"], "missing": ["nothing"]})
    return out


@query("t: WITH a AS (SELECT DISTINCT town FROM t WHERE year = 1996 AND amount > 90000), b AS (SELECT DISTINCT town FROM t WHERE year = 1997 AND amount > 90000) SELECT town, 'both' AS side FROM (SELECT town FROM a INTERSECT SELECT town FROM b) UNION ALL SELECT town, 'first' FROM (SELECT town FROM a EXCEPT SELECT town FROM b) UNION ALL SELECT town, 'second' FROM (SELECT town FROM b EXCEPT SELECT town FROM a)")
def so03_sets(spark, d):
    t = tenders(spark, d).filter("amount > 90000")
    a, b = (t.filter(C("year") == y).select("town").distinct() for y in (1996, 1997))
    return a.intersect(b).withColumn("side", F.lit("both")).unionByName(a.subtract(b).withColumn("side", F.lit("first"))).unionByName(b.subtract(a).withColumn("side", F.lit("second")))


@query("n: SELECT id, coalesce(kind_raw, 'N/D') AS kind, coalesce(plant_raw, 'N/D') AS plant, 'batch' AS origin, 1 AS version FROM n")
def so04_fill_and_metadata(spark, d):
    return notices(spark, d).select("id", C("kind_raw").alias("kind"), C("plant_raw").alias("plant")).fillna("N/D", ["kind", "plant"]).withColumns({"origin": F.lit("batch"), "version": F.lit(1)})


@query("n: SELECT id, upper(substr(v, 1, 1)) || lower(substr(v, 2)) AS category FROM (SELECT id, coalesce(nullif(trim(CASE WHEN id % 2 = 0 THEN '' ELSE kind_raw END), ''), 'illuminazione') AS v FROM n)")
def so05_category_fallback(spark, d):
    cat = F.nullif(F.trim(F.when(C("id") % 2 == 0, F.lit("")).otherwise(C("kind_raw"))), F.lit(""))
    return notices(spark, d).select("id", S.title_case(F.regexp_replace(F.coalesce(cat, F.lit("illuminazione")), "_", "0")).alias("category")).select("id", F.concat(F.substring("category", 1, 1), F.lower(F.regexp_replace(F.substring("category", F.lit(2), F.char_length("category")), "0", "_"))).alias("category"))


@query("n: SELECT id, coalesce(CASE WHEN lower(trim(string_split(code_raw, ';')[1])) NOT IN ('', 'nan', 'none', 'null') THEN upper(trim(string_split(code_raw, ';')[1])) END, 'ocid-' || id) AS key FROM n")
def so06_key(spark, d):
    return notices(spark, d).select("id", F.coalesce(S.first_key(C("code_raw")), F.concat(F.lit("ocid-"), C("id"))).alias("key"))


