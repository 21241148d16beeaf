"""LKP, JN, DD and the upsert: lookups, joins, deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import scalars as S
from ..operators import dedup as D
from ..operators import fuzzy as Z
from ..operators import joins as J
from ..operators import metrics as M
from ..operators.trigrams import TrigramIndex
from ..plans.bindings import notices, table, tenders
from ..streaming.incremental import shared_path
from .registry import query
from .scalars import sentinel_sql

C = F.col


def values(t: dict) -> str:
    q = lambda x: "'" + x.replace("'", "''") + "'" if isinstance(x, str) else f"{x}e0"
    return ", ".join("(" + ", ".join(q(x) for x in (k, *(v if isinstance(v, tuple) else (v,)))) + ")" for k, v in t.items())


@query(f"n: WITH p(prefix, region) AS (VALUES {values(R.PREFIX_REGION)}) SELECT id, coalesce(region, '') AS region FROM n LEFT JOIN p ON substr(postal_raw, 1, 2) = prefix")
def lkp01_postal_region(spark, d):
    return J.looked_up(notices(spark, d), F.substring("postal_raw", 1, 2), R.PREFIX_REGION, "region").select("id", F.coalesce("region", F.lit("")).alias("region"))


@query(f"n: WITH p(section, region) AS (VALUES {values(R.SECTIONS)}) SELECT id, region FROM n LEFT JOIN p ON upper(trim(section_raw)) = section")
def lkp02_section_region(spark, d):
    return J.looked_up(notices(spark, d), F.upper(F.trim("section_raw")), R.SECTIONS, "region").select("id", "region")


@query(f"n: WITH p(code, label) AS (VALUES {values(R.METHOD_LABELS)}) SELECT id, coalesce(label, method_raw) AS method FROM n LEFT JOIN p ON method_raw = code")
def lkp03_method_label(spark, d):
    return J.looked_up(notices(spark, d), C("method_raw"), R.METHOD_LABELS, "label").select("id", F.coalesce("label", "method_raw").alias("method"))


@query(f"""n: WITH p(town, region) AS (VALUES {values(R.TOWN_REGION)}), s(section, known) AS (VALUES {values(R.SECTIONS)})
    SELECT id, coalesce(known, region) AS region FROM n LEFT JOIN s ON upper(trim(section_raw)) = section LEFT JOIN p ON CASE trim(town_raw) WHEN 'L''AQUILA' THEN 'L''Aquila' WHEN 'MILANO' THEN 'Milano' WHEN 'FORLÌ' THEN 'Forlì' WHEN 'roma' THEN 'Roma' WHEN 'reggio  emilia' THEN 'Reggio Emilia' ELSE trim(town_raw) END = town""")
def lkp04_town_region(spark, d):
    df = J.looked_up(notices(spark, d), F.upper(F.trim("section_raw")), R.SECTIONS, "known")
    return J.looked_up(df, S.town_name(C("town_raw")), R.TOWN_REGION, "region").select("id", F.coalesce("known", "region").alias("region"))


@query(f"n: WITH s(section, region) AS (VALUES {values(R.SECTIONS)}), c(r, lat, lon) AS (VALUES {values(R.REGION_POINT)}) SELECT id, coalesce(lat, 42.0e0) AS lat, coalesce(lon, 12.0e0) AS lon FROM n LEFT JOIN s ON upper(trim(section_raw)) = section LEFT JOIN c ON region = r")
def lkp05_coordinates(spark, d):
    df = J.looked_up(notices(spark, d), F.upper(F.trim("section_raw")), R.SECTIONS, "region")
    df = J.looked_up(df, C("region"), R.REGION_POINT, "lat", "lon")
    return df.select("id", F.coalesce("lat", F.lit(R.DEFAULT_POINT[0])).alias("lat"), F.coalesce("lon", F.lit(R.DEFAULT_POINT[1])).alias("lon"))


@query(f"""n: WITH c(town, lat, lon) AS (VALUES {values(R.TOWN_POINT)}), g AS (SELECT upper(trim(town_raw)) AS town, count(*) AS n, round(sum(award), 2) AS total, round(avg(id % 50), 4) AS mean_discount FROM n WHERE town_raw IS NOT NULL GROUP BY 1),
    k AS (SELECT upper(trim(town_raw)) AS town, kind_raw AS kind FROM n WHERE kind_raw IS NOT NULL GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY upper(trim(town_raw)) ORDER BY count(*) DESC, kind_raw) = 1)
    SELECT town, n, total, mean_discount, kind, lat, lon FROM g JOIN c USING (town) LEFT JOIN k USING (town)""")
def lkp07_town_map(spark, d):
    """Figures per town on the map; towns without a known place are left out."""
    return M.town_map(notices(spark, d).withColumn("share", (C("id") % 50).cast("double")), "town_raw", "award", "share", "kind_raw")


def priority(c):
    out = None
    for name, p in R.SOURCE_PRIORITY.items():
        out = F.when(c == name, p) if out is None else out.when(c == name, p)
    return out.otherwise(R.OTHER_PRIORITY)


_prio = "CASE source " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in R.SOURCE_PRIORITY.items()) + f" ELSE {R.OTHER_PRIORITY} END"


@query(f"n: SELECT id, {_prio} AS priority FROM n")
def lkp06_source_priority(spark, d):
    return notices(spark, d).select("id", priority(C("source")).alias("priority"))


@query("""WITH l AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS info FROM orders),
    r AS (SELECT l_orderkey AS o_orderkey, l_returnflag AS info, l_quantity AS q FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity, l_returnflag, l_extendedprice) = 1)
    SELECT o_orderkey, coalesce(l.info, r.info) AS info, q FROM l LEFT JOIN r USING (o_orderkey)""")
def jn01_left_fill(spark, d):
    left = table(spark, d, "orders").select("o_orderkey", F.when(C("o_orderkey") % 3 != 0, C("o_orderpriority")).alias("info"))
    right = table(spark, d, "lineitem").select(C("l_orderkey").alias("o_orderkey"), C("l_returnflag").alias("info"), C("l_quantity").alias("q"), "l_linenumber", "l_extendedprice")
    return J.left_fill(left, right, "o_orderkey", [C("l_linenumber"), C("q"), C("info"), C("l_extendedprice")]).select("o_orderkey", "info", "q")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice, o_orderpriority FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def jn02_inner(spark, d):
    li = table(spark, d, "lineitem")
    return li.join(table(spark, d, "orders"), C("l_orderkey") == C("o_orderkey")).select("l_orderkey", "l_linenumber", "l_extendedprice", "o_orderpriority")


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN NULL ELSE l_orderkey END AS o_orderkey FROM lineitem), r AS (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderkey % 5 <> 0)
    SELECT CASE WHEN l.o_orderkey IS NULL THEN 'null_key' WHEN r.o_orderkey IS NULL THEN 'unmatched' ELSE 'matched' END AS status, count(*) AS n FROM l LEFT JOIN r ON l.o_orderkey = r.o_orderkey GROUP BY 1""")
def jn03_three_way(spark, d):
    left = table(spark, d, "lineitem").select("l_linenumber", F.when(C("l_linenumber") != 1, C("l_orderkey")).alias("o_orderkey"))
    right = table(spark, d, "orders").filter("o_orderkey % 5 <> 0").select("o_orderkey")
    return J.matched_or_not(left, right, "o_orderkey").groupBy("status").agg(F.count("*").alias("n"))


@query("SELECT o_orderpriority, count(*) AS n, count(l_orderkey) AS lots, count(c_custkey) AS buyers FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_quantity > 25 LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0 GROUP BY 1")
def jn04_left_chain(spark, d):
    o, li, c = (table(spark, d, t) for t in ("orders", "lineitem", "customer"))
    j = o.join(li.filter("l_quantity > 25"), C("o_orderkey") == C("l_orderkey"), "left").join(c.filter("c_acctbal > 0"), C("o_custkey") == C("c_custkey"), "left")
    return j.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.count("l_orderkey").alias("lots"), F.count("c_custkey").alias("buyers"))


@query("""n: WITH codes AS (SELECT DISTINCT upper(trim(unnest(string_split(code_raw, ';')))) AS c FROM n WHERE source = 'Gazzetta') SELECT id, code_raw FROM n WHERE source <> 'Gazzetta' AND (code_raw IS NULL OR trim(code_raw) = '' OR upper(trim(code_raw)) NOT IN (SELECT c FROM codes WHERE c <> ''))""")
def jn05_absent_from_lists(spark, d):
    n = notices(spark, d).select("id", "code_raw", "source")
    return J.absent_from_lists(n.filter("source <> 'Gazzetta'"), n.filter("source = 'Gazzetta'"), "code_raw", "code_raw").select("id", "code_raw")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_discount > 0.08)")
def jn06_semi(spark, d):
    keys = table(spark, d, "lineitem").filter("l_discount > 0.08").select("l_orderkey")
    return table(spark, d, "orders").join(keys, C("o_orderkey") == C("l_orderkey"), "left_semi").select("o_orderkey")


@query("SELECT o_orderkey, coalesce(flag, false) AS flagged FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey, true AS flag FROM lineitem WHERE l_returnflag = 'R') ON o_orderkey = l_orderkey")
def jn07_flag(spark, d):
    flags = table(spark, d, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey").distinct().withColumn("flag", F.lit(True))
    return table(spark, d, "orders").join(flags, C("o_orderkey") == C("l_orderkey"), "left").select("o_orderkey", F.coalesce("flag", F.lit(False)).alias("flagged"))


_norm = r"trim(regexp_replace(regexp_replace(lower(trim(p_name)), '[.,;:\-_''\"()\[\]{}]', ' ', 'g'), '\s+', ' ', 'g'))"


@query(f"""WITH c AS (SELECT p_name AS name, {_norm} AS norm, count(*) AS n FROM part WHERE p_name IS NOT NULL GROUP BY 1, 2), m AS (SELECT median(n) AS k FROM c), f AS (SELECT * FROM c, m WHERE n >= k), r AS (SELECT * FROM c, m WHERE n < k),
    s AS (SELECT r.name, f.name AS canonical, round(100.0e0 * (1 - levenshtein(r.norm, f.norm) / greatest(length(r.norm), length(f.norm), 1)), 4) AS score, f.n AS cn FROM r, f),
    b AS (SELECT * FROM s WHERE score >= 60 QUALIFY row_number() OVER (PARTITION BY name ORDER BY score DESC, cn DESC, canonical) = 1)
    SELECT c.name, c.n, coalesce(b.canonical, c.name) AS canonical, b.score FROM c LEFT JOIN b USING (name)""")
def jn08_fuzzy_levenshtein(spark, d):
    """Top-1 fuzzy join in the form that SQL can check: Levenshtein ratio, candidates by letter pairs, none missed."""
    parts = table(spark, d, "part")
    k = parts.groupBy("p_name").count().agg(F.percentile("count", F.lit(0.5))).first()[0]
    return Z.canonical(parts, "p_name", 60, k, blocked="grams", score=Z.levenshtein_ratio)


def spelt_entities(spark, d):
    """Raw entity names with a place for each run of 1,500 ids; of an entity's 125 rows in a run, 25 are spelt in five other ways."""
    md5 = F.md5(F.floor(C("id") / 1500).cast("string"))
    place = F.concat_ws(" ", F.substring(md5, 1, 6), F.substring(md5, 7, 6))
    n = notices(spark, d).select("id", F.concat_ws(" ", "entity_raw", place).alias("e"), F.concat_ws(" ", place, "entity_raw").alias("turned"), F.floor(C("id") % 1500 / 12).alias("i"))
    spelt = F.when(C("i") < 100, C("e")).when(C("i") < 105, F.expr("left(e, length(e) - 1)")).when(C("i") < 110, F.expr("e || right(e, 1)")).when(C("i") < 115, F.concat("turned", F.lit(".")))
    return n.select("id", spelt.when(C("i") < 120, F.concat(F.upper("e"), F.lit(" SRL"))).otherwise(F.expr("'X' || substr(e, 2)")).alias("entity"))


@query()
def jn08_fuzzy_weighted(spark, d):
    """Top-1 fuzzy join with blocking and the weighted ratio over entity names."""
    return Z.canonical(spelt_entities(spark, d), "entity", 85, 30)


_keyword_top = "t: WITH c AS (SELECT supplier, count(*) AS n FROM t GROUP BY 1), k(keyword) AS (VALUES ('00001'), ('0002'), ('#0')), j AS (SELECT keyword, supplier, n, row_number() OVER (PARTITION BY keyword ORDER BY n DESC, supplier) AS rank FROM c JOIN k ON contains(lower(supplier), keyword)) SELECT * FROM j WHERE rank <= 10"


@query(_keyword_top)
def jn09_keyword_top(spark, d):
    return J.keyword_top(tenders(spark, d), "supplier", ["00001", "0002", "#0"])


@query(_keyword_top)
def jn11_indexed_keyword_top(spark, d):
    """The same through the trigram index of the names; the keyword of two characters scans the names."""
    index = TrigramIndex(spark, shared_path(spark, "trigrams"))
    index.add(tenders(spark, d).filter("supplier IS NOT NULL").groupBy("supplier").agg(F.count("*").alias("n")), ["supplier"], ["supplier"])
    return J.keyword_top_in(index, "supplier", ["00001", "0002", "#0"])


@query("t: SELECT region, count(*) AS n, round(sum(amount), 2) AS total, count(DISTINCT category) AS categories, round(avg(discount), 4) AS mean_discount FROM t WHERE region IN ('ASIA', 'EUROPE') GROUP BY region")
def jn10_compare(spark, d):
    return J.compared(tenders(spark, d), "region", "ASIA", "EUROPE", [F.count("*").alias("n"), F.round(F.sum("amount"), 2).alias("total"), F.countDistinct("category").alias("categories"), F.round(F.avg("discount"), 4).alias("mean_discount")])


_fill = ["town_raw", "entity_raw", "amount_raw", "discount_raw", "date_raw", "procedure_raw", "kind_raw"]
_full = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in _fill)


@query(f"""n: WITH p AS (SELECT *, CASE WHEN code_raw IS NULL THEN NULL ELSE lpad(CAST(id % 500 AS VARCHAR), 5, '0') END AS k, {_prio} AS prio, {_full} AS c FROM n)
    SELECT id, source FROM p QUALIFY k IS NULL OR row_number() OVER (PARTITION BY k ORDER BY prio, c DESC, id) = 1""")
def dd01_survivor(spark, d):
    n = notices(spark, d).withColumn("k", F.when(C("code_raw").isNotNull(), F.lpad((C("id") % 500).cast("string"), 5, "0")))
    return D.best_per_key(n, "k", [priority(C("source")), D.completeness(_fill).desc(), C("id")]).select("id", "source")


@query(f"n: SELECT {_full} AS filled, count(*) AS n FROM n GROUP BY 1")
def dd02_completeness(spark, d):
    return notices(spark, d).groupBy(D.completeness(_fill).alias("filled")).agg(F.count("*").alias("n"))


@query("SELECT event_id, user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def dd03_keep_last(spark, d):
    e = table(spark, d, "events").withColumn("k", F.concat_ws("|", "user_id", "event_type"))
    return D.best_per_key(e, "k", [F.desc("ts"), F.desc("event_id")]).select("event_id", "user_id", "event_type")


@query(f"n: WITH p AS (SELECT id, source, upper({sentinel_sql("string_split(code_raw, ';')[1]")}) AS k FROM n WHERE source IN ('OCDS', 'CIG_JSON')) SELECT id, k FROM p WHERE k IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k ORDER BY CASE source WHEN 'OCDS' THEN 0 ELSE 1 END, id) = 1")
def dd04_first_code(spark, d):
    n = notices(spark, d).filter(C("source").isin("OCDS", "CIG_JSON")).withColumn("k", S.first_key(C("code_raw"))).filter("k is not null")
    return D.best_per_key(n, "k", [F.when(C("source") == "OCDS", 0).otherwise(1), C("id")]).select("id", "k")


@query("n: SELECT id, entity_raw FROM n QUALIFY entity_raw IS NULL OR row_number() OVER (PARTITION BY entity_raw ORDER BY id) = 1")
def dd05_keep_first_nulls_stay(spark, d):
    return D.best_per_key(notices(spark, d).select("id", "entity_raw"), "entity_raw", [C("id")])


@query("n: WITH p AS (SELECT id, coalesce('k:' || town_raw, 'h:' || sha256(subject)) AS u FROM n) SELECT id FROM p QUALIFY row_number() OVER (PARTITION BY u ORDER BY id) = 1")
def dd06_first_or_by_hash(spark, d):
    n = notices(spark, d).select("id", "town_raw", F.sha2("subject", 256).alias("h"))
    return D.first_or_by_hash(n, "town_raw", "h", [C("id")]).select("id")


@query("n: WITH p AS (SELECT lpad(CAST(id % 501 AS VARCHAR), 5, '0') AS k, source FROM n), g AS (SELECT k, count(*) AS c, string_agg(DISTINCT source, '+' ORDER BY source) AS sources FROM p GROUP BY k) SELECT sources, count(*) AS n FROM g WHERE c > 1 GROUP BY 1 ORDER BY n DESC, sources LIMIT 10")
def dd07_overlaps(spark, d):
    return D.overlaps(notices(spark, d).withColumn("k", F.lpad((C("id") % 501).cast("string"), 5, "0")), "k", "source")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice, l_partkey, l_suppkey, l_quantity) = 1")
def dd08_drop_repeated_ids(spark, d):
    li = table(spark, d, "lineitem").withColumn("k", F.concat_ws("|", "l_orderkey", "l_linenumber"))
    return D.best_per_key(li, "k", [C(c) for c in ("l_extendedprice", "l_partkey", "l_suppkey", "l_quantity")]).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("WITH h AS (SELECT doc_id, sha256(text) AS h FROM documents) SELECT doc_id FROM h WHERE h NOT IN (SELECT sha256(text) FROM benchmark) AND h NOT IN (SELECT h FROM h WHERE doc_id < 100)")
def dd09_content_ledger(spark, d):
    h = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    ledger = table(spark, d, "benchmark").select(F.sha2("text", 256).alias("h")).unionByName(h.filter("doc_id < 100").select("h"))
    return D.not_in_ledger(h, ledger, "h").select("doc_id")


@query("SELECT o_orderkey, round(o_totalprice, 2) AS price, 'old' AS state FROM orders WHERE o_orderkey % 4 <> 0 UNION ALL SELECT o_orderkey, round(o_totalprice * 2, 2), 'new' FROM orders WHERE o_orderkey % 4 = 0")
def snk03_upsert(spark, d):
    o = table(spark, d, "orders")
    target = o.select("o_orderkey", F.round("o_totalprice", 2).alias("price"), F.lit("old").alias("state"))
    stage = o.filter("o_orderkey % 4 = 0").select("o_orderkey", F.round(C("o_totalprice") * 2, 2).alias("price"), F.lit("new").alias("state"))
    return D.upsert(target, stage, "o_orderkey")
