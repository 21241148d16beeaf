"""AG: market figures on the tender view."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import scalars as S
from ..functions.classify import minor_price
from ..operators import joins as J
from ..operators import metrics as M
from ..operators.interim import stored
from ..operators.states import States
from ..plans.bindings import notices, table, tenders
from ..streaming.incremental import shared_path
from .registry import query

C = F.col
AS_OF = "1999-01-01"  # reports about the future take the day as a parameter


@query("""t: SELECT count(*) AS n, round(sum(amount), 2) AS total, round(avg(discount), 4) AS mean_discount, round(avg(offers), 4) AS mean_offers, count(DISTINCT buyer) AS buyers,
    count(DISTINCT supplier) AS suppliers, count(DISTINCT key) AS keys, round(quantile_cont(amount, 0.5), 2) AS median, round(max(amount), 2) AS largest FROM t""")
def ag01_headline(spark, d):
    return M.headline(tenders(spark, d), "amount", "discount", "offers", "buyer", "supplier", "key")


for _k in ("category", "region", "town", "buyer", "supplier", "year", "method"):

    @query(f"t: SELECT {_k}, count(*) AS n, round(sum(amount), 2) AS total, round(avg(amount), 8) AS mean FROM t GROUP BY {_k}", name=f"ag02_by_{_k}")
    def _one(spark, d, k=_k):
        return M.summary(tenders(spark, d), [k], "amount")


for _a, _b in (("year", "method"), ("buyer", "supplier"), ("supplier", "category"), ("year", "region")):

    @query(f"t: SELECT {_a}, {_b}, count(*) AS n, round(sum(amount), 2) AS total, round(avg(amount), 8) AS mean FROM t GROUP BY {_a}, {_b}", name=f"ag03_by_{_a}_{_b}")
    def _two(spark, d, k=(_a, _b)):
        return M.summary(tenders(spark, d), list(k), "amount")


@query("t: SELECT year, CAST(month(award_date) AS INTEGER) AS month, count(*) AS n, round(sum(amount), 2) AS total FROM t GROUP BY 1, 2")
def ag03_by_year_month(spark, d):
    return tenders(spark, d).groupBy("year", F.month("award_date").alias("month")).agg(F.count("*").alias("n"), F.round(F.sum("amount"), 2).alias("total"))


@query("t: SELECT category, count(DISTINCT supplier) AS suppliers FROM t GROUP BY category HAVING count(DISTINCT supplier) >= 10")
def ag04_distinct_having(spark, d):
    return M.keyed(tenders(spark, d), "category").groupBy("category").agg(F.countDistinct("supplier").alias("suppliers")).filter("suppliers >= 10")


@query("""t: SELECT supplier, count(*) AS n, round(sum(amount), 2) AS total, round(avg(amount), 8) AS mean, count(DISTINCT buyer) AS buyers, min(year) AS first_year, max(year) AS last_year,
    CAST(max(year) - min(year) + 1 AS INTEGER) AS years, round(count(*) / (max(year) - min(year) + 1), 4) AS per_year FROM t GROUP BY supplier""")
def ag05_supplier_summary(spark, d):
    g = M.keyed(tenders(spark, d), "supplier").groupBy("supplier").agg(F.count("*").alias("n"), F.round(F.sum("amount"), 2).alias("total"), F.round(F.avg("amount"), 8).alias("mean"), F.countDistinct("buyer").alias("buyers"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))
    return g.withColumn("years", C("last_year") - C("first_year") + 1).withColumn("per_year", F.round(F.try_divide("n", "years"), 4))


@query("t: WITH g AS (SELECT supplier, region, count(*) AS n FROM t GROUP BY 1, 2) SELECT supplier, region FROM g QUALIFY row_number() OVER (PARTITION BY supplier ORDER BY n DESC, region) = 1")
def ag06_mode(spark, d):
    return M.modes(tenders(spark, d), "supplier", "region")


_shares = "s AS (SELECT category, supplier, sum(amount) AS v, count(*) AS n FROM t GROUP BY 1, 2), p AS (SELECT *, v * 100 / sum(v) OVER (PARTITION BY category) AS share, row_number() OVER (PARTITION BY category ORDER BY v DESC, supplier) AS r FROM s)"


@query(f"t: WITH {_shares} SELECT category, round(sum(share * share), 4) AS hhi, count(*) AS members, round(sum(v), 2) AS total FROM p GROUP BY category")
def ag07_hhi_per_category(spark, d):
    return M.hhi(tenders(spark, d), ["category"], "supplier", "amount")


@query(f"t: WITH {_shares} SELECT category, round(sum(share) FILTER (r <= 4), 4) AS cr4 FROM p GROUP BY category")
def ag08_cr4(spark, d):
    return M.concentration(tenders(spark, d), ["category"], "supplier", "amount", 4)


@query(f"t: WITH {_shares} SELECT category, supplier, round(v, 2) AS value, round(share, 4) AS share FROM p WHERE r = 1 AND share > 1")
def ag09_dominant(spark, d):
    return M.dominant(tenders(spark, d), ["category"], "supplier", "amount", 1)


@query("""t: WITH s AS (SELECT supplier, sum(amount) AS v FROM t GROUP BY 1 ORDER BY v DESC, supplier LIMIT 20), r AS (SELECT *, row_number() OVER (ORDER BY v DESC, supplier) AS k FROM s)
    SELECT round(sum(v) FILTER (k <= 5) * 100 / sum(v), 4) AS top5, round(sum(v) FILTER (k <= 10) * 100 / sum(v), 4) AS top10 FROM r""")
def ag10_top_share(spark, d):
    from pyspark.sql import Window

    top = tenders(spark, d).groupBy("supplier").agg(F.sum("amount").alias("v")).orderBy(F.desc("v"), "supplier").limit(20)
    top = top.withColumn("k", F.row_number().over(Window.orderBy(F.desc("v"), "supplier")))  # 20 rows
    return top.agg(*[F.round(F.sum(F.when(C("k") <= k, C("v"))) * 100 / F.sum("v"), 4).alias(f"top{k}") for k in (5, 10)])


_desc = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{n}' AS statistic, round({e.format(c)}, 4) AS value FROM t" for c in ("amount", "discount", "offers") for n, e in (("mean", "avg({})"), ("median", "quantile_cont({}, 0.5)"), ("std", "stddev_samp({})"), ("min", "min({})"), ("max", "max({})")))


@query(f"t: {_desc}")
def ag11_described(spark, d):
    return M.described(tenders(spark, d), ["amount", "discount", "offers"])


@query("t: SELECT CAST(quarter(award_date) AS INTEGER) AS quarter, count(*) AS n, round(sum(amount), 2) AS total, round(avg(discount), 4) AS mean, round(quantile_cont(discount, 0.5), 4) AS median FROM t GROUP BY 1")
def ag12_quarters(spark, d):
    t = stored(tenders(spark, d).select(F.quarter("award_date").alias("quarter"), "amount", "discount"), "quarters")
    g = t.groupBy("quarter").agg(F.count("*").alias("n"), F.round(F.sum("amount"), 2).alias("total"), F.round(F.avg("discount"), 4).alias("mean"))
    return M.with_quantiles(g, M.quantiles(t, "discount", [0.5], ["quarter"]), ["quarter"]).select(*g.columns, F.round(C("q")[0], 4).alias("median"))


@query("t: SELECT round(corr(offers, discount), 6) AS r FROM t")
def ag13_correlation(spark, d):
    return tenders(spark, d).agg(F.round(F.corr("offers", "discount"), 6).alias("r"))


@query("t: WITH g AS (SELECT offers, avg(discount) AS y FROM t GROUP BY offers HAVING count(*) >= 5) SELECT round(regr_slope(y, offers), 6) AS slope, round(regr_intercept(y, offers), 4) AS intercept, count(*) AS points FROM g")
def ag14_trend(spark, d):
    g = tenders(spark, d).groupBy("offers").agg(F.avg("discount").alias("y"), F.count("*").alias("k")).filter("k >= 5")
    return M.trend(g, "offers", "y")


_band = "CASE WHEN amount <= 0 THEN NULL " + " ".join(f"WHEN amount <= {hi} THEN '{n}'" for hi, n in R.AMOUNT_BANDS) + f" ELSE '{R.AMOUNT_TOP}' END"


@query(f"t: SELECT {_band} AS band, count(*) AS n, round(avg(discount), 4) AS mean_discount FROM t GROUP BY 1")
def ag15_amount_bands(spark, d):
    return tenders(spark, d).groupBy(M.amount_bands(C("amount")).alias("band")).agg(F.count("*").alias("n"), F.round(F.avg("discount"), 4).alias("mean_discount"))


_edges = R.DISCOUNT_EDGES
_bins = ", ".join(f"({i}, {a}.0e0, {b}.0e0)" for i, (a, b) in enumerate(zip(_edges, _edges[1:])))


@query(f"t: WITH b(bin, low, high) AS (VALUES {_bins}), c AS (SELECT bin, count(*) AS k FROM t JOIN b ON discount <= high AND (discount > low OR bin = 0 AND discount >= low) GROUP BY bin) SELECT CAST(b.bin AS INTEGER) AS bin, low, high, coalesce(k, 0) AS n FROM b LEFT JOIN c USING (bin)")
def ag16_discount_histogram(spark, d):
    return M.binned(tenders(spark, d), "discount", _edges)


@query("t: WITH e AS (SELECT min(amount) AS lo, max(amount) AS hi FROM t) SELECT CAST(least(floor((amount - lo) * 30 / (hi - lo)), 29) AS INTEGER) AS bin, count(*) AS n FROM t, e GROUP BY 1")
def ag17_equal_width_histogram(spark, d):
    return M.histogram(tenders(spark, d), "amount", 30)


@query("t: SELECT category, " + ", ".join(f"round(quantile_cont(amount, {q}), 4) AS {n}" for q, n in ((0, "low"), (0.25, "q1"), (0.5, "mid"), (0.75, "q3"), (1, "high"))) + " FROM t GROUP BY category")
def ag18_five_numbers(spark, d):
    return M.five_numbers(tenders(spark, d), "category", "amount")


@query("""t: WITH v AS (SELECT *, CASE WHEN discount BETWEEN 0 AND 100 THEN discount END AS s FROM t)
    SELECT year, count(*) AS n, count(s) AS available, round(count(s) / count(*), 6) AS availability, round(avg(s), 2) AS mean, round(quantile_cont(s, 0.5), 2) AS median FROM v GROUP BY year""")
def ag19_discount_payload(spark, d):
    s = F.when(C("discount").between(0, 100), C("discount"))
    t = stored(M.keyed(tenders(spark, d), "year").select("year", "discount"), "discounts")
    g = t.groupBy("year").agg(F.count("*").alias("n"), F.count(s).alias("available"), F.round(F.count(s) / F.count("*"), 6).alias("availability"), F.round(F.avg(s), 2).alias("mean"))
    return M.with_quantiles(g, M.quantiles(t, s, [0.5], ["year"]), ["year"]).select(*g.columns, F.round(C("q")[0], 2).alias("median"))


@query("n: SELECT CAST(year(award_date) AS INTEGER) AS year, count(*) FILTER (regexp_matches(upper(concat_ws(' ', procedure_raw, subject)), 'MINOR|PREZZO')) AS n FROM n GROUP BY 1")
def ag20_minor_price(spark, d):
    return notices(spark, d).groupBy(F.year("award_date").alias("year")).agg(F.count_if(minor_price(C("procedure_raw"), C("subject"))).alias("n"))


_fields = ["code_raw", "project_raw", "vat_raw", "email_raw", "amount_raw", "discount_raw", "date_raw", "duration_raw", "procedure_raw", "town_raw", "entity_raw", "kind_raw", "plant_raw"]


@query("n: " + " UNION ALL ".join(f"SELECT '{c}' AS field, count(*) FILTER (trim(coalesce({c}, '')) <> '') AS filled, round(count(*) FILTER (trim(coalesce({c}, '')) <> '') * 100.0 / count(*), 4) AS percent FROM n" for c in _fields))
def ag21_coverage(spark, d):
    return M.coverage(notices(spark, d), _fields)


@query("""n: WITH p AS (SELECT *, upper(trim(string_split(code_raw, ';')[1])) AS k FROM n), g AS (SELECT k, count(*) AS c FROM p WHERE k IS NOT NULL AND k <> '' GROUP BY k)
    SELECT (SELECT count(*) FROM n) AS n, (SELECT count(*) FILTER (c > 1) FROM g) AS repeated_keys, (SELECT CAST(sum(c - 1) AS BIGINT) FROM g) AS surplus, (SELECT count(*) FILTER (award <= 0 OR award IS NULL) FROM n) AS bad_amounts, (SELECT count(*) FILTER (date_raw IS NULL) FROM n) AS no_date""")
def ag22_quality_ledger(spark, d):
    df = notices(spark, d).withColumn("k", S.first_key(C("code_raw")))
    keys = df.filter("k is not null").groupBy("k").agg(F.count("*").alias("c")).agg(F.count_if(C("c") > 1).alias("repeated_keys"), F.sum(C("c") - 1).alias("surplus"))
    return df.agg(F.count("*").alias("n"), F.count_if((C("award") <= 0) | C("award").isNull()).alias("bad_amounts"), F.count_if(C("date_raw").isNull()).alias("no_date")).crossJoin(keys)


@query("t: WITH g AS (SELECT supplier, buyer, count(*) AS n FROM t GROUP BY 1, 2) SELECT supplier, CAST(sum(n) AS BIGINT) AS tenders, count(*) AS buyers, round(sum(n) / count(*), 4) AS loyalty FROM g GROUP BY supplier")
def ag23_loyalty(spark, d):
    g = M.keyed(tenders(spark, d), "supplier", "buyer").groupBy("supplier", "buyer").agg(F.count("*").alias("n"))
    return g.groupBy("supplier").agg(F.sum("n").alias("tenders"), F.count("*").alias("buyers"), F.round(F.sum("n") / F.count("*"), 4).alias("loyalty"))


@query("t: SELECT buyer, count(*) AS n, count(DISTINCT supplier) AS suppliers, round(count(*) / count(DISTINCT supplier), 4) AS per_supplier FROM t GROUP BY buyer HAVING count(*) >= 10 ORDER BY per_supplier DESC, buyer LIMIT 20")
def ag24_buyer_concentration(spark, d):
    g = M.keyed(tenders(spark, d), "buyer").groupBy("buyer").agg(F.count("*").alias("n"), F.countDistinct("supplier").alias("suppliers")).filter("n >= 10")
    return g.withColumn("per_supplier", F.round(C("n") / C("suppliers"), 4)).orderBy(F.desc("per_supplier"), "buyer").limit(20)


@query(f"t: SELECT CAST(year(expiry_date) AS INTEGER) AS year, category, CAST(month(expiry_date) AS INTEGER) AS month, count(*) AS n, round(sum(amount), 2) AS total FROM t WHERE expiry_date > DATE '{AS_OF}' AND year(expiry_date) <= 2040 GROUP BY 1, 2, 3")
def ag25_expiries(spark, d):
    df = tenders(spark, d).filter((C("expiry_date") > F.lit(AS_OF).cast("date")) & (F.year("expiry_date") <= 2040))
    return df.groupBy(F.year("expiry_date").alias("year"), "category", F.month("expiry_date").alias("month")).agg(F.count("*").alias("n"), F.round(F.sum("amount"), 2).alias("total"))


_yr = "CASE " + " ".join(f"WHEN lower(subject) LIKE '%{w}%' THEN {y}" for w, y in R.CONTRACT_YEARS) + f" ELSE {R.DEFAULT_YEARS} END"


@query(f"""n: WITH e AS (SELECT *, CAST(award_date + to_days(CAST(365 * ({_yr}) AS INTEGER)) AS DATE) AS x FROM n)
    SELECT CAST(year(x) AS INTEGER) AS year, count(*) AS n, round(sum(award), 2) AS total, count(*) FILTER (x BETWEEN DATE '{AS_OF}' AND DATE '{AS_OF}' + INTERVAL 180 DAY) AS imminent FROM e GROUP BY 1""")
def ag26_estimated_expiries(spark, d):
    x = F.date_add("award_date", S.contract_years(C("subject")) * 365)
    df = notices(spark, d).withColumn("x", x)
    return df.groupBy(F.year("x").alias("year")).agg(F.count("*").alias("n"), F.round(F.sum("award"), 2).alias("total"), F.count_if(C("x").between(F.lit(AS_OF).cast("date"), F.date_add(F.lit(AS_OF).cast("date"), 180))).alias("imminent"))


@query("n: SELECT source, count(*) AS n, count(*) FILTER (code_raw IS NULL) AS no_code, count(*) FILTER (town_raw IS NULL) AS no_town, round(sum(award), 2) AS total FROM n GROUP BY source")
def ag27_frequency_stats(spark, d):
    return notices(spark, d).groupBy("source").agg(F.count("*").alias("n"), F.count_if(C("code_raw").isNull()).alias("no_code"), F.count_if(C("town_raw").isNull()).alias("no_town"), F.round(F.sum("award"), 2).alias("total"))


_prefix_values = ", ".join(f"('{p}', '{r.replace(chr(39), chr(39) * 2)}')" for p, r in R.PREFIX_REGION.items())
_point_values = ", ".join(f"('{r.replace(chr(39), chr(39) * 2)}', {a}e0, {b}e0)" for r, (a, b) in R.REGION_POINT.items())


@query(f"""n: WITH p(prefix, region) AS (VALUES {_prefix_values}), c(region, lat, lon) AS (VALUES {_point_values})
    SELECT p.region, lat, lon, count(*) AS n, round(sum(award), 2) AS total FROM n JOIN p ON substr(postal_raw, 1, 2) = prefix JOIN c ON p.region = c.region GROUP BY 1, 2, 3""")
def ag28_map_heat(spark, d):
    df = J.looked_up(notices(spark, d), F.substring("postal_raw", 1, 2), R.PREFIX_REGION, "region")
    g = M.keyed(df, "region").groupBy("region").agg(F.count("*").alias("n"), F.round(F.sum("award"), 2).alias("total"))
    return J.looked_up(g, C("region"), R.REGION_POINT, "lat", "lon").filter("lat is not null").select("region", "lat", "lon", "n", "total")


@query("""t: WITH g AS (SELECT supplier, count(*) AS wins, avg(amount) AS m FROM t WHERE category = 'Brand#1' OR category = (SELECT min(category) FROM t) GROUP BY 1),
    b AS (SELECT *, round(wins * 100.0 / sum(wins) OVER (), 1) AS base, max(m) OVER () AS top FROM g)
    SELECT supplier, wins, base, round(base * greatest(0.3, least(1.0, 1 - abs(m - 30000) / top)), 1) AS likelihood FROM b ORDER BY likelihood DESC, wins DESC, supplier LIMIT 10""")
def ag29_win_likelihood(spark, d):
    df = tenders(spark, d)
    first = df.agg(F.min("category").alias("_c"))
    return M.win_likelihood(df.join(F.broadcast(first), C("category") == C("_c")), "supplier", "amount", 30_000)


@query("""t: WITH s AS (SELECT supplier FROM t GROUP BY 1 ORDER BY sum(amount) DESC, supplier LIMIT 1)
    SELECT year, count(*) AS n, round(sum(amount), 2) AS total, count(DISTINCT category) AS categories FROM t WHERE supplier = (SELECT supplier FROM s) AND year >= 1996 GROUP BY year""")
def ag30_supplier_dossier(spark, d):
    df = tenders(spark, d)
    top = df.groupBy("supplier").agg(F.sum("amount").alias("v")).orderBy(F.desc("v"), "supplier").limit(1).select("supplier")
    return df.join(F.broadcast(top), "supplier", "left_semi").filter("year >= 1996").groupBy("year").agg(F.count("*").alias("n"), F.round(F.sum("amount"), 2).alias("total"), F.countDistinct("category").alias("categories"))


@query("n: SELECT count(*) AS n, round(sum(award), 2) AS total, round(avg(award), 2) AS mean FROM n")
def ag31_totals(spark, d):
    return notices(spark, d).agg(F.count("*").alias("n"), F.round(F.sum("award"), 2).alias("total"), F.round(F.avg("award"), 2).alias("mean"))


@query()
def ag32_source_inventory(spark, d):
    """Files, bytes and records of a source, from the scan's own metadata."""
    from ..sources.sources import inventory

    return inventory(table(spark, d, "documents"))


@query("n: SELECT count(*) AS n, round(sum(award), 2) AS total FROM n")
def snk05_kpi_payload(spark, d):
    """The JSON payload, its headline figures read back."""
    df = notices(spark, d).withColumns({"year": F.year("award_date"), "pct": S.percent(C("discount_raw"))})
    doc = M.kpi_payload(df, "award", "pct", "subject", "source", "year")
    return doc.select(F.from_json("payload", "n long, total double").alias("j")).select("j.n", "j.total")


@query("""t: SELECT category, count(*) AS n, round(sum(amount), 2) AS total, min(amount) AS least, max(amount) AS most, true AS suppliers_near, true AS buyers_near, true AS median_near, true AS last_feed_alone FROM t WHERE year >= 1993 GROUP BY category""")
def ag33_states_by_feed(spark, d):
    """Figures from states: all feeds but the last year's at once, then that one, which is all that is read; estimates are held against exact figures.

    Distinct counts are within 2 %, the median's rank within the stated error.
    """
    t = stored(tenders(spark, d).select("category", "supplier", "buyer", "amount", "year", F.date_format("award_date", "yyyy-MM").alias("month")), "feeds")
    states = States(spark, shared_path(spark, "states"), ["category"], ["amount"], ["supplier", "buyer"], ["amount"])
    states.add(t.filter("year < 1998"), "month", "until-1997")
    states.add(t.filter("year >= 1998"), "month", "from-1998")
    told = states.report(["category"], first="1993-01")
    exact = t.filter("month >= '1993-01'").groupBy(C("category").alias("_c")).agg(F.countDistinct("supplier").alias("_s"), F.countDistinct("buyer").alias("_b"))
    near = lambda got, want: F.abs(got - want) <= F.greatest(F.lit(1.0), 0.02 * want)
    out = told.join(exact, C("category") == C("_c"))
    middle = out.select("category", C("quantiles_amount")[0].alias("_m"))
    below = t.filter("month >= '1993-01'").join(middle, "category").groupBy(C("category").alias("_c2")).agg((F.count_if(C("amount") < C("_m")) / F.count("*")).alias("_lo"), (F.count_if(C("amount") <= C("_m")) / F.count("*")).alias("_hi"))
    out = out.join(below, C("category") == C("_c2"))
    own = states.rows().filter("feed = 'from-1998'").agg((F.min("month") >= "1998-01").alias("last_feed_alone"))
    return out.crossJoin(F.broadcast(own)).select("category", "n", F.round("sum_amount", 2).alias("total"), C("min_amount").alias("least"), C("max_amount").alias("most"), near(C("distinct_supplier"), C("_s")).alias("suppliers_near"), near(C("distinct_buyer"), C("_b")).alias("buyers_near"), ((C("_lo") <= 0.505) & (C("_hi") >= 0.495)).alias("median_near"), "last_feed_alone")
