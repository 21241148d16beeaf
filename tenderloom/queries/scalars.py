"""TXT, STR, NUM, DAT, VAL: scalar functions over the raw notices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import scalars as S
from ..functions.classify import quoted
from ..plans.bindings import notices, table
from .registry import query

C = F.col


def title_sql(e: str) -> str:
    return f"array_to_string(list_transform(regexp_extract_all(lower({e}), '[a-zà-öø-ÿ]+|[^a-zà-öø-ÿ]+'), lambda w: upper(w[1]) || w[2:]), '')"


def sentinel_sql(e: str) -> str:
    return f"CASE WHEN lower(trim({e})) NOT IN ('', 'nan', 'none', 'null') THEN trim({e}) END"


@query(f"n: SELECT id, {title_sql('entity_raw')} AS title FROM n")
def txt01_title_case(spark, d):
    return notices(spark, d).select("id", S.title_case(C("entity_raw")).alias("title"))


@query(r"SELECT doc_id, trim(regexp_replace(replace(coalesce(text, ''), '\n', ' '), '[\s\x{00A0}]+', ' ', 'g')) AS cleaned FROM documents")
def txt02_clean_text(spark, d):
    return table(spark, d, "documents").select("doc_id", S.clean_text(C("text")).alias("cleaned"))


@query("SELECT doc_id, sha256(text) AS hash FROM documents")
def txt03_sha256(spark, d):
    return table(spark, d, "documents").select("doc_id", S.content_hash(C("text")).alias("hash"))


@query("n: SELECT id, sha256(coalesce(code_raw, '') || '|' || coalesce(subject, '') || '|' || coalesce(town_raw, '') || '|' || coalesce(date_raw, '')) AS hash FROM n")
def txt04_row_hash(spark, d):
    return notices(spark, d).select("id", S.row_hash(C("code_raw"), C("subject"), C("town_raw"), C("date_raw")).alias("hash"))


@query("n: SELECT id, lower(subject) AS low, CASE WHEN length(subject) > 20 THEN substr(subject, 1, 17) || '...' ELSE subject END AS short FROM n")
def txt05_lower_truncate(spark, d):
    return notices(spark, d).select("id", F.lower("subject").alias("low"), S.truncate(C("subject"), 20).alias("short"))


@query(r"SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '[\s\x{00A0}]+', ' ', 'g')) AS plain FROM pages")
def str06_strip_tags(spark, d):
    return table(spark, d, "pages").select("page_id", S.strip_tags(C("html")).alias("plain"))


@query(r"n: SELECT id, upper(trim(regexp_replace(town_raw, '\s+', ' ', 'g'))) AS town_raw, upper(trim(regexp_replace(entity_raw, '\s+', ' ', 'g'))) AS entity_raw, upper(trim(regexp_replace(subject, '\s+', ' ', 'g'))) AS subject FROM n")
def txt07_normal_upper(spark, d):
    cols = ["town_raw", "entity_raw", "subject"]
    return notices(spark, d).select("id", *[S.normal_upper(C(c)).alias(c) for c in cols])


@query(r"n: WITH p AS (SELECT id, regexp_replace(trim(town_raw), '^(COMUNE\s+DI|SEZIONE\s+REGIONALE)\s+', '', 'i') AS v FROM n) SELECT id, upper(substr(v, 1, 1)) || lower(substr(v, 2)) AS town FROM p")
def txt08_strip_prefix(spark, d):
    return notices(spark, d).select("id", S.strip_prefixes(C("town_raw")).alias("town"))


_particles = ", ".join(quoted(p) for p in R.PARTICLES)


@query(rf"""n: WITH w AS (SELECT id, string_split({title_sql(rf"regexp_replace({sentinel_sql('town_raw')}, '\s+', ' ', 'g')")}, ' ') AS ws FROM n)
    SELECT id, array_to_string(list_transform(ws, lambda x, i: CASE WHEN i > 1 AND x IN ({_particles}) THEN lower(x) ELSE x END), ' ') AS town FROM w""")
def txt09_town_name(spark, d):
    return notices(spark, d).select("id", S.town_name(C("town_raw")).alias("town"))


def _entity_sql(e: str) -> str:
    t = rf"regexp_replace({sentinel_sql(e)}, '\s+', ' ', 'g')"
    t = f"(CASE WHEN {t} = upper({t}) OR {t} = lower({t}) THEN {title_sql(t)} ELSE {t} END)"
    for pattern, form in R.COMPANY_FORMS:
        t = f"regexp_replace({t}, {quoted(pattern)}, {quoted(form)}, 'gi')"
    return t


@query(f"n: SELECT id, {_entity_sql('entity_raw')} AS entity FROM n")
def txt10_entity_name(spark, d):
    return notices(spark, d).select("id", S.entity_name(C("entity_raw")).alias("entity"))


def _label_sql(e: str, labels: dict[str, str]) -> str:
    cases = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in labels.items())
    return f"CASE lower(trim({e})) {cases} ELSE {title_sql(f"replace(trim({e}), '_', ' ')")} END"


@query(f"n: SELECT id, {_label_sql('kind_raw', R.CONTRACT_LABELS)} AS kind, {_label_sql('plant_raw', R.PLANT_LABELS)} AS plant, {_label_sql('subject', R.QUICK_LABELS)} AS quick, {_label_sql('plant_raw', R.ENERGY_LABELS)} AS energy FROM n")
def txt11_code_labels(spark, d):
    return notices(spark, d).select("id", S.code_label(C("kind_raw"), R.CONTRACT_LABELS).alias("kind"), S.code_label(C("plant_raw"), R.PLANT_LABELS).alias("plant"), S.code_label(C("subject"), R.QUICK_LABELS).alias("quick"), S.code_label(C("plant_raw"), R.ENERGY_LABELS).alias("energy"))


@query(f"n: SELECT id, {title_sql("replace(trim(kind_raw), '_', ' ')")} AS kind, {title_sql("replace(trim(plant_raw), '_', ' ')")} AS plant FROM n")
def txt12_underscores(spark, d):
    return notices(spark, d).select("id", S.underscored(C("kind_raw")).alias("kind"), S.underscored(C("plant_raw")).alias("plant"))


@query(f"n: SELECT id, upper({sentinel_sql("string_split(code_raw, ';')[1]")}) AS key FROM n")
def txt13_first_key(spark, d):
    return notices(spark, d).select("id", S.first_key(C("code_raw")).alias("key"))


@query(f"n: SELECT id, CASE WHEN {sentinel_sql('code_raw')} IS NOT NULL THEN 'https://portale.example/cig/' || trim(code_raw) END AS url FROM n")
def txt14_portal_url(spark, d):
    return notices(spark, d).select("id", S.portal_url(C("code_raw"), "https://portale.example/cig/").alias("url"))


@query("""n: WITH p AS (SELECT id, trim(CASE WHEN id % 2 = 0 THEN procedure_raw ELSE procedure_raw END) AS v FROM n)
    SELECT id, CASE WHEN length(v) > 35 THEN substr(v, 1, 35) || '...' ELSE v END AS label FROM p""")
def txt15_procedure_label(spark, d):
    marked = F.when(C("id") % 2 == 0, F.concat(F.lit("codice TITLE: "), C("procedure_raw"))).otherwise(C("procedure_raw"))
    return notices(spark, d).select("id", S.procedure_label(marked).alias("label"))


@query("n: SELECT id, TRY_CAST(amount_raw AS DOUBLE) AS value FROM n")
def num01_number(spark, d):
    return notices(spark, d).select("id", S.number(C("amount_raw")).alias("value"))


@query(r"n: WITH p AS (SELECT id, TRY_CAST(replace(regexp_replace(discount_raw, '[%\s]', '', 'g'), ',', '.') AS DOUBLE) AS pct FROM n) SELECT id, pct, pct / 100 AS share FROM p")
def num02_percent(spark, d):
    pct = S.percent(C("discount_raw"))
    return notices(spark, d).select("id", pct.alias("pct"), S.fraction(pct).alias("share"))


@query("n: SELECT id, round(CASE WHEN base > 0 AND award > 0 AND award <= base THEN (base - award) / base * 100 END, 6) AS discount FROM n")
def num03_discount_from_amounts(spark, d):
    return notices(spark, d).select("id", F.round(S.discount_from_amounts(C("base"), C("award")), 6).alias("discount"))


@query("n: SELECT id, round((award * 0.25e0) * 100 / (award + award * 0.25e0), 2) AS discount FROM n")
def num04_discount_from_reduction(spark, d):
    return notices(spark, d).select("id", S.discount_from_reduction(C("award"), C("award") * 0.25).alias("discount"))


@query(r"n: WITH p AS (SELECT id, TRY_CAST(replace(regexp_replace(discount_raw, '[%\s]', '', 'g'), ',', '.') AS DOUBLE) AS v FROM n) SELECT id, CASE WHEN v BETWEEN 0 AND 100 THEN v END AS valid, greatest(0.0e0, least(100.0e0, v)) + v * 0 AS clipped FROM p")
def num05_clip(spark, d):
    v = S.percent(C("discount_raw"))
    return notices(spark, d).select("id", S.within(v, 0, 100).alias("valid"), S.clipped(v, 0, 100).alias("clipped"))


_amount_sql = r"""(SELECT CASE WHEN x >= 0 THEN x END FROM (SELECT TRY_CAST(CASE
    WHEN contains(z, ',') AND contains(z, '.') AND instr(reverse(z), ',') < instr(reverse(z), '.') THEN replace(replace(z, '.', ''), ',', '.')
    WHEN contains(z, ',') AND contains(z, '.') THEN replace(z, ',', '') WHEN contains(z, ',') THEN replace(z, ',', '.') ELSE z END AS DOUBLE) AS x
    FROM (SELECT regexp_replace(amount_raw, '[€$£¥\s]', '', 'g') AS z)))"""


@query(f"n: SELECT id, {_amount_sql} AS amount FROM n")
def num06_amount(spark, d):
    return notices(spark, d).select("id", S.amount(C("amount_raw")).alias("amount"))


@query("n: SELECT count(*) AS n, count(*) FILTER (award IS NULL) AS missing, count(*) FILTER (award < 0 OR award > 300000) AS invalid, count(CASE WHEN award BETWEEN 0 AND 300000 THEN award END) AS kept FROM n")
def num07_amount_quality(spark, d):
    ok = S.within(C("award"), 0, 300_000)
    return notices(spark, d).agg(F.count("*").alias("n"), F.count_if(C("award").isNull()).alias("missing"), F.count_if((C("award") < 0) | (C("award") > 300_000)).alias("invalid"), F.count(ok).alias("kept"))


@query("n: SELECT id, round(CASE WHEN award > 0 THEN log10(award) END, 9) AS magnitude FROM n")
def num08_log10(spark, d):
    return notices(spark, d).select("id", F.round(F.when(C("award") > 0, F.log10("award")), 9).alias("magnitude"))


@query("""t: WITH g AS (SELECT region, sum(amount) AS total, count(*) AS n, avg(discount) AS disc, count(DISTINCT supplier) AS sup FROM t GROUP BY region)
    SELECT region, round((total - min(total) OVER ()) / nullif(max(total) OVER () - min(total) OVER (), 0), 6) AS total, round((n - min(n) OVER ()) / nullif(max(n) OVER () - min(n) OVER (), 0), 6) AS n,
           round((disc - min(disc) OVER ()) / nullif(max(disc) OVER () - min(disc) OVER (), 0), 6) AS disc, round((sup - min(sup) OVER ()) / nullif(max(sup) OVER () - min(sup) OVER (), 0), 6) AS sup FROM g""")
def num09_min_max_scale(spark, d):
    from ..operators.metrics import min_max_scaled
    from ..plans.bindings import tenders

    g = tenders(spark, d).groupBy("region").agg(F.sum("amount").alias("total"), F.count("*").alias("n"), F.avg("discount").alias("disc"), F.countDistinct("supplier").alias("sup"))
    return min_max_scaled(g, ["total", "n", "disc", "sup"], 6)


_months_sql = "lower(trim(date_raw))"
for _i, _m in enumerate(R.MONTHS, 1):
    _months_sql = rf"regexp_replace({_months_sql}, '\s*\b{_m}\b\s*', '/{_i:02d}/', 'g')"
_date_sql = rf"""(SELECT coalesce(
    CASE WHEN regexp_matches(v, '^\d{{1,2}}/\d{{1,2}}/\d{{4}}$') THEN try_strptime(v, '%d/%m/%Y') END, CASE WHEN regexp_matches(v, '^\d{{1,2}}-\d{{1,2}}-\d{{4}}$') THEN try_strptime(v, '%d-%m-%Y') END,
    CASE WHEN regexp_matches(v, '^\d{{1,2}}\.\d{{1,2}}\.\d{{4}}$') THEN try_strptime(v, '%d.%m.%Y') END, CASE WHEN regexp_matches(v, '^\d{{1,2}}-\d{{1,2}}-\d{{2}}$') THEN try_strptime(v, '%d-%m-%y') END,
    CASE WHEN regexp_matches(v, '^\d{{4}}-\d{{1,2}}-\d{{1,2}}$') THEN try_strptime(v, '%Y-%m-%d') END, CASE WHEN regexp_matches(v, '^\d{{8}}$') THEN try_strptime(v, '%Y%m%d') END,
    CASE WHEN regexp_matches(v, '^\d{{1,2}}/\d{{1,2}}/\d{{4}}$') THEN try_strptime(v, '%m/%d/%Y') END) FROM (SELECT {_months_sql} AS v))"""


@query(f"n: SELECT id, CAST({_date_sql} AS DATE) AS day FROM n")
def dat01_date_of(spark, d):
    return notices(spark, d).select("id", S.date_of(C("date_raw")).alias("day"))


@query(r"n: SELECT id, CAST(CASE WHEN regexp_matches(date_raw, '^\d{1,2}/\d{1,2}/\d{4}$') THEN try_strptime(date_raw, '%d/%m/%Y') END AS DATE) AS day FROM n")
def dat02_day_first(spark, d):
    c = F.when(C("date_raw").rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_timestamp("date_raw", F.lit("d/M/yyyy")))
    return notices(spark, d).select("id", c.cast("date").alias("day"))


@query(f"n: WITH p AS (SELECT CAST({_date_sql} AS DATE) AS v FROM n) SELECT count(*) FILTER (year(v) BETWEEN 2019 AND 2023) AS valid, count(*) FILTER (v IS NULL) AS missing, count(*) AS n FROM p")
def dat03_valid_window(spark, d):
    v = S.date_of(C("date_raw"))
    return notices(spark, d).agg(F.count_if(S.valid_date(v, 2019, 2023).isNotNull()).alias("valid"), F.count_if(v.isNull()).alias("missing"), F.count("*").alias("n"))


@query("t: SELECT key, lot, amount, CASE WHEN date_diff('day', award_date, expiry_date) BETWEEN 1 AND 10949 THEN CAST(date_diff('day', award_date, expiry_date) AS INTEGER) END AS days FROM t")
def dat04_duration_days(spark, d):
    from ..plans.bindings import tenders

    return tenders(spark, d).select("key", "lot", "amount", S.duration_days(C("award_date"), C("expiry_date")).alias("days"))


@query(r"""n: WITH p AS (SELECT id, lower(trim(duration_raw)) AS v FROM n) SELECT id, CAST(CASE
    WHEN v LIKE '%non specificat%' THEN NULL WHEN v LIKE '%giorn%' THEN CAST(regexp_extract(v, '(\d+)', 1) AS INTEGER) WHEN v LIKE '%mesi%' THEN CAST(regexp_extract(v, '(\d+)', 1) AS INTEGER) * 30
    WHEN v LIKE '%anni%' THEN CAST(regexp_extract(v, '(\d+)', 1) AS INTEGER) * 365 WHEN v LIKE '%ventennale%' THEN 7300 WHEN v LIKE '%quinquennale%' THEN 1825
    WHEN v LIKE 'dal %' THEN date_diff('day', DATE '2024-01-01', DATE '2024-12-31') END AS INTEGER) AS days FROM p""")
def dat05_duration_text(spark, d):
    return notices(spark, d).select("id", S.duration_from_text(C("duration_raw")).alias("days"))


@query("n: SELECT id, CAST(award_date + INTERVAL 30 DAY AS DATE) AS later, CAST(award_date + to_days(CAST(365 * (id % 9 + 1) AS INTEGER)) AS DATE) AS expiry FROM n")
def dat06_add_days(spark, d):
    return notices(spark, d).select("id", F.date_add("award_date", 30).alias("later"), F.date_add("award_date", ((C("id") % 9 + 1) * 365).cast("int")).alias("expiry"))


@query("n: SELECT id, CAST(year(award_date) AS INTEGER) AS y, CAST(quarter(award_date) AS INTEGER) AS q, CAST(month(award_date) AS INTEGER) AS m, strftime(award_date, '%Y-%m') AS period FROM n")
def dat07_date_parts(spark, d):
    return notices(spark, d).select("id", F.year("award_date").alias("y"), F.quarter("award_date").alias("q"), F.month("award_date").alias("m"), S.period(C("award_date")).alias("period"))


@query("n: SELECT id, strftime(award_date, '%d/%m/%Y') AS data_aggiudicazione, strftime(award_date + INTERVAL 10 DAY, '%d/%m/%Y') AS data_scadenza, award FROM n")
def dat08_format_date_columns(spark, d):
    df = notices(spark, d).select("id", C("award_date").alias("data_aggiudicazione"), F.date_add("award_date", 10).alias("data_scadenza"), "award")
    return df.withColumns({c: F.date_format(c, "dd/MM/yyyy") for c in df.columns if "data" in c.lower()})


_years_sql = "CASE " + " ".join(f"WHEN lower(subject) LIKE '%{w}%' THEN {y}" for w, y in R.CONTRACT_YEARS) + f" ELSE {R.DEFAULT_YEARS} END"


@query(f"n: SELECT id, CAST({_years_sql} AS INTEGER) AS years, CAST(award_date + to_days(CAST(365 * ({_years_sql}) AS INTEGER)) AS DATE) AS expiry FROM n")
def dat09_estimated_expiry(spark, d):
    years = S.contract_years(C("subject"))
    return notices(spark, d).select("id", years.alias("years"), F.date_add("award_date", years * 365).alias("expiry"))


@query("n: WITH p AS (SELECT CASE WHEN id % 7 = 0 THEN 'N/D' WHEN year(award_date) < 1997 THEN '<1997' ELSE CAST(year(award_date) AS VARCHAR) END AS bucket FROM n) SELECT bucket, count(*) AS n FROM p GROUP BY bucket")
def dat10_display_year(spark, d):
    day = F.when(C("id") % 7 != 0, C("award_date"))
    return notices(spark, d).groupBy(S.display_year(day, 1997).alias("bucket")).agg(F.count("*").alias("n"))


def _code_sql(e: str, pattern: str) -> str:
    return f"CASE WHEN upper(trim({e})) NOT IN ('NON SPECIFICATO', 'NON SPECIFICATA', 'N/A', 'N.A.', '-', '') AND regexp_matches(upper(trim({e})), '{pattern}') THEN upper(trim({e})) END"


@query(f"n: SELECT id, {_code_sql('code_raw', '^(?:[0-9A-F]{10}|[ZX][0-9A-F]{9})$')} AS code FROM n")
def val01_lot_code(spark, d):
    return notices(spark, d).select("id", S.lot_code(C("code_raw")).alias("code"))


@query(f"n: SELECT id, {_code_sql('project_raw', '^[A-Z][0-9A-Z]{14}$')} AS code FROM n")
def val02_project_code(spark, d):
    return notices(spark, d).select("id", S.project_code(C("project_raw")).alias("code"))


_digits_sql = r"regexp_replace(vat_raw, '\D', '', 'g')"
_luhn_sql = "(SELECT CASE WHEN length(v) = 11 AND list_sum(list_transform(range(1, 12), lambda i: CASE WHEN i % 2 = 1 THEN CAST(v[i] AS INTEGER) WHEN CAST(v[i] AS INTEGER) < 5 THEN 2 * CAST(v[i] AS INTEGER) ELSE 2 * CAST(v[i] AS INTEGER) - 9 END)) % 10 = 0 THEN v END FROM (SELECT {} AS v))"


@query(f"n: SELECT id, {_luhn_sql.format(_digits_sql)} AS vat FROM n")
def val03_vat_number(spark, d):
    return notices(spark, d).select("id", S.vat_number(C("vat_raw")).alias("vat"))


@query(f"n: SELECT id, CASE WHEN regexp_matches(upper(trim(vat_raw)), '^[A-Z]{{6}}[0-9]{{2}}[A-Z][0-9]{{2}}[A-Z][0-9]{{3}}[A-Z]$') THEN upper(trim(vat_raw)) WHEN regexp_matches(trim(vat_raw), '^[0-9]{{11}}$') THEN {_luhn_sql.format('trim(vat_raw)')} END AS code FROM n")
def val04_tax_code(spark, d):
    return notices(spark, d).select("id", S.tax_code(C("vat_raw")).alias("code"))


@query(r"n: SELECT id, CASE WHEN regexp_matches(lower(trim(email_raw)), '^[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}$') THEN lower(trim(email_raw)) END AS email FROM n")
def val05_email(spark, d):
    return notices(spark, d).select("id", S.email(C("email_raw")).alias("email"))


@query(r"n: SELECT id, CASE WHEN regexp_matches(upper(trim(coalesce(code_raw, ''))), '^[A-Z0-9]+$') THEN upper(trim(code_raw)) ELSE '' END AS code, CASE WHEN len(regexp_extract_all(discount_raw, '\d+(?:[.,]\d+)?')) = 1 THEN TRY_CAST(replace(regexp_extract(discount_raw, '\d+(?:[.,]\d+)?'), ',', '.') AS DOUBLE) END AS discount FROM n")
def val06_code_and_single_number(spark, d):
    return notices(spark, d).select("id", S.alnum_code(C("code_raw")).alias("code"), S.single_number(C("discount_raw")).alias("discount"))


@query("n: SELECT coalesce(lower(kind_raw) IN ('works', 'services', 'goods'), false) AS valid, count(*) AS n FROM n GROUP BY 1")
def val07_enum_membership(spark, d):
    return notices(spark, d).groupBy(F.coalesce(F.lower("kind_raw").isin("works", "services", "goods"), F.lit(False)).alias("valid")).agg(F.count("*").alias("n"))


@query(f"""n: WITH p AS (SELECT id, list_filter([CASE WHEN {_code_sql('code_raw', '^(?:[0-9A-F]{10}|[ZX][0-9A-F]{9})$')} IS NULL THEN 'code' END, CASE WHEN {_amount_sql} IS NULL THEN 'amount' END,
    CASE WHEN kind_raw IS NULL THEN 'kind' END], lambda x: x IS NOT NULL) AS r FROM n) SELECT id, len(r) = 0 AS valid, array_to_string(r, ',') AS reasons FROM p""")
def val08_quarantine(spark, d):
    df = notices(spark, d).withColumn("reasons", S.reasons({"code": S.lot_code(C("code_raw")).isNotNull(), "amount": S.amount(C("amount_raw")).isNotNull(), "kind": C("kind_raw").isNotNull()}))
    return df.select("id", (F.size("reasons") == 0).alias("valid"), F.array_join("reasons", ",").alias("reasons"))


@query("n: SELECT id, coalesce(TRY_CAST(method_raw AS INTEGER), -1) AS code FROM n")
def val09_cast_or(spark, d):
    return notices(spark, d).select("id", S.cast_or(C("method_raw"), "int", -1).alias("code"))
