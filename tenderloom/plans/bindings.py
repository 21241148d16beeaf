"""The procurement view of the star-schema tables that the registered queries run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark".split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LOTS_AT_ONCE = 1_000_000


def tenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per awarded lot: key, lot, buyer, supplier, category, plant, method, region, town, amount, discount (percent), offers, award_date, expiry_date, year.

    The large tables join on their keys; the small ones (by count, not by
    guess) are left to Spark's size check to broadcast.  Column pruning keeps
    out what a query does not use.  Where scans are larger than LOTS_AT_ONCE,
    lots are dealt out by their order in tasks of about that many: sorts and
    groups of a task, which follow in it, then don't grow with the table.
    """
    li, o, c, s, p, n, r = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "supplier", "part", "nation", "region"))
    tasks = -(-li.count() // LOTS_AT_ONCE)
    li = li.repartition(tasks, "l_orderkey") if tasks > li.rdd.getNumPartitions() else li
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).join(s, li.l_suppkey == s.s_suppkey).join(p, li.l_partkey == p.p_partkey)
    j = j.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.select(
        F.col("l_orderkey").alias("key"),
        F.col("l_linenumber").alias("lot"),
        F.col("c_name").alias("buyer"),
        F.col("s_name").alias("supplier"),
        F.col("p_brand").alias("category"),
        F.col("p_type").alias("plant"),
        F.col("o_orderpriority").alias("method"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("town"),
        F.col("l_extendedprice").alias("amount"),
        (F.col("l_discount") * 100).alias("discount"),
        F.col("l_quantity").alias("offers"),
        F.col("o_orderdate").cast("date").alias("award_date"),
        F.col("l_shipdate").cast("date").alias("expiry_date"),
        F.year("o_orderdate").alias("year"),
    )


#: The same view for DuckDB.
TENDERS_SQL = """t AS (
    SELECT l_orderkey AS key, l_linenumber AS lot, c_name AS buyer, s_name AS supplier, p_brand AS category, p_type AS plant,
           o_orderpriority AS method, r_name AS region, n_name AS town, l_extendedprice AS amount, l_discount * 100 AS discount,
           l_quantity AS offers, CAST(o_orderdate AS DATE) AS award_date, CAST(l_shipdate AS DATE) AS expiry_date,
           CAST(year(o_orderdate) AS INTEGER) AS year
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
         JOIN part ON l_partkey = p_partkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


#: CASEs over literals and the same choice as a look into an array, which takes Spark a few instructions.
_BY_PLACE: dict[str, str] = {}


def _choose(key: str, values: list[str | None], as_text: bool = True) -> str:
    """A CASE that takes the values in turn by the key."""
    shown = ["NULL" if v is None else "'" + v.replace("'", "''") + "'" if as_text else v for v in values]
    case = f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(shown)) + " END"
    if as_text:
        _BY_PLACE[case] = f"get(array({', '.join(shown)}), CAST({key} % {len(values)} AS INT))"
    return case


SUBJECTS = [
    "Servizio di illuminazione pubblica e manutenzione impianti", "Fornitura di arredi per uffici", "Riqualificazione energetica della scuola media",
    "Sistema di videosorveglianza urbana con telecamere", "Gestione integrata rifiuti e raccolta differenziata", "Realizzazione pista ciclabile e segnaletica stradale",
    "Colonnine di ricarica per veicoli elettrici", "Manutenzione del verde pubblico e giardini comunali", "Adesione Consip servizio luce 3", "Convenzione SIE4 sigef 1615",
    "Museo civico: illuminazione festiva", "Museo civico e illuminazione pubblica a led", "Acquedotto e rete idrica: lavori di manutenzione", "Impianto fotovoltaico sul palazzo comunale",
    "Smart city e sensori IoT per il comune", "Parcheggio con parcometri e gestione automatizzata", "Galleria stradale: impianti e ventilazione", "Pulizia uffici", "Siemens SIE 4 assistenza",
    "Servizio luce consip convenzione", "Palestra comunale: ristrutturazione", "Caldaie per edifici pubblici", "Fibra ottica e digitalizzazione dei servizi", "Lavori di asfalto su strade e viadotti",
    "Depuratore e collettore fognario", "Relamping a LED di edifici comunali", "Luce naturale nelle sale", "abc", "Global service immobili comunali", "Trasporto pubblico locale: autobus",
]
PROCEDURE_TEXTS = [
    "open", "SELECTIVE", "limited", "direct", "Affidamento diretto in adesione ad accordo quadro/convenzione", "Affidamento diretto", "Confronto competitivo", "Sistema di qualificazione", "Dialogo competitivo",
    "Partenariato per l'innovazione", "Concessione di servizi", "Procedura negoziata senza previa pubblicazione", "Procedura negoziata con pubblicazione", "Procedura negoziata", "Procedura ristretta", "PROCEDURA APERTA",
    "MePA ordine", "RdO aperto a tutti", "Manifestazione di interesse", "Procedura competitiva con negoziazione", "Procedura selettiva", "Pubblico incanto", "Variante in corso", "Modifica del contratto", "Project financing",
    "Sistema dinamico", "Concorso di idee", "Cottimo fiduciario", "Asta elettronica", "Offerta economicamente vantaggiosa", "Prezzo basso", "Avviso", "Bando e gara", "Settori speciali", "ai sensi art. 36", "art. 60", "art. 61",
    "art. 63 codice", "art. 54", "art. 57 c. 2", "art. 125", "art. 183", "art. 106", "art. 112", "gara europea", "Sintel", "riservato", "boh", None,
]
TOWNS = ["ACQUAVIVA DELLE FONTI", "L'AQUILA", "reggio  emilia", "Torino", "MILANO", "nan", None, "  roma ", "san giovanni a teduccio", "FORLÌ", "COMUNE DI bari", "Ignota"]
ENTITIES = ["ENEL SOLE SRL", "Enel Sole S.r.l.", "ENEL S.P.A.", "Spazio Verde", None, "nan", "city green light s.r.l.", "HERA LUCE S.P.A", "coop servizi", "Hera Luce spa", "A2A ILLUMINAZIONE PUBBLICA SRL", "A2A Illuminazione  Pubblica"]
D, M, Y = "day(o_orderdate)", "month(o_orderdate)", "(year(o_orderdate) + 23)"
_dd, _mm = f"lpad(CAST({D} AS STRING), 2, '0')", f"lpad(CAST({M} AS STRING), 2, '0')"
_month = "CASE " + M + " " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate("gennaio febbraio marzo aprile maggio giugno luglio agosto settembre ottobre novembre dicembre".split(), 1)) + " END"
_s = lambda e: f"CAST({e} AS STRING)"
K = "o_orderkey"
_italian = f"{_s(f'{K} % 900 + 100')} || '.' || lpad({_s(f'{K} % 1000')}, 3, '0') || ',' || lpad({_s(f'{K} % 100')}, 2, '0')"

#: Raw notices derived from orders, with the irregular fields that feeds have; the text runs in Spark SQL and DuckDB alike.
NOTICES_SQL = f"""SELECT {K} AS id,
    {_choose(K, SUBJECTS)} AS subject,
    {_choose(f'({K} + 3)', PROCEDURE_TEXTS)} AS procedure_raw,
    {_choose(K, TOWNS)} AS town_raw,
    {_choose(K, ENTITIES)} AS entity_raw,
    {_choose(K, [f"lpad({_s(K)}, 10, '0')", f"'ZB' || lpad({_s(K)}, 8, '0')", "'non specificato'", f"' x' || lpad({_s(K)}, 9, '0') || ' '", "''", "NULL", f"lpad({_s(K)}, 10, '0') || ';' || lpad({_s(f'{K} + 1')}, 10, '0')", "'QW12345678'"], False)} AS code_raw,
    {_choose(K, [f"'B12F' || lpad({_s(K)}, 11, '0')", "'B12'", "NULL", f"'c11' || lpad({_s(K)}, 12, '0')"], False)} AS project_raw,
    {_choose(K, [f"lpad({_s(f'({K} * 7919) % 100000000000')}, 11, '0')", "'12345678903'", "'IT 12345678903'", "'123'", "NULL", "'RSSMRA80A01H501U'"], False)} AS vat_raw,
    {_choose(K, [f"'Ufficio.' || {_s(K)} || '@comune.it'", "'non valida'", "NULL", "' GARE@ente.gov.it '"], False)} AS email_raw,
    {_choose(K, [_italian, f"'€ ' || {_italian}", f"{_s(f'{K} % 900 + 100')} || '.' || {_s(f'{K} % 10')}", f"'$' || {_s(f'{K} % 9 + 1')} || ',234.56'", "'-100'", "'n/d'", "NULL", f"{_s(f'{K} % 5000')} || ',5'"], False)} AS amount_raw,
    {_choose(K, [f"{_s(f'{K} % 120')} || ',300%'", f"'Ribasso economico ' || {_s(f'{K} % 60')} || ',678%...'", f"'- ' || {_s(f'{K} % 99')} || ',919 %'", "'43.0'", "'150%'", "''", "NULL", f"{_s(f'{K} % 130')}"], False)} AS discount_raw,
    {_choose(K, [f"{_dd} || '/' || {_mm} || '/' || {_s(Y)}", f"{_s(Y)} || '-' || {_mm} || '-' || {_dd}", f"{_s(D)} || ' ' || {_month} || ' ' || {_s(Y)}", "'non specificata'", "'31/02/2024'", "NULL", f"{_s(D)} || '.' || {_s(M)} || '.' || {_s(Y)}", f"{_s(Y)} || {_mm} || {_dd}", f"{_dd} || '-' || {_mm} || '-' || substr({_s(Y)}, 3, 2)", "'invalid'"], False)} AS date_raw,
    {_choose(K, [f"{_s(f'{K} % 9 + 1')} || ' anni'", f"{_s(f'{K} % 24 + 1')} || ' mesi'", f"{_s(f'{K} % 90 + 1')} || ' giorni'", "'Ventennale'", "'dal 01/01/2024 al 31/12/2024'", "'non specificata'", "NULL", "'durata quinquennale'", "'altro'"], False)} AS duration_raw,
    {_choose(K, ["Works", "services", "goods", "accordo_quadro", None, "altro_tipo"])} AS kind_raw,
    {_choose(K, ["pubblica_illuminazione", "smart_city", "Illuminazione Pubblica", None, "rete_gas"])} AS plant_raw,
    {_choose(K, ["01", "02", "08", "23", "99", "1", None])} AS method_raw,
    {_choose(K, ["20121", "00184", "9", None, "70122", "33100", "49000"])} AS postal_raw,
    {_choose(K, ["SEZIONE REGIONALE LOMBARDIA", " sezione regionale emilia romagna ", "ALTRO", None])} AS section_raw,
    {_choose(K, ["Gazzetta", "CONSIP", "OCDS", "CIG_JSON"])} AS source,
    o_totalprice AS award, o_totalprice * (0.9e0 + ({K} % 40) / 100.0e0) AS base, CAST(o_orderdate AS DATE) AS award_date,
    {_choose(K, SUBJECTS)} || ' nel Comune di ' || coalesce({_choose(K, [t for t in TOWNS])}, 'Ignoto') || ', CIG: ' || lpad({_s(K)}, 10, '0') || ' importo euro ' || {_italian} || ' del ' || {_s(D)} || ' ' || {_month} || ' ' || {_s(Y)} || '. Aggiudicata a ' || coalesce({_choose(K, ENTITIES)}, 'nessuno') AS text
    FROM orders"""
NOTICES_SQL = NOTICES_SQL.replace("STRING", "VARCHAR")


ROWS_AT_ONCE = 50_000


def spread(df: DataFrame) -> DataFrame:
    """The same rows in tasks of about ROWS_AT_ONCE, at least as many as there are cores, where a scan has fewer: for costly expressions, so that no task grows with the table.

    Rows are counted before: ``df`` is a projection of a stored table.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_AT_ONCE))
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df


def notices(spark: SparkSession, sf_dir: str, by_place: bool = False) -> DataFrame:
    """The rows of NOTICES_SQL.

    ``by_place``: choices among literals are looks into arrays, which is
    cheaper where many columns are cleaned; as CASEs of up to 49 branches they
    are copied into every expression on them.  Patterns on them want the CASE,
    into whose branches Spark moves a pattern.
    """
    text = NOTICES_SQL
    for case, place in _BY_PLACE.items() if by_place else ():
        text = text.replace(case, place)
    return spark.sql(text.replace("VARCHAR", "STRING").replace("FROM orders", "FROM {orders}"), orders=table(spark, sf_dir, "orders"))


NOTICES_CTE = f"n AS ({NOTICES_SQL})"
