"""SRC-1 to SRC-9, SNK-1 and SNK-2: feeds derived from the tables, written in the feeds' formats and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import nested as N
from ..plans.bindings import notices, table
from ..sources import sinks, sources
from ..sources.archives import write_archives, write_packed
from ..streaming.incremental import month_of, shared_path
from .nested import _base, _ocid, lot_code_records, release_rows
from .registry import query

C = F.col
PER_FILE = 500


def written_packages(spark, d, extra_lines: bool = False):
    """Packages of about PER_FILE releases in one folder; with ``extra_lines`` half of them line by line, with a bad line.

    A folder for each would cost every reader a listing per package.  A task
    writes its releases itself, gzipped: as text they take some ten times the
    room of the tables, and shuffles of it by package are large as well.
    """
    path = shared_path(spark, "packages")

    def whole(number: int, releases: list[str]) -> str:
        if extra_lines and number % 2:
            return "\n".join(releases) + "\n{ broken"
        return '{"releases": [' + ",".join(releases) + "]}"

    write_packed(N.packed_json(*release_rows(spark, d), ordered=True).select("json"), path, "package_{}.txt.gz", PER_FILE, whole)
    return path


@query(f"SELECT {_ocid}, count(*) AS n_lots {_base} GROUP BY o_orderkey")
def src01_packages(spark, d):
    got = sources.read_releases(spark, written_packages(spark, d))
    return got.select("ocid", F.size("tender.lots").cast("long").alias("n_lots"))


@query(f"SELECT count(DISTINCT o_orderkey) AS releases, true AS tagged {_base}")
def src02_tagged_directory(spark, d):
    got = sources.read_releases(spark, written_packages(spark, d))
    return got.agg(F.count("*").alias("releases"), F.every(C("source_file").endswith(".txt.gz")).alias("tagged"))


@query(f"SELECT {_ocid} {_base} GROUP BY o_orderkey")
def src03_tolerant(spark, d):
    got = sources.read_releases_tolerant(spark, written_packages(spark, d, True))
    return got.filter("ocid is not null").select("ocid")


def archives(spark, d):
    """A folder of archives of about PER_FILE lot-code records of a month each, one line of each broken."""
    path = shared_path(spark, "archives")
    r = lot_code_records(spark, d)
    lines = r.select(F.substring("data_pubblicazione", 1, 7).alias("month"), F.to_json(F.struct(*r.columns)).alias("line"))
    text = F.concat(F.array_join(F.sort_array(F.collect_list("line")), "\n"), F.lit("\n{ broken"))
    files = lines.groupBy("month").agg(F.ceil(F.count("*") / PER_FILE).alias("files"))
    parts = lines.join(files, "month").withColumn("part", F.pmod(F.xxhash64("line"), C("files"))).groupBy("month", "part").agg(text.alias("text"))
    name = F.concat(F.lit("cig_json_"), F.translate("month", "-", "_"), F.lit("_"), C("part").cast("string"), F.lit(".zip"))
    write_archives(parts.select(name.alias("name"), F.lit("records.json").alias("member"), "text"), path)
    return path


@query("n: SELECT CAST(id AS VARCHAR) AS cpv, subject FROM n")
def src04_zipped_lines(spark, d):
    return sources.read_lot_codes(spark, archives(spark, d)).select("cpv", C("oggetto_gara").alias("subject"))


@query("n: SELECT strftime(award_date, '%Y-%m') AS month, count(*) AS n FROM n GROUP BY 1")
def src05_archives_by_month(spark, d):
    got = sources.read_lot_codes(spark, archives(spark, d))
    return got.groupBy(month_of(C("source_file")).alias("month")).agg(F.count("*").alias("n"))


@query("n: SELECT count(*) AS good, true AS one_bad_line_each FROM n")
def src12_malformed_lines_of_archives(spark, d):
    """Lines that are no records, counted per archive: each has one."""
    got = sources.malformed_lines(sources.read_zipped_lines(spark, archives(spark, d), suffix=".json"))
    return got.agg(F.sum(C("lines") - C("malformed")).alias("good"), F.every(C("malformed") == 1).alias("one_bad_line_each"))


def written_registry(spark, d, part: int | None = None):
    path = shared_path(spark, "registry")
    n = notices(spark, d) if part is None else notices(spark, d).filter(C("id") % 2 == part)
    rows = n.select(C("id").cast("string").alias("cig"), C("subject").alias("oggetto_gara"), C("town_raw").alias("sezione_regionale"), F.when(C("id") % 5 == 0, "n/d").otherwise(F.round("award", 2).cast("string")).alias("importo_aggiudicazione"))
    rows.write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").csv(path)
    return path


@query("n: SELECT CAST(id AS VARCHAR) AS code, subject, trim(town_raw) AS section, CASE WHEN id % 5 <> 0 THEN round(award, 2) END AS award FROM n")
def src06_registry_csv(spark, d):
    got = sources.read_registry(spark, written_registry(spark, d))
    return got.select("code", "subject", F.trim("section").alias("section"), "award")


@query("n: SELECT CAST(id AS BIGINT) AS id, subject FROM n WHERE id % 5 <> 0")
def src07_malformed_lines(spark, d):
    """Lines whose amount is no number are dropped, without loading chunks."""
    got = sources.read_registry(spark, written_registry(spark, d), "cig long, oggetto_gara string, sezione_regionale string, importo_aggiudicazione double")
    return got.filter("award is not null").select(C("code").alias("id"), "subject")


@query("SELECT o_orderkey, o_orderpriority FROM orders")
def src08_first_existing(spark, d):
    return sources.read_any(spark, [f"{d}/no_such_table.csv", f"{d}/orders.parquet", f"{d}/lineitem.parquet"]).select("o_orderkey", "o_orderpriority")


@query("n: SELECT count(*) AS n, round(sum(CASE WHEN id % 5 <> 0 THEN round(award, 2) END), 2) AS total FROM n")
def src09_many_registries(spark, d):
    got = sources.read_registry(spark, [written_registry(spark, d, 0), written_registry(spark, d, 1)])
    return got.agg(F.count("*").alias("n"), F.round(F.sum("award"), 2).alias("total"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority FROM orders")
def snk01_csv_gz(spark, d):
    path = shared_path(spark, "orders") + ".csv"
    sinks.write_csv(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), path)
    return sources.read_any(spark, [path])


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS anno FROM orders WHERE year(o_orderdate) = 1997")
def snk02_partitioned_parquet(spark, d):
    path = shared_path(spark, "by_year")
    sinks.write_table(table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("anno")), path)
    return spark.read.parquet(path).filter("anno = 1997").select("o_orderkey", C("anno").cast("int").alias("anno"))
