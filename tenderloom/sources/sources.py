"""Readers of the feeds: release packages, NDJSON in ZIP archives, registry CSVs, web pages."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shipping import ship
from .archives import member_lines, members_of
from .packages import documents_of

C = F.col

RELEASE = (
    "ocid string, id string, date string, tag array<string>, initiationType string, "
    "tender struct<id:string, title:string, description:string, status:string, value:struct<amount:double, currency:string>, tenderPeriod:struct<startDate:string, endDate:string>, "
    "procurementMethod:string, procurementMethodDetails:string, mainProcurementCategory:string, awardCriteria:string, numberOfTenderers:int, items:array<struct<description:string, classification:struct<id:string, description:string>>>, "
    "lots:array<struct<id:string, title:string, description:string, value:struct<amount:double>>>, documents:array<struct<title:string>>>, "
    "buyer struct<id:string, name:string>, parties array<struct<id:string, name:string, roles:array<string>, address:struct<locality:string, postalCode:string>>>, "
    "awards array<struct<title:string, description:string, date:string, value:struct<amount:double, currency:string>, suppliers:array<struct<id:string, name:string>>, items:array<struct<description:string, relatedLot:string>>>>, "
    "contracts array<struct<title:string, description:string, period:struct<startDate:string, endDate:string>>>"
)
LOT_CODE = (
    "cig string, oggetto_gara string, oggetto_lotto string, descrizione_cpv string, sezione_regionale string, cod_tipo_scelta_contraente string, importo_complessivo_gara double, importo_aggiudicazione double, "
    "data_pubblicazione string, data_scadenza_offerta string, denominazione_amministrazione_appaltante string, oggetto_principale_contratto string, cpv string"
)
REGISTRY_NAMES = {"cig": "code", "oggetto_gara": "subject", "oggetto_lotto": "lot_subject", "sezione_regionale": "section", "denominazione_amministrazione_appaltante": "buyer", "importo_complessivo_gara": "base", "importo_aggiudicazione": "award", "data_pubblicazione": "published"}


def release_schema() -> T.StructType:
    return T._parse_datatype_string(RELEASE)


def lot_code_schema() -> T.StructType:
    return T._parse_datatype_string(LOT_CODE)


def read_releases(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per release with a tender, tagged with its file.

    A file is read by as many tasks as Spark cuts it into (packages.py).  One
    whose brackets or quotes don't close gives no rows, a release that can't be
    parsed neither.
    """
    found, _ = documents_of(spark, path)
    return found.filter("kind = 'package'").select(F.from_json("text", release_schema()).alias("r"), "source_file").filter(C("r.tender").isNotNull()).select("r.*", "source_file")


def read_releases_tolerant(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per release from packages or bare releases, whole-file or line by line; bad lines come back in ``bad``.

    Files that are one document are read as such; the others, whose names the
    driver lists, as lines, each a package or a bare release.
    """
    found, files = documents_of(spark, path)
    own = F.from_json("text", release_schema())
    some = C("r.tender").isNotNull() | C("r.buyer").isNotNull() | C("r.awards").isNotNull()
    good = found.select(own.alias("r"), "source_file", "kind").filter((C("kind") == "package") | some).select("r.*", "source_file", F.lit(None).cast("string").alias("bad"))
    as_lines = [r["path"] for r in files.filter("kind = 'lines'").select("path").collect()]
    if not as_lines:
        return good
    lines = spark.read.text(as_lines).select("value", F.xxhash64("_metadata.file_path").alias("file")).filter(F.trim("value") != "")
    lines = lines.join(F.broadcast(files.filter("kind = 'lines'").select("file", "source_file")), "file").drop("file")
    package, bare = F.from_json("value", f"struct<releases:array<struct<{_fields(RELEASE)}>>>")["releases"], F.from_json("value", f"struct<{_fields(RELEASE)}>")
    bare = F.when(bare["tender"].isNotNull() | bare["buyer"].isNotNull() | bare["awards"].isNotNull(), F.array(bare))
    lines = lines.withColumn("found", F.coalesce(package, bare)).withColumn("bad", F.when(C("found").isNull(), C("value")))
    return good.unionByName(lines.select(F.explode_outer("found").alias("r"), "source_file", "bad").filter(C("r").isNotNull() | C("bad").isNotNull()).select("r.*", "source_file", "bad"))


def _fields(ddl: str) -> str:
    """Top-level ``name type`` pairs of a DDL string as ``name:type``."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(ddl + ","):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            name, kind = ddl[start:i].strip().split(" ", 1)
            out.append(f"{name}:{kind}")
            start = i + 1
    return ", ".join(out)


def read_zipped_lines(spark: SparkSession, path: str | list[str], pattern: str = "*.zip", suffix: str = "") -> DataFrame:
    """file, member, line of the members of ZIP archives whose name ends with ``suffix``; undecodable bytes are replaced.

    A member is one task at least, and is inflated as it is read (archives.py).
    """
    return member_lines(members_of(spark, path, pattern, suffix))


def read_lot_codes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lot-code records from NDJSON in ZIP archives; malformed lines are skipped."""
    return lot_codes(read_zipped_lines(spark, path, suffix=".json"))


def malformed_lines(lines: DataFrame) -> DataFrame:
    """Per file: how many lines its members have, and how many of them are no JSON objects."""
    broken = F.try_parse_json("line").isNull()
    return lines.filter(F.trim("line") != "").groupBy("file").agg(F.count("*").alias("lines"), F.count_if(broken | ~F.ltrim("line").startswith("{")).alias("malformed"))


def lot_codes(lines: DataFrame) -> DataFrame:
    r = F.from_json("line", LOT_CODE)
    return lines.select(r.alias("r"), C("file").alias("source_file")).filter(C("r.cig").isNotNull() | C("r.oggetto_gara").isNotNull()).select("r.*", "source_file")


def read_registry(spark: SparkSession, path: str | list[str], schema: str | None = None, encoding: str = "ISO-8859-1", sep: str = ";") -> DataFrame:
    """A registry CSV (or several): renamed, amounts as numbers; lines that don't fit are dropped."""
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", encoding).option("mode", "DROPMALFORMED")
    df = (reader.schema(schema) if schema else reader).csv(path)
    df = df.withColumnsRenamed({k: v for k, v in REGISTRY_NAMES.items() if k in df.columns})
    return df.withColumns({c: C(c).try_cast("double") for c in ("base", "award") if c in df.columns})


def read_any(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The first of the paths that exists, by its suffix: parquet, orc, json, csv (also .gz)."""
    jvm = spark.sparkContext._jvm
    for p in paths:
        h = jvm.org.apache.hadoop.fs.Path(p)
        if h.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(h):
            kind = p.removesuffix(".gz").rsplit(".", 1)[-1].lower()
            if kind == "csv":
                return spark.read.option("header", True).csv(p)
            return spark.read.format(kind if kind in ("parquet", "orc", "json") else "parquet").load(p)
    raise FileNotFoundError(f"none of {paths}")


def section_links(pages: DataFrame, id_col: str, html_col: str, marker: str, heading: str) -> DataFrame:
    """Distinct links per section of a page whose first text matches ``heading``; a section begins at ``marker``."""
    parts = pages.select(id_col, F.posexplode(F.split(html_col, marker)).alias("section", "part")).filter("section > 0").filter(F.regexp_extract("part", "^([^<]*)", 1).rlike(heading))
    return parts.select(id_col, "section", F.array_distinct(F.regexp_extract_all("part", F.lit('href="([^"]*)"'), 1)).alias("links"))


def tag_blocks(html: str | None, tag: str) -> list[str]:
    """What stands inside each element of a tag, by where it begins: nested ones too, one that is never closed up to the end.

    Tags in comments, scripts and styles don't count, nor do closing tags without
    an open element.
    """
    if not html:
        return []
    pattern = re.compile(rf"<!--.*?-->|<(script|style)\b.*?</\1\s*>|<(/?){re.escape(tag)}(?=[\s/>])[^>]*>", re.I | re.S)
    found, open_ = [], []
    for m in pattern.finditer(html):
        if m[2] == "":
            open_.append(len(found))
            found.append((m.end(), len(html)))
        elif m[2] and open_:
            at = open_.pop()
            found[at] = (found[at][0], m.start())
    return [html[a:b] for a, b in found]


def html_blocks(pages: DataFrame, id_col: str, html_col: str, tag: str, keep: str) -> DataFrame:
    """Text and first link of each block of a tag (see ``tag_blocks``), where the text matches ``keep``."""
    from ..functions.scalars import strip_tags

    ship(pages.sparkSession)

    @F.pandas_udf("array<string>")
    def found(html: pd.Series) -> pd.Series:
        return html.map(lambda x: tag_blocks(x, tag))

    blocks = pages.select(id_col, F.posexplode(found(html_col)).alias("block", "raw"))
    rows = blocks.select(id_col, "block", strip_tags(C("raw")).alias("text"), F.nullif(F.regexp_extract("raw", 'href="([^"]*)"', 1), F.lit("")).alias("link"))
    return rows.filter(C("text").rlike(keep))


def inventory(df: DataFrame) -> DataFrame:
    """Records, and bytes, per file of a file-based frame."""
    return df.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("records"), F.max("_metadata.file_size").alias("bytes"))
