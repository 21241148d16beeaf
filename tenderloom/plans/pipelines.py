"""The composed pipelines: standardise each source, unify, enrich."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify as K
from ..functions import rules as R
from ..functions import scalars as S
from ..operators import dedup as D
from ..operators import fuzzy as Z
from ..operators import joins as J
from ..operators.interim import stored

C = F.col
TYPES = {"importo_aggiudicazione": "double", "sconto": "double", "offerte_ricevute": "double", "num_lotti": "double", "filter_confidence": "double", "data_aggiudicazione": "timestamp", "data_scadenza": "timestamp", "scadenza_gara": "timestamp", "anno": "int"}


def unified(df: DataFrame, source: str, columns: dict[str, Column]) -> DataFrame:
    """The canonical columns in their order and types; those not given are NULL; sentinels are NULL from here on."""
    given = columns | {"fonte": F.lit(source)}
    out = []
    for name in R.UNIFIED_COLUMNS:
        c = given.get(name, F.lit(None))
        kind = TYPES.get(name, "string")
        out.append((S.sentinel_null(c.cast("string")) if kind == "string" else c.try_cast(kind) if name in given else c.cast(kind)).alias(name))
    return df.select(*out)


def from_gazette(df: DataFrame) -> DataFrame:
    """Notices: code_raw, subject, text, award, discount_raw, award_date, town_raw, entity_raw, procedure_raw, kind_raw, plant_raw, duration_raw."""
    from ..functions.extract import discount_in

    day = C("award_date").cast("timestamp")
    return unified(df, "Gazzetta", {"cig": C("code_raw"), "oggetto": C("subject"), "testo_completo": C("text"), "importo_aggiudicazione": C("award"), "sconto": discount_in(C("discount_raw")), "data_aggiudicazione": day, "comune": C("town_raw"), "ente_appaltante": C("entity_raw"), "procedura": C("procedure_raw"), "tipo_appalto": C("kind_raw"), "tipo_impianto": C("plant_raw"), "durata_appalto": C("duration_raw")})


def from_releases(df: DataFrame, source: str = "OCDS") -> DataFrame:
    """Flat releases or lot-code records that carry the same columns."""
    have = set(df.columns)
    get = lambda c: C(c) if c in have else F.lit(None)
    discount = S.discount_from_amounts(get("base").cast("double"), get("award").cast("double"))
    return unified(df, source, {"cig": get("code"), "ocid": get("ocid"), "oggetto": get("subject"), "testo_completo": get("text"), "importo_aggiudicazione": get("award"), "sconto": discount, "data_aggiudicazione": get("published"), "ente_appaltante": get("buyer"), "regione": get("region"), "aggiudicatario": get("supplier"), "procedura": get("procedure"), "cpv_code": get("cpv"), "offerte_ricevute": get("offers"), "comune": get("town")})


def from_frameworks(df: DataFrame) -> DataFrame:
    """Framework rows: code, subject, buyer, award, award_date, agreement, edition, confidence."""
    return unified(df, "CONSIP", {"cig": C("code"), "oggetto": C("subject"), "ente_appaltante": C("buyer"), "importo_aggiudicazione": C("award"), "data_aggiudicazione": C("award_date").cast("timestamp"), "tipo_accordo": C("agreement"), "edizione": C("edition"), "filter_confidence": C("confidence")})


def framework_table(notices: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Notices of framework agreements, one per first code, and historical rows whose code is not among them."""
    f = notices.withColumn("f", K.framework(C("subject"))).filter(C("f").isNotNull())
    f = f.select("id", S.first_key(C("code_raw")).alias("code"), C("code_raw").alias("codes"), "subject", C("entity_raw").alias("buyer"), "award", "award_date", "f.agreement", "f.edition", "f.confidence", "source")
    new = D.best_per_key(f, "code", [F.when(C("source") == "OCDS", 0).otherwise(1), C("id")])
    if history is None:
        return new
    old = J.absent_from_lists(history, new, "code", "codes")
    return new.unionByName(old, allowMissingColumns=True)


CRITICAL = ["oggetto", "importo_aggiudicazione", "ente_appaltante", "comune", "aggiudicatario", "data_aggiudicazione", "procedura"]


def unify(frames: list[DataFrame], fuzzy: bool = False, most: float = 1e10, years: tuple[int, int] = (2000, 2030)) -> DataFrame:
    """Union, cross-source survivor per code, amounts, dates, keys, labels, towns, regions; entities by fuzzy match on request.

    Award, expiry and tender dates outside ``years`` are NULL.
    """
    df = J.union_aligned(frames).withColumn("cig", S.first_key(C("cig")))
    prio = F.lit(R.OTHER_PRIORITY)
    for name, p in R.SOURCE_PRIORITY.items():
        prio = F.when(C("fonte") == name, p).otherwise(prio)
    tie = F.xxhash64(*R.UNIFIED_COLUMNS)
    df = D.best_per_key(df, "cig", [prio, D.completeness(CRITICAL).desc(), tie])
    day = S.valid_date(C("data_aggiudicazione"), *years)
    df = df.withColumns({
        "importo_aggiudicazione": S.within(C("importo_aggiudicazione"), 0, most),
        "sconto": S.within(C("sconto"), 0, 100),
        "data_aggiudicazione": day,
        **{c: S.valid_date(C(c), *years).cast(kind) for c, kind in df.dtypes if c in ("data_scadenza", "scadenza_gara")},
        "anno": F.year(day),
        "chiave": F.coalesce("cig", "ocid"),
        "categoria": S.title_case(F.coalesce("categoria", "quick_category")),
        "tipo_appalto": S.code_label(C("tipo_appalto"), R.CONTRACT_LABELS),
        "tipo_impianto": S.code_label(C("tipo_impianto"), R.PLANT_LABELS),
        "procedura": K.procedure(C("procedura")),
        "comune": S.town_name(C("comune")),
        "ente_appaltante": S.entity_name(C("ente_appaltante")),
        "aggiudicatario": S.entity_name(C("aggiudicatario")),
    })
    df = J.looked_up(df, C("comune"), R.TOWN_REGION, "_region").withColumn("regione", F.coalesce("regione", "_region")).drop("_region")
    if fuzzy:
        df = stored(df.select(*R.UNIFIED_COLUMNS), "unified")  # the names are counted before they are replaced
        names = Z.canonical(df, "ente_appaltante").filter(C("canonical") != C("name"))  # stored, so that their size is known: they may be few
        names = stored(names.select(C("name").alias("ente_appaltante"), "canonical"), "renamed")
        df = df.join(names, "ente_appaltante", "left").withColumn("ente_appaltante", F.coalesce("canonical", "ente_appaltante")).drop("canonical")
    return df.select(*R.UNIFIED_COLUMNS)


def minutes_table(registry: DataFrame, minutes: DataFrame, awards: DataFrame, key: str = "code") -> DataFrame:
    """Minutes with their registry rows; those without a code or a match stay; award rows multiply."""
    out = minutes.join(registry, key, "left").join(awards, key, "left")
    return out.withColumns({c: F.date_format(c, "dd/MM/yyyy") for c, t in out.dtypes if "data" in c.lower() and t in ("date", "timestamp")})


def lighting_table(registry: DataFrame, awards: DataFrame, base_url: str) -> DataFrame:
    """Lighting-service rows with edition, award figures, discount, duration and link."""
    df = registry.filter(K.any_keyword([C("subject"), C("text")], ["servizio luce", "illuminazione pubblica", "pubblica illuminazione"]))
    df = df.withColumn("edition", K.edition(F.concat_ws(" ", "subject", "text"))).join(awards, "code", "left")
    return df.withColumns({"discount": S.discount_from_amounts(C("base"), C("award")), "days": S.duration_days(C("award_date"), C("expiry_date")), "url": S.portal_url(C("code"), base_url)})


def final_transform(df: DataFrame, flags: DataFrame) -> DataFrame:
    """Dates, percents, date parts, upper-case texts, one row per code, flag join, sort keys, minor-price mark."""
    df = D.best_per_key(df.withColumn("code", S.first_key(C("code_raw"))), "code", [C("id")])
    day = S.date_of(C("date_raw"))
    df = df.withColumns({"day": day, "share": S.fraction(S.percent(C("discount_raw"))), "y": F.year(day), "q": F.quarter(day), "m": F.month(day), "subject": S.normal_upper(C("subject")), "town": S.normal_upper(C("town_raw"))})
    df = df.join(flags.select("id").distinct().withColumn("flag", F.lit(True)), "id", "left")
    return df.withColumns({"flag": F.coalesce("flag", F.lit(False)), "minor": K.minor_price(C("procedure_raw"), C("subject"))})


def with_urls(df: DataFrame, key: str, base: str) -> DataFrame:
    return df.withColumn("url", S.portal_url(C(key), base))
