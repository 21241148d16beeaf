"""Projections of nested release packages and lot-code records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R
from ..functions import scalars as S
from ..functions.classify import criterion
from .joins import looked_up

C = F.col


def first_where(items: Column, ok) -> Column:
    return F.try_element_at(F.filter(items, ok), F.lit(1))


def buyer(parties: Column) -> Column:
    """The first party with the buyer's role."""
    return first_where(parties, lambda p: F.coalesce(F.array_contains(p["roles"], "buyer"), F.lit(False)))


def supplier(parties: Column, awards: Column) -> Column:
    """The name of the first supplying party, else of the first award's first supplier."""
    party = first_where(parties, lambda p: F.coalesce(F.array_contains(p["roles"], "supplier"), F.lit(False)))
    award = first_where(awards, lambda a: F.size(a["suppliers"]) > 0)
    return F.coalesce(party["name"], F.try_element_at(award["suppliers"], F.lit(1))["name"])


def lot_ids(lots: Column) -> Column:
    return F.array_join(F.filter(F.transform(lots, lambda x: x["id"]), lambda x: x != ""), ";")


def procedure_name(details: Column, method: Column) -> Column:
    """What follows ``TITLE:`` in title case, else the method."""
    return F.when(details.contains("TITLE:"), S.title_case(F.trim(F.substring_index(details, "TITLE:", -1)))).otherwise(method)


def full_text(tender: Column) -> Column:
    """Title, description, and those of all lots."""
    lots = F.array_join(F.transform(F.coalesce(tender["lots"], F.array()), lambda x: F.concat_ws(" ", x["title"], x["description"])), " ")
    return F.trim(F.concat_ws(" ", tender["title"], tender["description"], F.nullif(lots, F.lit(""))))


def wide_text(r: str = "") -> Column:
    """Search text from the tender, its items and documents, awards and contracts."""
    t = C(f"{r}tender")
    parts = F.flatten(
        F.array(
            F.array(t["title"], t["description"]),
            F.coalesce(F.transform(t["items"], lambda x: x["description"]), F.array()),
            F.coalesce(F.transform(t["documents"], lambda x: x["title"]), F.array()),
            F.coalesce(F.transform(C(f"{r}awards"), lambda x: F.concat_ws(" ", x["title"], x["description"])), F.array()),
            F.coalesce(F.transform(C(f"{r}contracts"), lambda x: F.concat_ws(" ", x["title"], x["description"])), F.array()),
        )
    )
    return F.array_join(F.filter(parts, lambda x: x.isNotNull() & (x != "")), " ")


def flat_release(df: DataFrame) -> DataFrame:
    """One flat record per release."""
    t, b = C("tender"), buyer(C("parties"))
    contract, award, item = (F.try_element_at(c, F.lit(1)) for c in (C("contracts"), C("awards"), t["items"]))
    out = df.select(
        "ocid",
        C("id").alias("release_id"),
        S.safe_date(C("date")).alias("published"),
        t["title"].alias("title"),
        full_text(t).alias("full_text"),
        lot_ids(t["lots"]).alias("lots"),
        F.size(F.coalesce(t["lots"], F.array())).alias("n_lots"),
        t["value"]["amount"].alias("base"),
        award["value"]["amount"].alias("award"),
        S.safe_date(award["date"]).alias("award_date"),
        S.safe_date(t["tenderPeriod"]["endDate"]).alias("deadline"),
        S.safe_date(contract["period"]["startDate"]).alias("contract_start"),
        S.safe_date(contract["period"]["endDate"]).alias("contract_end"),
        b["name"].alias("buyer"),
        b["address"]["locality"].alias("locality"),
        b["address"]["postalCode"].alias("postal_code"),
        supplier(C("parties"), C("awards")).alias("supplier"),
        procedure_name(t["procurementMethodDetails"], t["procurementMethod"]).alias("procedure"),
        t["mainProcurementCategory"].alias("kind"),
        t["numberOfTenderers"].alias("offers"),
        item["classification"]["id"].alias("cpv"),
        item["description"].alias("cpv_text"),
        *[c for c in ("source_file",) if c in df.columns],
    )
    return looked_up(out, F.substring("postal_code", 1, 2), R.PREFIX_REGION, "region")


def flat_lot_code(df: DataFrame) -> DataFrame:
    """One unified record per lot-code record."""
    out = df.withColumns({"text": F.concat_ws(" ", "oggetto_gara", "oggetto_lotto", "descrizione_cpv"), "_s": F.upper(F.trim("sezione_regionale"))})
    out = looked_up(out, C("_s"), R.SECTIONS, "region")
    out = looked_up(out, C("cod_tipo_scelta_contraente"), R.METHOD_LABELS, "label")
    return out.select(
        S.first_key(C("cig")).alias("code"),
        C("oggetto_gara").alias("subject"),
        "text",
        C("importo_complessivo_gara").alias("base"),
        C("importo_aggiudicazione").alias("award"),
        S.safe_date(C("data_pubblicazione")).alias("published"),
        S.safe_date(C("data_scadenza_offerta")).alias("deadline"),
        C("denominazione_amministrazione_appaltante").alias("buyer"),
        "region",
        F.coalesce("label", "cod_tipo_scelta_contraente").alias("procedure"),
        "cpv",
    )


def exploded_lots(df: DataFrame, keep=None) -> DataFrame:
    """One row per lot with its parent's fields; a release without lots stays once.

    ``keep``: a condition on a lot's text; lots that fail it go.
    """
    rows = df.select("*", F.explode_outer("tender.lots").alias("lot"))
    if keep is not None:
        text = F.concat_ws(" ", C("lot.title"), C("lot.description"))
        rows = rows.filter(C("lot").isNull() | keep(text))
    return rows


def award_criterion(tender: Column) -> Column:
    return criterion(tender["awardCriteria"], tender["procurementMethodDetails"], fallback=tender["procurementMethod"])


def release_summary(df: DataFrame) -> DataFrame:
    """Whether there is an award, its first value, its band, items and classification."""
    award = F.try_element_at("awards", F.lit(1))["value"]["amount"]
    band = F.when(award < 40_000, "<40K").when(award < 200_000, "40-200K").when(award < 1_000_000, "200K-1M").when(award.isNotNull(), ">1M")
    item = F.try_element_at(C("tender")["items"], F.lit(1))
    return df.select("ocid", (F.size(F.coalesce("awards", F.array())) > 0).alias("has_award"), award.alias("award"), band.alias("band"), F.size(F.coalesce(C("tender")["items"], F.array())).alias("n_items"), item["classification"]["id"].alias("cpv"))


def shown(amount: Column, day: Column) -> list[Column]:
    """Two-decimal amount and dd/MM/yyyy date, as text."""
    return [F.format_string("%.2f", amount), F.date_format(F.try_to_timestamp(F.substring(day, 1, 10), F.lit("yyyy-MM-dd")), "dd/MM/yyyy")]


HEAD = ["ocid", "title", "details", "method", "buyer", "supplier", "postal_code", "published"]


def fields(kind: T.StructType, **given: Column) -> list[Column]:
    """The columns of a feed's type; those that are not given are NULL."""
    return [given.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in kind]


def structured(kind: T.StructType, **given: Column) -> Column:
    """A struct of a feed's type; fields that are not given are NULL."""
    return F.struct(*fields(kind, **given))


def packed_releases(heads: DataFrame, lots: DataFrame, ordered: bool = False) -> DataFrame:
    """Release structures in the feed's schema: ``heads`` has key and HEAD, ``lots`` has key, lot_id, lot_title, lot_amount; one release per distinct head with lots.

    Lots are collected by key before they meet their head, so that its texts
    are moved once a release, and both sides are dealt out by the key alone.
    A head that comes several times has its lots as often.  ``ordered``: by key inside tasks, which a merge join gives anyway.
    """
    from ..sources.sources import release_schema

    kind = {f.name: f.dataType for f in release_schema()}
    tender, party, award = kind["tender"], kind["parties"].elementType, kind["awards"].elementType
    item, lot = tender["items"].dataType.elementType, tender["lots"].dataType.elementType
    lots = lots.groupBy("key").agg(F.collect_list(structured(lot, id=C("lot_id"), title=C("lot_title"), value=F.struct(C("lot_amount").alias("amount")))).alias("lots"))
    heads = heads.repartition("key").groupBy("key", *HEAD).agg(F.count("*").cast("int").alias("_copies"))
    g = heads.join(lots, "key")
    g = (g.sortWithinPartitions("key") if ordered else g).withColumn("lots", F.sort_array(F.when(C("_copies") == 1, C("lots")).otherwise(F.flatten(F.array_repeat("lots", C("_copies"))))))
    g = g.withColumn("total", F.aggregate("lots", F.lit(0.0), lambda a, x: a + x["value"]["amount"]))
    value = F.struct(C("total").alias("amount"), F.lit("EUR").alias("currency"))
    given = {
        "ocid": C("ocid"), "id": C("ocid"), "date": C("published"),
        "tender": structured(
            tender, id=C("ocid"), title=C("title"), procurementMethodDetails=C("details"), procurementMethod=C("method"), lots=C("lots"), value=value,
            items=F.array(structured(item, description=C("title"), classification=structured(item["classification"].dataType, id=F.lit("45000000")))),
        ),
        "parties": F.array(*[structured(party, name=C(role), roles=F.array(F.lit(role)), address=F.struct(F.lit("Roma").alias("locality"), C("postal_code").alias("postalCode"))) for role in ("buyer", "supplier")]),
        "awards": F.array(structured(award, title=C("title"), date=C("published"), value=value, suppliers=F.array(structured(award["suppliers"].dataType.elementType, name=C("supplier"))))),
    }
    return g.select(*[given.get(k, F.lit(None).cast(t)).alias(k) for k, t in kind.items()])


def packed_json(heads: DataFrame, lots: DataFrame, ordered: bool = False) -> DataFrame:
    """(ocid, json) of ``packed_releases``, without the fields that are NULL."""
    df = packed_releases(heads, lots, ordered)
    return df.select("ocid", F.to_json(F.struct(*df.columns)).alias("json"))


def merged(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
