import re

import pytest
from compare import SMALL
from pyspark.sql import functions as F

from tenderloom.operators import nested as N
from tenderloom.plans import bindings as B
from tenderloom.queries import nested as Q
from tenderloom.sources.sources import LOT_CODE, release_schema

C = F.col


@pytest.fixture
def sort_merge(spark):
    """Joins as on tables too large to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_releases_are_dealt_out_by_one_key_and_not_parsed(spark, sort_merge):
    """Texts of the head were in the grouping key of every lot, and each release went through JSON text."""
    p = plan(Q.releases(spark, SMALL))
    keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", p)
    assert keys and not any("," in k for k in keys)
    assert "from_json" not in p


def test_releases_equal_their_json(spark):
    """What readers of the packages get is what the structures hold, in all fields."""
    shown = lambda df: sorted(str(r) for r in df.collect())
    rows = Q.release_rows(spark, SMALL)
    parsed = N.packed_json(*rows).select(F.from_json("json", release_schema()).alias("r")).select("r.*")
    assert parsed.schema.simpleString() == N.packed_releases(*rows).schema.simpleString()
    assert shown(parsed) == shown(N.packed_releases(*rows)) != []


def test_heads_that_come_twice_have_their_lots_twice(spark):
    lots = spark.createDataFrame([(1, "1-2", "Lotto B", 2.0), (1, "1-1", "Lotto A", 1.0), (2, "", "Lotto C", 4.0), (None, "x", "x", 8.0)], "key long, lot_id string, lot_title string, lot_amount double")
    head = lambda k, title: (k, f"ocds-{k}", title, None, "m", None, "s", "9", "1995-01-01T")
    heads = spark.createDataFrame([head(1, "a"), head(1, "a"), head(1, "b"), head(2, None), head(3, "no lots"), head(None, "no key")], "key long, " + ", ".join(f"{c} string" for c in N.HEAD))
    got = N.packed_releases(heads, lots).select("ocid", "tender.title", C("tender.lots.title").alias("lots"), "tender.value.amount").collect()
    assert sorted(map(tuple, got), key=str) == [("ocds-1", "a", ["Lotto A", "Lotto A", "Lotto B", "Lotto B"], 6.0), ("ocds-1", "b", ["Lotto A", "Lotto B"], 3.0), ("ocds-2", None, ["Lotto C"], 4.0)]


def test_lot_code_records_equal_their_json(spark):
    """The records are structures of the feed; they were written as JSON and parsed for each query."""
    df = Q.lot_code_records(spark, SMALL)
    assert "from_json" not in plan(df)
    parsed = df.select(F.from_json(F.to_json(F.struct(*df.columns)), LOT_CODE).alias("r")).select("r.*")
    assert parsed.schema.simpleString() == df.schema.simpleString()
    assert parsed.exceptAll(df).count() == df.exceptAll(parsed).count() == 0 < df.count()


def test_lots_are_dealt_out_before_their_texts(spark, sort_merge):
    """Lots were collected in each scan task, and once more behind the shuffle, with the texts of all lots in both."""
    p = plan(Q.releases(spark, SMALL))
    assert p.index("partial_collect_list") < p.index("Lotto ") < p.rindex("REPARTITION_BY_COL") and p.count("REPARTITION_BY_COL") == 2


def test_fields_of_lot_codes_are_computed_on_demand(spark):
    """All fields were packed into one structure, whichever were asked for."""
    p = plan(Q.lot_code_records(spark, SMALL).select("cpv", "cod_tipo_scelta_contraente", "data_pubblicazione"))
    assert "Museo civico" not in p and "lpad" not in p


def test_notices_by_place_are_the_notices(spark, tmp_path):
    """Also for keys that are null or negative, whose remainder is none of the CASE's."""
    key = F.when(C("o_orderkey") % 5 == 0, -C("o_orderkey")).when(C("o_orderkey") % 7 != 0, C("o_orderkey"))
    B.table(spark, SMALL, "orders").withColumn("o_orderkey", key).write.parquet(f"{tmp_path}/orders.parquet")
    looked, chosen = B.notices(spark, str(tmp_path), by_place=True), B.notices(spark, str(tmp_path))
    assert looked.schema.simpleString() == chosen.schema.simpleString()
    assert looked.exceptAll(chosen).count() == chosen.exceptAll(looked).count() == 0 < looked.filter("id < 0").count()


def test_lots_of_tenders_are_dealt_out_in_bounded_tasks(spark, sort_merge, monkeypatch):
    """Sorts and groups of a task grew with the table, as there were as many tasks as the shuffle's size asked for."""
    old = sorted(map(tuple, B.tenders(spark, SMALL).select("key", "lot", "supplier", "category", "amount").collect()))
    monkeypatch.setattr(B, "LOTS_AT_ONCE", 500)
    df = B.tenders(spark, SMALL).select("key", "lot", "supplier", "category", "amount")
    tasks = -(-B.table(spark, SMALL, "lineitem").count() // 500)
    assert tasks > 4 and "hashpartitioning(l_orderkey#" in plan(df) and f", {tasks}), REPARTITION_BY_NUM" in plan(df)
    assert sorted(map(tuple, df.collect())) == old
