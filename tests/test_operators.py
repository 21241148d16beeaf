"""Operators on small hand-made frames: ties, nulls, empty tables, metamorphic checks."""

import json
import random
import re
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenderloom.operators import dedup as D
from tenderloom.operators import fuzzy as Z
from tenderloom.operators import metrics as M
from tenderloom.operators import nested as N
from tenderloom.operators import windows as W
from tenderloom.operators.ordering import Ordered
from tenderloom.plans import pipelines as P
from tenderloom.functions import rules as R
from tenderloom.sources import sinks, sources
from tenderloom.streaming import incremental as I

C = F.col


def test_best_per_key_keeps_nulls_and_is_idempotent(spark):
    df = spark.createDataFrame([(1, "a", 2), (2, "a", 1), (3, None, 9), (4, None, 8), (5, "b", 1)], "id int, k string, p int")
    once = D.best_per_key(df, "k", [C("p"), C("id")])
    assert sorted(r.id for r in once.collect()) == [2, 3, 4, 5]
    assert sorted(r.id for r in D.best_per_key(once, "k", [C("p"), C("id")]).collect()) == [2, 3, 4, 5]
    assert D.best_per_key(df.limit(0), "k", [C("p")]).count() == 0


def test_hhi_single_supplier_and_no_value(spark):
    df = spark.createDataFrame([("x", "s1", 10.0), ("x", "s1", 5.0), ("y", "s1", 0.0), ("z", "s1", 1.0), ("z", "s2", 1.0), (None, "s1", 1.0)], "c string, s string, v double")
    got = {r.c: r.hhi for r in M.hhi(df, ["c"], "s", "v").collect()}
    assert got == {"x": 10000.0, "y": None, "z": 5000.0}


def test_growth_from_nothing(spark):
    df = spark.createDataFrame([("a", 2000, 0.0), ("a", 2001, 5.0), ("b", 2000, 4.0), ("b", 2001, 6.0)], "s string, y int, v double")
    got = {r.s: r.value_growth for r in M.growth(df, "s", "y", "v", 2000, 2001).collect()}
    assert got == {"a": 100.0, "b": 50.0}


def test_upsert_replaces_and_keeps(spark):
    t = spark.createDataFrame([(1, "old"), (2, "old"), (None, "x")], "k int, v string")
    s = spark.createDataFrame([(2, "new"), (3, "new"), (None, "x")], "k int, v string")
    got = sorted(((r.k, r.v) for r in D.upsert(t, s, "k").collect()), key=str)
    assert got == sorted([(1, "old"), (2, "new"), (3, "new"), (None, "x")], key=str)


def test_fill_forward_then_backward(spark):
    df = spark.createDataFrame([(1, "g", None), (2, "g", 5), (3, "g", None), (1, "h", None)], "o int, g string, v int")
    got = {(r.g, r.o): r.v for r in D.filled(df, "v", ["g"], [C("o")]).collect()}
    assert got == {("g", 1): 5, ("g", 2): 5, ("g", 3): 5, ("h", 1): None}


def test_concentration_curve_equals_plain_order(spark):
    df = spark.createDataFrame([(f"k{i}", float((i * 7) % 50)) for i in range(200)], "k string, v double")
    rows = sorted(W.concentration_curve(df, "k", "v").collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in rows] == list(range(1, 201))
    assert all(a.value >= b.value for a, b in zip(rows, rows[1:]))
    assert abs(rows[-1].percent - 100) < 1e-9


def test_order_in_ranges(spark):
    """A tenth of equal values, nulls and repeated rows; ranges share the equal values; pages at any depth read their ranges only."""
    rows = [(i % 1000 if i % 10 else 7, i if i % 3 else None) for i in range(5000)] + [(7, 1)] * 20
    df = spark.createDataFrame(rows, "v int, k int").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small ranges would be joined
    order = Ordered(df, [F.desc_nulls_last("v"), F.asc_nulls_first("k")])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = sorted(rows, key=lambda r: (-r[0], r[1] is not None, r[1] or 0))
    got = sorted(order.numbered().collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in got] == list(range(1, len(rows) + 1)) and [(r.v, r.k) for r in got] == want
    spread = {r["_part"]: r["n"] for r in order.rows.filter("v = 7").groupBy("_part").agg(F.count("*").alias("n")).collect()}
    whole = {r["_part"]: r["_n"] for r in order.ranges().collect()}
    assert sum(spread.values()) == 525 and max(whole.values()) < len(rows) / 2
    run = sorted(order.running(C("v"), "run").collect(), key=lambda r: r["rank"])
    assert [r.run for r in run] == np.cumsum([v for v, _ in want]).tolist() and {r.run_all for r in run} == {sum(v for v, _ in want)}
    page = order.page(100, 50)
    assert [(r.v, r.k) for r in page.collect()] == want[4950:5000]
    assert re.search(r"PartitionFilters: \[[^\]]*_part", page._jdf.queryExecution().toString())
    assert order.page(102, 50).count() == 0 and [r["rank"] for r in order.page(101, 50).collect()] == list(range(5001, 5021))
    empty = Ordered(df.limit(0), ["v"])
    assert empty.numbered().count() == 0 and empty.page(1).count() == 0 and empty.running(C("v"), "run").count() == 0


def test_sort_query_keeps_all_rows(spark):
    from compare import SMALL

    from tenderloom.queries import QUERIES

    rows = QUERIES["sl10_sort_all_nulls_last"](spark, SMALL).collect()
    assert [r["rank"] for r in rows] == list(range(1, 1_501))
    dated = [r for r in rows if r.date_raw is not None]
    assert 0 < len(dated) < 1_500 and rows[: len(dated)] == dated
    assert [(r.date_raw, r.id) for r in dated] == sorted(sorted(((r.date_raw, r.id) for r in dated), key=lambda x: x[1]), key=lambda x: x[0], reverse=True)


def test_minutes_query_keeps_all_notices(spark):
    from compare import SMALL

    from tenderloom.queries import QUERIES

    got = QUERIES["pl08_minutes_of_all_notices"](spark, SMALL).agg(F.countDistinct("id"), F.count("subject"), F.count("award"), F.count("*")).first()
    assert got[0] == 1_500 and 0 < got[1] < got[3] and 0 < got[2] < got[3]


def test_archives_of_a_month_are_bounded(spark, monkeypatch):
    from compare import SMALL

    from tenderloom.queries import feeds

    monkeypatch.setattr(feeds, "PER_FILE", 5)
    folder = feeds.archives(spark, SMALL)
    got = sources.members_of(spark, folder).select(I.month_of(C("file")).alias("month"), "path")
    assert got.filter("month is null").count() == 0 and got.count() == got.distinct().count() > 2 * got.select("month").distinct().count()
    per_file = sources.read_zipped_lines(spark, folder).groupBy("file").count()
    assert per_file.agg(F.max("count")).first()[0] < 20


def test_weighted_ratio():
    assert Z.weighted_ratio("enel sole", "enel sole") == 100
    assert Z.weighted_ratio("sole enel", "enel sole") >= 95
    assert Z.weighted_ratio("enel", "hera luce") < 60
    assert Z.weighted_ratio("", "x") == 0
    assert Z.common_length("abcde", "ace") == 3


def test_fuzzy_canonical(spark):
    names = ["Enel Sole S.r.l."] * 3 + ["ENEL SOLE SRL", "Spazio Verde", None, "nan", "Hera Luce spa"] + ["Hera Luce"] * 2
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r.name: r.canonical for r in Z.canonical(df, "n").collect()}
    assert got["ENEL SOLE SRL"] == "Enel Sole S.r.l." and got["Hera Luce spa"] == "Hera Luce" and got["Spazio Verde"] == "Spazio Verde"
    assert "nan" not in got


def test_fuzzy_common_word_blocks(spark, monkeypatch):
    monkeypatch.setattr(Z, "CELL", 100, raising=False)
    rows = [(f"comune {i}",) for i in range(2_001)] * 2 + [("nuovo comune 7",), ("vecchio comune 1999",), ("altro",)]
    df = spark.createDataFrame(rows, "n string")
    got, want = ({r.name: (r.canonical, r.score) for r in Z.canonical(df, "n", 60, blocked=b).collect() if r.n == 1} for b in (True, False))
    assert got == want and got["nuovo comune 7"][0] == "comune 7" and got["vecchio comune 1999"][1] >= 60 and got["altro"][1] is None


def test_bound_of_weighted_ratio():
    rng = random.Random(5)
    text = lambda: " ".join(rng.choice(["enel", "sole", "luce", "lu", "a", "hera", "coop servizi", " x", "sole enel verde spazio"]) for _ in range(rng.randint(0, 5)))
    for _ in range(3_000):
        a, b, least = text(), text(), rng.choice([40, 60, 85, 90])
        score = Z.weighted_ratio(a, b)
        assert not a or not b or Z.most_ratio(a, b) >= score - 1e-9
        screened = Z.weighted_ratio(a, b, least)
        assert screened == score if score >= least else screened < least
    assert Z.most_ratio("comune di milano", "comune di torino e asti") < 85


def test_fuzzy_leading_part_in_cells(spark, monkeypatch):
    monkeypatch.setattr(Z, "CELL", 8)
    left = spark.createDataFrame([(f"cust{i}", ["^cust"]) for i in range(64)], "name string, keys array<string>")
    right = spark.createDataFrame([(f"cust{i}", ["^cust"]) for i in range(64)], "candidate string, c_keys array<string>")
    pairs = Z.block_pairs(left, right)
    assert pairs.count() == pairs.distinct().count() == 64 * 64
    assert pairs.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 64 * 64 / 4


def test_fuzzy_query_compares_names(spark):
    from compare import SMALL

    from tenderloom.queries import QUERIES, dedup_joins

    got = sorted(map(tuple, QUERIES["jn08_fuzzy_weighted"](spark, SMALL).collect()))
    assert got == sorted(map(tuple, Z.canonical(dedup_joins.spelt_entities(spark, SMALL), "entity", 85, 30, blocked=False).collect()))
    frequent, matched = {r[0] for r in got if r[1] >= 30}, [r for r in got if r[3] is not None]
    assert len(frequent) == 12 and len(got) == 72
    assert len(matched) == 60 and all(r[2] in frequent for r in matched)


RELEASE = {
    "ocid": "o1", "id": "r1", "date": "2024-02-10 17:35:30.228T12:00:00Z",
    "tender": {"title": "Illuminazione", "description": "pubblica", "procurementMethodDetails": "x TITLE: procedura aperta", "lots": [{"id": "L1", "title": "a"}, {"id": "", "title": "b"}], "value": {"amount": 10.0}},
    "parties": [{"name": "Comune", "roles": ["buyer"], "address": {"locality": "Milano", "postalCode": "20121"}}],
    "awards": [{"value": {"amount": 8.0}, "suppliers": [{"name": "Ditta"}]}],
}


def test_release_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"releases": [RELEASE, {"ocid": "none"}]}))
    (tmp_path / "b.json").write_text("{ broken")
    (tmp_path / "c.json").write_text(json.dumps(RELEASE | {"ocid": "o2"}) + "\nbad line\n" + json.dumps(RELEASE | {"ocid": "o3"}))
    strict = sources.read_releases(spark, str(tmp_path / "a.json"))
    flat = N.flat_release(strict).collect()
    assert len(flat) == 1
    r = flat[0]
    assert (r.buyer, r.supplier, r.lots, r.n_lots, r.published, r.region, r.procedure) == ("Comune", "Ditta", "L1", 2, "2024-02-10", "Lombardia", "Procedura Aperta")
    assert sources.read_releases(spark, str(tmp_path / "b.json")).count() == 0
    loose = sources.read_releases_tolerant(spark, str(tmp_path)).collect()
    assert sorted(x.ocid for x in loose if x.ocid) == ["none", "o1", "o2", "o3"] or sorted(x.ocid for x in loose if x.ocid) == ["o1", "o2", "o3"]
    assert sum(x.bad is not None for x in loose) == 2
    assert N.exploded_lots(strict).count() == 2
    assert N.exploded_lots(strict, lambda t: t.contains("b")).count() == 1


def test_zipped_lines(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "cig_json_2024_03.zip", "w") as z:
        z.writestr("x.json", json.dumps({"cig": "1234567890", "oggetto_gara": "Luce", "sezione_regionale": "SEZIONE REGIONALE VENETO", "cod_tipo_scelta_contraente": "1"}) + "\nbroken\n")
    (tmp_path / "not_a.zip").write_text("text")
    rows = N.flat_lot_code(sources.read_lot_codes(spark, str(tmp_path))).collect()
    assert [(r.code, r.region, r.procedure) for r in rows] == [("1234567890", "Veneto", "1")]


def test_registry_csv_and_sinks(spark, tmp_path):
    (tmp_path / "r.csv").write_bytes("cig;oggetto_gara;importo_aggiudicazione\nSL001;Città;12.5\nSL002;Luce;x\n".encode("latin-1"))
    df = sources.read_registry(spark, str(tmp_path / "r.csv"))
    got = {r.code: (r.subject, r.award) for r in df.collect()}
    assert got == {"SL001": ("Città", 12.5), "SL002": ("Luce", None)}
    sinks.write_csv(df, str(tmp_path / "out.csv"))
    assert sources.read_any(spark, [str(tmp_path / "missing.parquet"), str(tmp_path / "out.csv")]).count() == 2
    with pytest.raises(FileNotFoundError):
        sources.read_any(spark, [str(tmp_path / "nothing")])
    years = df.withColumn("anno", F.lit(2024))
    sinks.write_table(years, str(tmp_path / "t"))
    sinks.swap_table(spark, spark.read.parquet(str(tmp_path / "t")).filter("code = 'SL001'"), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


def test_unify_prefers_source_and_keeps_null_keys(spark):
    rows = spark.createDataFrame([("A1", "x"), ("A1", "y"), (None, "z"), (";X", "w")], "code string, subject string")
    a, b = P.from_releases(rows), P.from_releases(rows.filter("code = 'A1'"), "CIG_JSON")
    out = P.unify([a, b])
    assert out.columns == R.UNIFIED_COLUMNS
    assert out.filter("cig = 'A1'").count() == 1 and out.filter("cig is null").count() == 2
    assert out.filter("cig = 'A1'").first().fonte == "OCDS"
    assert sorted(map(str, P.unify([b, a]).collect())) == sorted(map(str, out.collect()))


def test_month_of_name(spark):
    df = spark.createDataFrame([("2024_03.json",), ("cig_json_2024_04.zip",), ("other.json",)], "n string")
    assert [r.m for r in df.select(I.month_of(C("n")).alias("m")).collect()] == ["2024-03", "2024-04", None]


def test_stream_third_run_is_idle(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 1)], "id int, k string, o int")
    df.write.parquet(str(tmp_path / "in/one"))
    table = I.KeyedTable(spark, str(tmp_path / "t"), ["k"], ["o", "id"])
    for _ in range(2):
        I.ingest(spark, str(tmp_path / "in"), df.schema, table, str(tmp_path / "c"))
    assert table.ledger().count() == 1 and sorted(r.id for r in table.read().collect()) == [2, 3]
    df.selectExpr("id + 10 as id", "k", "o + 10 as o").write.parquet(str(tmp_path / "in/two"))
    I.ingest(spark, str(tmp_path / "in"), df.schema, table, str(tmp_path / "c"))
    assert sorted(r.id for r in table.read().collect()) == [12, 13]


def test_table_outlives_its_object_and_replays(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id int, k string, o int")
    new = lambda: I.KeyedTable(spark, str(tmp_path / "t"), ["k"], ["o", "id"], parts=3)
    assert new().read() is None
    df.write.parquet(str(tmp_path / "in/one"))
    I.ingest(spark, str(tmp_path / "in"), df.schema, new(), str(tmp_path / "c"))
    spark.createDataFrame([(3, "c", 1), (4, "a", 2)], df.schema).write.parquet(str(tmp_path / "in/two"))
    I.ingest(spark, str(tmp_path / "in"), df.schema, new(), str(tmp_path / "c"))
    assert sorted(r.id for r in new().read().collect()) == [2, 3, 4]
    # the same batch again, as after a crash between the merge and the stream's own record of it
    new().merge(spark.createDataFrame([(9, "z", 9)], df.schema), 1, str(tmp_path / "c"))
    assert sorted(r.id for r in new().read().collect()) == [2, 3, 4] and new().ledger().count() == 2
    # a merge that broke off left a folder that no ledger row names
    df.withColumn("_part", F.lit(0)).write.partitionBy("_part").parquet(str(tmp_path / "t/data/torn"))
    assert sorted(r.id for r in new().read().collect()) == [2, 3, 4]


def test_update_rebuilds_only_after_a_change(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id int, k string, o int")
    df.write.parquet(str(tmp_path / "in/one"))
    made = []
    run = lambda force=False: I.update(spark, str(tmp_path / "in"), df.schema, I.KeyedTable(spark, str(tmp_path / "t"), ["k"], ["o", "id"]), str(tmp_path / "c"), lambda rows: made.append(rows.count()), force)
    assert [run()["rebuilt"], run()["rebuilt"], run(True)["rebuilt"], run()["rebuilt"]] == [True, False, True, False] and made == [2, 2]
    df.selectExpr("id + 10 as id", "concat(k, 'x') as k", "o").write.parquet(str(tmp_path / "in/two"))
    assert run()["rebuilt"] and made == [2, 2, 4]


@pytest.mark.parametrize("accuracy", [30, 100_000])
def test_quantiles_are_exact(spark, accuracy):
    """With an accuracy of 30, tables from 300 rows on go through the sketch's intervals."""
    rng = random.Random(7)
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    for n in (1, 2, 10, 11, 45, 300, 2000):
        values = [rng.choice([rng.gauss(0, 1), 1.5, rng.randint(0, 9)]) for _ in range(n)]
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(3)
        assert M.quantiles(df, "v", qs, accuracy=accuracy).first()["q"] == pytest.approx(np.quantile(values, qs).tolist(), abs=1e-12)
    assert M.quantiles(df.limit(0), "v", [0.5]).first()["q"] == [None]
    groups = {"a": [1.0, 2.0, 2.0, 9.0], None: [4.0], "b": [rng.random() for _ in range(700)]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs] + [("c", None)], "k string, v double")
    got = {r["k"]: r["q"] for r in M.with_quantiles(df.select("k").distinct(), M.quantiles(df, "v", qs, ["k"], accuracy), ["k"]).collect()}
    assert got.pop("c") is None and got == {k: pytest.approx(np.quantile(v, qs).tolist(), abs=1e-12) for k, v in groups.items()}


@pytest.mark.parametrize("threshold", [55, 60, 80])
def test_gram_blocking_misses_no_pair(spark, threshold):
    rng = random.Random(threshold)
    base = ["".join(rng.choice("aab c") for _ in range(rng.randint(0, 14))) for _ in range(60)] + ["aaaaaaa", "a", "", "spa", "rossi srl", "rossi"]
    names = {b for b in base} | {"".join(c for c in b if rng.random() < 0.8) + rng.choice(["", "b", "cc"]) for b in base for _ in range(2)}
    df = spark.createDataFrame([(n,) for n in sorted(names) for _ in range(1 + rng.randint(0, 1))], "name string")
    whole, blocked = (sorted(map(tuple, Z.canonical(df, "name", threshold, 2, how, Z.levenshtein_ratio).collect())) for how in (False, "grams"))
    assert whole == blocked and sum(r[3] is not None for r in whole) > 10


def test_inventory_is_the_files(spark, tmp_path):
    spark.range(1000).repartition(3).write.parquet(str(tmp_path / "t"))
    got = {r.file: (r.records, r.bytes) for r in sources.inventory(spark.read.parquet(str(tmp_path / "t"))).collect()}
    assert {k: b for k, (_, b) in got.items()} == {f.name: f.stat().st_size for f in (tmp_path / "t").glob("*.parquet")} and sum(n for n, _ in got.values()) == 1000


GOLDEN = [
    ("this is a test", "this is a new test!!!", 85.5), ("this is a word", "THIS IS A WORD", 21.428571428571427), ("this is a test", "this is a new test", 95.0),
    ("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear", 95.0), ("same", "same", 100.0), ("", "x", 0.0), ("abc", "xyz", 0.0),
]


@pytest.mark.parametrize("a,b,want", GOLDEN)
def test_weighted_ratio_golden(a, b, want):
    """Published values of the weighted ratio, and its corner cases."""
    assert Z.weighted_ratio(a, b) == pytest.approx(want) and Z.weighted_ratio(b, a) == pytest.approx(want)
    assert Z.most_ratio(a, b) >= want - 1e-9 if a and b else True


def test_partitioned_table_splits_a_large_year(spark, tmp_path):
    df = spark.range(3000).selectExpr("id", "cast(if(id % 3 = 0, 1990 + id % 7, 2000) as int) as anno")
    sinks.write_table(df, str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 3000 and {p.name for p in (tmp_path / "t").iterdir() if p.is_dir()} == {f"anno={y}" for y in [*range(1990, 1997), 2000]}


def test_unified_row_is_enriched(spark):
    """Golden values of the unified table's derived columns."""
    names = "code_raw string, subject string, text string, award double, discount_raw string, award_date date, town_raw string, entity_raw string, procedure_raw string, kind_raw string, plant_raw string, duration_raw string"
    rows = [
        (" a1;b2", "s", "t", 100.0, "10,5 %", "2024-03-05", "TORINO", "COMUNE X", "PROCEDURA APERTA", "Works", "pubblica_illuminazione", "nan"),
        ("C3", "s", "t", 2e10, "150%", "1980-01-01", "Ignota", None, "boh", None, None, None),
    ]
    df = spark.createDataFrame(rows, names.replace("date date", "date string")).withColumn("award_date", C("award_date").cast("date"))
    one, two = P.unify([P.from_gazette(df)]).orderBy("cig").collect()
    assert (one.cig, one.chiave, one.importo_aggiudicazione, one.sconto, one.anno) == ("A1", "A1", 100.0, 10.5, 2024)
    assert (one.comune, one.regione, one.procedura, one.fonte, one.durata_appalto) == ("Torino", "Piemonte", "Procedura Aperta", "Gazzetta", None)
    assert (two.cig, two.importo_aggiudicazione, two.sconto, two.data_aggiudicazione, two.anno, two.regione) == ("C3", None, None, None, None, None)
    assert two.procedura == R.OTHER_PROCEDURE and two.ente_appaltante is None


def test_concentration_curve_sums_exactly(spark):
    """Keys with the same amounts tie, in whatever order their rows come; amounts that are no numbers count beside."""
    from tenderloom.operators import windows as W

    amounts = [0.1, 0.2, 0.3, 1e9, 900.7]
    rows = [(f"k{i}", x) for i in range(40) for x in (amounts if i % 2 else amounts[::-1])]
    df = spark.createDataFrame(rows, "k string, v double").coalesce(1)
    got = W.concentration_curve(df, "k", "v").orderBy("rank").collect()
    assert [r.k for r in got] == sorted({k for k, _ in rows})
    assert [r.cumulative for r in got] == [round(n * 1000000901.3, 1) for n in range(1, 41)]
    odd = spark.createDataFrame([("a", 1.0), ("b", float("inf")), ("c", None)], "k string, v double")
    assert [(r.k, r.value, r.cumulative) for r in W.concentration_curve(odd, "k", "v").orderBy("rank").collect()] == [("b", float("inf"), float("inf")), ("a", 1.0, float("inf")), ("c", None, float("inf"))]


def test_best_per_key_reads_once(spark, tmp_path):
    """Rows without key all stay, and the frame is read once for them and the others."""
    rows = [("a", 2), ("a", 1), (None, 5), (None, 5), ("b", 3)]
    spark.createDataFrame(rows, "k string, v int").write.parquet(str(tmp_path / "t"))
    got = D.best_per_key(spark.read.parquet(str(tmp_path / "t")), "k", [C("v")])
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("a", 1), ("b", 3), (None, 5), (None, 5)], key=str)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1 and "WindowGroupLimit" in got._jdf.queryExecution().sparkPlan().toString()


def test_costly_rows_are_spread_by_their_number(spark, tmp_path, monkeypatch):
    from tenderloom.plans import bindings

    monkeypatch.setattr(bindings, "ROWS_AT_ONCE", 100, raising=False)
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "t"))
    got = bindings.spread(spark.read.parquet(str(tmp_path / "t")))
    assert got.rdd.getNumPartitions() == 10 and got.count() == 1000
