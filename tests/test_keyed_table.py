"""Merge-on-read: deltas as large as their batches, compaction, vacuum, versions, several writers."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from tenderloom.streaming import incremental as I

C = F.col
SCHEMA = "k long, j string, o int, v string"


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def plain(batches):
    last = {}
    for rows in batches:
        for r in rows:
            key = r[:2]
            if key not in last or (r[2], r[3]) > last[key][2:]:
                last[key] = r
    return sorted(last.values(), key=str)


def shown(df):
    return sorted((tuple(r[c] for c in "kjov") for r in df.collect()), key=str)


def test_merges_equal_a_dictionary(spark, tmp_path):
    """Null keys, repeats and older rows; every version can be read again; compaction changes nothing."""
    rng = random.Random(1)
    make = lambda n: [(rng.choice([None, *range(30)]), rng.choice("ab"), rng.randrange(20), f"v{rng.randrange(99)}") for _ in range(n)]
    batches = [make(60), make(10), make(10), make(5)]
    table = I.KeyedTable(spark, str(tmp_path / "t"), ["k", "j"], ["o", "v"], share=1e9)
    for k, rows in enumerate(batches):
        table.merge(batch(spark, rows), k)
    for k in range(4):
        assert shown(table.read(k)) == plain(batches[: k + 1])
    assert [(r.rows, r.total) for r in table.totals().orderBy("sequence").collect()] == [(len(b), len(plain(batches[: k + 1]))) for k, b in enumerate(batches)]
    assert table.compact() and not table.compact()
    assert shown(table.read()) == plain(batches) and len(table._last()["deltas"]) == 0
    table.merge(batch(spark, [(1, "a", 99, "new")]), 4)
    assert (1, "a", 99, "new") in shown(table.read())


def test_a_batch_writes_what_it_holds(spark, tmp_path):
    table = I.KeyedTable(spark, str(tmp_path / "t"), ["k"], ["o"], parts=1)
    spread = lambda lo, hi, o: spark.range(lo, hi).select(C("id").alias("k"), F.lit(o).alias("o"), F.sha2(C("id").cast("string"), 256).alias("v"))
    table.merge(spread(0, 20_000, 1), 0)
    table.merge(spread(500, 700, 2), 1)
    last = table._last()
    assert table._bytes(last["deltas"]) < 0.03 * table._bytes(last["base"]) and table.read().filter("o = 2").count() == 200 and table.read().count() == 20_000
    plan = table.read().filter("k = 5")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(k), EqualTo(k,5)]" in plan


def test_compaction_by_size_and_vacuum(spark, tmp_path):
    table = I.KeyedTable(spark, str(tmp_path / "t"), ["k"], ["o"], share=1.5)
    for k in range(4):
        table.merge(batch(spark, [(i, "a", k, "x") for i in range(5)]), k)
    assert {r.stream for r in table.ledger().collect()} == {"", "compact"}
    reader, before = table.read(), shown(table.read())
    assert table.vacuum(keep=1) == 0  # young folders may be a writer's
    assert table.vacuum(keep=1, older_than=0) >= 2
    assert shown(reader) == shown(table.read()) == before


def test_two_writers_both_land(spark, tmp_path):
    path, failed = str(tmp_path / "t"), []

    def write(who):
        try:
            for k in range(4):
                I.KeyedTable(spark, path, ["k", "j"], ["o", "v"]).merge(batch(spark, [(k, who, k, who), (99, "both", k, who)]), k, who)
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=write, args=(w,)) for w in "ab"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    table = I.KeyedTable(spark, path, ["k", "j"], ["o", "v"])
    assert not failed and shown(table.read()) == plain([[(k, w, k, w) for k in range(4)] + [(99, "both", k, w) for k in range(4)] for w in "ab"])
    log = table.ledger().filter("stream <> 'compact'").collect()
    assert len(log) == 8 and sorted(r.sequence for r in table.ledger().collect()) == list(range(table.ledger().count()))


def test_an_entry_is_taken_once(spark, tmp_path):
    table = I.KeyedTable(spark, str(tmp_path / "t"), ["k"], ["o"])
    assert table._commit(0, "s", 0, 1, 0.0, ["x"], []) and not table._commit(0, "s", 1, 1, 0.0, ["y"], [])
    assert table._last()["base"] == ["x"]
    table.tries = 0
    with pytest.raises(I.Conflict):
        table.clear()
