"""Late rows by what each feed has processed: runs, restarts, broken runs, null feeds and periods."""

import pytest

from tenderloom.streaming import incremental as I

SCHEMA = "feed string, month string, k long, v long"


def made(spark, tmp_path):
    return I.KeyedTable(spark, str(tmp_path / "t"), ["k"], ["v"]), I.Processed(spark, str(tmp_path / "s"), "feed", "month")


def run(spark, tmp_path, rows, name, table=None, late=None, **more):
    if rows:
        spark.createDataFrame(rows, SCHEMA).repartition(len(rows)).write.parquet(str(tmp_path / "in" / name))
    own, rule = made(spark, tmp_path)
    I.ingest(spark, str(tmp_path / "in"), SCHEMA, table or own, str(tmp_path / "c"), late=late or rule, **more)
    return sorted(r.k for r in own.read().collect()), {r.feed: r.period for r in rule.bounds().collect()}


def test_bounds_per_feed(spark, tmp_path):
    first = [("a", "2024-03", 1, 1), ("a", "2024-01", 2, 1), ("b", "2024-01", 3, 1), (None, "2024-02", 4, 1), ("a", None, 5, 1)]
    # one file a batch: months out of order inside a run are not late
    assert run(spark, tmp_path, first, "one", files=1) == ([1, 2, 3, 4], {"a": "2024-03", "b": "2024-01", None: "2024-02"})
    then = [("a", "2024-02", 11, 1), ("a", "2024-03", 12, 1), ("a", "2024-04", 13, 1), ("b", "2024-02", 14, 1), (None, "2024-02", 15, 1), (None, "2024-03", 16, 1), ("c", "2020-01", 17, 1)]
    keys, bounds = run(spark, tmp_path, then, "two")
    assert keys == [1, 2, 3, 4, 13, 14, 16, 17]
    assert bounds == {"a": "2024-04", "b": "2024-02", None: "2024-03", "c": "2020-01"}
    assert run(spark, tmp_path, [], "none") == (keys, bounds)


def test_a_broken_run_goes_on_under_its_bounds(spark, tmp_path):
    assert run(spark, tmp_path, [("a", "2024-01", 1, 1)], "one")[1] == {"a": "2024-01"}
    table, late = made(spark, tmp_path)
    merge, done = table.merge, []

    def breaks(batch, k, stream):
        if len(done) == 2:
            raise RuntimeError("lost")
        done.append(k)
        merge(batch, k, stream)

    table.merge = breaks
    rows = [("a", m, k, 1) for k, m in enumerate(["2024-05", "2024-02", "2024-04", "2024-03"], 10)]
    with pytest.raises(Exception, match="lost"):
        run(spark, tmp_path, rows, "two", table, late, files=1)
    assert {r.feed: r.period for r in late.bounds().collect()} == {"a": "2024-01"}
    assert run(spark, tmp_path, [], "none", files=1) == ([1, 10, 11, 12, 13], {"a": "2024-05"})
