"""Stored ledger: verdicts come back, nothing shuffles its side, repeated and interrupted writes count once."""

from pyspark.sql import functions as F

from tenderloom.operators.ledger import Ledger

C = F.col


def judge(word):
    return lambda new: new.withColumn("verdict", F.concat(F.lit(word + " "), "text"))


def test_verdicts_are_kept(spark, tmp_path):
    path = str(tmp_path / "l")
    batch = lambda rows: spark.createDataFrame(rows, "id long, text string, seen string").drop("seen").withColumn("hash", F.sha2("text", 256))
    first = batch([(1, "a", ""), (2, "a", ""), (3, "b", ""), (4, None, "")])
    ledger = Ledger(spark, path, "verdict string", buckets=4)
    got = ledger.judged(first, judge("one"))
    assert sorted((r.id, r.verdict, r.seen) for r in got.collect()) == [(1, "one a", False), (2, "one a", False), (3, "one b", False), (4, None, False)]
    ledger.record(got)
    ledger.record(ledger.judged(batch([]), judge("none")))
    spark.sql(f"DROP TABLE {ledger.table}")  # as in another session
    again = Ledger(spark, path, "verdict string", buckets=32)
    assert again.buckets == 4 and sorted(r.verdict for r in again.rows().collect()) == ["one a", "one b"]
    second = batch([(5, "b", ""), (6, "c", ""), (7, None, "")])
    assert sorted(r.id for r in again.unseen(second).collect()) == [6, 7]
    got = again.judged(second, judge("two"))
    assert sorted((r.id, r.verdict, r.seen) for r in got.collect()) == [(5, "one b", True), (6, "two c", False), (7, None, False)]
    for _ in range(2):  # the same rows written twice
        again.record(got.filter("id = 6"))
    assert again.rows().count() == 3 and spark.table(again.table).count() in (3, 4)


def test_the_ledger_is_not_shuffled(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "l"), "verdict string", buckets=8)
    big = spark.range(20_000).select(F.sha2(C("id").cast("string"), 256).alias("hash"), C("id").cast("string").alias("text"))
    ledger.record(ledger.judged(big, judge("one")))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = big.limit(500).join(ledger.rows(), "hash")
        assert joined.count() == 500
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "Bucketed: true" in plan and "SelectedBucketsCount: 8 out of 8" in plan
    assert plan.count("Exchange hashpartitioning(hash") <= 1  # the batch's
