"""ST: incremental ingest of the events table, split by day."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..plans.bindings import table
from ..streaming import incremental as I
from .registry import query

C = F.col
SPLIT, LAST = "2024-01-15", "2024-01-20"


def streamed(spark, d, late: bool):
    """Two runs over day folders: the early days, then the rest; the second run reads only what is new.

    With ``late`` the second run drops periods up to those processed.
    """
    events = table(spark, d, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    source, target, checkpoint = (I.shared_path(spark, n) for n in ("events", "merged", "progress"))
    merged = I.KeyedTable(spark, target, ["user_id", "event_type"], ["ts", "event_id"])
    events.filter(C("day") < SPLIT).write.parquet(f"{source}/early")
    I.ingest(spark, source, events.schema, merged, checkpoint)
    events.filter(C("day") >= SPLIT).write.parquet(f"{source}/rest")
    events.filter(C("day") < "2024-01-03").withColumn("event_id", C("event_id") + 10_000_000).withColumn("ts", C("ts") + F.expr("INTERVAL 60 DAYS")).write.parquet(f"{source}/late")
    I.ingest(spark, source, events.schema, merged, checkpoint, late_after=("day", "2024-01-14") if late else None)
    return merged


_events = "e AS (SELECT event_id, user_id, event_type, ts, strftime(ts, '%Y-%m-%d') AS day FROM events), late AS (SELECT event_id + 10000000 AS event_id, user_id, event_type, ts + INTERVAL 60 DAY AS ts, day FROM e WHERE day < '2024-01-03')"
_last = "QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"


@query(f"WITH {_events} SELECT event_id, user_id, event_type FROM (SELECT * FROM e UNION ALL SELECT * FROM late) {_last}")
def st01_incremental_merge(spark, d):
    """New files only, merged keep-last: the result equals one batch over everything (late files count)."""
    return streamed(spark, d, False).read().select("event_id", "user_id", "event_type")


@query("WITH d AS (SELECT DISTINCT strftime(ts, '%Y-%m') AS m FROM events) SELECT m AS month, 'feed_' || replace(m, '-', '_') || '.zip' AS name FROM d")
def st02_month_of_name(spark, d):
    names = table(spark, d, "events").select(F.concat(F.lit("feed_"), F.date_format("ts", "yyyy_MM"), F.lit(".zip")).alias("name")).distinct()
    return names.select(I.month_of(C("name")).alias("month"), "name")


@query("WITH m AS (SELECT strftime(unnest(generate_series(DATE '1994-06-01', DATE '2002-03-01', INTERVAL 1 MONTH)), '%Y-%m') AS month), p AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month FROM orders) SELECT month, CASE WHEN month < '1998-08' THEN 'releases' ELSE 'lot_codes' END AS feed FROM m WHERE month NOT IN (SELECT month FROM p)")
def st03_missing_months(spark, d):
    present = table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("m"))
    return I.expected_feeds(I.missing_months(spark, "1994-06", "2002-03", present, "m"), "1998-08")


@query("SELECT event_id, user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def st04_keep_last_batch(spark, d):
    """The merge's rule as one batch."""
    return I.last_per_key(table(spark, d, "events"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).select("event_id", "user_id", "event_type")


@query(f"WITH {_events} SELECT event_id, user_id, event_type FROM e {_last}")
def st05_drop_late(spark, d):
    """The old rule: files of periods already passed are ignored."""
    return streamed(spark, d, True).read().select("event_id", "user_id", "event_type")


_first = "(feed = 'even' AND day < '2024-01-15' AND day <> '2024-01-05') OR (feed = 'odd' AND day < '2024-01-10')"


@query(f"""WITH e AS (SELECT event_id, user_id, event_type, ts, strftime(ts, '%Y-%m-%d') AS day, CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS feed FROM events),
    one AS (SELECT * FROM e WHERE {_first}), bound AS (SELECT feed, max(day) AS last FROM one GROUP BY feed),
    two AS (SELECT e.*, day <= last AS late FROM e LEFT JOIN bound USING (feed) WHERE NOT ({_first})),
    both_ AS (SELECT 'dropped' AS late_rows, * FROM one UNION ALL SELECT 'kept', * FROM one UNION ALL SELECT 'kept', * EXCLUDE (late) FROM two UNION ALL SELECT 'dropped', * EXCLUDE (late) FROM two WHERE NOT coalesce(late, false))
    SELECT late_rows, feed, user_id, event_type, event_id FROM both_ QUALIFY row_number() OVER (PARTITION BY late_rows, feed, user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def st08_late_by_state(spark, d):
    """Two feeds that got to different days, a restart, then the rest: what each feed had processed decides which rows are late, and a parameter whether they go."""
    events = table(spark, d, "events").withColumns({"day": F.date_format("ts", "yyyy-MM-dd"), "feed": F.when(C("event_id") % 2 == 0, "even").otherwise("odd")})
    source = I.shared_path(spark, "feeds")
    out = []
    targets = {rule: [I.shared_path(spark, n) for n in ("merged", "progress", "processed")] for rule in ("dropped", "kept")}
    for run, some in enumerate((_first, f"NOT ({_first})")):
        events.filter(some).write.parquet(f"{source}/{run}")
        for rule, (target, checkpoint, state) in targets.items():
            # new objects each time: table and state live in their folders
            merged = I.KeyedTable(spark, target, ["feed", "user_id", "event_type"], ["ts", "event_id"])
            I.ingest(spark, source, events.schema, merged, checkpoint, late=I.Processed(spark, state, "feed", "day") if rule == "dropped" else None)
            if run:
                out.append(merged.read().select(F.lit(rule).alias("late_rows"), "feed", "user_id", "event_type", "event_id"))
    return out[0].unionByName(out[1])


@query("""WITH n AS (SELECT event_type, count(DISTINCT user_id) + max(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END) AS n FROM events GROUP BY event_type)
    SELECT run, rebuilt, event_type, CASE WHEN rebuilt THEN n END AS n FROM n, (VALUES (1, true), (2, false), (3, true)) AS r(run, rebuilt)""")
def st06_forced_rebuild(spark, d):
    """Three runs over the same files: the first rebuilds, the second finds nothing new and skips it, the third is forced and rebuilds the same."""
    source, target, checkpoint = (I.shared_path(spark, n) for n in ("again", "rebuilt", "fresh"))
    events = table(spark, d, "events")
    events.write.parquet(source)
    runs = []
    for k, force in enumerate((False, False, True), 1):
        rebuilt = []
        # a new object each time: the table lives in its folder
        merged = I.KeyedTable(spark, target, ["user_id", "event_type"], ["ts", "event_id"])
        told = I.update(spark, source, events.schema, merged, checkpoint, lambda rows: rebuilt.append(rows.groupBy("event_type").agg(F.count("*").alias("n"))), force)
        kinds = events.select("event_type").distinct()
        made = kinds.join(rebuilt[0], "event_type") if rebuilt else kinds.withColumn("n", F.lit(None).cast("long"))
        runs.append(made.select(F.lit(k).alias("run"), F.lit(told["rebuilt"]).alias("rebuilt"), "event_type", "n"))
    return runs[0].unionByName(runs[1]).unionByName(runs[2])


@query(f"""WITH {_events}, b AS (SELECT 1 AS batch, user_id, event_type FROM e WHERE day < '{SPLIT}' UNION ALL SELECT 2, user_id, event_type FROM e WHERE day >= '{SPLIT}' UNION ALL SELECT 2, user_id, event_type FROM late)
    SELECT batch, count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM b AS x WHERE x.batch <= b.batch)) AS total FROM b GROUP BY batch""")
def st07_run_ledger(spark, d):
    """Rows of each merge, as the log keeps them (with elapsed time and time of the update), and of the table after it."""
    return streamed(spark, d, False).totals().select(F.row_number().over(Window.orderBy("sequence")).cast("long").alias("batch"), "rows", "total")  # a row per merge
