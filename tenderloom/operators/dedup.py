"""Deduplication, keyed fills and upserts.  Every choice among rows has an explicit, complete order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

C = F.col


def completeness(cols: list[str]) -> Column:
    """How many of the columns are filled."""
    out = F.lit(0)
    for c in cols:
        out = out + C(c).isNotNull().cast("int")
    return out


def best_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of each key by the order; rows without key all stay.

    Each row without key has a number of its own beside the key, so that it is
    the first of its kind, and ``df`` is read once.  Rows of a key are cut down
    to one in each task before the shuffle.
    """
    alone = F.when(C(key).isNull(), F.monotonically_increasing_id())
    rank = F.row_number().over(Window.partitionBy(key, "_alone").orderBy(*order))
    return df.withColumn("_alone", alone).withColumn("_rank", rank).filter("_rank = 1").drop("_rank", "_alone")


def first_or_by_hash(df: DataFrame, key: str, hash_col: str, order: list[Column]) -> DataFrame:
    """The first row per key, of rows without key the first per hash."""
    unit = F.coalesce(F.concat(F.lit("k:"), C(key).cast("string")), F.concat(F.lit("h:"), C(hash_col).cast("string")))
    return best_per_key(df.withColumn("_unit", unit), "_unit", order).drop("_unit")


def overlaps(df: DataFrame, key: str, source: str, top: int = 10) -> DataFrame:
    """How many keys each combination of sources shares."""
    g = df.filter(C(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_rows"), F.array_join(F.array_sort(F.collect_set(source)), "+").alias("sources"))
    return g.filter("_rows > 1").groupBy("sources").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "sources").limit(top)


def not_in_ledger(df: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    return df.join(ledger.select(key).distinct(), key, "left_anti")


def upsert(target: DataFrame, stage: DataFrame, key: str) -> DataFrame:
    """Rows of the target whose key is not staged, and all staged rows; rows without key are matched by content."""
    unit = F.coalesce(C(key).cast("string"), F.sha2(F.to_json(F.struct(*[F.col(c) for c in target.columns])), 256))
    old, new = target.withColumn("_unit", unit), stage.withColumn("_unit", unit)
    return old.join(new.select("_unit").distinct(), "_unit", "left_anti").unionByName(new).drop("_unit")


def filled(df: DataFrame, col: str, group: list[str], order: list[Column]) -> DataFrame:
    """Nulls take the last value before them in their group, else the next one after; rows without a whole group key stay as they are."""
    before = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(*group).orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    whole = F.lit(True)
    for g in group:
        whole = whole & C(g).isNotNull()
    out = df.filter(whole).withColumn(col, F.coalesce(F.last(col, True).over(before), F.first(col, True).over(after)))
    return out.unionByName(df.filter(~whole)).select(*df.columns)


def filled_by(df: DataFrame, col: str, groups: list[list[str]], order: list[Column]) -> DataFrame:
    """``filled`` by one group key after the other: a later key fills what is left, from values filled before, too."""
    for group in groups:
        df = filled(df, col, group, order)
    return df


def with_verdicts(df: DataFrame, ledger: DataFrame, key: str, verdict: list[str], judge) -> DataFrame:
    """``df`` with the columns ``verdict``: rows whose key the ledger has carry the stored ones, the others what ``judge`` adds.

    The ledger has one row per key.  ``judge`` runs on rows that are not in it
    alone.  Rows without key are judged.  ``seen`` tells which ones were stored.
    """
    known = ledger.select(C(key).alias("_key"), F.struct(*verdict).alias("_verdict"))
    met = df.drop(*verdict).join(known, C(key) == C("_key"), "left").drop("_key")
    seen = met.filter(C("_verdict").isNotNull()).select(*[c for c in df.columns if c not in verdict], *[C(f"_verdict.{v}").alias(v) for v in verdict], F.lit(True).alias("seen"))
    new = judge(met.filter(C("_verdict").isNull()).drop("_verdict")).withColumn("seen", F.lit(False))
    return seen.unionByName(new.select(*seen.columns))


def record(ledger: DataFrame, judged: DataFrame, key: str, verdict: list[str]) -> DataFrame:
    """The ledger with the verdicts of rows that it had not, one per key (of several, the least)."""
    new = judged.filter(~C("seen") & C(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*verdict)).alias("v")).select(key, "v.*")
    return ledger.select(key, *verdict).unionByName(new)
