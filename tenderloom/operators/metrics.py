"""Aggregations.  Null group keys are dropped and sums of nothing are 0, as the market reports expect."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from .interim import stored
from .joins import looked_up

C = F.col


def keyed(df: DataFrame, *keys: str) -> DataFrame:
    for k in keys:
        df = df.filter(C(k).isNotNull())
    return df


def summary(df: DataFrame, keys: list[str], amount: str, digits: int = 2) -> DataFrame:
    """Count, sum and mean of an amount by keys."""
    return keyed(df, *keys).groupBy(*keys).agg(F.count("*").alias("n"), F.round(F.coalesce(F.sum(amount), F.lit(0.0)), digits).alias("total"), F.round(F.avg(amount), 8).alias("mean"))


def quantiles(df: DataFrame, value: str | Column, qs: list[float], keys: list[str] = [], accuracy: int = 100_000) -> DataFrame:  # noqa: B006
    """Keys and ``q``, the exact interpolated quantiles of a column per key; without keys one row, NULLs without values.

    Two passes, and no task holds all values of a group: a sketch (a mergeable
    summary of some ``accuracy`` entries) gives an interval around each
    quantile; then rows are counted, those inside intervals by value, all
    others by gap.  Groups below 10 * accuracy rows are one interval.  Groups
    without values have no row.
    """
    margin = 3.0 / accuracy
    own_keys = [f"_k{i}" for i in range(len(keys))]
    v = df.select(*[C(k).alias(o) for k, o in zip(keys, own_keys)], (C(value) if isinstance(value, str) else value).cast("double").alias("v")).filter("v is not null")
    ends = [x for q in qs for x in (max(0.0, q - margin), min(1.0, q + margin))]
    b = v.groupBy(*own_keys).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.percentile_approx("v", ends, accuracy).alias("b"))
    few = C("n") < 10 * accuracy
    b = b.select(*[C(o).alias(f"b{o}") for o in own_keys], "n", *[F.when(few | F.lit(q <= margin), C("lo")).otherwise(C("b")[2 * i]).alias(f"lo{i}") for i, q in enumerate(qs)], *[F.when(few | F.lit(q >= 1 - margin), C("hi")).otherwise(C("b")[2 * i + 1]).alias(f"hi{i}") for i, q in enumerate(qs)])
    inside, passed = F.lit(False), F.lit(0)
    for i in range(len(qs)):
        inside = inside | C("v").between(C(f"lo{i}"), C(f"hi{i}"))
        passed = passed + (C("v") >= C(f"lo{i}")).cast("int") + (C("v") > C(f"hi{i}")).cast("int")
    v = v.join(b, reduce(and_, [C(o).eqNullSafe(C(f"b{o}")) for o in own_keys])) if keys else v.crossJoin(F.broadcast(b))
    g = v.groupBy(*own_keys, passed.alias("gap"), F.when(inside, C("v")).alias("own")).agg(F.count("*").alias("k"), F.min("v").alias("m"), F.max("n").alias("n"))
    g = g.withColumn("until", F.sum("k").over(Window.partitionBy(*own_keys).orderBy("m")))  # values inside the intervals, and some gaps

    def at(q: float) -> Column:
        rank = (C("n") - 1) * q
        low, high = (F.min(F.when(C("until") > f(rank), C("m"))) for f in (F.floor, F.ceil))
        return low + F.max(rank - F.floor(rank)) * (high - low)

    return g.groupBy(*own_keys).agg(F.array(*map(at, qs)).alias("q")).withColumnsRenamed(dict(zip(own_keys, keys)))


def with_quantiles(summary: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """``summary`` (a row per key) with ``q`` of ``quantiles``; NULL for keys without values."""
    found = found.withColumnsRenamed({k: f"_{k}" for k in keys})
    return summary.join(found, reduce(and_, [C(k).eqNullSafe(C(f"_{k}")) for k in keys]), "left").drop(*[f"_{k}" for k in keys])


def beside(row: DataFrame, *others: DataFrame) -> DataFrame:
    """Frames of one row each, as one row."""
    for other in others:
        row = row.crossJoin(F.broadcast(other))
    return row


def headline(df: DataFrame, amount: str, discount: str, offers: str, buyer: str, supplier: str, key: str) -> DataFrame:
    """All headline figures: plain sums, distinct counts and the median come from aggregates of their own, since distinct counts multiply rows.

    ``df`` runs once: its six columns are stored for the aggregates.
    """
    df = stored(df.select(amount, discount, offers, buyer, supplier, key), "headline")
    plain = df.agg(
        F.count("*").alias("n"),
        F.round(F.coalesce(F.sum(amount), F.lit(0.0)), 2).alias("total"),
        F.round(F.avg(discount), 4).alias("mean_discount"),
        F.round(F.avg(offers), 4).alias("mean_offers"),
        F.round(F.max(amount), 2).alias("largest"),
    )
    kinds = [keyed(df, c).select(c).distinct().agg(F.count("*").alias(name)) for c, name in ((buyer, "buyers"), (supplier, "suppliers"), (key, "keys"))]
    median = quantiles(df, amount, [0.5]).select(F.round(C("q")[0], 2).alias("median"))
    out = beside(plain, *kinds, median)
    return out.select("n", "total", "mean_discount", "mean_offers", "buyers", "suppliers", "keys", "median", "largest")


def town_map(df: DataFrame, town: str, amount: str, discount: str, kind: str) -> DataFrame:
    """Per town with a known place: rows, value, mean discount, most frequent kind (the least of several), latitude and longitude."""
    g = keyed(df, town).groupBy(F.upper(F.trim(town)).alias("town")).agg(F.count("*").alias("n"), F.round(F.coalesce(F.sum(amount), F.lit(0.0)), 2).alias("total"), F.round(F.avg(discount), 4).alias("mean_discount"), F.mode(kind, True).alias("kind"))
    return looked_up(g, C("town"), R.TOWN_POINT, "lat", "lon").filter(C("lat").isNotNull())


def min_max_scaled(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Each column to 0..1 over all rows; NULL where all are equal.  The extremes are one aggregated row."""
    ends = df.agg(*[f(c).alias(f"_{n}_{c}") for c in cols for n, f in (("lo", F.min), ("hi", F.max))])
    out = df.crossJoin(F.broadcast(ends))
    return out.select(*[c for c in df.columns if c not in cols], *[F.round(F.try_divide(C(c) - C(f"_lo_{c}"), C(f"_hi_{c}") - C(f"_lo_{c}")), digits).alias(c) for c in cols])


def shares(df: DataFrame, within: list[str], of: str, amount: str) -> DataFrame:
    """One row per (within, of): value, its share of the group in percent, its rank.

    The window runs over sums, so a group holds as many rows as it has members.
    Over a whole table that would be one task: see ``concentration_curve``.
    """
    if not within:
        raise ValueError("name the columns to divide by")
    g = keyed(df, *within, of).groupBy(*within, of).agg(F.coalesce(F.sum(amount), F.lit(0.0)).alias("value"), F.count("*").alias("n"))
    w = Window.partitionBy(*within)
    rank = F.row_number().over(w.orderBy(F.desc("value"), of))
    return g.withColumns({"share": F.try_divide(C("value") * 100, F.sum("value").over(w)), "rank": rank})


def hhi(df: DataFrame, within: list[str], of: str, amount: str) -> DataFrame:
    """Sum of squared shares (0 to 10,000); NULL for a group without value."""
    s = shares(df, within, of, amount)
    return s.groupBy(*within).agg(F.round(F.sum(C("share") * C("share")), 4).alias("hhi"), F.count("*").alias("members"), F.round(F.sum("value"), 2).alias("total"))


def concentration(df: DataFrame, within: list[str], of: str, amount: str, k: int = 4) -> DataFrame:
    """The share of the k largest members."""
    return shares(df, within, of, amount).groupBy(*within).agg(F.round(F.sum(F.when(C("rank") <= k, C("share"))), 4).alias(f"cr{k}"))


def dominant(df: DataFrame, within: list[str], of: str, amount: str, above: float) -> DataFrame:
    """Each group's largest member, where its share exceeds ``above`` percent."""
    return shares(df, within, of, amount).filter((C("rank") == 1) & (C("share") > above)).select(*within, of, F.round("value", 2).alias("value"), F.round("share", 4).alias("share"))


def modes(df: DataFrame, key: str, value: str) -> DataFrame:
    """The most frequent value per key; ties go to the smallest."""
    return keyed(df, key, value).groupBy(key).agg(F.mode(value, True).alias(value))


def described(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per column and statistic.  ``df`` runs once: its columns are stored."""
    df = stored(df.select(*cols), "described")
    stats = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    row = df.agg(*[F.round(f(c), 4).alias(f"{c}__{n}") for c in cols for n, f in stats.items()])
    row = beside(row, *[quantiles(df, c, [0.5]).select(F.round(C("q")[0], 4).alias(f"{c}__median")) for c in cols])
    pairs = ", ".join(f"'{c}', '{n}', `{c}__{n}`" for c in cols for n in [*stats, "median"])
    return row.selectExpr(f"stack({len(cols) * (len(stats) + 1)}, {pairs}) AS (column, statistic, value)")


def five_numbers(df: DataFrame, key: str, value: str) -> DataFrame:
    """Extremes and quartiles per key.  ``df`` runs once: both columns are stored."""
    df = stored(keyed(df, key).select(key, value), "five_numbers")
    g = with_quantiles(df.select(key).distinct(), quantiles(df, value, [0.0, 0.25, 0.5, 0.75, 1.0], [key]), [key])
    return g.select(key, *[F.round(C("q")[i], 4).alias(n) for i, n in enumerate(("low", "q1", "mid", "q3", "high"))])


def trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least squares over the rows given (one per group), unweighted."""
    return df.agg(F.round(F.regr_slope(y, x), 6).alias("slope"), F.round(F.regr_intercept(y, x), 4).alias("intercept"), F.count("*").alias("points"))


def binned(df: DataFrame, value: str, edges: list[float]) -> DataFrame:
    """Counts in right-closed bins, the first closed at both ends, empty bins kept in order."""
    spark = df.sparkSession
    bins = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(edges, edges[1:]))], "bin int, low double, high double")
    c, place = C(value), F.lit(None).cast("int")
    expr = F.when(c < edges[0], place)
    for i, hi in enumerate(edges[1:]):
        expr = expr.when(c <= hi, i)
    counts = df.select(expr.alias("bin")).filter("bin is not null").groupBy("bin").agg(F.count("*").alias("k"))
    return bins.join(counts, "bin", "left").select("bin", "low", "high", F.coalesce("k", F.lit(0)).alias("n"))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins between the extremes; the last bin is closed.  Extremes are one aggregated row."""
    ends = df.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    b = F.least(F.floor(F.try_divide((C(value) - C("_lo")) * bins, C("_hi") - C("_lo"))), F.lit(bins - 1)).cast("int")
    return df.filter(C(value).isNotNull()).crossJoin(F.broadcast(ends)).groupBy(F.coalesce(b, F.lit(0)).alias("bin")).agg(F.count("*").alias("n"))


def coverage(df: DataFrame, cols: list[str]) -> DataFrame:
    """Filled rows per field, blank counting as missing."""
    row = df.agg(F.count("*").alias("_n"), *[F.count_if(C(c).isNotNull() & (F.trim(C(c).cast("string")) != "")).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return row.selectExpr("_n", f"stack({len(cols)}, {pairs}) AS (field, filled)").select("field", "filled", F.round(F.try_divide(C("filled") * 100.0, "_n"), 4).alias("percent"))


def win_likelihood(df: DataFrame, supplier: str, amount: str, middle: float, top: int = 10) -> DataFrame:
    """Share of awards times closeness of the mean value to a target (0.3 to 1), best first."""
    g = keyed(df, supplier).groupBy(supplier).agg(F.count("*").alias("wins"), F.avg(amount).alias("mean_value"))
    ends = g.agg(F.sum("wins").alias("_all"), F.max("mean_value").alias("_top"))
    base = F.round(C("wins") * 100.0 / C("_all"), 1)
    near = F.when(C("_top") > 0, F.greatest(F.lit(0.3), F.least(F.lit(1.0), 1 - F.abs(C("mean_value") - middle) / C("_top")))).otherwise(1.0)
    return g.crossJoin(F.broadcast(ends)).select(supplier, "wins", base.alias("base"), F.round(base * near, 1).alias("likelihood")).orderBy(F.desc("likelihood"), F.desc("wins"), supplier).limit(top)


def kpi_payload(df: DataFrame, amount: str, discount: str, category: str, region: str, year: str) -> DataFrame:
    """The dashboard's payload as one JSON document: figures, all years, the ten categories and fifteen regions with most rows."""
    pct = F.when(C(discount).between(0, 100), C(discount))
    kpi = df.agg(F.count("*").alias("n"), F.round(F.sum(amount), 2).alias("total"), F.round(F.avg(pct), 4).alias("mean_discount"))
    kpi = beside(kpi, quantiles(df, pct, [0.5]).select(F.round(C("q")[0], 4).alias("median_discount")))

    def listed(key: str, most: int, name: str) -> DataFrame:
        g = keyed(df, key).groupBy(C(key).cast("string").alias("key")).agg(F.count("*").alias("n"))
        g = g.orderBy(F.desc("n"), "key").limit(most) if most else g
        ranked = F.array_sort(F.collect_list(F.struct((-C("n") if most else F.lit(0)).alias("o"), "key", "n")))
        return g.agg(F.transform(ranked, lambda x: F.struct(x["key"].alias("key"), x["n"].alias("n"))).alias(name))

    out = kpi.crossJoin(listed(year, 0, "per_year")).crossJoin(listed(category, 10, "per_category")).crossJoin(listed(region, 15, "per_region"))
    return out.select(F.to_json(F.struct(*out.columns)).alias("payload"))


def growth(df: DataFrame, key: str, year: str, amount: str, first: int, last: int, top: int = 10) -> DataFrame:
    """Growth from the first to the last year of the top keys by total, by value and by count; from nothing it is 100 (or 0)."""
    g = keyed(df, key).groupBy(key).agg(
        F.sum(amount).alias("total"),
        *[F.coalesce(F.sum(F.when(C(year) == y, C(amount))), F.lit(0.0)).alias(f"v{i}") for i, y in enumerate((first, last))],
        *[F.count_if(C(year) == y).alias(f"n{i}") for i, y in enumerate((first, last))],
    )

    def rate(a: Column, b: Column) -> Column:
        return F.round(F.when(a > 0, (b - a) * 100.0 / a).when(b > 0, 100.0).otherwise(0.0), 1)

    g = g.orderBy(F.desc("total"), key).limit(top)
    return g.select(key, F.round("total", 2).alias("total"), rate(C("v0"), C("v1")).alias("value_growth"), rate(C("n0"), C("n1")).alias("count_growth"))


def amount_bands(c: Column) -> Column:
    from ..functions.scalars import band

    return band(c, R.AMOUNT_BANDS, R.AMOUNT_TOP)
