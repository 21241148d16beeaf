"""Filters, facets, search, sampling and paging."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

C = F.col


def faceted(df: DataFrame, **facets) -> DataFrame:
    """Equality on the facets that are given; None means any."""
    for name, value in facets.items():
        if value is not None:
            df = df.filter(C(name) == value)
    return df


def facet_values(df: DataFrame, facet: str, **fixed) -> DataFrame:
    return faceted(df, **fixed).filter(C(facet).isNotNull()).select(facet).distinct().orderBy(facet)


def text_search(df: DataFrame, cols: list[str], pattern: str) -> DataFrame:
    """Rows in which any of the columns matches the pattern, whatever the case."""
    return df.filter(reduce(or_, [F.coalesce(C(c).rlike("(?iU)" + pattern), F.lit(False)) for c in cols]))


def names_with_totals(df: DataFrame, name: str, amount: str) -> DataFrame:
    return df.filter(C(name).isNotNull()).groupBy(name).agg(F.sum(amount).alias("total"), F.count("*").alias("n"))


def name_search(df: DataFrame, name: str, amount: str, term: str | None, most: int = 50, top: int = 100) -> DataFrame:
    """Names that contain a term of three characters or more; else those with the highest total."""
    g = names_with_totals(df, name, amount)
    if term and len(term) >= 3:
        return g.filter(F.upper(name).contains(term.upper())).orderBy(name).limit(most)
    return g.orderBy(F.desc("total"), name).limit(top)


def name_search_in(index, name: str, term: str | None, most: int = 50, top: int = 100) -> DataFrame:
    """``name_search`` in a trigram index over ``names_with_totals``."""
    if term and len(term) >= 3:
        return index.containing_upper(name, term).orderBy(name).limit(most)
    return index.rows().select(name, "total", "n").orderBy(F.desc("total"), name).limit(top)


def ranged(df: DataFrame, ranges: dict[str, tuple]) -> DataFrame:
    """Bounds per column; None leaves a side open."""
    for name, (lo, hi) in ranges.items():
        if lo is not None:
            df = df.filter(C(name) >= lo)
        if hi is not None:
            df = df.filter(C(name) <= hi)
    return df


def sample(df: DataFrame, key: list[str], n: int) -> DataFrame:
    """The same n rows each time, in any engine: those with the smallest SHA-256 of their key as text."""
    return df.orderBy(F.sha2(F.concat_ws("|", *[C(k).cast("string") for k in key]), 256), *key).limit(n)


def page(df: DataFrame, order: list[Column], number: int, size: int = 50) -> DataFrame:
    return df.orderBy(*order).offset((number - 1) * size).limit(size)
