"""Where queries and their SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..plans.bindings import NOTICES_CTE, TENDERS_SQL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query.  In its SQL a leading ``t:`` stands for the tender view, ``n:`` for the notices; both open a WITH list."""

    def add(f: Query) -> Query:
        key = name or f.__name__
        QUERIES[key] = f
        if sql is not None:
            text = sql.strip()
            for mark, cte in (("t:", TENDERS_SQL), ("n:", NOTICES_CTE)):
                if text.startswith(mark):
                    rest = text[len(mark) :].strip()
                    text = f"WITH {cte}" + (f", {rest[5:]}" if rest[:5].upper() == "WITH " else f" {rest}")
            ORACLE[key] = text
        return f

    return add
