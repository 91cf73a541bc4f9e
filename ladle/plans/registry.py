"""Named queries: a Spark plan over the mart and, where SQL can say it, a check statement."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.plans.mart import StarMart
from ladle.plans.views import check


@dataclass(frozen=True)
class Query:
    name: str
    covers: str
    run: Callable[[StarMart], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, covers: str, run: Callable[[StarMart], DataFrame], sql: str | None = None, *views: str) -> None:
    """Register a query. ``covers`` lists the operator ids of the survey it answers."""
    if name in QUERIES:
        raise ValueError(f"query {name!r} is registered twice")
    QUERIES[name] = Query(name, covers, run, check(sql, *views) if sql else None)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, so that results do not depend on summation order."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def load_all() -> dict[str, Query]:
    """Import the query modules once; each registers its queries."""
    from ladle.plans import (  # noqa: F401
        queries_base, queries_business, queries_customers, queries_learning, queries_series)
    return QUERIES
