"""Registry of checked queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables import SQL_VIEWS, Tables


@dataclass
class Check:
    ids: str
    run: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.run(Tables(spark, folder))


CHECKS: dict[str, Check] = {}


def sql_over(views: str, body: str) -> str:
    """``body`` with the named views in front of it."""
    ctes = ", ".join(f"{name} AS ({SQL_VIEWS[name]})" for name in views.split())
    body = body.strip()
    if not ctes:
        return body
    if body.startswith("WITH "):
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"


def check(name: str, ids: str, views: str = "", sql: str | None = None):
    """Register the decorated function as query ``name`` covering the inventory rows ``ids``."""
    def add(run: Callable[[Tables], DataFrame]):
        CHECKS[name] = Check(ids, run, None if sql is None else sql_over(views, sql))
        return run

    return add


def r6(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column.cast("double"), 6)


def big(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("bigint")
