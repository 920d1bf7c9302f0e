"""Registry of named queries and, where one exists, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query '{name}' is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round the named columns; adding zero turns a negative zero into a plain one."""
    return df.withColumns({c: F.round(c, d) + F.lit(0.0) for c, d in digits.items()})


def r(column: Column, digits: int) -> Column:
    return F.round(column, digits) + F.lit(0.0)


# Common table expressions of the SQL twins: name -> (names needed before it, text).
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, text: str, *needs: str) -> None:
    CTES[name] = (needs, text)


def with_(needs: str, body: str, recursive: bool = False) -> str:
    """``body`` behind the WITH clause made of the listed expressions and all they need."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for before in CTES[name][0]:
            visit(before)
        if name not in ordered:
            ordered.append(name)

    for name in needs.split():
        visit(name)
    parts = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered)
    return f"WITH {'RECURSIVE ' if recursive else ''}{parts}\n{body}"
