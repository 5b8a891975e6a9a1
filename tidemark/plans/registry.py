"""The registered queries: a Spark plan each, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.tables import Inputs

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(inputs)`` under an inventory ID, with equivalent SQL."""

    def register(fn: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Inputs(spark, folder))

        run.__name__, run.__doc__ = name, fn.__doc__
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


# --- pieces of SQL that several queries share ------------------------------------

# Prices hold two decimals: exact decimal arithmetic does not depend on row order.
REVENUE = "CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"


def r(expression: str, places: int) -> str:
    """Round a DOUBLE half away from zero as decimal text would be."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38,10)), {places}) AS DOUBLE)"


def total(column: str, scale: int = 2) -> str:
    """Exact SUM of a DOUBLE column that holds ``scale`` decimals."""
    return f"CAST(sum(CAST({column} AS DECIMAL(18,{scale}))) AS DOUBLE)"


def mean(column: str, scale: int = 2) -> str:
    """Exact AVG; NULLs are skipped."""
    return f"({total(column, scale)} / nullif(count({column}), 0))"


def day_part_sql(ts: str) -> str:
    return (
        f"CASE WHEN hour({ts}) < 6 THEN 'overnight' WHEN hour({ts}) < 10 THEN 'morning rush' "
        f"WHEN hour({ts}) < 16 THEN 'midday' WHEN hour({ts}) < 20 THEN 'evening rush' ELSE 'night' END"
    )
