"""Data tests. Each returns its failing rows; no rows means it passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import side_by_side
from tidemark.operators.sets import bag_difference
from tidemark.operators.staging import rows_not_in
from tidemark.sources.warehouse import Warehouse

# --- row rules: true where a row fails ---------------------------------------------


def is_null(column: str) -> Column:
    return F.col(column).isNull()


def not_accepted(column: str, values: Sequence[object]) -> Column:
    return ~F.col(column).isin(list(values))


def out_of_range(column: str, low: object = None, high: object = None, inclusive: bool = True) -> Column:
    """Below ``low`` or above ``high``; either may be left out. NULL passes."""
    if low is None and high is None:
        raise ValueError("a range needs a bound")
    c, fail = F.col(column), F.lit(False)
    if low is not None:
        fail = fail | (c < low if inclusive else c <= low)
    if high is not None:
        fail = fail | (c > high if inclusive else c >= high)
    return F.coalesce(fail, F.lit(False))


# --- tests: failing rows --------------------------------------------------------------


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(is_null(column))


def unique(df: DataFrame, column: str, digest: bool = False) -> DataFrame:
    """Values that occur more than once, with their counts; NULLs are not compared.

    For long texts, ``digest`` compares and reports SHA-256 digests, so that
    the texts themselves are not shuffled.
    """
    known = df.where(F.col(column).isNotNull())
    if digest:
        known = known.select(F.sha2(column, 256).alias(column))
    return unique_combination(known, [column])


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once, with their counts."""
    return df.groupBy(*columns).agg(F.count("*").alias("n_records")).where("n_records > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """Values outside the list, with their counts."""
    return df.where(not_accepted(column, values)).groupBy(column).agg(F.count("*").alias("n_records"))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose key no parent has; NULL keys pass."""
    return rows_not_in(child.where(F.col(column).isNotNull()), parent, {column: parent_column})


def in_range(df: DataFrame, column: str, low: object, high: object) -> DataFrame:
    return df.where(out_of_range(column, low, high))


def non_negative(df: DataFrame, column: str) -> DataFrame:
    return df.where(out_of_range(column, low=0))


def accepted_range(df: DataFrame, column: str, low: object = None, high: object = None, inclusive: bool = True) -> DataFrame:
    return df.where(out_of_range(column, low, high, inclusive))


def reconciles(rollup: DataFrame, detail: DataFrame, exact: Sequence[str], within: Mapping[str, float]) -> DataFrame:
    """One row if two one-row totals disagree, none if they agree.

    Columns in ``exact`` must be equal, those in ``within`` may differ by the
    given amount.
    """
    both = side_by_side(rollup=rollup, detail=detail)
    fail = F.lit(False)
    for c in exact:
        fail = fail | ~F.col(f"rollup_{c}").eqNullSafe(F.col(f"detail_{c}"))
    for c, tolerance in within.items():
        fail = fail | F.coalesce(F.abs(F.col(f"rollup_{c}") - F.col(f"detail_{c}")) > tolerance, F.lit(True))
    return both.where(fail)


def equal_rows(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows that two relations do not hold equally often, on the given columns."""
    if columns is not None:
        left, right = left.select(*columns), right.select(*columns)
    return bag_difference(left, right)


# --- suites -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """A named test. Give ``rule`` for a row rule over the suite's table, or ``failures``.

    More than ``error_over`` failing rows is an error, or only a warning if the
    severity is 'warn'; more than ``warn_over`` is a warning.
    """

    name: str
    rule: Column | None = None
    failures: DataFrame | None = None
    severity: str = "error"
    warn_over: int = 0
    error_over: int = 0


def status(check: Check, failures: Column) -> Column:
    warned = F.when(failures > check.warn_over, "warn").otherwise("pass")
    if check.severity == "warn":
        return warned
    return F.when(failures > check.error_over, "error").otherwise(warned)


def run_suite(tables: Sequence[tuple[DataFrame, Sequence[Check]]]) -> DataFrame:
    """One row per test: name, severity, failures, status.

    All row rules of a table are counted in a single scan of it; each other
    test is one aggregate. The parts are one lazy DataFrame.
    """
    parts = []
    for df, checks in tables:
        rules = [c for c in checks if c.rule is not None]
        if rules:
            counts = df.agg(*[F.count_if(F.coalesce(c.rule, F.lit(False))).alias(f"r{i}") for i, c in enumerate(rules)])
            rows = [_result(c, F.col(f"r{i}")) for i, c in enumerate(rules)]
            parts.append(counts.select(F.inline(F.array(*rows))))
        for c in checks:
            if c.rule is None:
                counts = c.failures.agg(F.count("*").alias("n"))
                parts.append(counts.select(F.inline(F.array(_result(c, F.col("n"))))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _result(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.name).alias("test"),
        F.lit(check.severity).alias("severity"),
        failures.alias("failures"),
        status(check, failures).alias("status"),
    )


def totals_by_status(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count("*").alias("tests"))


def store_failures(warehouse: Warehouse, table: str, failures: DataFrame, order: Sequence[str], cap: int | None = None) -> DataFrame:
    """Keep failing rows in a table for a look; ``cap`` is the report's length."""
    rows = failures if cap is None else failures.orderBy(*order).limit(cap)
    return warehouse.replace(table, rows)
