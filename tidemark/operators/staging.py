"""Row-level work: projections, validity rules, and subquery filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates, numbers


def stage(
    df: DataFrame,
    rename: Mapping[str, str],
    derive: Mapping[str, Column] | None = None,
    fill: Mapping[str, object] | None = None,
    valid: Sequence[Column] = (),
) -> DataFrame:
    """Filter, rename, derive and default-fill in one projection.

    ``rename`` maps input to output names and lists the columns to keep;
    ``derive`` is over input names; ``fill`` gives the value for NULLs, by
    output name. The rules come first, so they reach the scan.
    """
    rows = df
    for rule in valid:
        rows = rows.where(rule)
    fill = dict(fill or {})
    kept = [
        (F.coalesce(F.col(old), F.lit(fill[new])) if new in fill else F.col(old)).alias(new)
        for old, new in rename.items()
    ]
    made = [
        (F.coalesce(c, F.lit(fill[name])) if name in fill else c).alias(name) for name, c in (derive or {}).items()
    ]
    return rows.select(*kept, *made)


def time_fields(ts: str, prefix: str) -> dict[str, Column]:
    """The date, hour, ISO weekday and day part of a timestamp column."""
    return {
        f"{prefix}_date": F.to_date(ts),
        f"{prefix}_hour": F.hour(ts),
        f"{prefix}_iso_weekday": dates.iso_weekday(ts),
        f"{prefix}_day_part": dates.day_part(ts),
    }


def newest_rows(df: DataFrame, column: str, interval: str) -> DataFrame:
    """Rows no older than ``interval`` before the newest row (a scalar subquery)."""
    limit = df.agg((F.max(column) - F.expr(f"INTERVAL '{interval}'")).alias("limit")).scalar()
    return df.where(F.col(column) >= limit)


def rows_in(left: DataFrame, right: DataFrame, on: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """``(k1, k2) IN (SELECT …)`` or a correlated EXISTS: a semi join.

    The right side is cut to its distinct keys first. Partial aggregation
    folds a hot key before the shuffle, so no task gets all of its copies.
    """
    return left.join(*_keys_of(left, right, on), "left_semi")


def rows_not_in(left: DataFrame, right: DataFrame, on: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Rows with no partner (an anti join); a NULL key has no partner."""
    return left.join(*_keys_of(left, right, on), "left_anti")


def _keys_of(left: DataFrame, right: DataFrame, on: Mapping[str, str] | Sequence[str]):
    pairs = on if isinstance(on, Mapping) else {k: k for k in on}
    keys = right.select(*[F.col(r).alias(f"__in_{i}") for i, r in enumerate(pairs.values())]).distinct()
    condition = None
    for i, name in enumerate(pairs):
        test = left[name] == keys[f"__in_{i}"]
        condition = test if condition is None else condition & test
    return keys, condition


def greater_than_all(left: DataFrame, value: str, right: DataFrame, other: str) -> DataFrame:
    """``value > ALL (SELECT other …)``.

    True for every row when the subquery is empty, unknown (so dropped) when
    it holds a NULL, else a comparison with its largest value.
    """
    bound = right.agg(
        F.struct(
            F.max(other).alias("largest"), F.count("*").alias("n"), F.count(other).alias("known")
        ).alias("bound")
    ).scalar()
    rows = left.withColumn("__bound", bound)
    empty = F.col("__bound.n") == 0
    no_nulls = F.col("__bound.n") == F.col("__bound.known")
    return rows.where(empty | (no_nulls & (F.col(value) > F.col("__bound.largest")))).drop("__bound")


def discount_pct(price: str, discount: str) -> Column:
    """What is left of a price after its discount, as a guarded percentage."""
    return numbers.guarded_pct(F.col(price) * (1 - F.col(discount)), price, F.col(discount) > 0)
