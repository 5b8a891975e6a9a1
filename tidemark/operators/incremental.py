"""Increments: how a batch of rows changes a table, as functions from (target, batch) to the new rows.

``operators.stored`` applies them to stored tables.

Keyed operators read only the keys of the batch's distinct rows on the build
side of their joins, so a small batch is broadcast and a large target is never
shuffled for it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import align, differs
from tidemark.operators.staging import rows_in, rows_not_in

# The words for what to do about changed columns.
SCHEMA_POLICIES = ("ignore", "fail", "append_new_columns", "sync_all_columns")


class BadKeys(ValueError):
    """A batch that a keyed merge must not take."""


class SchemaChange(ValueError):
    """A batch whose columns differ from the table's under the 'fail' policy."""


# --- checks -------------------------------------------------------------------


def bad_keys(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of a batch that are NULL or occur more than once."""
    counts = batch.groupBy(*keys).agg(F.count("*").alias("n"))
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    return counts.where((F.col("n") > 1) | null_key)


def require_unique_keys(batch: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a merge of this batch could not tell which row wins."""
    bad = bad_keys(batch, keys).limit(1).collect()
    if bad:
        raise BadKeys(f"the batch has a NULL or repeated key: {bad[0].asDict()}")


# --- pure functions ------------------------------------------------------------


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """All rows of both."""
    return target.unionByName(batch)


def _kept(target: DataFrame, batch: DataFrame, keys: Sequence[str], predicate: Column | None) -> DataFrame:
    """Target rows that a batch leaves alone.

    With a predicate, only target rows that meet it can be replaced. NULL
    counts as not met.
    """
    if predicate is None:
        return rows_not_in(target, batch, list(keys))
    marked = target.withColumn("__open", F.coalesce(predicate, F.lit(False)))
    free = rows_not_in(marked.where("__open"), batch, list(keys))
    return marked.where(~F.col("__open")).unionByName(free).drop("__open")


def delete_insert(target: DataFrame, batch: DataFrame, keys: Sequence[str], predicate: Column | None = None) -> DataFrame:
    """Remove the target rows whose key is in the batch, then add the whole batch.

    Every batch row is kept, also two with one key; a NULL key removes nothing.
    """
    return _kept(target, batch, keys, predicate).unionByName(batch)


def merge(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    exclude: Sequence[str] = (),
    predicate: Column | None = None,
    check: bool = True,
) -> DataFrame:
    """Update matched rows, insert new ones, keep the rest.

    A column in ``exclude`` keeps the target's value in matched rows. Updates
    to NULL are updates. A target row that fails the predicate never matches,
    so it stays, and the batch row with its key is inserted beside it.
    """
    if check:
        require_unique_keys(batch, keys)
    if not exclude:
        return _kept(target, batch, keys, predicate).unionByName(batch)
    open_rows = target if predicate is None else target.where(F.coalesce(predicate, F.lit(False)))
    matched = rows_in(open_rows, batch, list(keys)).select(*keys, *[F.col(c).alias(f"__old_{c}") for c in exclude])
    changed = batch.join(matched.withColumn("__matched", F.lit(True)), list(keys), "left").select(
        *[
            F.when(F.col("__matched"), F.col(f"__old_{c}")).otherwise(F.col(c)).alias(c) if c in exclude else F.col(c)
            for c in batch.columns
        ]
    )
    return _kept(target, batch, keys, predicate).unionByName(changed)


def lookback(source: DataFrame, target: DataFrame | None, column: str, hours: int) -> DataFrame:
    """Source rows from ``hours`` before the target's newest row on.

    With no target, or an empty one, all rows are taken. The bound is one value,
    read first, so that it reaches the source scan as a plain filter and prunes
    its files and partitions.
    """
    newest = target.agg(F.max(column)).first()[0] if target is not None else None
    if newest is None:
        return source
    return source.where(F.col(column) >= F.lit(newest - timedelta(hours=hours)).cast("timestamp_ntz"))


@dataclass(frozen=True)
class Batch:
    """A half-open event-time window."""

    start: datetime
    end: datetime


def batches(start: str, end: str, size: str = "day", lookback: int = 0, begin: str | None = None) -> list[Batch]:
    """The windows of a run over ``[start, end)``, moved back by ``lookback`` batches.

    The first window is never before ``begin``. The list is one entry per
    hour, day, month or year of a calendar range.
    """
    first = _floor(datetime.fromisoformat(start), size)
    for _ in range(lookback):
        first = _floor(first - timedelta(microseconds=1), size)
    if begin is not None:
        first = max(first, _floor(datetime.fromisoformat(begin), size))
    return list(_windows(first, datetime.fromisoformat(end), size))


def _windows(first: datetime, end: datetime, size: str) -> Iterator[Batch]:
    while first < end:
        after = _next(first, size)
        yield Batch(first, after)
        first = after


def _floor(t: datetime, size: str) -> datetime:
    t = t.replace(minute=0, second=0, microsecond=0)
    if size == "hour":
        return t
    t = t.replace(hour=0)
    if size == "day":
        return t
    t = t.replace(day=1)
    return t if size == "month" else t.replace(month=1)


def _next(t: datetime, size: str) -> datetime:
    if size == "hour":
        return t + timedelta(hours=1)
    if size == "day":
        return t + timedelta(days=1)
    if size == "month":
        return t.replace(year=t.year + t.month // 12, month=t.month % 12 + 1)
    return t.replace(year=t.year + 1)


def replace_window(
    target: DataFrame, batch: DataFrame, column: str, start: str | None, end: str | None, predicate: Column | None = None
) -> DataFrame:
    """Replace the target's rows in ``[start, end)`` by the batch.

    One bound may be open; with neither, and no predicate, the call is refused,
    as it would drop every row.
    """
    if start is None and end is None and predicate is None:
        raise ValueError("a window needs its bounds: without them all rows would be replaced")
    inside = F.lit(True)
    if start is not None:
        inside = inside & (F.col(column) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        inside = inside & (F.col(column) < F.lit(end).cast("timestamp_ntz"))
    if predicate is not None:
        inside = inside & predicate
    return target.where(~F.coalesce(inside, F.lit(False))).unionByName(batch)


def fit_schema(target: DataFrame, batch: DataFrame, policy: str = "ignore") -> tuple[DataFrame, DataFrame]:
    """Make a target and a batch agree on columns; the pair to go on with.

    ignore: the target's columns stay; batch columns it lacks are dropped, and
    columns the batch lacks are NULL. fail: any difference raises.
    append_new_columns: the target gains the batch's new columns.
    sync_all_columns: the target also loses columns that the batch lacks, and
    takes the batch's types.
    """
    if policy not in SCHEMA_POLICIES:
        raise ValueError(f"unknown schema policy {policy!r}; use one of {', '.join(SCHEMA_POLICIES)}")
    new = [c for c in batch.columns if c not in target.columns]
    gone = [c for c in target.columns if c not in batch.columns]
    if policy == "fail":
        retyped = [
            f.name for f in target.schema if f.name in batch.columns and batch.schema[f.name].dataType != f.dataType
        ]
        if new or gone or retyped:
            raise SchemaChange(f"columns differ: added {new}, missing {gone}, retyped {retyped}")
        return target, batch.select(*target.columns)
    if policy == "sync_all_columns":
        names = [c for c in target.columns if c not in gone] + new
    elif policy == "append_new_columns":
        names = target.columns + new
    else:
        names = target.columns
    return _project(target, names, batch, policy), _project(batch, names, target, policy)


def _project(df: DataFrame, names: Sequence[str], other: DataFrame, policy: str) -> DataFrame:
    out = []
    for c in names:
        own, theirs = c in df.columns, c in other.columns
        source = F.col(c) if own else F.lit(None)
        if not own or (policy == "sync_all_columns" and theirs):
            kind = other.schema[c].dataType if theirs else df.schema[c].dataType
            source = source.cast(kind)
        out.append(source.alias(c))
    return df.select(*out)


def update_where(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """``UPDATE … SET … WHERE``; all new values are taken from the old row."""
    hit = F.coalesce(condition, F.lit(False))
    return df.select(
        *[F.when(hit, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in df.columns]
    )


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """``DELETE … WHERE``; a row whose condition is NULL stays."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def update_from(df: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``UPDATE … FROM``: take columns from the source row with the same key, NULLs too.

    The source must have one row per key; aggregate it first.
    """
    slim = source.select(*keys, *[F.col(c).alias(f"__new_{c}") for c in columns], F.lit(True).alias("__hit"))
    return df.join(slim, list(keys), "left").select(
        *[F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def delete_using(df: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``DELETE … USING``: remove rows whose key the source has."""
    return rows_not_in(df, source, list(keys))


def changes(target: DataFrame, batch: DataFrame, keys: Sequence[str], full_source: bool = False) -> DataFrame:
    """What a merge would do, one row per key: insert, update, keep or delete.

    With ``full_source`` the batch is the whole truth and keys it lacks are
    deletes; otherwise they are kept.
    """
    columns = [c for c in target.columns if c not in keys and c in batch.columns]
    aligned = align(target, batch, keys, columns)
    action = (
        F.when(~F.col("in_old"), "insert")
        .when(~F.col("in_new"), "delete" if full_source else "keep")
        .when(differs(columns), "update")
        .otherwise("keep")
    )
    return aligned.select(*keys, action.alias("action"))


def change_counts(target: DataFrame, batch: DataFrame, keys: Sequence[str], full_source: bool = False) -> DataFrame:
    """How many rows each action affects."""
    return changes(target, batch, keys, full_source).groupBy("action").agg(F.count("*").alias("n_rows"))
