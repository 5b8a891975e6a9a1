"""Stored increments: batches, windows and mutations that rewrite only the partitions they touch.

A batch is staged first, so whatever it is computed from is read once. Which
partitions it touches is found once, from keys and the partition column only; a
predicate on the target and the range of the batch's keys bound that scan, so
partitions and row groups outside them are not read. The touched partitions are
rewritten in one dynamic overwrite, and those left without rows are dropped in one
statement. Every step can be repeated after it broke off.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import truncate
from tidemark.operators import incremental
from tidemark.operators.contracts import Contract
from tidemark.operators.incremental import SCHEMA_POLICIES, SchemaChange, batches, require_unique_keys
from tidemark.operators.joins import differs
from tidemark.operators.staging import rows_in
from tidemark.sources.tables import in_window
from tidemark.sources.warehouse import Warehouse, one_of

# Fixed value: how the start of a batch window is written in a partition name.
STAMP = "yyyy-MM-dd'T'HH"

# The words for how a batch enters a table.
STRATEGIES = ("append", "delete+insert", "merge")

# Types whose smallest and largest key bound a scan.
ORDERED = (T.IntegralType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)

# Type changes that files need not be rewritten for: they are read as the wider type.
WIDER = {("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"), ("smallint", "int"), ("smallint", "bigint"), ("int", "bigint"), ("float", "double")}


# --- columns ------------------------------------------------------------------------


@dataclass(frozen=True)
class SchemaPlan:
    """What a policy makes of a table's and a batch's columns, before anything is changed."""

    table: T.StructType
    after: T.StructType
    added: list[T.StructField] = field(default_factory=list)
    dropped: list[str] = field(default_factory=list)
    retyped: list[str] = field(default_factory=list)

    def project(self, batch: DataFrame) -> DataFrame:
        """The batch with the columns and types that the table will have."""
        return batch.select(
            *[(F.col(f"`{f.name}`") if f.name in batch.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.after]
        )

    def apply(self, house: Warehouse, table: str, partition_by: str) -> None:
        """Change the table's columns.

        New columns, dropped ones and wider types are entries in the catalog. Files are
        rewritten, all of them, only if a type changes otherwise, or if a new column has
        the name of one dropped before, whose values the files still hold.
        """
        if not (self.added or self.dropped or self.retyped):
            return
        was = {f.name: f.dataType.simpleString() for f in self.table}
        wider = all((was[c], self.after[c].dataType.simpleString()) in WIDER for c in self.retyped)
        if not wider or house.dropped_columns(table) & {f.name for f in self.added}:
            house.replace(table, self.project(house.read(table)), [partition_by])
        elif self.dropped or self.retyped:
            house.redefine(table, self.after, [partition_by], set(self.dropped))
        else:
            house.add_columns(table, self.added)


def schema_plan(table: T.StructType, batch: T.StructType, policy: str | None, fixed: Sequence[str] = ()) -> SchemaPlan:
    """What to do about columns that differ. ``fixed`` columns (keys, partitions) can neither go nor change type.

    None: the names must agree. ignore: the table stays as it is; fail: any
    difference raises; append_new_columns: the table gains the batch's; and
    sync_all_columns: it also loses what the batch lacks and takes its types.
    """
    if policy is not None and policy not in SCHEMA_POLICIES:
        raise ValueError(f"unknown schema policy {policy!r}; use one of {', '.join(SCHEMA_POLICIES)}")
    new = [f for f in batch if f.name not in table.names]
    gone = [c for c in table.names if c not in batch.names]
    retyped = [f.name for f in table if f.name in batch.names and batch[f.name].dataType != f.dataType]
    if policy is None and (new or gone):
        raise SchemaChange(f"the table and the batch differ in columns: new {[f.name for f in new]}, missing {gone}; a schema policy decides what to do")
    if policy == "fail" and (new or gone or retyped):
        raise SchemaChange(f"columns differ: added {[f.name for f in new]}, missing {gone}, retyped {retyped}")
    if policy == "append_new_columns":
        return SchemaPlan(table, T.StructType([*table, *new]), added=new)
    if policy == "sync_all_columns":
        stuck = [c for c in (*gone, *retyped) if c in fixed]
        if stuck:
            raise SchemaChange(f"keys and partition columns cannot be dropped or retyped: {stuck}")
        kept = [T.StructField(f.name, batch[f.name].dataType) for f in table if f.name not in gone]
        return SchemaPlan(table, T.StructType([*kept, *new]), new, gone, retyped)
    return SchemaPlan(table, table)


# --- batches ------------------------------------------------------------------------


@dataclass(frozen=True)
class Increment:
    """How batches enter a stored table.

    strategy: ``append``, ``delete+insert`` or ``merge``; by default delete+insert with
    keys and append without. ``exclude`` columns keep the table's values in matched rows
    (merge only). ``predicate`` is SQL over the table's columns: rows that do not meet
    it are never replaced; where it names the partition column, other partitions are
    not even read. ``on_schema_change`` is a policy of :func:`schema_plan`. A batch that
    breaks ``contract`` fails while it is staged, before the table is changed.
    """

    partition_by: str
    keys: Sequence[str] = ()
    strategy: str | None = None
    exclude: Sequence[str] = ()
    predicate: str | None = None
    on_schema_change: str | None = None
    contract: Contract | None = None

    def run(self, house: Warehouse, table: str, batch: DataFrame) -> set | None:
        """Apply a batch; the partitions it touched, or None if it made the table."""
        strategy = self.strategy or ("delete+insert" if self.keys else "append")
        if strategy not in STRATEGIES:
            raise ValueError(f"unknown strategy {strategy!r}; use one of {', '.join(STRATEGIES)}")
        if strategy != "append" and not self.keys:
            raise ValueError(f"{strategy} needs keys")
        house.recover(table)
        plan = None
        if house.exists(table):
            plan = schema_plan(house.read(table).schema, batch.schema, self.on_schema_change, [*self.keys, self.partition_by])
            batch = plan.project(batch)
        if self.contract is not None:
            batch = self.contract.enforce(batch)
        with house.staged(batch) as rows:
            if strategy == "merge":
                require_unique_keys(rows, self.keys)
            if plan is None:
                house.replace(table, rows, [self.partition_by])
                return None
            plan.apply(house, table, self.partition_by)
            return self._enter(house, table, rows, strategy)

    def _enter(self, house: Warehouse, table: str, rows: DataFrame, strategy: str) -> set:
        p = self.partition_by
        filled, bounds = self._extent(rows)
        if not filled:
            return set()
        if strategy == "append":
            house.append(table, rows, [p])
            return filled
        left = self.home(house.read(table), rows, bounds)
        old = house.read(table).where(one_of(F.col(p), filled | set(left)))
        if strategy == "merge":
            after = incremental.merge(old, rows, self.keys, self.exclude, self._open(), check=False)
        else:
            after = incremental.delete_insert(old, rows, self.keys, self._open())
        lost = {v: n for v, n in left.items() if v not in filled}
        # A partition that loses as many rows as it holds is not written again, but dropped.
        held = dict(old.where(one_of(F.col(p), lost)).groupBy(p).count().collect()) if lost else {}
        house.overwrite_partitions(table, after, [p])
        house.drop_partitions(table, p, [v for v, n in lost.items() if held[v] == n])
        return filled | set(left)

    def _open(self) -> Column | None:
        return F.expr(self.predicate) if self.predicate is not None else None

    def _extent(self, rows: DataFrame) -> tuple[set, dict[str, tuple]]:
        """The partitions of a batch, and the smallest and largest of each key: one row per partition."""
        ordered = [k for k in self.keys if isinstance(rows.schema[k].dataType, ORDERED)]
        ends = [(f"{name}_{i}", f(k)) for i, k in enumerate(ordered) for name, f in (("lo", F.min), ("hi", F.max))]
        held = rows.groupBy(self.partition_by).agg(F.lit(True).alias("__any"), *[c.alias(name) for name, c in ends])
        # The ends as text, which any type comes back from.
        over = [(F.min if name.startswith("lo") else F.max)(name).cast("string").alias(name) for name, _ in ends]
        total = held.agg(F.collect_list(F.struct(self.partition_by)).alias("held"), *over).first()
        return {r[0] for r in total["held"]}, {k: (total[f"lo_{i}"], total[f"hi_{i}"]) for i, k in enumerate(ordered)}

    def home(self, target: DataFrame, rows: DataFrame, bounds: Mapping[str, tuple]) -> dict[object, int]:
        """Partitions of open target rows with keys of the batch, and how many rows; one entry per partition.

        Nothing is read if the partition column is a key, for then no key can move.
        """
        if self.partition_by in self.keys:
            return {}
        return dict(self.matches(target, rows, bounds).groupBy(self.partition_by).count().collect())

    def matches(self, target: DataFrame, rows: DataFrame, bounds: Mapping[str, tuple], more: Sequence[str] = ()) -> DataFrame:
        """Keys and partition (and ``more``) of the open target rows that a batch meets."""
        open_rows = target if self.predicate is None else target.where(self.predicate)
        for k, (lo, hi) in bounds.items():
            kind = target.schema[k].dataType
            open_rows = open_rows.where(F.col(k).between(F.lit(lo).cast(kind), F.lit(hi).cast(kind)))
        return rows_in(open_rows.select(*dict.fromkeys([*self.keys, self.partition_by, *more])), rows, list(self.keys))


def change_counts(house: Warehouse, table: str, batch: DataFrame, keys: Sequence[str], partition_by: str) -> DataFrame:
    """How many rows a merge of the batch would insert, update and keep: (action, n_rows), actions without rows left out.

    Only the table's rows with keys of the batch meet it, found as a merge finds them; all
    others are counted and not read. NULLs are values: a change to or from NULL is an update.
    """
    step = Increment(partition_by, keys, "merge")
    with house.staged(batch) as rows:
        require_unique_keys(rows, keys)
        target = house.read(table)
        columns = [c for c in target.columns if c not in keys and c in rows.columns]
        held = step.matches(target, rows, step._extent(rows)[1], columns)
        old = held.select(*keys, *[F.col(c).alias(f"old_{c}") for c in columns], F.lit(True).alias("__held"))
        new = rows.select(*keys, *[F.col(c).alias(f"new_{c}") for c in columns])
        pair = new.join(old, list(keys), "left")
        known = F.col("__held").isNotNull()
        found = pair.agg(F.count_if(~known).alias("insert"), F.count_if(known & differs(columns)).alias("update")).first()
        counts = {"insert": found["insert"], "update": found["update"], "keep": target.count() - found["update"]}
    data = [(action, n) for action, n in counts.items() if n]
    return house.spark.createDataFrame(data, "action string, n_rows long")


def store_merge(
    warehouse: Warehouse, table: str, batch: DataFrame, keys: Sequence[str], partition_by: str, exclude: Sequence[str] = (), strategy: str = "merge", **more
) -> DataFrame:
    """The table after an :class:`Increment` with these settings."""
    Increment(partition_by, keys, strategy, exclude, **more).run(warehouse, table, batch)
    return warehouse.read(table)


def lookback(house: Warehouse, table: str, source: DataFrame, column: str, hours: int, partition_by: str) -> DataFrame:
    """Source rows from ``hours`` before the stored table's newest row on.

    Partitions must ascend with the column, as days do: then the newest row is in the
    newest partition, which the catalog knows, and only that one is read.
    """
    if not house.exists(table):
        return source
    newest = house.partitions(table, partition_by).agg(F.max(partition_by)).first()[0]
    target = house.read(table)
    if newest is not None:
        last = target.where(F.col(partition_by) == F.lit(newest))
        # A newest partition of NULLs only says nothing about the others.
        if last.where(F.col(column).isNotNull()).limit(1).count():
            target = last
    return incremental.lookback(source, target, column, hours)


def store_rollup(
    warehouse: Warehouse,
    table: str,
    facts: DataFrame,
    rollup: Callable[[DataFrame], DataFrame],
    partition_by: str,
    touched: set | None = None,
) -> DataFrame:
    """Recompute the rollup's partitions that a fact step touched; all if ``touched`` is None.

    Facts and rollup share the partition column, so the rollup always agrees
    with the facts, whatever lookback the fact step used.
    """
    if touched is None or not warehouse.exists(table):
        return warehouse.replace(table, rollup(facts), [partition_by])
    if not touched:
        return warehouse.read(table)
    part = facts.where(one_of(F.col(partition_by), touched))
    held = {row[0] for row in part.select(partition_by).distinct().collect()}
    if held:
        warehouse.overwrite_partitions(table, rollup(part), [partition_by])
    warehouse.drop_partitions(table, partition_by, touched - held)
    return warehouse.read(table)


# --- windows ------------------------------------------------------------------------


def store_windows(
    warehouse: Warehouse,
    table: str,
    source: DataFrame,
    column: str,
    start: str | None,
    end: str | None,
    size: str = "day",
    lookback: int = 0,
    begin: str | None = None,
    predicate: str | None = None,
) -> DataFrame:
    """Replace every batch window in ``[start, end)`` by the source's rows in it.

    The table is partitioned by the window's start (``batch_start``). All windows of a
    run are one job: their partitions are disjoint, so Spark writes them side by side,
    and runs over disjoint windows may go on at the same time. The rows are staged
    first, as with a merge, and windows that end up without rows are dropped in one
    statement. With a ``predicate``, the table's rows that do not meet it stay.
    """
    if start is None or end is None:
        raise ValueError("a window needs its bounds: without them all rows would be replaced")
    windows = batches(start, end, size, lookback, begin)
    if not windows:
        return warehouse.read(table)
    lo, hi = str(windows[0].start), str(windows[-1].end)
    rows = source.where(in_window(F.col(column), lo, hi)).withColumn(
        "batch_start", F.replace(truncate(size, column).cast("string").substr(1, 13), F.lit(" "), F.lit("T"))
    )
    warehouse.ensure(table, rows.schema, ["batch_start"])
    inside = in_window(F.to_timestamp_ntz("batch_start", F.lit(STAMP)), lo, hi)
    stale = {row[0] for row in warehouse.partitions(table, "batch_start").where(inside).collect()}
    with warehouse.staged(rows) as fresh:
        after = fresh
        if predicate is not None:
            kept = warehouse.read(table).where(inside).where(~F.coalesce(F.expr(predicate), F.lit(False)))
            after = fresh.unionByName(kept)
        stale -= {row[0] for row in after.select("batch_start").distinct().collect()}
        warehouse.overwrite_partitions(table, after, ["batch_start"])
    warehouse.drop_partitions(table, "batch_start", stale)
    return warehouse.read(table)


# --- mutations ----------------------------------------------------------------------


def update_rows(house: Warehouse, table: str, partition_by: str, condition: str | Column, values: Mapping[str, Column]) -> set:
    """``UPDATE … SET … WHERE`` on a stored table; the partitions it touched.

    Only partitions with rows to change are rewritten. A new partition value moves rows;
    the partitions they come to are rewritten too.
    """
    condition = F.expr(condition) if isinstance(condition, str) else condition
    return _mutated(house, table, partition_by, house.read(table).where(condition), lambda rows: incremental.update_where(rows, condition, dict(values)), values.get(partition_by))


def delete_rows(house: Warehouse, table: str, partition_by: str, condition: str | Column) -> set:
    """``DELETE … WHERE`` on a stored table; a partition that loses all rows is dropped, not written."""
    condition = F.expr(condition) if isinstance(condition, str) else condition
    return _deleted(house, table, partition_by, house.read(table).where(condition), lambda rows: incremental.delete_where(rows, condition))


def update_rows_from(house: Warehouse, table: str, partition_by: str, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> set:
    """``UPDATE … FROM`` on a stored table; the source has one row per key and does not set the partition column."""
    if partition_by in columns:
        raise ValueError("rows cannot be moved between partitions by an update from a source; merge them")
    with house.staged(source.select(*keys, *columns)) as new:
        hit = rows_in(house.read(table), new, list(keys))
        return _mutated(house, table, partition_by, hit, lambda rows: incremental.update_from(rows, new, keys, columns))


def delete_rows_using(house: Warehouse, table: str, partition_by: str, source: DataFrame, keys: Sequence[str]) -> set:
    """``DELETE … USING`` on a stored table."""
    with house.staged(source.select(*keys).distinct()) as gone:
        hit = rows_in(house.read(table), gone, list(keys))
        return _deleted(house, table, partition_by, hit, lambda rows: incremental.delete_using(rows, gone, keys))


def _mutated(house: Warehouse, table: str, p: str, hit: DataFrame, change: Callable[[DataFrame], DataFrame], moved: Column | None = None) -> set:
    found = hit.select(p).distinct() if moved is None else hit.select(F.explode(F.array(F.col(p), moved)).alias(p)).distinct()
    touched = {row[0] for row in found.collect()}
    if not touched:
        return touched
    with house.staged(change(house.read(table).where(one_of(F.col(p), touched)))) as after:
        held = touched if moved is None else {row[0] for row in after.select(p).distinct().collect()}
        house.overwrite_partitions(table, after, [p])
    house.drop_partitions(table, p, touched - held)
    return touched


def _deleted(house: Warehouse, table: str, p: str, hit: DataFrame, change: Callable[[DataFrame], DataFrame]) -> set:
    lost = dict(hit.groupBy(p).count().collect())
    if not lost:
        return set()
    target = house.read(table)
    held = dict(target.where(one_of(F.col(p), lost)).groupBy(p).count().collect())
    partly = {v for v, n in lost.items() if held[v] > n}
    if partly:
        house.overwrite_partitions(table, change(target.where(one_of(F.col(p), partly))), [p])
    house.drop_partitions(table, p, set(lost) - partly)
    return set(lost)
