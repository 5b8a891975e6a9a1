"""History tables: one row per version of each key (SCD type 2)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import surrogate_key
from tidemark.operators.incremental import require_unique_keys
from tidemark.sources.warehouse import Warehouse

# The words for what to do about keys that left the source.
HARD_DELETES = ("ignore", "invalidate", "new_record")


@dataclass(frozen=True)
class Names:
    """The bookkeeping columns; rename any of them."""

    scd_id: str = "scd_id"
    updated_at: str = "updated_at"
    valid_from: str = "valid_from"
    valid_to: str = "valid_to"
    is_deleted: str = "is_deleted"

    def check(self, source: DataFrame) -> None:
        names = astuple(self)
        for n in names:
            if not n or not n.replace("_", "a").isalnum() or n[0].isdigit():
                raise ValueError(f"not a column name: {n!r}")
        if len(set(names)) != len(names):
            raise ValueError("bookkeeping columns need different names")
        clash = [n for n in names if n in source.columns]
        if clash:
            raise ValueError(f"the source already has a column {', '.join(clash)}")


@dataclass(frozen=True)
class Snapshot:
    """How a history is kept.

    strategy 'check' opens a version when any of ``check_cols`` (all
    non-key columns if None) changed, NULL-safely; 'timestamp' when the
    source's ``updated_column`` is later than the version's. ``hard_deletes``
    says what happens to a key that left the source: 'ignore' it, 'invalidate'
    (close) its version, or also write a closing 'new_record' whose
    ``is_deleted`` is the text 'True'. ``valid_to_current`` is the end of open
    versions, NULL if None. A key that comes back after a deletion opens a
    fresh version.
    """

    keys: Sequence[str]
    strategy: str = "check"
    check_cols: Sequence[str] | None = None
    updated_column: str | None = None
    hard_deletes: str = "ignore"
    valid_to_current: str | None = None
    names: Names = Names()

    def __post_init__(self) -> None:
        if self.strategy not in ("check", "timestamp"):
            raise ValueError(f"unknown snapshot strategy {self.strategy!r}")
        if self.strategy == "timestamp" and not self.updated_column:
            raise ValueError("the timestamp strategy needs updated_column")
        if self.hard_deletes not in HARD_DELETES:
            raise ValueError(f"hard_deletes is one of {', '.join(HARD_DELETES)}")

    # -- pure ---------------------------------------------------------------------

    def first(self, source: DataFrame, as_of: str) -> DataFrame:
        """The history after the first run: every row is a current version."""
        self.names.check(source)
        start = self._start(as_of)
        return source.select("*", *[c.alias(n) for n, c in self._bookkeeping(self.keys, start, F.lit("False"))])

    def apply(self, history: DataFrame, source: DataFrame, as_of: str) -> DataFrame:
        """The history after another run at ``as_of``."""
        current = self._is_current(history)
        return history.where(~current).unionByName(
            self.versions(history.where(current), source, as_of), allowMissingColumns=True
        )

    def versions(self, current: DataFrame, source: DataFrame, as_of: str) -> DataFrame:
        """What becomes of the current versions: kept, closed and opened rows.

        One full outer join on the key; each joined pair yields its one to
        two versions in place, so the sides are read and shuffled once.
        """
        n, keys = self.names, list(self.keys)
        n.check(source)
        flag = [n.is_deleted] if self.hard_deletes == "new_record" else []
        book = [n.scd_id, n.updated_at, n.valid_from, n.valid_to, *flag]
        data = [c for c in current.columns if c not in keys and c not in book]
        gained = [c for c in source.columns if c not in keys and c not in data]
        kinds = {f.name: f.dataType for f in [*current.schema, *source.schema]}

        old = current.select(
            *keys, F.struct(*[c for c in current.columns if c not in keys]).alias("h"), F.lit(True).alias("in_h")
        )
        new = source.select(
            *keys, F.struct(F.lit(True).alias("__there"), *[c for c in source.columns if c not in keys]).alias("s")
        )
        pair = old.join(new, keys, "full_outer")
        in_h, in_s = F.col("in_h").isNotNull(), F.col("s").isNotNull()
        dead = in_h & F.coalesce(F.col(f"h.{n.is_deleted}") == "True", F.lit(False)) if flag else F.lit(False)

        def h(c: str) -> Column:
            return F.col(f"h.{c}") if c in current.columns else F.lit(None).cast(kinds[c])

        def s(c: str) -> Column:
            return F.col(f"s.{c}").cast(kinds[c]) if c in source.columns else F.lit(None).cast(kinds[c])

        if self.strategy == "timestamp":
            moved = s(self.updated_column).cast("timestamp_ntz") > h(n.updated_at)
        else:
            moved = F.lit(False)
            for c in self.check_cols or [c for c in source.columns if c not in keys]:
                moved = moved | ~h(c).eqNullSafe(s(c))
        opened = in_s & (~in_h | dead | F.coalesce(moved, F.lit(False)))
        gone = in_h & ~in_s & ~dead if self.hard_deletes != "ignore" else F.lit(False)

        instant = F.lit(as_of).cast("timestamp_ntz")
        start = s(self.updated_column).cast("timestamp_ntz") if self.strategy == "timestamp" else instant
        # A key that returns starts when its return is seen.
        start = F.when(dead, F.greatest(start, instant)).otherwise(start) if flag else start
        end = F.when(opened & in_h, start).when(gone, instant).otherwise(h(n.valid_to))

        def row(present: Column, value, marks: list[tuple[str, Column]]) -> Column:
            fields = [value(c).alias(c) for c in [*data, *gained]] + [c.alias(m) for m, c in marks]
            return F.when(present, F.struct(*fields))

        kept = [(m, h(m)) for m in (n.scd_id, n.updated_at, n.valid_from)] + [(n.valid_to, end)]
        kept += [(m, F.coalesce(h(m), F.lit("False"))) for m in flag]
        rows = [
            row(in_h, h, kept),
            row(opened, s, self._bookkeeping(keys, start, F.lit("False"))),
        ]
        if flag:
            rows.append(row(gone, h, self._bookkeeping(keys, instant, F.lit("True"))))
        out = pair.select(*keys, F.explode(F.array_compact(F.array(*rows))).alias("v")).select(*keys, "v.*")
        order = [c for c in current.columns if c not in book] + gained + book
        return out.select(*order)

    def _start(self, as_of: str) -> Column:
        if self.strategy == "timestamp":
            return F.col(self.updated_column).cast("timestamp_ntz")
        return F.lit(as_of).cast("timestamp_ntz")

    def _bookkeeping(self, keys: Sequence[str], start: Column, deleted: Column) -> list[tuple[str, Column]]:
        n = self.names
        out = [
            (n.scd_id, surrogate_key(*keys, start)),
            (n.updated_at, start),
            (n.valid_from, start),
            (n.valid_to, F.lit(self.valid_to_current).cast("timestamp_ntz")),
        ]
        return out + [(n.is_deleted, deleted)] if self.hard_deletes == "new_record" else out

    def _is_current(self, history: DataFrame) -> Column:
        end = F.col(self.names.valid_to)
        if self.valid_to_current is None:
            return end.isNull()
        return end.isNull() | (end == F.lit(self.valid_to_current).cast("timestamp_ntz"))

    # -- stored ---------------------------------------------------------------------

    def run(self, warehouse: Warehouse, table: str, source: DataFrame, as_of: str, check: bool = True) -> DataFrame:
        """Bring a stored history up to date, without rewriting closed versions.

        A source with NULL or repeated keys is refused, unless ``check`` is off.

        The table is partitioned by ``version_set``: 'open' holds the current
        versions, and each run's closings get a partition of their own. The
        closings are written before 'open' is replaced, and until then the table
        keeps a note of them. A run that broke off in between is undone by the
        next one, whatever its ``as_of``; until then a reader may see a closed
        version as open too. If the source gained a column the table is rebuilt
        once with it. The source is staged: it is computed once for the check
        and the versions.
        """
        with warehouse.staged(source) as rows:
            if check:
                require_unique_keys(rows, self.keys)
            return self._run(warehouse, table, rows, as_of)

    def _mend(self, warehouse: Warehouse, table: str) -> None:
        """Undo the closings of a run that broke off before it replaced the open versions."""
        begun = warehouse.noted(table)
        if not begun:
            return
        history, version = warehouse.read(table), self.names.scd_id
        closings = history.where(F.col("version_set") == begun).select(version)
        if not history.where("version_set = 'open'").select(version).join(closings, version, "left_semi").isEmpty():
            warehouse.drop_partitions(table, "version_set", [begun])
        warehouse.note(table, "")

    def _run(self, warehouse: Warehouse, table: str, source: DataFrame, as_of: str) -> DataFrame:
        warehouse.recover(table)
        if not warehouse.exists(table):
            first = self.first(source, as_of).withColumn("version_set", F.lit("open"))
            warehouse.replace(table, first, ["version_set"])
            return warehouse.read(table).drop("version_set")
        self._mend(warehouse, table)
        history = warehouse.read(table)
        closed_set = "closed-" + as_of.replace(" ", "T").replace(":", "")
        rows = self.versions(history.where("version_set = 'open'").drop("version_set"), source, as_of)
        rows = rows.withColumn("version_set", F.when(self._is_current(rows), "open").otherwise(closed_set))
        if set(rows.columns) != set(history.columns):
            rest = history.where("version_set <> 'open'")
            warehouse.replace(table, rest.unionByName(rows, allowMissingColumns=True), ["version_set"])
        else:
            all_closed = self.hard_deletes == "invalidate" and source.isEmpty()
            # Closings go first: if the run breaks off between the two, the open versions are
            # as they were, and the note says which closings to undo.
            with warehouse.staged(rows) as ready:
                warehouse.note(table, closed_set)
                for part in (ready.where("version_set <> 'open'"), ready.where("version_set = 'open'")):
                    warehouse.overwrite_partitions(table, part, ["version_set"])
            if all_closed:
                warehouse.drop_partitions(table, "version_set", ["open"])
            warehouse.note(table, "")
        return warehouse.read(table).drop("version_set")
