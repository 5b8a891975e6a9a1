"""Column contracts: declared names, types and rules that a write must meet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quality import Check, is_null, relationships, unique_combination
from tidemark.sources.csvload import spark_type
from tidemark.sources.warehouse import Warehouse


class ContractBroken(ValueError):
    """The columns of a DataFrame are not those of its contract."""


@dataclass(frozen=True)
class Column:
    """One column: its SQL type, whether NULL is refused, and CHECK expressions."""

    name: str
    type: str
    not_null: bool = False
    checks: Sequence[str] = ()


@dataclass(frozen=True)
class Contract:
    """The columns of a table, in order, and what else is declared of it.

    ``not_null`` and ``checks`` are enforced on every write. Keys are declared
    only; :meth:`tests` turns them into data tests.
    """

    columns: Sequence[Column]
    checks: Sequence[str] = ()
    primary_key: Sequence[str] = ()
    unique: Sequence[Sequence[str]] = ()
    foreign_keys: Sequence[tuple[str, str, str]] = field(default=())

    def tests(self, df: DataFrame, parents: Mapping[str, DataFrame]) -> list[Check]:
        """Data tests of the declared keys; ``parents`` has the tables that foreign keys name."""
        found = []
        if self.primary_key:
            found += [Check(f"not_null({c})", rule=is_null(c)) for c in self.primary_key]
            found.append(Check(f"primary_key({', '.join(self.primary_key)})", failures=unique_combination(df, self.primary_key)))
        for columns in self.unique:
            whole = df.dropna(how="any", subset=list(columns))  # as in SQL, NULLs are not compared
            found.append(Check(f"unique({', '.join(columns)})", failures=unique_combination(whole, columns)))
        for column, parent, parent_column in self.foreign_keys:
            found.append(Check(f"foreign_key({column})", failures=relationships(df, column, parents[parent], parent_column)))
        return found

    def mismatches(self, df: DataFrame) -> list[tuple[str, str | None, str | None, str]]:
        """(column, declared type, found type, reason) for every difference; reads no rows."""
        found = {f.name: f.dataType.simpleString() for f in df.schema}
        declared = {c.name: _simple(c.type) for c in self.columns}
        out = []
        for name in [*declared, *[n for n in found if n not in declared]]:
            want, have = declared.get(name), found.get(name)
            if want != have:
                reason = "missing in query" if have is None else "missing in contract" if want is None else "type differs"
                out.append((name, want, have, reason))
        return out

    def mismatch_rows(self, spark: SparkSession, df: DataFrame) -> DataFrame:
        """:meth:`mismatches` as a DataFrame; no rows means that the columns agree."""
        schema = "column_name string, declared_type string, found_type string, reason string"
        rows = [
            F.struct(*[F.lit(v).cast("string").alias(f.name) for v, f in zip(m, T._parse_datatype_string(schema))])
            for m in self.mismatches(df)
        ]
        if not rows:
            return spark.createDataFrame([], schema)
        return spark.range(1).select(F.inline(F.array(*rows)))

    def rules(self) -> list[tuple[str, str]]:
        """(label, condition) of all enforced rules. A NULL condition passes, as in SQL CHECK."""
        out = []
        for c in self.columns:
            if c.not_null:
                out.append((f"not_null({c.name})", f"`{c.name}` IS NOT NULL"))
            out += [(f"check({e})", e) for e in c.checks]
        return out + [(f"check({e})", e) for e in self.checks]

    def violations(self, df: DataFrame) -> DataFrame:
        """Rows that break each rule, counted in one scan."""
        rules = self.rules()
        counts = df.agg(*[F.count_if(~F.coalesce(F.expr(e), F.lit(True))).alias(f"r{i}") for i, (_, e) in enumerate(rules)])
        pairs = [F.struct(F.lit(label).alias("rule"), F.col(f"r{i}").alias("failures")) for i, (label, _) in enumerate(rules)]
        return counts.select(F.inline(F.array(*pairs)))

    def enforce(self, df: DataFrame) -> DataFrame:
        """Check the columns now, and guard the rows: a bad row fails the job that writes it.

        The guard is part of the projection, so it costs no pass of its own.
        """
        problems = self.mismatches(df)
        if problems:
            lines = "; ".join(f"{n}: declared {w}, found {h} ({why})" for n, w, h, why in problems)
            raise ContractBroken(lines)
        message = None
        for label, condition in self.rules():
            broken = ~F.coalesce(F.expr(condition), F.lit(True))
            text = F.lit(f"contract rule broken: {label}")
            message = F.when(broken, text) if message is None else message.when(broken, text)
        ordered = df.select(*[c.name for c in self.columns])
        if message is None:
            return ordered
        # One filter in front of all columns: it cannot be pruned away.
        return ordered.where(F.when(message.isNotNull(), F.raise_error(message).cast("boolean")).otherwise(True))

    def write(self, warehouse: Warehouse, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Replace a table under the contract; a broken rule leaves the old rows."""
        return warehouse.replace(table, self.enforce(df), partition_by)

    def append(self, warehouse: Warehouse, table: str, df: DataFrame) -> DataFrame:
        """Add rows under the contract; a broken rule adds none of them."""
        return warehouse.append(table, self.enforce(df))


def _simple(sql_type: str) -> str:
    return T._parse_datatype_string(spark_type(sql_type)).simpleString()
