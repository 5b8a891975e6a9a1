"""Parquet tables in the session catalog, replaced by stage and swap.

Each build of a table goes to a folder of its own and becomes visible by
renaming catalog entries, which moves no data: cheap on object stores, and a
build that fails leaves the old table as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.session import scratch_path


class Warehouse:
    """A catalog database whose tables live below one shared folder."""

    def __init__(self, spark: SparkSession, database: str, location: str):
        self.spark = spark
        self.database = database
        self.location = location.rstrip("/")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.location}'")

    @classmethod
    def scratch(cls, spark: SparkSession, label: str = "work") -> Warehouse:
        """A new, empty warehouse in the session's scratch folder."""
        path = scratch_path(spark, label)
        return cls(spark, path.rsplit("/", 1)[1].replace("-", "_"), path)

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def fresh(self, table: str) -> DataFrame:
        """The table after another session, such as a stream's, has written it."""
        self.spark.catalog.refreshTable(self.name(table))
        return self.read(table)

    def view(self, name: str, df: DataFrame) -> DataFrame:
        """A lazily evaluated view: reading it runs the query on today's rows."""
        df.createOrReplaceTempView(name)
        return self.spark.table(name)

    def recover(self, table: str) -> None:
        """Finish or undo a swap that stopped between its two renames."""
        if not self.exists(table) and self.exists(f"{table}__backup"):
            self._rename(f"{table}__backup", table)

    def replace(self, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Build ``df`` beside the current table, then swap it in.

        The query may read the table it replaces. Partitioned tables are
        written after a REBALANCE on the partition columns: few files per
        partition, and a hot partition is still spread over many tasks.
        """
        self.recover(table)
        stage, backup = f"{table}__stage", f"{table}__backup"
        for leftover in (stage, backup):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(leftover)}")
        path = f"{self.location}/{table}/{uuid.uuid4().hex}"
        rows = df.hint("rebalance", *partition_by) if partition_by else df
        writer = rows.write.format("parquet").option("path", path)
        if partition_by:
            # Kept with the table: later overwrites touch only the partitions
            # that they write.
            writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
        writer.saveAsTable(self.name(stage))
        if self.exists(table):
            self._rename(table, backup)
        self._rename(stage, table)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(backup)}")
        return self.read(table)

    def fitted(self, table: str, df: DataFrame) -> DataFrame:
        """``df`` in the table's column order; a column that one of them lacks is an error."""
        columns = self.read(table).columns
        new, missing = [c for c in df.columns if c not in columns], [c for c in columns if c not in df.columns]
        if new or missing:
            raise ValueError(f"{table} and the rows differ in columns: new {new}, missing {missing}; fit_schema decides what to do")
        return df.select(*columns)

    def append(self, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Add rows to a table, creating it if it is new."""
        if not self.exists(table):
            return self.replace(table, df, partition_by)
        rows = df.hint("rebalance", *partition_by) if partition_by else df
        self.fitted(table, rows).write.mode("append").insertInto(self.name(table))
        return self.read(table)

    def create(self, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Like :meth:`replace`, but an existing table is an error."""
        if self.exists(table):
            raise ValueError(f"table {self.name(table)} already exists")
        return self.replace(table, df, partition_by)

    @contextmanager
    def staged(self, df: DataFrame) -> Iterator[DataFrame]:
        """``df`` written once and dropped at the end.

        For a batch that several steps read: it is computed once, all steps
        see the same rows, a lost executor costs no recomputation of its
        sources, and Spark knows its size when it plans the joins.
        """
        name = f"batch__{uuid.uuid4().hex}"
        df.write.format("parquet").saveAsTable(self.name(name))
        try:
            yield self.read(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(name)}")

    def vacuum(self, table: str) -> None:
        """Delete the files of superseded builds; call it when nobody reads them any more."""
        fs = self.spark._jvm.org.apache.hadoop.fs
        root = fs.Path(f"{self.location}/{table}")
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        current = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}").where("col_name = 'Location'")
        keep = current.first()["data_type"].rstrip("/").rsplit("/", 1)[1]
        for status in files.listStatus(root):
            if status.getPath().getName() != keep:
                files.delete(status.getPath(), True)

    def overwrite_partitions(self, table: str, df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
        """Replace exactly the partitions that ``df`` has rows for.

        The table must be partitioned, and ``df`` may read from it: Spark
        stages the new files and moves them in when the job is done.
        """
        if not self.exists(table):
            return self.replace(table, df, partition_by)
        ordered = self.fitted(table, df.hint("rebalance", *partition_by))
        ordered.write.mode("overwrite").insertInto(self.name(table))
        return self.read(table)

    def drop_partitions(self, table: str, column: str, values: Collection[object]) -> None:
        """Remove all rows of the given partitions, in one statement and without a job.

        Files go first: if this breaks off, the rows are gone and the next call removes the
        entries. Entries without files would only cost a listing; files without entries
        would come back with the next rows of that partition.
        """
        if not values:
            return
        held = self.read(table).where(one_of(F.col(column), values)).inputFiles()
        jvm = self.spark._jvm
        for folder in {f.rsplit("/", 1)[0] for f in held}:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        specs = ", ".join(f"PARTITION (`{column}` = {_literal(v)})" for v in values)
        self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS {specs}")
        self.spark.catalog.refreshTable(self.name(table))

    def partitions(self, table: str, column: str) -> DataFrame:
        """The values of a table's only partition column, from the catalog: no file is read."""
        kind = self.read(table).schema[column].dataType
        text = F.expr(f"url_decode(replace(substr(partition, {len(column) + 2}), '+', '%2B'))")
        known = self.spark.sql(f"SHOW PARTITIONS {self.name(table)}")
        return known.select(F.when(text != "__HIVE_DEFAULT_PARTITION__", text).cast(kind).alias(column))

    def ensure(self, table: str, schema: StructType, partition_by: Sequence[str]) -> None:
        """Create an empty table if there is none; runs side by side may all call it."""
        self.recover(table)
        if not self.exists(table):
            self._define(table, schema, partition_by, f"{self.location}/{table}/{uuid.uuid4().hex}")

    def add_columns(self, table: str, fields: Sequence[StructField]) -> None:
        """New columns, NULL in the rows there are; an entry in the catalog, no file is touched."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        self.spark.sql(f"ALTER TABLE {self.name(table)} ADD COLUMNS ({columns})")

    def note(self, table: str, text: str) -> None:
        """Keep a word about a table in the catalog, beside it; an empty one removes it.

        Readers of the table keep what they have listed: its own entry does not change.
        """
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}__note")
        if text:
            self.spark.sql(f"CREATE TABLE {self.name(table)}__note (note STRING) USING parquet TBLPROPERTIES ('note' = {_literal(text)})")

    def noted(self, table: str) -> str:
        """What :meth:`note` keeps; empty if nothing."""
        return self._property(f"{table}__note", "note") if self.exists(f"{table}__note") else ""

    def _property(self, table: str, key: str) -> str:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").where(F.col("key") == key).collect()
        return rows[0]["value"] if rows else ""

    def dropped_columns(self, table: str) -> set[str]:
        """Columns that files may still hold although the table has them no more."""
        return set(filter(None, self._property(table, "dropped_columns").split("\x1f")))

    def redefine(self, table: str, schema: StructType, partition_by: Sequence[str], dropped: set[str]) -> None:
        """The same files under other columns: some left out, some of a wider type.

        The new entry is made beside the old one and swapped in. Columns that are left out
        stay in the files, so their names are kept with the table.
        """
        stage, backup = f"{table}__stage", f"{table}__backup"
        for leftover in (stage, backup):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(leftover)}")
        known = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}").where("col_name = 'Location'")
        self._define(stage, schema, partition_by, known.first()["data_type"], self.dropped_columns(table) | dropped)
        self.spark.sql(f"ALTER TABLE {self.name(stage)} RECOVER PARTITIONS")
        self._rename(table, backup)
        self._rename(stage, table)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(backup)}")

    def _define(self, table: str, schema: StructType, partition_by: Sequence[str], location: str, dropped: Collection[str] = ()) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        by = ", ".join(f"`{c}`" for c in partition_by)
        gone = "\x1f".join(sorted(dropped))
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') "
            f"PARTITIONED BY ({by}) LOCATION '{location}' TBLPROPERTIES ('dropped_columns' = '{gone}')"
        )

    def _rename(self, old: str, new: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(old)} RENAME TO {self.name(new)}")


def _literal(value: object) -> str:
    """A partition value in SQL."""
    if value is None:
        return "NULL"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def one_of(column: Column, values: Collection[object]) -> Column:
    """Whether a partition column holds one of the values, NULL among them or not; it prunes the scan."""
    test = column.isin([v for v in values if v is not None])
    return test | column.isNull() if None in values else test
