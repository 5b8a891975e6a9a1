"""CSV loads: typed files, seeds, and reloads that check before they replace."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.sampling import stride
from tidemark.sources.warehouse import Warehouse

# SQL type names a caller may use, with the Spark type of each.
SQL_TYPES = {
    "BOOLEAN": "boolean",
    "SMALLINT": "smallint",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "REAL": "float",
    "DOUBLE PRECISION": "double",
    "NUMERIC": "decimal(38,9)",
    "VARCHAR": "string",
    "TEXT": "string",
    "VARBINARY": "binary",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "TIMESTAMP WITH TIME ZONE": "timestamp",
}


def spark_type(sql_type: str) -> str:
    """The Spark type for a SQL type name; a length or precision is kept."""
    name, paren, rest = sql_type.strip().upper().partition("(")
    name = name.strip()
    if paren and name in ("NUMERIC", "DECIMAL"):
        return f"decimal({rest}"
    if name in ("VARCHAR", "CHARACTER VARYING", "CHAR", "CHARACTER") and paren:
        return "string"
    return SQL_TYPES.get(name, sql_type.lower())


def load_csv(
    spark: SparkSession,
    path: str,
    column_types: Mapping[str, str],
    timestamp_format: str = "yyyy-MM-dd HH:mm:ss",
    sample_every: int = 1,
    limit: int | None = None,
    row_number_column: str | None = None,
) -> DataFrame:
    """Read a CSV file (gzip too) with a header into typed columns.

    Only the listed columns are kept, in the listed order. A value that does not
    fit its type fails the read: of any row, or, where rows are sampled, of the
    rows that are kept, for plain and gzip files alike. An empty field is NULL and other text,
    'N/A' among it, stays text. ``row_number_column`` holds each row's 1-based
    position in the file, the same however the file is sampled. A quote inside
    a quoted field is doubled, as usual in CSV.

    A gzip file cannot be split, so one task decompresses it; the rows are
    spread out again before anything else happens to them.
    """
    header = spark.read.option("header", True).option("escape", '"').csv(path).columns
    missing = [c for c in column_types if c not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    schema = T.StructType(
        [T.StructField(c, T._parse_datatype_string(spark_type(column_types.get(c, "VARCHAR")))) for c in header]
    )
    options = {"header": True, "mode": "FAILFAST", "escape": '"', "enforceSchema": False}
    options |= {"timestampFormat": timestamp_format, "timestampNTZFormat": timestamp_format}
    kept = list(column_types)
    if sample_every == 1 and limit is None and row_number_column is None:
        return _spread(spark.read.schema(schema).options(**options).csv(path).select(*kept), path)
    # Which row a value stands in is known before it is parsed: only kept rows can fail.
    texts = spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in header])).options(**options).csv(path).select(*kept)
    row_id = row_number_column or "__row_id"
    one_split = path.endswith(".gz") and len(texts.inputFiles()) == 1
    sampled = stride(texts, sample_every, limit, row_id, one_split=one_split)
    typed = [_typed(f, timestamp_format) for f in schema if f.name in kept]
    order = ([row_number_column] if row_number_column else []) + kept
    return _spread(sampled.select(row_id, *typed).select(*order), path)


def _typed(field: T.StructField, timestamp_format: str) -> Column:
    """A text column as its type; an error for a value that does not fit."""
    text, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        value = F.try_to_timestamp(text, F.lit(timestamp_format)).cast(kind)
    elif isinstance(kind, T.BinaryType):
        return F.encode(text, "UTF-8").alias(field.name)
    else:
        value = text.try_cast(kind)
    wrong = F.raise_error(F.concat(F.lit(f"{field.name}: not of type {kind.simpleString()}: "), text))
    return F.when(text.isNotNull() & value.isNull(), wrong.cast(kind)).otherwise(value).alias(field.name)


def _spread(df: DataFrame, path: str) -> DataFrame:
    return df.hint("rebalance") if path.endswith(".gz") else df


def load_seed(
    spark: SparkSession, path: str, overrides: Mapping[str, str] | None = None, timestamp_format: str = "yyyy-MM-dd HH:mm:ss"
) -> DataFrame:
    """Read a lookup CSV with inferred types and per-column overrides.

    Whole numbers become BIGINT and numbers with decimals DOUBLE, whatever
    their size. Override columns are read as text and cast, so '007' can stay
    text.
    """
    overrides = dict(overrides or {})
    reader = spark.read.option("header", True).option("timestampFormat", timestamp_format)
    reader = reader.option("timestampNTZFormat", timestamp_format)
    reader = reader.option("escape", '"').option("inferSchema", True).option("preferDate", True)
    guessed = reader.csv(path).schema
    fields = []
    for field in guessed:
        kind = field.dataType
        if field.name in overrides:
            kind = T.StringType()
        elif isinstance(kind, T.IntegerType):
            kind = T.LongType()
        elif isinstance(kind, T.DecimalType):
            kind = T.DoubleType()
        elif isinstance(kind, T.TimestampType):
            kind = T.TimestampNTZType()
        fields.append(T.StructField(field.name, kind))
    rows = (
        spark.read.schema(T.StructType(fields))
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("escape", '"')
        .option("timestampFormat", timestamp_format)
        .option("timestampNTZFormat", timestamp_format)
        .csv(path)
    )
    return rows.select(
        *[
            F.col(f.name).cast(spark_type(overrides[f.name])).alias(f.name) if f.name in overrides else F.col(f.name)
            for f in fields
        ]
    )


def reload_seed(warehouse: Warehouse, table: str, rows: DataFrame, full_refresh: bool = False) -> None:
    """Replace a seed table's rows, checking the columns first.

    A column that the table lacks raises before anything is touched, so the
    old rows stay. A full refresh takes the new columns as they are. A table
    column that the new rows lack becomes NULL.
    """
    if full_refresh or not warehouse.exists(table):
        warehouse.replace(table, rows)
        return
    old = warehouse.read(table)
    unknown = [c for c in rows.columns if c not in old.columns]
    if unknown:
        raise ValueError(f"new columns in the seed of {table}: {', '.join(unknown)}. Only full_refresh changes a seed table's columns")
    fitted = [
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in old.schema
    ]
    warehouse.replace(table, rows.select(*fitted))
