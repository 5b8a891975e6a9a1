"""Table scans and the switches that apply to every input of a pipeline."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import elapsed

# The columns of the given tables. Stating them saves the footer
# read that schema inference costs on every scan.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def scan(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The parquet table ``name``. Projection and filters reach the scan."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


@dataclass(frozen=True)
class Inputs:
    """How a pipeline reads its tables.

    ``empty`` gives every input no rows but its full schema. ``sample`` is a
    half-open event-time range, put on every input listed in ``event_times``.
    """

    spark: SparkSession
    folder: str
    empty: bool = False
    sample: tuple[str, str] | None = None
    event_times: tuple[tuple[str, str], ...] = (("events", "ts"), ("orders", "o_orderdate"), ("lineitem", "l_shipdate"))

    def __call__(self, name: str) -> DataFrame:
        df = scan(self.spark, self.folder, name)
        if self.empty:
            return df.limit(0)
        column = dict(self.event_times).get(name)
        if self.sample and column:
            return df.where(in_window(F.col(column), *self.sample))
        return df


def in_window(column: Column, start: str, end: str) -> Column:
    """``start <= column < end`` for zone-less timestamps; reaches the scan as a filter."""
    kind = "timestamp_ntz"
    return (column >= F.lit(start).cast(kind)) & (column < F.lit(end).cast(kind))


def freshness(df: DataFrame, column: str, as_of: str) -> DataFrame:
    """The newest event time and its age in seconds at ``as_of``."""
    instant = F.lit(as_of).cast("timestamp_ntz")
    newest = df.agg(F.max(column).alias("max_loaded_at"))
    return newest.select(
        "max_loaded_at",
        instant.alias("as_of"),
        elapsed("second", "max_loaded_at", instant).alias("age_seconds"),
    )
