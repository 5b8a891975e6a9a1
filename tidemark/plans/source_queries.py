"""SRC: scans, loads, samples and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import numbers
from tidemark.plans import marts
from tidemark.plans.mart_sql import DAILY_EVENTS
from tidemark.plans.registry import query, total
from tidemark.session import scratch_path
from tidemark.sources import csvload, sampling
from tidemark.sources.tables import Inputs, freshness, in_window
from tidemark.sources.warehouse import Warehouse

ORDER_TYPES = {
    "o_orderkey": "BIGINT",
    "o_custkey": "BIGINT",
    "o_totalprice": "DOUBLE PRECISION",
    "o_orderdate": "TIMESTAMP",
    "o_orderpriority": "VARCHAR",
}


def orders_csv(inputs: Inputs) -> str:
    """The orders as CSV files in a new scratch folder, in key order."""
    path = scratch_path(inputs.spark, "orders-csv")
    writer = inputs("orders").orderBy("o_orderkey").write.option("header", True)
    writer.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    return path


@query(
    "src_1_typed_csv_load",
    f"""SELECT o_orderpriority, count(*) AS n_orders, {total("o_totalprice")} AS total_price,
        min(o_orderdate) AS first_date, max(o_orderdate) AS last_date
        FROM orders GROUP BY o_orderpriority""",
)
def typed_csv_load(inputs: Inputs) -> DataFrame:
    orders = csvload.load_csv(inputs.spark, orders_csv(inputs), ORDER_TYPES)
    return orders.groupBy("o_orderpriority").agg(
        F.count("*").alias("n_orders"),
        numbers.exact_sum("o_totalprice").alias("total_price"),
        F.min("o_orderdate").alias("first_date"),
        F.max("o_orderdate").alias("last_date"),
    )


NUMBERED = "SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders"


@query("src_2_stride_sample", f"SELECT o_orderkey, o_totalprice FROM ({NUMBERED}) WHERE pos % 50 = 0")
def stride_sample(inputs: Inputs) -> DataFrame:
    orders = inputs("orders").select("o_orderkey", "o_totalprice")
    return sampling.every_nth(orders, ["o_orderkey"], 50)


@query(
    "src_3_capped_sample",
    f"SELECT o_orderkey, o_totalprice FROM ({NUMBERED}) WHERE pos % 50 = 0 ORDER BY o_orderkey LIMIT 100",
)
def capped_sample(inputs: Inputs) -> DataFrame:
    orders = inputs("orders").select("o_orderkey", "o_totalprice")
    return sampling.every_nth(orders, ["o_orderkey"], 50, limit=100)


@query(
    "src_4_stable_row_id",
    f"SELECT CAST(pos + 1 AS BIGINT) AS file_row, o_orderkey, o_orderdate FROM ({NUMBERED}) WHERE pos % 50 = 0",
)
def stable_row_id(inputs: Inputs) -> DataFrame:
    types = {c: ORDER_TYPES[c] for c in ("o_orderkey", "o_orderdate")}
    return csvload.load_csv(
        inputs.spark, orders_csv(inputs), types, sample_every=50, row_number_column="file_row"
    )


@query(
    "src_5_seed_load",
    """SELECT c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_acctbal, c_mktsegment
       FROM customer""",
)
def seed_load(inputs: Inputs) -> DataFrame:
    path = scratch_path(inputs.spark, "seed-csv")
    inputs("customer").write.option("header", True).csv(path)
    return csvload.load_seed(inputs.spark, path, {"c_nationkey": "VARCHAR"})


@query(
    "src_6_guarded_reload",
    "SELECT c_custkey, c_name, greatest(c_acctbal, 0) AS c_acctbal, true AS bad_reload_refused FROM customer",
)
def guarded_reload(inputs: Inputs) -> DataFrame:
    """A reload with an unknown column is refused; the next one replaces the rows."""
    house = Warehouse.scratch(inputs.spark, "seeds")
    rows = inputs("customer").select("c_custkey", "c_name", "c_acctbal")
    csvload.reload_seed(house, "customers", rows)
    refused = False
    try:
        csvload.reload_seed(house, "customers", rows.withColumn("c_rating", F.lit(1)))
    except ValueError:
        refused = house.read("customers").columns == rows.columns
    csvload.reload_seed(house, "customers", rows.withColumn("c_acctbal", F.greatest("c_acctbal", F.lit(0.0))))
    return house.read("customers").withColumn("bad_reload_refused", F.lit(refused))


@query(
    "src_7_pruned_scan",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, l_shipdate FROM lineitem
       WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-01-01'""",
)
def pruned_scan(inputs: Inputs) -> DataFrame:
    year = in_window(F.col("l_shipdate"), "1996-01-01", "1997-01-01")
    return inputs("lineitem").where(year).select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate")


@query(
    "src_8_freshness",
    """SELECT max(ts) AS max_loaded_at, TIMESTAMP '2024-02-01 00:00:00' AS as_of,
       CAST(floor(date_diff('microsecond', max(ts), TIMESTAMP '2024-02-01 00:00:00') / 1e6) AS BIGINT) AS age_seconds
       FROM events""",
)
def source_freshness(inputs: Inputs) -> DataFrame:
    return freshness(inputs("events"), "ts", "2024-02-01 00:00:00")


@query(
    "src_9_empty_mode",
    """SELECT count(DISTINCT CAST(ts AS DATE)) AS rows_full, CAST(0 AS BIGINT) AS rows_empty, true AS same_schema
       FROM events""",
)
def empty_mode(inputs: Inputs) -> DataFrame:
    """The daily rollup on the whole input, and on no rows with the same schema."""
    full = marts.daily_events(inputs)
    empty = marts.daily_events(Inputs(inputs.spark, inputs.folder, empty=True))
    same = full.schema == empty.schema
    none = empty.agg(F.count("*").alias("n")).scalar()
    return full.agg(F.count("*").alias("rows_full")).select(
        "rows_full", none.alias("rows_empty"), F.lit(same).alias("same_schema")
    )


SAMPLE = ("2024-01-10", "2024-01-13")


@query("src_10_sample_mode", DAILY_EVENTS.replace("FROM events", f"FROM events WHERE ts >= TIMESTAMP '{SAMPLE[0]}' AND ts < TIMESTAMP '{SAMPLE[1]}'"))
def sample_mode(inputs: Inputs) -> DataFrame:
    """The daily rollup with every input cut to three days."""
    return marts.daily_events(Inputs(inputs.spark, inputs.folder, sample=SAMPLE))


@query(
    "src_11_bulk_sink",
    """SELECT o_orderpriority, count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys, true AS second_create_refused
       FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'F') GROUP BY o_orderpriority""",
)
def bulk_sink(inputs: Inputs) -> DataFrame:
    """Create a table, append to it, and see a second create refused."""
    house = Warehouse.scratch(inputs.spark, "sink")
    orders = inputs("orders")
    house.create("orders", orders)
    house.append("orders", orders.where("o_orderstatus = 'F'"))
    try:
        house.create("orders", orders)
        refused = False
    except ValueError:
        refused = True
    counts = house.read("orders").groupBy("o_orderpriority").agg(
        F.count("*").alias("n_rows"), F.count_distinct("o_orderkey").alias("n_keys")
    )
    return counts.withColumn("second_create_refused", F.lit(refused))
