"""SET and GEN: set operations and row generators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates, numbers
from tidemark.operators import sets
from tidemark.plans.registry import query
from tidemark.sources.tables import Inputs


@query(
    "set_1_union_all",
    """SELECT 'customer' AS kind, c_custkey AS party_key, c_name AS name, c_acctbal AS balance FROM customer
       UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal FROM supplier""",
)
def union_all(inputs: Inputs) -> DataFrame:
    customers = inputs("customer").select(
        F.lit("customer").alias("kind"),
        F.col("c_custkey").alias("party_key"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
    )
    suppliers = inputs("supplier").select(
        F.col("s_acctbal").alias("balance"),
        F.col("s_name").alias("name"),
        F.col("s_suppkey").alias("party_key"),
        F.lit("supplier").alias("kind"),
    )
    return customers.unionByName(suppliers)


@query(
    "set_2_except",
    """SELECT c_custkey AS custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'""",
)
def except_(inputs: Inputs) -> DataFrame:
    finished = inputs("orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("custkey"))
    return inputs("customer").select(F.col("c_custkey").alias("custkey")).subtract(finished)


@query(
    "set_2_except_all",
    """SELECT c_nationkey AS nationkey FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier""",
)
def except_all(inputs: Inputs) -> DataFrame:
    suppliers = inputs("supplier").select(F.col("s_nationkey").alias("nationkey"))
    return inputs("customer").select(F.col("c_nationkey").alias("nationkey")).exceptAll(suppliers)


@query(
    "set_3_intersect",
    """SELECT n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
       INTERSECT SELECT n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def intersect(inputs: Inputs) -> DataFrame:
    nation = inputs("nation")
    customers = inputs("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name")
    suppliers = inputs("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("n_name")
    return customers.intersect(suppliers)


@query(
    "set_4_widening_union",
    """SELECT CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS at FROM orders UNION SELECT ts FROM events""",
)
def widening_union(inputs: Inputs) -> DataFrame:
    """Dates and timestamps in one column: a date is its midnight."""
    ordered = inputs("orders").select(F.to_date("o_orderdate").cast("timestamp_ntz").alias("at"))
    return ordered.union(inputs("events").select(F.col("ts").alias("at"))).distinct()


@query(
    "gen_1_date_spine",
    """SELECT CAST(d AS DATE) AS date_day, count(event_id) AS purchases
       FROM (SELECT unnest(generate_series(DATE '2023-12-25', DATE '2024-02-05' - 1, INTERVAL 1 DAY)) AS d)
       LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') ON CAST(ts AS DATE) = CAST(d AS DATE)
       GROUP BY 1""",
)
def date_spine(inputs: Inputs) -> DataFrame:
    """Purchases per day, with days that have none; the end date is left out."""
    spine = sets.date_spine(inputs.spark, "2023-12-25", "2024-02-05")
    daily = (
        inputs("events")
        .where("event_type = 'purchase'")
        .groupBy(F.to_date("ts").alias("date_day"))
        .agg(F.count("*").alias("purchases"))
    )
    return spine.join(daily, "date_day", "left").withColumn("purchases", F.coalesce("purchases", F.lit(0)))


@query(
    "gen_2_series",
    """SELECT CAST(n AS BIGINT) AS n, count(o_orderkey) AS n_orders FROM generate_series(1, 12) s(n)
       LEFT JOIN orders ON month(o_orderdate) = n GROUP BY 1""",
)
def series(inputs: Inputs) -> DataFrame:
    """Orders by month number over a generated 1..12."""
    monthly = inputs("orders").groupBy(F.month("o_orderdate").cast("bigint").alias("n")).agg(
        F.count("*").alias("n_orders")
    )
    months = sets.series(inputs.spark, 12)
    return months.join(monthly, "n", "left").withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))


@query(
    "gen_3_intervals_between",
    """SELECT l_orderkey, l_linenumber, l_shipdate, date_diff('day', o_orderdate, l_shipdate) AS days,
       date_diff('day', date_trunc('week', o_orderdate), date_trunc('week', l_shipdate)) // 7 AS weeks
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def intervals_between(inputs: Inputs) -> DataFrame:
    """Days and weeks from order to shipment; negative where shipped before."""
    lines = inputs("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = inputs("orders").select("o_orderkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey",
        "l_linenumber",
        "l_shipdate",
        dates.boundaries_between("day", "o_orderdate", "l_shipdate").alias("days"),
        dates.boundaries_between("week", "o_orderdate", "l_shipdate").alias("weeks"),
    )


@query(
    "gen_4_powers_of_two",
    """SELECT p_partkey, p_size, CAST(greatest(ceil(log2(p_size)), 1) AS INTEGER) AS bits FROM part""",
)
def powers_of_two(inputs: Inputs) -> DataFrame:
    return inputs("part").select("p_partkey", "p_size", numbers.powers_of_two("p_size").alias("bits"))


@query(
    "gen_5_recursive_query",
    """WITH RECURSIVE powers(n, p) AS (SELECT 0, CAST(1 AS BIGINT) UNION ALL
         SELECT n + 1, p * 2 FROM powers WHERE p * 2 <= (SELECT max(p_size) FROM part))
       SELECT n, p, count(p_partkey) AS parts FROM powers LEFT JOIN part ON p_size = p GROUP BY 1, 2""",
)
def recursive_query(inputs: Inputs) -> DataFrame:
    """Parts whose size is a power of two, from a recursive query up to the largest size."""
    sizes = inputs("part").groupBy("p_size").agg(F.count("*").alias("parts"))
    return inputs.spark.sql(
        """WITH RECURSIVE powers(n, p) AS (SELECT 0, 1L UNION ALL
             SELECT n + 1, p * 2 FROM powers WHERE p * 2 <= {limit})
           SELECT n, p, coalesce(parts, 0L) AS parts FROM powers LEFT JOIN {sizes} ON p_size = p""",
        sizes=sizes,
        limit=inputs("part").agg(F.max("p_size")).first()[0] or 0,
    )
