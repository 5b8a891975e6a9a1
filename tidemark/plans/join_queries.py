"""JOIN: lookups, dimensions, semi and anti joins, alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import numbers
from tidemark.operators import joins, staging
from tidemark.operators.aggregates import first_per_key
from tidemark.plans import mart_sql, marts
from tidemark.plans.registry import query, total
from tidemark.sources.tables import Inputs


@query(
    "join_1_lookup_default",
    """SELECT d.doc_id, d.lang, coalesce(CASE l.quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END, 'Unknown') AS quality
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def lookup_default(inputs: Inputs) -> DataFrame:
    name = F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    labels = inputs("labels").select("doc_id", name.alias("quality_name"))
    return joins.lookup(
        inputs("documents").select("doc_id", "lang"),
        labels,
        {"doc_id": "doc_id"},
        {"quality_name": "quality"},
        {"quality": joins.UNKNOWN},
    )


@query(
    "join_2_role_playing",
    f"""SELECT customer_nation, supplier_nation, count(*) AS lines
        FROM ({mart_sql.ENRICHED}) GROUP BY 1, 2""",
)
def role_playing(inputs: Inputs) -> DataFrame:
    """The nation table in two roles: the customer's and the supplier's."""
    lines = marts.enriched_lines(inputs, ("customer", "supplier"))
    return lines.groupBy("customer_nation", "supplier_nation").agg(F.count("*").alias("lines"))


@query(
    "join_3_star_join",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ship_date, CAST(revenue AS DOUBLE) AS revenue, priority,
        segment, customer_nation, customer_region, supplier_nation, supplier_region, brand FROM ({mart_sql.ENRICHED})""",
)
def star_join(inputs: Inputs) -> DataFrame:
    lines = marts.enriched_lines(inputs)
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "ship_date",
        (F.col("revenue_units") / 10_000.0).alias("revenue"),
        "priority",
        "segment",
        "customer_nation",
        "customer_region",
        "supplier_nation",
        "supplier_region",
        "brand",
    )


query("join_4_dimension_with_activity", mart_sql.NATION_DIMENSION)(marts.nation_dimension)


@query(
    "join_5_side_by_side_totals",
    f"""SELECT d.n AS daily_n, d.v AS daily_v, e.n AS detail_n, e.v AS detail_v
        FROM (SELECT CAST(sum(n_events) AS BIGINT) AS n, {total("total_value")} AS v FROM ({mart_sql.DAILY_EVENTS})) d,
             (SELECT count(*) AS n, {total("value")} AS v FROM events) e""",
)
def side_by_side_totals(inputs: Inputs) -> DataFrame:
    daily = marts.daily_events(inputs).agg(
        F.sum("n_events").alias("n"), numbers.exact_sum("total_value").alias("v")
    )
    detail = inputs("events").agg(F.count("*").alias("n"), numbers.exact_sum("value").alias("v"))
    return joins.side_by_side(daily=daily, detail=detail)


@query(
    "join_6_semi_join",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey IN
       (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')
       AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""",
)
def semi_join(inputs: Inputs) -> DataFrame:
    customers = inputs("customer").select("c_custkey", "c_name")
    urgent = inputs("orders").where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
    dear = inputs("orders").where("o_totalprice > 400000")
    with_urgent = staging.rows_in(customers, urgent, {"c_custkey": "o_custkey"})
    return staging.rows_in(with_urgent, dear, {"c_custkey": "o_custkey"})


@query(
    "join_7_anti_join",
    """SELECT d.doc_id, d.lang, d.source FROM documents d
       WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
)
def anti_join(inputs: Inputs) -> DataFrame:
    documents = inputs("documents").select("doc_id", "lang", "source")
    return staging.rows_not_in(documents, inputs("labels"), ["doc_id"])


@query(
    "join_8_natural_join",
    """SELECT custkey, orderkey, totalprice, mktsegment
       FROM (SELECT o_custkey AS custkey, o_orderkey AS orderkey, o_totalprice AS totalprice FROM orders)
       NATURAL JOIN (SELECT nullif(c_custkey, 0) AS custkey, c_mktsegment AS mktsegment FROM customer)""",
)
def natural_join(inputs: Inputs) -> DataFrame:
    """Joined on the shared column; the customer whose key is made NULL matches nothing."""
    orders = inputs("orders").select(
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderkey").alias("orderkey"),
        F.col("o_totalprice").alias("totalprice"),
    )
    customers = inputs("customer").select(
        F.nullif("c_custkey", F.lit(0)).alias("custkey"), F.col("c_mktsegment").alias("mktsegment")
    )
    return joins.natural(orders, customers)


@query(
    "join_9_lateral_top_row",
    """SELECT c_custkey, c_name, o.o_orderkey, o.o_orderdate, o.o_totalprice FROM customer,
       LATERAL (SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_custkey = c_custkey
                ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1) o""",
)
def lateral_top_row(inputs: Inputs) -> DataFrame:
    """The latest order of each customer: an aggregate, then a join on its key."""
    orders = inputs("orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    latest = first_per_key(orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])
    customers = inputs("customer").select("c_custkey", "c_name")
    return customers.join(latest, customers["c_custkey"] == latest["o_custkey"]).drop("o_custkey")


OLD = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'"
NEW = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS o_totalprice,
         o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'"""


@query(
    "join_10_full_outer_alignment",
    f"""SELECT o_orderkey, a.o_totalprice AS old_o_totalprice, b.o_totalprice AS new_o_totalprice,
        a.o_orderkey IS NOT NULL AS in_old, b.o_orderkey IS NOT NULL AS in_new,
        a.o_totalprice IS DISTINCT FROM b.o_totalprice AS changed
        FROM ({OLD}) a FULL OUTER JOIN ({NEW}) b USING (o_orderkey)""",
)
def full_outer_alignment(inputs: Inputs) -> DataFrame:
    """Two versions of the orders, one row per key."""
    orders = inputs("orders")
    old = orders.where(F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz"))
    new = orders.where(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")).withColumn(
        "o_totalprice", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    )
    aligned = joins.align(old, new, ["o_orderkey"], ["o_totalprice"])
    return aligned.withColumn("changed", joins.differs(["o_totalprice"]))


@query(
    "join_11_scalar_columns",
    """SELECT (SELECT count(*) FROM events) AS n_events, (SELECT max(ts) FROM events) AS last_event,
       (SELECT count(*) FROM orders) AS n_orders, (SELECT count(DISTINCT user_id) FROM events) AS n_users""",
)
def scalar_columns(inputs: Inputs) -> DataFrame:
    events, orders = inputs("events"), inputs("orders")
    one = inputs.spark.range(1)
    return one.select(
        events.agg(F.count("*")).scalar().alias("n_events"),
        events.agg(F.max("ts")).scalar().alias("last_event"),
        orders.agg(F.count("*")).scalar().alias("n_orders"),
        events.agg(F.count_distinct("user_id")).scalar().alias("n_users"),
    )
