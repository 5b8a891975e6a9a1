"""The reporting tables, from staged facts to rollups.

Facts are order lines. Dimensions are joined left, so no line is lost, and each
mart asks only for the dimensions it uses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column as SqlColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates, numbers
from tidemark.functions.text import surrogate_key
from tidemark.operators import joins, windows
from tidemark.operators.contracts import Column, Contract
from tidemark.sources.tables import Inputs


# Fixed value: the decimals of a price after its discount.
REVENUE_SCALE = 4


def revenue_units():
    """Price after discount in ten-thousandths, exact."""
    return numbers.units("l_extendedprice") * (100 - numbers.units("l_discount"))


def revenue_off():
    """How far the factors of :func:`revenue_units` are from two decimals."""
    return F.greatest(numbers.deviation("l_extendedprice"), numbers.deviation("l_discount"))


def revenue(units: str | SqlColumn = "revenue_units", off: str | SqlColumn = "revenue_off"):
    """Total revenue, exact; an error if a factor held more decimals."""
    return numbers.refused(numbers.sum_units(units, REVENUE_SCALE), F.max(off), 2)


def with_geography(inputs: Inputs, df: DataFrame, nation_key: str, who: str) -> DataFrame:
    """Add the nation and region names of a nation key, and drop the key.

    The two lookups are joined one after the other, straight from their files:
    Spark knows the sizes of both and broadcasts them. Joined to each other
    first, their size would be a guess, and a far too high one.
    """
    df = joins.lookup(df, inputs("nation"), {nation_key: "n_nationkey"}, {"n_name": f"{who}_nation", "n_regionkey": "__region"})
    return joins.lookup(df, inputs("region"), {"__region": "r_regionkey"}, {"r_name": f"{who}_region"}).drop("__region", nation_key)


def unknown(df: DataFrame, *columns: str) -> DataFrame:
    """Put 'Unknown' where a lookup found nothing."""
    return df.withColumns({c: F.coalesce(c, F.lit(joins.UNKNOWN)) for c in columns})


def geography(inputs: Inputs, who: str) -> DataFrame:
    """Customers or suppliers with the names of their nation and region."""
    prefix, key = {"customer": ("c", "c_custkey"), "supplier": ("s", "s_suppkey")}[who]
    people = with_geography(inputs, inputs(who).select(key, f"{prefix}_nationkey"), f"{prefix}_nationkey", who)
    return unknown(people, f"{who}_nation", f"{who}_region")


def placed_orders(inputs: Inputs, dimensions: Sequence[str]) -> DataFrame:
    """Orders, with who placed them if the customer dimension is asked for."""
    orders = inputs("orders").select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("priority"), "o_orderdate")
    if "customer" not in dimensions:
        return orders
    take = {"c_nationkey": "c_nationkey", "c_mktsegment": "segment"}
    orders = joins.lookup(orders, inputs("customer"), {"o_custkey": "c_custkey"}, take)
    return with_geography(inputs, orders, "c_nationkey", "customer")


def enriched_lines(inputs: Inputs, dimensions: Sequence[str] = ("order", "customer", "supplier", "part")) -> DataFrame:
    """Order lines with the dimensions asked for; missing names are 'Unknown'.

    Customers are joined to the orders, and the orders to the lines, so the
    lines, the largest table, are not shuffled for the customers. Suppliers and
    parts are broadcast for as long as their files are small.
    """
    names = []
    lines = inputs("lineitem").select(
        "*",
        F.to_date("l_shipdate").alias("ship_date"),
        revenue_units().alias("revenue_units"),
        revenue_off().alias("revenue_off"),
    )
    if "supplier" in dimensions:
        lines = joins.lookup(lines, inputs("supplier"), {"l_suppkey": "s_suppkey"}, {"s_nationkey": "s_nationkey"})
        lines = with_geography(inputs, lines, "s_nationkey", "supplier")
        names += ["supplier_nation", "supplier_region"]
    if "part" in dimensions:
        lines = joins.lookup(lines, inputs("part"), {"l_partkey": "p_partkey"}, {"p_brand": "brand"})
        names.append("brand")
    if "customer" in dimensions or "order" in dimensions:
        orders = placed_orders(inputs, dimensions)
        take = {c: c for c in orders.columns if c != "o_orderkey"}
        lines = joins.lookup(lines, orders, {"l_orderkey": "o_orderkey"}, take)
        names += [c for c in take if c in ("priority", "customer_nation", "customer_region", "segment")]
    return unknown(lines, *names)


def daily_revenue(inputs: Inputs) -> DataFrame:
    """Revenue per ship date with a 7-day average, the change in lines, and a rank."""
    off = F.when(F.col("l_discount") > 0, F.col("l_discount"))
    lines = inputs("lineitem").select(
        F.to_date("l_shipdate").alias("ship_date"),
        "l_quantity",
        "l_extendedprice",
        revenue_units().alias("revenue_units"),
        revenue_off().alias("revenue_off"),
        off.alias("off"),
    )
    daily = lines.groupBy("ship_date").agg(
        F.count("*").alias("lines"),
        numbers.exact_sum("l_quantity", 0).alias("quantity"),
        numbers.exact_sum("l_extendedprice").alias("gross_revenue"),
        F.round(revenue(), 2).cast("double").alias("total_revenue"),
        numbers.rounded(numbers.ratio(revenue(), F.count("*")), 2).alias("avg_revenue_per_line"),
        numbers.rounded(numbers.exact_avg("off"), 4).alias("avg_discount_given"),
        numbers.ratio(revenue(), numbers.exact_sum("l_quantity", 0), 2).alias("revenue_per_unit"),
    )
    return daily.select(
        "ship_date",
        dates.iso_weekday("ship_date").alias("iso_weekday"),
        *[c for c in daily.columns if c != "ship_date"],
        numbers.rounded(windows.rolling_avg("total_revenue", "ship_date", 7), 2).alias("revenue_7d_avg"),
        windows.change_from_previous("lines", "ship_date").alias("lines_vs_prev_day"),
        windows.rank_over_all(F.col("total_revenue").desc()).alias("revenue_rank"),
    )


def staged_events(inputs: Inputs) -> DataFrame:
    """Events with their date, hour, weekday and part of day."""
    return inputs("events").select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        F.to_date("ts").alias("event_date"),
        F.hour("ts").alias("event_hour"),
        dates.iso_weekday("ts").alias("iso_weekday"),
        dates.day_part("ts").alias("day_part"),
    )


def daily_events(inputs: Inputs) -> DataFrame:
    """Events per day: how many, their value, and value per event."""
    return (
        staged_events(inputs)
        .groupBy("event_date")
        .agg(
            F.min("iso_weekday").alias("iso_weekday"),
            F.count("*").alias("n_events"),
            numbers.exact_sum("value").alias("total_value"),
            numbers.rounded(numbers.exact_avg("value"), 2).alias("avg_value"),
            F.max("ts").alias("last_ts"),
        )
    )


def hourly_demand(inputs: Inputs) -> DataFrame:
    """The daily profile: events per active day, value and purchase value by hour."""
    bought = F.when(F.col("event_type") == "purchase", F.col("value"))
    return (
        staged_events(inputs)
        .withColumn("bought", bought)
        .groupBy("event_hour", "day_part")
        .agg(
            F.count("*").alias("n_events"),
            numbers.rounded(numbers.ratio(F.count("*"), F.count_distinct("event_date")), 1).alias("avg_events_per_day"),
            numbers.rounded(numbers.exact_avg("value"), 2).alias("avg_value"),
            numbers.rounded(numbers.exact_avg("bought"), 2).alias("avg_purchase"),
        )
    )


# Fixed value: flows with fewer lines than this are left out.
MIN_FLOW = 25


def region_flows(inputs: Inputs, least: int = MIN_FLOW) -> DataFrame:
    """Lines and revenue from customer region to supplier region."""
    lines = enriched_lines(inputs, ("customer", "supplier"))
    flows = (
        lines.groupBy("customer_region", "supplier_region")
        .agg(
            F.count("*").alias("lines"),
            numbers.rounded(numbers.exact_avg("l_quantity", 0), 2).alias("avg_quantity"),
            numbers.rounded(numbers.ratio(revenue(), F.count("*")), 2).alias("avg_revenue"),
            F.round(revenue(), 2).cast("double").alias("total_revenue"),
        )
        .where(F.col("lines") >= least)
    )
    return flows.select(surrogate_key("customer_region", "supplier_region").alias("flow_key"), "*")


def priority_mix(inputs: Inputs) -> DataFrame:
    """Orders by priority and their share of all orders."""
    mix = (
        inputs("orders")
        .groupBy("o_orderpriority")
        .agg(
            F.count("*").alias("n_orders"),
            numbers.rounded(numbers.exact_avg("o_totalprice"), 2).alias("avg_price"),
            numbers.exact_sum("o_totalprice").alias("total_price"),
        )
    )
    return windows.share_of_total(mix, "n_orders", "pct_of_orders")


def top_nations(inputs: Inputs, k: int = 3) -> DataFrame:
    """The busiest customer nations of each region.

    Orders are folded to one row per customer before they meet the customers,
    so a customer with a third of all orders is one row.
    """
    per_customer = inputs("orders").groupBy("o_custkey").agg(
        F.count("*").alias("n"), numbers.exact_sum("o_totalprice").alias("price")
    )
    named = joins.lookup(
        per_customer,
        geography(inputs, "customer"),
        {"o_custkey": "c_custkey"},
        {"customer_nation": "nation", "customer_region": "region"},
        {"nation": joins.UNKNOWN, "region": joins.UNKNOWN},
    )
    counts = (
        named.where(~F.col("region").isin(joins.UNKNOWN, "N/A"))
        .groupBy("region", "nation")
        .agg(F.sum("n").alias("n_orders"), numbers.exact_sum("price").alias("total_price"))
    )
    return windows.top_ranked(counts, ["region"], [F.col("n_orders").desc()], k, "region_rank")


def border_traffic(inputs: Inputs) -> DataFrame:
    """Lines by direction: within a nation, within a region, across regions, or unknown where either end is."""
    lines = enriched_lines(inputs, ("customer", "supplier"))
    direction = (
        F.when((F.col("customer_nation") == joins.UNKNOWN) | (F.col("supplier_nation") == joins.UNKNOWN), "unknown")
        .when(F.col("customer_nation") == F.col("supplier_nation"), "domestic")
        .when(F.col("customer_region") == F.col("supplier_region"), "same region")
        .otherwise("cross region")
    )
    return (
        lines.withColumn("direction", direction)
        .groupBy("customer_region", "direction")
        .agg(
            F.count("*").alias("lines"),
            numbers.rounded(numbers.exact_avg("l_quantity", 0), 2).alias("avg_quantity"),
            numbers.rounded(numbers.exact_avg("l_extendedprice"), 2).alias("avg_price"),
            numbers.rounded(numbers.ratio(revenue(), F.count("*")), 2).alias("avg_revenue"),
        )
    )


NATION_CONTRACT = Contract(
    columns=[
        Column("nation_id", "INTEGER", not_null=True),
        Column("nation", "VARCHAR"),
        Column("region", "VARCHAR"),
        Column("is_first", "BOOLEAN"),
        Column("orders_placed", "BIGINT", not_null=True, checks=["orders_placed >= 0"]),
        Column("lines_supplied", "BIGINT", not_null=True, checks=["lines_supplied >= 0"]),
        Column("revenue_supplied", "DOUBLE PRECISION"),
    ],
    primary_key=["nation_id"],
)


def nation_dimension(inputs: Inputs) -> DataFrame:
    """Nations with the orders they place and the lines they supply.

    Each fact table is folded to one row per customer or supplier before it
    meets a dimension, then to one row per nation.
    """
    placed = inputs("orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    placed = placed.join(inputs("customer"), F.col("o_custkey") == F.col("c_custkey"))
    placed = placed.groupBy("c_nationkey").agg(F.sum("n").alias("orders_placed"))
    supplied = inputs("lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"), revenue(revenue_units(), revenue_off()).alias("revenue"))
    supplied = supplied.join(inputs("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    supplied = supplied.groupBy("s_nationkey").agg(
        F.sum("n").alias("lines_supplied"), F.round(F.sum("revenue"), 2).cast("double").alias("revenue_supplied")
    )
    nations = joins.lookup(inputs("nation"), inputs("region"), {"n_regionkey": "r_regionkey"}, {"r_name": "region"})
    nations = nations.select(
        F.col("n_nationkey").alias("nation_id"),
        F.col("n_name").alias("nation"),
        "region",
        F.col("n_name").like("%\\_0").alias("is_first"),
    )
    return joins.with_activity(
        nations,
        "nation_id",
        {
            "orders_placed": (placed, "c_nationkey"),
            "lines_supplied": (supplied, "s_nationkey"),
            "revenue_supplied": (supplied, "s_nationkey"),
        },
    )


def user_days(events: DataFrame) -> DataFrame:
    """Events and value per user and day."""
    return (
        events.withColumn("event_date", F.to_date("ts"))
        .groupBy("event_date", "user_id")
        .agg(F.count("*").alias("n_events"), numbers.exact_sum("value").alias("total_value"))
    )


def daily_zscores(inputs: Inputs) -> DataFrame:
    """Each day's total value in standard deviations from the mean day."""
    daily = daily_events(inputs).select("event_date", "n_events", "total_value")
    return windows.zscores(daily, "total_value", "value_zscore")


def busiest(inputs: Inputs, least: int = 5, k: int = 20) -> DataFrame:
    """The busiest (event type, day part, user) combinations."""
    return (
        staged_events(inputs)
        .groupBy("event_type", "day_part", "user_id")
        .agg(F.count("*").alias("n_events"), numbers.rounded(numbers.exact_avg("value"), 2).alias("avg_value"))
        .where(F.col("n_events") >= least)
        .orderBy(F.col("n_events").desc(), "event_type", "day_part", "user_id")
        .limit(k)
    )
