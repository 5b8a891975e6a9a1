"""AGG: aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import numbers
from tidemark.operators import aggregates
from tidemark.plans import mart_sql, marts
from tidemark.plans.registry import REVENUE, mean, query, r, total
from tidemark.sources.tables import Inputs

query("agg_1_grouped_measures", mart_sql.DAILY_EVENTS)(marts.daily_events)
query("agg_2_having", mart_sql.FLOWS.replace(">= 25", ">= 2400"))(lambda inputs: marts.region_flows(inputs, 2400))


@query(
    "agg_3_count_distinct",
    f"""SELECT CAST(hour(ts) AS INTEGER) AS event_hour, count(DISTINCT CAST(ts AS DATE)) AS active_days,
        count(DISTINCT user_id) AS users,
        {r("CAST(count(*) AS DOUBLE) / count(DISTINCT CAST(ts AS DATE))", 1)} AS events_per_day FROM events GROUP BY 1""",
)
def count_distinct(inputs: Inputs) -> DataFrame:
    events = inputs("events").select(F.hour("ts").alias("event_hour"), F.to_date("ts").alias("day"), "user_id")
    return events.groupBy("event_hour").agg(
        F.count_distinct("day").alias("active_days"),
        F.count_distinct("user_id").alias("users"),
        numbers.ratio(F.count("*"), F.count_distinct("day"), 1).alias("events_per_day"),
    )


query("agg_4_computed_key", mart_sql.BORDER)(marts.border_traffic)
query("agg_5_hourly_profile", mart_sql.HOURLY)(marts.hourly_demand)


@query(
    "agg_6_ordered_list",
    """SELECT r_name AS region, string_agg(DISTINCT n_name, ', ' ORDER BY n_name) AS nations
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1""",
)
def ordered_list(inputs: Inputs) -> DataFrame:
    """The nations of each region that have customers, by name."""
    customers = marts.geography(inputs, "customer")
    named = customers.select(F.col("customer_region").alias("region"), F.col("customer_nation").alias("nation"))
    return aggregates.ordered_list(named, ["region"], "nation", ", ", "nations")


@query(
    "agg_7_bool_or_any_value",
    """SELECT d.lang, bool_or(l.toxic = 1) AS any_toxic, bool_and(l.quality = 1) AS all_good,
       min(d.source) AS some_source, any_value(d.lang) AS some_lang
       FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1""",
)
def bool_or_any_value(inputs: Inputs) -> DataFrame:
    """``any_value`` is free to choose; the smallest source keeps the result the same every time."""
    documents = inputs("documents").select("doc_id", "lang", "source")
    return (
        documents.join(inputs("labels"), "doc_id")
        .groupBy("lang")
        .agg(
            F.bool_or(F.col("toxic") == 1).alias("any_toxic"),
            F.bool_and(F.col("quality") == 1).alias("all_good"),
            F.min("source").alias("some_source"),
            F.any_value("lang").alias("some_lang"),
        )
    )


GROUPINGS = f"""SELECT customer_region, segment, CAST(grouping(customer_region, segment) AS BIGINT) AS grouping_id,
  count(*) AS lines, CAST(sum(revenue) AS DOUBLE) AS revenue FROM ({mart_sql.ENRICHED})"""


def _revenue():
    return [F.count("*").alias("lines"), marts.revenue().cast("double").alias("revenue")]


@query("agg_8_grouping_sets", f"{GROUPINGS} GROUP BY GROUPING SETS ((customer_region, segment), (segment), ())")
def grouping_sets(inputs: Inputs) -> DataFrame:
    lines = marts.enriched_lines(inputs, ("customer",))
    return aggregates.grouping_sets(lines, [["customer_region", "segment"], ["segment"], []], _revenue())


@query("agg_8_rollup", f"{GROUPINGS} GROUP BY ROLLUP (customer_region, segment)")
def rollup(inputs: Inputs) -> DataFrame:
    lines = marts.enriched_lines(inputs, ("customer",))
    return lines.rollup("customer_region", "segment").agg(F.grouping_id().alias("grouping_id"), *_revenue())


@query("agg_8_cube", f"{GROUPINGS} GROUP BY CUBE (customer_region, segment)")
def cube(inputs: Inputs) -> DataFrame:
    lines = marts.enriched_lines(inputs, ("customer",))
    return lines.cube("customer_region", "segment").agg(F.grouping_id().alias("grouping_id"), *_revenue())


@query(
    "agg_9_percentiles",
    f"""SELECT event_type, {r("quantile_cont(value, 0.5)", 6)} AS median_value,
        {r("quantile_cont(value, 0.9)", 6)} AS p90_value, quantile_disc(value, 0.25) AS q1_value,
        {r("stddev_samp(value)", 6)} AS sd_value, {r("var_pop(value)", 6)} AS var_value, min(top.mode_value) AS mode_value
        FROM events JOIN (SELECT event_type AS et, arg_min(value, (-n, value)) AS mode_value
          FROM (SELECT event_type, value, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1) top ON et = event_type
        GROUP BY event_type""",
)
def percentiles(inputs: Inputs) -> DataFrame:
    """Exact percentiles, mode and spread of the value per event type."""
    spread = [
        ("sd_value", numbers.rounded(F.stddev_samp("v"), 6)),
        ("var_value", numbers.rounded(F.var_pop("v"), 6)),
    ]
    found = aggregates.exact_percentiles(
        inputs("events"),
        ["event_type"],
        "value",
        {"median_value": 0.5, "p90_value": 0.9},
        {"q1_value": 0.25},
        measures=spread,
        mode="mode_value",
    )
    return found.withColumns({c: numbers.rounded(c, 6) for c in ("median_value", "p90_value")})


@query(
    "agg_10_filtered_aggregates",
    f"""SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS errors,
        count(*) FILTER (WHERE value > 100) AS large,
        CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'purchase') AS DOUBLE) AS purchase_value
        FROM events GROUP BY user_id""",
)
def filtered_aggregates(inputs: Inputs) -> DataFrame:
    bought = F.when(F.col("event_type") == "purchase", F.col("value"))
    return (
        inputs("events")
        .groupBy("user_id")
        .agg(
            F.count_if(F.col("event_type") == "error").alias("errors"),
            F.count_if(F.col("value") > 100).alias("large"),
            numbers.exact_sum(bought).alias("purchase_value"),
        )
    )


@query(
    "agg_11_order_free_sums",
    f"""SELECT l_returnflag, CAST(sum({REVENUE}) AS DOUBLE) AS revenue, {mean("l_extendedprice")} AS avg_price,
        {r("sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) * CAST(l_tax AS DECIMAL(4,2)))", 3)} AS off_tax,
        {r("sum(CAST(l_quantity AS DECIMAL(12,2)))", 3)} AS tiny_times_1e15, 'NaN' AS with_nan, '-Infinity' AS with_infinity,
        true AS same_when_shuffled FROM lineitem GROUP BY 1""",
)
def order_free_sums(inputs: Inputs) -> DataFrame:
    """The same doubles, bit for bit, however the rows are spread over tasks: declared decimals, and any doubles."""
    lines = inputs("lineitem").select("l_returnflag", "l_extendedprice", "l_discount", "l_tax", "l_quantity", "l_linenumber")
    declared = lines.groupBy("l_returnflag").agg(
        marts.revenue(marts.revenue_units(), marts.revenue_off()).cast("double").alias("revenue"),
        numbers.exact_avg("l_extendedprice").alias("avg_price"),
    )
    first = F.col("l_linenumber") == 1
    measures = {
        "price": F.col("l_extendedprice") * (1 - F.col("l_discount")),
        "off_tax": F.col("l_extendedprice") * F.col("l_discount") * F.col("l_tax"),
        "tiny": F.col("l_quantity") * 1e-15,
        "with_nan": F.when(first, float("nan")).otherwise(F.col("l_tax")),
        "with_infinity": F.when(first, float("-inf")).otherwise(F.col("l_tax")),
    }
    # By splits, dealt anew by values, and two splits at a time: no task takes a fixed share of the table.
    last = inputs("lineitem").select(F.spark_partition_id().alias("split")).agg(F.max("split").alias("split")).first()["split"] or 0
    spread = (lines, lines.repartition("l_extendedprice", "l_quantity", "l_linenumber"), lines.coalesce((last + 2) // 2))
    runs = [aggregates.exact_totals(df, ["l_returnflag"], measures).select("l_returnflag", F.struct(*measures).alias(f"run{i}")) for i, df in enumerate(spread)]
    out = declared.join(runs[0], "l_returnflag").join(runs[1], "l_returnflag").join(runs[2], "l_returnflag")
    return out.select(
        "l_returnflag",
        "revenue",
        "avg_price",
        numbers.rounded("run0.off_tax", 3).alias("off_tax"),
        numbers.rounded(F.col("run0.tiny") * 1e15, 3).alias("tiny_times_1e15"),
        *[F.col(f"run0.{c}").cast("string").alias(c) for c in ("with_nan", "with_infinity")],
        ((F.col("run0") == F.col("run1")) & (F.col("run0") == F.col("run2"))).alias("same_when_shuffled"),
    )


@query(
    "agg_12_distinct",
    f"""SELECT DISTINCT event_type, day_part, event_type AS event_type_again FROM ({mart_sql.STAGED_EVENTS})""",
)
def distinct(inputs: Inputs) -> DataFrame:
    events = marts.staged_events(inputs)
    return events.select("event_type", "day_part", F.col("event_type").alias("event_type_again")).distinct()


@query(
    "agg_13_distinct_on",
    """SELECT DISTINCT ON (user_id) user_id, event_id, ts, CASE WHEN event_type <> 'error' THEN event_type END AS event_type
       FROM events ORDER BY user_id, ts DESC, event_id DESC""",
)
def distinct_on(inputs: Inputs) -> DataFrame:
    """The latest event of each user, kept even where its type is NULL."""
    kind = F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type")
    events = inputs("events").select("user_id", "event_id", "ts", kind)
    return aggregates.first_per_key(events, ["user_id"], [F.col("ts"), F.col("event_id")])
