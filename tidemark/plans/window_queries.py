"""WIN and SORT: window functions, ordering, top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import numbers
from tidemark.operators import windows
from tidemark.plans import mart_sql, marts
from tidemark.plans.registry import query, r
from tidemark.sources.tables import Inputs

DAILY = mart_sql.DAILY_EVENTS


@query(
    "win_1_rolling_average",
    f"""SELECT event_date, total_value,
        {r('''CAST(sum(CAST(total_value AS DECIMAL(38,2))) OVER w AS DOUBLE) / count(*) OVER w''', 2)} AS value_7d_avg
        FROM ({DAILY}) WINDOW w AS (ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
)
def rolling_average(inputs: Inputs) -> DataFrame:
    average = numbers.rounded(windows.rolling_avg("total_value", "event_date", 7), 2)
    return marts.daily_events(inputs).select("event_date", "total_value", average.alias("value_7d_avg"))


@query(
    "win_2_change_from_previous",
    f"SELECT event_date, n_events, n_events - lag(n_events) OVER (ORDER BY event_date) AS change FROM ({DAILY})",
)
def change_from_previous(inputs: Inputs) -> DataFrame:
    change = windows.change_from_previous("n_events", "event_date")
    return marts.daily_events(inputs).select("event_date", "n_events", change.alias("change"))


@query(
    "win_3_rank",
    f"SELECT event_date, n_events, CAST(rank() OVER (ORDER BY n_events DESC) AS INTEGER) AS day_rank FROM ({DAILY})",
)
def rank(inputs: Inputs) -> DataFrame:
    place = windows.rank_over_all(F.col("n_events").desc())
    return marts.daily_events(inputs).select("event_date", "n_events", place.alias("day_rank"))


query("win_4_top_per_group", mart_sql.TOP_NATIONS)(marts.top_nations)


@query(
    "win_5_share_of_total",
    f"""SELECT event_type, count(*) AS n_events,
        {r("count(*) * 100.0::DOUBLE / sum(count(*)) OVER ()", 2)} AS pct FROM events GROUP BY 1""",
)
def share_of_total(inputs: Inputs) -> DataFrame:
    mix = inputs("events").groupBy("event_type").agg(F.count("*").alias("n_events"))
    return windows.share_of_total(mix, "n_events", "pct")


query("win_6_zscore", mart_sql.ZSCORES)(marts.daily_zscores)

BIG = "CASE WHEN value >= 50 THEN value END"


@query(
    "win_7_ignore_nulls",
    f"""SELECT event_id, user_id, last_value({BIG} IGNORE NULLS) OVER
        (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_big
        FROM events""",
)
def ignore_nulls(inputs: Inputs) -> DataFrame:
    """The last large value that each user had at every event."""
    big = F.when(F.col("value") >= 50, F.col("value"))
    events = inputs("events").select("event_id", "user_id", "ts", big.alias("big"))
    bucket = windows.time_bucket(events, ["user_id"], "ts")
    filled = windows.fill_forward(events, ["user_id"], ["ts", "event_id"], bucket, "big", "last_big")
    return filled.select("event_id", "user_id", "last_big")


DEC = "CAST(total_value AS DECIMAL(38,2))"
NEAR = "ORDER BY event_date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING"
BY_WEEKDAY = "PARTITION BY iso_weekday ORDER BY n_events RANGE BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"


def _without(frame: str, what: str) -> str:
    over = f"OVER ({frame} EXCLUDE {what})"
    return r(f"CAST(sum({DEC}) {over} AS DOUBLE) / nullif(count(*) {over}, 0)", 2)


@query(
    "win_8_frame_exclude",
    f"""SELECT event_date, {_without(NEAR, "CURRENT ROW")} AS neighbours_avg,
        {_without(BY_WEEKDAY, "GROUP")} AS others_avg, {_without(BY_WEEKDAY, "TIES")} AS untied_avg FROM ({DAILY})""",
)
def frame_exclude(inputs: Inputs) -> DataFrame:
    """Averages of the neighbouring days, and of weekday rollups without ties."""
    near = Window.orderBy("event_date").rowsBetween(-3, 3)
    weekday = Window.partitionBy("iso_weekday").orderBy("n_events")
    whole = weekday.rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    peers = Window.partitionBy("iso_weekday", "n_events")
    averages = {
        "neighbours_avg": windows.avg_excluding_row("total_value", near),
        "others_avg": windows.avg_excluding_peers("total_value", whole, peers, keep_self=False),
        "untied_avg": windows.avg_excluding_peers("total_value", whole, peers, keep_self=True),
    }
    daily = marts.daily_events(inputs)
    return daily.select("event_date", *[numbers.rounded(c, 2).alias(n) for n, c in averages.items()])


@query(
    "win_9_row_number",
    """SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nth FROM events""",
)
def row_number(inputs: Inputs) -> DataFrame:
    events = inputs("events").select("event_id", "user_id", "ts")
    bucket = windows.time_bucket(events, ["user_id"], "ts")
    numbered = windows.numbered(events, ["user_id"], ["ts", "event_id"], bucket, "nth")
    return numbered.select("event_id", "user_id", "nth")


@query(
    "sort_1_multi_key",
    f"SELECT customer_region, supplier_region, lines FROM ({mart_sql.FLOWS}) ORDER BY lines DESC, 1, 2",
)
def multi_key_order(inputs: Inputs) -> DataFrame:
    flows = marts.region_flows(inputs).select("customer_region", "supplier_region", "lines")
    return flows.orderBy(F.col("lines").desc(), "customer_region", "supplier_region")


TOP_ORDERS = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20"


def _top_orders(inputs: Inputs) -> DataFrame:
    orders = inputs("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(20)


query("sort_2_top_n", TOP_ORDERS)(_top_orders)


@query("sort_3_preview", f"SELECT * FROM ({TOP_ORDERS}) ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def preview(inputs: Inputs) -> DataFrame:
    """A limit put around a query that has its own limit."""
    return _top_orders(inputs).limit(5)
