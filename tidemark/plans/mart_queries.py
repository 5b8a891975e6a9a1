"""MART: the reporting tables, end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import stored, windows
from tidemark.operators.models import Context, run_model
from tidemark.plans import mart_sql, marts
from tidemark.plans.registry import query
from tidemark.sources.tables import Inputs
from tidemark.sources.warehouse import Warehouse

query("mart_1_daily_revenue", mart_sql.DAILY_REVENUE)(marts.daily_revenue)
query("mart_2_hourly_demand", mart_sql.HOURLY)(marts.hourly_demand)
query("mart_3_region_flows", mart_sql.FLOWS)(marts.region_flows)
query("mart_4_priority_mix", mart_sql.MIX)(marts.priority_mix)
query("mart_5_top_nations", mart_sql.TOP_NATIONS)(marts.top_nations)
query("mart_6_border_traffic", mart_sql.BORDER)(marts.border_traffic)


@query("mart_7_nation_dimension", mart_sql.NATION_DIMENSION)
def nation_dimension(inputs: Inputs) -> DataFrame:
    """The nation dimension, written under its contract."""
    house = Warehouse.scratch(inputs.spark, "dims")
    return marts.NATION_CONTRACT.write(house, "nations", marts.nation_dimension(inputs))


@query("mart_8_user_days", mart_sql.USER_DAYS)
def user_days(inputs: Inputs) -> DataFrame:
    """User-day totals in two steps: all but the last days, then from the newest stored day on."""
    house = Warehouse.scratch(inputs.spark, "rollups")
    events = inputs("events")
    early = events.where(F.col("ts") < F.lit("2024-01-20 15:00:00").cast("timestamp_ntz"))
    keys = ["event_date", "user_id"]
    stored.store_merge(house, "user_days", marts.user_days(early), keys, "event_date", strategy="delete+insert")
    # Whole days only: the newest stored day may be half full.
    newest = house.read("user_days").agg(F.max("event_date")).first()[0]
    late = marts.user_days(events.where(F.col("ts") >= F.lit(newest).cast("timestamp_ntz")))
    return stored.store_merge(house, "user_days", late, keys, "event_date", strategy="delete+insert")


@query("mart_9_zscores", mart_sql.ZSCORES)
def zscores(inputs: Inputs) -> DataFrame:
    """The z-scores as a Python model over the daily rollup."""

    def model(context: Context, spark) -> DataFrame:
        daily = context.ref("daily").select("event_date", "n_events", "total_value")
        return windows.zscores(daily, "total_value", "value_zscore", context.config["places"])

    context = Context({"daily": lambda: marts.daily_events(inputs)}, config={"places": 3}, this="daily_zscores")
    return run_model(model, context, inputs.spark, Warehouse.scratch(inputs.spark, "models"))


query("mart_10_busiest", mart_sql.BUSIEST)(marts.busiest)
