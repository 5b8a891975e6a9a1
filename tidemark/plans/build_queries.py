"""BLD: table states after builds and increments."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import numbers
from tidemark.operators import incremental, sets, stored
from tidemark.plans import mart_sql, marts
from tidemark.plans.registry import mean, query, r, total
from tidemark.sources.tables import Inputs
from tidemark.sources.warehouse import Warehouse


def ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


def days_of(events: DataFrame) -> tuple[date, date]:
    """The first day of the events and the day after their last; one day if there are none."""
    first, last = events.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    first, last = first or date(2024, 1, 1), last or date(2024, 1, 1)
    return first, last + timedelta(days=1)


def type_totals(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(
        F.count("*").alias("n_events"), numbers.exact_sum("value").alias("total_value")
    )


@query(
    "bld_1_view",
    f"SELECT event_type, count(*) AS n_events, {total('value')} AS total_value FROM events GROUP BY 1",
)
def view(inputs: Inputs) -> DataFrame:
    """A view over a table that grows after the view was made."""
    house = Warehouse.scratch(inputs.spark, "views")
    events = inputs("events")
    house.append("events", events.where("event_type <> 'error'"))
    seen = house.view(f"{house.database}_totals", type_totals(house.read("events")))
    house.append("events", events.where("event_type = 'error'"))
    return seen.sparkSession.table(f"{house.database}_totals")


@query(
    "bld_2_stage_and_swap",
    f"SELECT event_date, n_events, total_value, true AS failed_build_kept_rows FROM ({mart_sql.DAILY_EVENTS})",
)
def stage_and_swap(inputs: Inputs) -> DataFrame:
    """A first build, a rebuild, and a build that fails and changes nothing."""
    house = Warehouse.scratch(inputs.spark, "swap")
    daily = marts.daily_events(inputs).select("event_date", "n_events", "total_value")
    house.replace("daily", daily.where("n_events > 300"))
    house.replace("daily", daily)
    bad = F.when(F.col("n_events") > 0, F.raise_error(F.lit("bad row")).cast("bigint"))
    try:
        house.replace("daily", daily.withColumn("n_events", bad))
        failed = False
    except PySparkException:
        failed = True
    return house.read("daily").withColumn("failed_build_kept_rows", F.lit(failed))


@query("bld_3_append", "SELECT event_id, user_id, event_type, value FROM events")
def append(inputs: Inputs) -> DataFrame:
    house = Warehouse.scratch(inputs.spark, "append")
    events = inputs("events")
    for half in (F.col("ts") < ts("2024-01-16"), F.col("ts") >= ts("2024-01-16")):
        house.append("events", events.where(half).select("event_id", "user_id", "event_type", "value"))
    return house.read("events")


@query("bld_4_delete_insert", mart_sql.USER_DAYS)
def delete_insert(inputs: Inputs) -> DataFrame:
    """User-day totals on a composite key; the second batch runs twice and adds nothing."""
    house = Warehouse.scratch(inputs.spark, "delete_insert")
    events = inputs("events")
    first = marts.user_days(events.where(F.col("ts") < ts("2024-01-20 12:00:00")))
    second = marts.user_days(events.where(F.col("ts") >= ts("2024-01-20")))
    for batch in (first, second, second):
        stored.store_merge(
            house, "user_days", batch, ["event_date", "user_id"], "event_date", strategy="delete+insert"
        )
    return house.read("user_days")


ORDERS = "o_orderkey, o_totalprice, o_orderstatus, o_orderpriority"


def order_rows(inputs: Inputs) -> DataFrame:
    return inputs("orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("order_year")
    )


def late_orders(inputs: Inputs) -> DataFrame:
    """A batch of corrections: dearer, not urgent any more, and some without a status."""
    return (
        order_rows(inputs)
        .where("order_year >= 2000")
        .withColumn("o_totalprice", numbers.rounded(F.col("o_totalprice") + 100, 2))
        .withColumn("o_orderstatus", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))
        .withColumn("o_orderpriority", F.lit("0-LATE"))
    )


EARLY_SQL = "SELECT *, year(o_orderdate) AS y FROM orders WHERE year(o_orderdate) <= 2000"
LATE_SQL = f"""SELECT o_orderkey, {r("o_totalprice + 100", 2)} AS o_totalprice,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus, '0-LATE' AS o_orderpriority,
  year(o_orderdate) AS y FROM orders WHERE year(o_orderdate) >= 2000"""


@query(
    "bld_5_merge",
    f"""SELECT {ORDERS} FROM ({EARLY_SQL}) WHERE y < 2000 UNION ALL SELECT {ORDERS} FROM ({LATE_SQL})""",
)
def merge(inputs: Inputs) -> DataFrame:
    """A stored table, partitioned by year; the batch is merged twice."""
    house = Warehouse.scratch(inputs.spark, "merge")
    stored.store_merge(house, "orders", order_rows(inputs).where("order_year <= 2000"), ["o_orderkey"], "order_year")
    for _ in range(2):
        stored.store_merge(house, "orders", late_orders(inputs), ["o_orderkey"], "order_year")
    return house.read("orders").drop("order_year")


@query(
    "bld_6_merge_excluding_columns",
    f"""SELECT {ORDERS} FROM ({EARLY_SQL}) WHERE y < 2000
        UNION ALL SELECT b.o_orderkey, b.o_totalprice, b.o_orderstatus, coalesce(a.o_orderpriority, b.o_orderpriority)
        FROM ({LATE_SQL}) b LEFT JOIN ({EARLY_SQL}) a USING (o_orderkey)""",
)
def merge_excluding(inputs: Inputs) -> DataFrame:
    """Matched rows keep their old priority."""
    old = order_rows(inputs).where("order_year <= 2000")
    merged = incremental.merge(old, late_orders(inputs), ["o_orderkey"], exclude=["o_orderpriority"])
    return merged.drop("order_year")


# After the first run, the batch's own rows are closed too if they fail the predicate: the second run adds them once more.
OPEN = "order_year = 2000 AND o_totalprice < 250000"


@query(
    "bld_7_merge_with_predicate",
    f"""SELECT {ORDERS} FROM ({EARLY_SQL}) WHERE NOT (y = 2000 AND o_totalprice < 250000)
        UNION ALL SELECT {ORDERS} FROM ({LATE_SQL})
        UNION ALL SELECT {ORDERS} FROM ({LATE_SQL}) WHERE NOT (y = 2000 AND o_totalprice < 250000)""",
)
def merge_with_predicate(inputs: Inputs) -> DataFrame:
    """A stored merge, twice: only cheap orders of the last year may be replaced; others stay beside the new rows."""
    house = Warehouse.scratch(inputs.spark, "predicate")
    step = stored.Increment("order_year", ["o_orderkey"], "merge", predicate=OPEN)
    for batch in (order_rows(inputs).where("order_year <= 2000"), late_orders(inputs), late_orders(inputs)):
        step.run(house, "orders", batch)
    return house.read("orders").drop("order_year")


@query("bld_8_lookback", "SELECT event_id, ts, event_type, value, CAST(ts AS DATE) AS event_date FROM events")
def lookback(inputs: Inputs) -> DataFrame:
    """Late rows from the last hours before a cut arrive with the next increment."""
    house = Warehouse.scratch(inputs.spark, "lookback")
    source = inputs("events").select("event_id", "ts", "event_type", "value", F.to_date("ts").alias("event_date"))
    cut, hours = "2024-01-15 12:00:00", 6
    late = (F.col("ts") >= ts("2024-01-15 07:00:00")) & (F.col("event_type") == "error")
    stored.store_merge(house, "facts", source.where((F.col("ts") < ts(cut)) & ~late), ["event_id"], "event_date")
    for _ in range(2):
        batch = stored.lookback(house, "facts", source, "ts", hours, "event_date")
        stored.store_merge(house, "facts", batch, ["event_id"], "event_date")
    return house.read("facts")


@query(
    "bld_9_microbatch",
    """SELECT event_id, ts, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-02' THEN 0 ELSE value END AS value,
       true AS refused_without_window FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-03'""",
)
def microbatch(inputs: Inputs) -> DataFrame:
    """Daily windows; two of them run again from a corrected source that has no 3 January."""
    house = Warehouse.scratch(inputs.spark, "microbatch")
    source = inputs("events").select("event_id", "ts", "value")
    first, end = map(str, days_of(source))
    stored.store_windows(house, "facts", source, "ts", first, end, begin=first)
    fixed = source.where(F.to_date("ts") != F.lit("2024-01-03").cast("date")).withColumn(
        "value", F.when(F.to_date("ts") == F.lit("2024-01-02").cast("date"), 0.0).otherwise(F.col("value"))
    )
    stored.store_windows(house, "facts", fixed, "ts", "2024-01-03", "2024-01-04", lookback=1)
    try:
        stored.store_windows(house, "facts", source, "ts", None, None)
        refused = False
    except ValueError:
        refused = True
    return house.read("facts").drop("batch_start").withColumn("refused_without_window", F.lit(refused))


@query(
    "bld_10_schema_change",
    """SELECT event_id, event_type, CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN user_id END AS user_id,
       CASE WHEN ts < TIMESTAMP '2024-01-16' THEN value END AS value, 'event_id,event_type,value,event_date' AS columns_ignoring,
       'event_id,event_type,user_id,event_date' AS columns_syncing, true AS fail_raised FROM events""",
)
def schema_change(inputs: Inputs) -> DataFrame:
    """Stored tables whose batch gains ``user_id`` and loses ``value``: appended (twice), ignored, synced, refused."""
    house = Warehouse.scratch(inputs.spark, "columns")
    events = inputs("events").withColumn("event_date", F.to_date("ts"))
    old = events.where(F.col("ts") < ts("2024-01-16")).select("event_id", "event_type", "value", "event_date")
    new = events.where(F.col("ts") >= ts("2024-01-16")).select("event_id", "event_type", "user_id", "event_date")

    def run(policy: str, batches: list[DataFrame]) -> DataFrame:
        for batch in batches:
            stored.Increment("event_date", ["event_id"], "merge", on_schema_change=policy).run(house, policy, batch)
        return house.read(policy)

    ignoring, syncing = (",".join(run(policy, [old, new]).columns) for policy in ("ignore", "sync_all_columns"))
    try:
        run("fail", [old, new])
        raised = False
    except incremental.SchemaChange:
        raised = True
    return run("append_new_columns", [old, new, new]).drop("event_date").select(
        "*", F.lit(ignoring).alias("columns_ignoring"), F.lit(syncing).alias("columns_syncing"), F.lit(raised).alias("fail_raised")
    )


@query(
    "bld_11_full_refresh",
    f"""SELECT count(*) AS n_full, count(*) AS n_incremental, CAST(0 AS BIGINT) AS n_different FROM ({mart_sql.USER_DAYS})""",
)
def full_refresh(inputs: Inputs) -> DataFrame:
    """Incremental batches and a rebuild from scratch hold the same rows."""
    house = Warehouse.scratch(inputs.spark, "refresh")
    events, keys = inputs("events"), ["event_date", "user_id"]
    first, last = days_of(events)
    cuts = [first, *(first + (last - first) * i // 3 for i in (1, 2)), last]
    for start, end in zip(cuts, cuts[1:]):
        if start == end:
            continue
        part = events.where((F.col("ts") >= ts(str(start))) & (F.col("ts") < ts(str(end))))
        stored.store_merge(house, "steps", marts.user_days(part), keys, "event_date", strategy="delete+insert")
    full, steps = house.replace("full", marts.user_days(events)), house.read("steps")
    different = sets.bag_difference(full, steps.select(*full.columns))
    return full.agg(F.count("*").alias("n_full")).select(
        "n_full",
        steps.agg(F.count("*")).scalar().alias("n_incremental"),
        different.agg(F.count("*")).scalar().alias("n_different"),
    )


@query(
    "bld_12_mutations",
    f"""SELECT p_partkey, CASE WHEN p_brand = 'Brand#1' THEN 'Brand#01' ELSE p_brand END AS p_brand, p_size,
        CASE WHEN l_partkey IS NOT NULL THEN avg_price ELSE p_retailprice END AS p_retailprice
        FROM part LEFT JOIN (SELECT l_partkey, {r(mean("l_extendedprice"), 2)} AS avg_price FROM lineitem
          WHERE l_returnflag = 'R' GROUP BY 1) ON p_partkey = l_partkey
        WHERE NOT (p_size >= 45) AND p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)""",
)
def mutations(inputs: Inputs) -> DataFrame:
    """Update, delete, update from and delete using on a stored table; each rewrites what it touches."""
    house = Warehouse.scratch(inputs.spark, "mutations")
    house.replace("part", inputs("part").select("p_partkey", "p_brand", "p_size", "p_retailprice"), ["p_size"])
    lines = inputs("lineitem").withColumnRenamed("l_partkey", "p_partkey")
    returned = lines.where("l_returnflag = 'R'").groupBy("p_partkey")
    prices = returned.agg(numbers.rounded(numbers.exact_avg("l_extendedprice"), 2).alias("p_retailprice"))
    # Whole partitions go first: nothing else is read or written for them.
    stored.delete_rows(house, "part", "p_size", "p_size >= 45")
    stored.delete_rows_using(house, "part", "p_size", lines.where("l_quantity = 50"), ["p_partkey"])
    stored.update_rows(house, "part", "p_size", "p_brand = 'Brand#1'", {"p_brand": F.lit("Brand#01")})
    stored.update_rows_from(house, "part", "p_size", prices, ["p_partkey"], ["p_retailprice"])
    return house.read("part")


@query(
    "bld_13_change_report",
    f"""SELECT CASE WHEN a.o_orderkey IS NULL THEN 'insert' WHEN b.o_orderkey IS NULL THEN 'keep'
        WHEN (a.o_totalprice, a.o_orderstatus, a.o_orderpriority) IS DISTINCT FROM
             (b.o_totalprice, b.o_orderstatus, b.o_orderpriority) THEN 'update' ELSE 'keep' END AS action,
        count(*) AS n_rows FROM ({EARLY_SQL}) a FULL OUTER JOIN ({LATE_SQL}) b USING (o_orderkey) GROUP BY 1""",
)
def change_report(inputs: Inputs) -> DataFrame:
    """What a merge into a stored table would do, from the batch's side."""
    house = Warehouse.scratch(inputs.spark, "report")
    house.replace("orders", order_rows(inputs).where("order_year <= 2000"), ["order_year"])
    return stored.change_counts(house, "orders", late_orders(inputs), ["o_orderkey"], "order_year")


@query(
    "bld_14_composed_increments",
    f"SELECT CAST(ts AS DATE) AS event_date, count(*) AS n_events, {total('value')} AS total_value FROM events GROUP BY 1",
)
def composed_increments(inputs: Inputs) -> DataFrame:
    """Facts merged with a lookback, then the days they touched rolled up again."""
    house = Warehouse.scratch(inputs.spark, "composed")
    source = inputs("events").select("event_id", "ts", "value", F.to_date("ts").alias("event_date"))
    late = (F.col("ts") >= ts("2024-01-14 20:00:00")) & (F.col("value") > 100)

    def rollup(facts: DataFrame) -> DataFrame:
        return facts.groupBy("event_date").agg(
            F.count("*").alias("n_events"), numbers.exact_sum("value").alias("total_value")
        )

    step = stored.Increment("event_date", ["event_id"], "merge")
    for batch_of in (
        lambda: source.where((F.col("ts") < ts("2024-01-15 01:00:00")) & ~late),
        lambda: stored.lookback(house, "facts", source, "ts", 6, "event_date"),
    ):
        touched = step.run(house, "facts", batch_of())
        stored.store_rollup(house, "daily", house.read("facts"), rollup, "event_date", touched)
    return house.read("daily")
