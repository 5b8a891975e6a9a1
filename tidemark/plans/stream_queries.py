"""STR: streaming builds, run over everything that has landed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates, numbers
from tidemark.plans.registry import query, total
from tidemark.session import scratch_path
from tidemark.sources.tables import Inputs
from tidemark.sources.warehouse import Warehouse
from tidemark.streaming import jobs


def ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


def slices(inputs: Inputs) -> list[DataFrame]:
    """The events in three deliveries, each with parts of days and some late rows."""
    events = inputs("events")
    late = (F.col("ts") < ts("2024-01-06")) & (F.col("event_type") == "error")
    return [
        events.where((F.col("ts") < ts("2024-01-10 15:00:00")) & ~late),
        events.where((F.col("ts") >= ts("2024-01-10 15:00:00")) & (F.col("ts") < ts("2024-01-20 09:00:00"))),
        events.where((F.col("ts") >= ts("2024-01-20 09:00:00")) | late),
    ]


def deliver(inputs: Inputs, run) -> None:
    """Land the slices in a scratch folder, running ``run(stream, checkpoint)`` after each."""
    landing, checkpoint = scratch_path(inputs.spark, "landing"), scratch_path(inputs.spark, "checkpoint")
    session = jobs.stream_session(inputs.spark)
    schema = inputs("events").schema
    jobs.replay(slices(inputs), landing, lambda: run(jobs.file_stream(session, landing, schema), checkpoint))


@query(
    "str_1_streaming_upsert",
    """SELECT DISTINCT ON (user_id) user_id, event_id, ts, event_type, value FROM events
       ORDER BY user_id, ts DESC, event_id DESC""",
)
def streaming_upsert(inputs: Inputs) -> DataFrame:
    """The latest event of each user; late deliveries do not overwrite newer rows."""
    house = Warehouse.scratch(inputs.spark, "latest")

    def run(stream: DataFrame, checkpoint: str) -> None:
        rows = stream.select("user_id", "event_id", "ts", "event_type", "value")
        jobs.upsert_log(rows, house.database, house.location, "latest", ["user_id"], ["ts", "event_id"], checkpoint, fan=2)

    deliver(inputs, run)
    return jobs.latest(house, "latest", ["user_id"], ["ts", "event_id"])


@query(
    "str_2_streaming_day_rebuild",
    f"""SELECT CAST(ts AS DATE) AS event_date, event_type, count(*) AS n_events, {total("value")} AS total_value
        FROM events GROUP BY 1, 2""",
)
def streaming_day_rebuild(inputs: Inputs) -> DataFrame:
    """Day totals that stay right when a day arrives in parts and late."""
    house = Warehouse.scratch(inputs.spark, "days")

    def rollup(facts: DataFrame) -> DataFrame:
        return facts.groupBy("event_date", "event_type").agg(
            F.count("*").alias("n_events"), numbers.exact_sum("value").alias("total_value")
        )

    def run(stream: DataFrame, checkpoint: str) -> None:
        jobs.rebuild_days(
            stream, house.database, house.location, "landed", "totals", F.to_date("ts"), rollup, checkpoint
        )

    deliver(inputs, run)
    return house.fresh("totals")


DELAY = "6 hours"
CLOSED = "CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) <= (SELECT max(ts) - INTERVAL 6 HOUR FROM events)"


@query(
    "str_3_tumbling_totals",
    f"""SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS window_start, event_type, count(*) AS n_events,
        {total("value")} AS total_value FROM events WHERE {CLOSED} GROUP BY 1, 2""",
)
def tumbling_totals(inputs: Inputs) -> DataFrame:
    """Totals of all days that the watermark has closed, from a stream over the events table."""
    session = jobs.stream_session(inputs.spark)
    stream = jobs.file_stream(session, f"{inputs.folder}/events*.parquet", inputs("events").schema)
    totals = jobs.tumbling_totals(
        stream, "ts", DELAY, ["event_type"],
        [F.count("*").alias("n_events"), numbers.exact_sum("value").alias("total_value")],
    )
    out = scratch_path(inputs.spark, "totals")
    jobs.run_to_files(totals, scratch_path(inputs.spark, "checkpoint"), out)
    return inputs.spark.read.schema(totals.schema).parquet(out)


@query(
    "str_4_late_rows",
    f"""SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS window_start, count(*) AS n_landed,
        count(*) - count(*) FILTER (WHERE event_type = 'error' AND ts < TIMESTAMP '2024-01-06') AS n_streamed,
        count(*) FILTER (WHERE event_type = 'error' AND ts < TIMESTAMP '2024-01-06') AS n_late
        FROM events WHERE {CLOSED} GROUP BY 1""",
)
def late_rows(inputs: Inputs) -> DataFrame:
    """What a bounded lateness leaves out when errors of the first days come weeks late."""
    out = scratch_path(inputs.spark, "totals")
    schemas = []

    def run(stream: DataFrame, checkpoint: str) -> None:
        totals = jobs.tumbling_totals(stream, "ts", DELAY, [], [F.count("*").alias("n_events")])
        schemas.append(totals.schema)
        jobs.run_to_files(totals, checkpoint, out)

    deliver(inputs, run)
    streamed = inputs.spark.read.schema(schemas[0]).parquet(out)
    landed = (
        inputs("events")
        .groupBy(dates.truncate("day", "ts").alias("window_start"))
        .agg(F.count("*").alias("n_events"))
    )
    return jobs.late_rows(streamed, landed, ["window_start"], "n_events")
