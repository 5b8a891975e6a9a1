"""Structured Streaming forms of the table builds.

Streams read files as they land and run to the end of what has landed
(``availableNow``), so the same job serves a schedule, a replay, or, with
another trigger, a continuous run. Every sink can be replayed: a batch that
runs twice leaves the same table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.aggregates import first_per_key
from tidemark.operators.stored import store_rollup
from tidemark.sources.warehouse import Warehouse


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session for streams that leaves the caller's settings alone.

    The number of state partitions is fixed for the life of a checkpoint, so
    it is set to the cluster's cores and not to a default. Zone-less times are
    UTC here.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.shuffle.partitions", str(state_partitions or spark.sparkContext.defaultParallelism))
    return session


def file_stream(session: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """Parquet files as they land below ``path``."""
    reader = session.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def run_batches(stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None]) -> None:
    """Hand every micro-batch that is available to ``step``, then stop."""
    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def run_to_files(stream: DataFrame, checkpoint: str, path: str) -> None:
    """Append all closed results to parquet files, each exactly once, then stop."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer.option("path", path).trigger(availableNow=True).start().awaitTermination()


def upsert_latest(
    stream: DataFrame, database: str, location: str, table: str, keys: Sequence[str], order: Sequence[str], buckets: int, checkpoint: str
) -> None:
    """Keep one row per key, the latest by ``order``.

    The table is partitioned by a hash bucket of the key. A batch is folded to
    one row per key first, and only the buckets it touches are read and
    rewritten. The winner depends on the rows alone, not on how they were
    batched, so replays and reorderings end in the same table.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        house = Warehouse(batch.sparkSession, database, location)
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        newest = first_per_key(batch, keys, [F.col(c) for c in order]).withColumn("key_bucket", bucket)
        with house.staged(newest) as fresh:
            if house.exists(table):
                touched = [row[0] for row in fresh.select("key_bucket").distinct().collect()]
                old = house.read(table).where(F.col("key_bucket").isin(touched))
                fresh = first_per_key(old.unionByName(fresh), [*keys, "key_bucket"], [F.col(c) for c in order])
            house.overwrite_partitions(table, fresh, ["key_bucket"])

    run_batches(stream, checkpoint, step)


def upsert_log(
    stream: DataFrame, database: str, location: str, table: str, keys: Sequence[str], order: Sequence[str], checkpoint: str, fan: int = 16
) -> None:
    """Keep the latest row per key as a log: a batch writes its own keys and reads nothing.

    Every batch is folded to one row per key and becomes one partition, named by the
    query and the batch. :func:`latest` reads the log as one row per key. More than
    ``fan`` partitions of a level are folded into one of the next, so that a row is
    written again once per level, a logarithm of the batches, and readers meet few
    partitions. A batch that runs twice replaces its partition or repeats rows that are
    there already; neither changes which row is the latest, nor does a checkpoint that
    is lost, or a fold that breaks off between writing and dropping.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        house = Warehouse(batch.sparkSession, database, location)
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        newest = first_per_key(batch, keys, [F.col(c) for c in order]).withColumn("delivery", F.lit(f"0-{run}-{batch_id}"))
        house.ensure(table, newest.schema, ["delivery"])
        house.overwrite_partitions(table, newest, ["delivery"])
        fold_log(house, table, keys, order, fan)

    run_batches(stream, checkpoint, step)


def fold_log(house: Warehouse, table: str, keys: Sequence[str], order: Sequence[str], fan: int) -> None:
    """Fold each level of a log that has more than ``fan`` partitions into one partition of the next level."""
    level = 0
    while True:
        held = [r["delivery"] for r in house.partitions(table, "delivery").where(F.col("delivery").startswith(f"{level}-")).collect()]
        if len(held) <= fan:
            return
        level += 1
        rows = house.read(table).where(F.col("delivery").isin(held)).drop("delivery")
        folded = first_per_key(rows, keys, [F.col(c) for c in order]).withColumn("delivery", F.lit(f"{level}-{uuid.uuid4().hex}"))
        house.overwrite_partitions(table, folded, ["delivery"])
        house.drop_partitions(table, "delivery", held)


def latest(house: Warehouse, table: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A log of :func:`upsert_log` as a table with one row per key."""
    return first_per_key(house.fresh(table).drop("delivery"), keys, [F.col(c) for c in order])


def rebuild_days(
    stream: DataFrame,
    database: str,
    location: str,
    landed: str,
    totals: str,
    day: Column,
    rollup: Callable[[DataFrame], DataFrame],
    checkpoint: str,
) -> None:
    """Keep day totals that are right although a batch holds only part of a day.

    Rows are landed first, in a partition per day and source file. A file comes
    whole in one batch, so reading it again, in whatever batch, under the same
    checkpoint or a new one, replaces its own rows. The touched days are then
    computed again from all their landed rows. ``stream`` must come straight
    from files.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        house = Warehouse(batch.sparkSession, database, location)
        with house.staged(batch.withColumn("event_date", day)) as rows:
            house.overwrite_partitions(landed, rows, ["event_date", "origin"])
            days = {row[0] for row in rows.select("event_date").distinct().collect()}
        store_rollup(house, totals, house.read(landed), rollup, "event_date", days)

    run_batches(stream.select("*", F.xxhash64("_metadata.file_path").alias("origin")), checkpoint, step)


def tumbling_totals(stream: DataFrame, ts: str, delay: str, keys: Sequence[str], measures: Sequence[Column], width: str = "1 day") -> DataFrame:
    """Totals per time window and key, emitted once the watermark has passed the window.

    ``delay`` is how late a row may be. Partial sums are made before the
    shuffle, so a key with most of the rows is no burden.
    """
    timed = stream.withColumn("__at", F.col(ts).cast("timestamp")).withWatermark("__at", delay)
    totals = timed.groupBy(F.window("__at", width), *keys).agg(*measures)
    start = F.col("window.start").cast("timestamp_ntz").alias("window_start")
    return totals.select(start, *[c for c in totals.columns if c != "window"])


def replay(slices: Sequence[DataFrame], landing: str, run: Callable[[], None]) -> None:
    """Land one slice after another and run the stream after each, as a schedule would."""
    for part in slices:
        part.write.mode("append").parquet(landing)
        run()


def late_rows(streamed: DataFrame, batch: DataFrame, on: Sequence[str], count: str) -> DataFrame:
    """How many rows of each closed window the stream left out as too late.

    ``streamed`` and ``batch`` are the same rollup, one from the stream and
    one over all landed rows. The stream's own counter of dropped rows counts
    after partial sums and is only a signal.
    """
    slim = streamed.select(*on, F.col(count).alias("n_streamed"))
    both = batch.select(*on, F.col(count).alias("n_landed")).join(slim, list(on))
    return both.withColumn("n_late", F.col("n_landed") - F.col("n_streamed"))
