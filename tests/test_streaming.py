from __future__ import annotations

from datetime import datetime
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators.aggregates import first_per_key
from tidemark.session import scratch_path
from tidemark.sources.warehouse import Warehouse
from tidemark.streaming import jobs

SCHEMA = "user_id long, event_id long, ts timestamp_ntz, v int"


def make(spark, *data):
    return spark.createDataFrame([(u, e, datetime.fromisoformat(t), v) for u, e, t, v in data], SCHEMA)


def test_upsert_is_free_of_order_and_replay(spark, house):
    early = make(spark, (1, 1, "2024-01-01 00:00:00", 1), (2, 2, "2024-01-05 00:00:00", 2))
    late = make(spark, (1, 3, "2024-01-02 00:00:00", 3), (2, 4, "2024-01-03 00:00:00", 4))
    session = jobs.stream_session(spark, 2)
    for table, order in (("ab", (early, late)), ("ba", (late, early)), ("aba", (early, late, early))):
        landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "cp")
        schema = early.schema

        def run(table=table, landing=landing, checkpoint=checkpoint):
            stream = jobs.file_stream(session, landing, schema)
            jobs.upsert_latest(stream, house.database, house.location, table, ["user_id"], ["ts", "event_id"], 2, checkpoint)

        jobs.replay(order, landing, run)
        assert rows(house.fresh(table), "user_id", "v") == [(1, 3), (2, 2)]


def test_a_batch_of_the_log_writes_its_own_keys(spark, house):
    """Each batch adds as many rows as it has keys; folds, replays and lost checkpoints end in the same rows."""
    landing, session = scratch_path(spark, "landing"), jobs.stream_session(spark, 2)
    keys, order = ["user_id"], ["ts", "event_id"]
    parts = [make(spark, *[(u, i, f"2024-01-0{1 + i % 4} 0{i}:00:00", 10 * i + u) for u in range(5 if i else 100)]) for i in range(8)]
    sizes = []

    def run(checkpoint):
        stream = jobs.file_stream(session, landing, parts[0].schema, 1)
        jobs.upsert_log(stream, house.database, house.location, "log", keys, order, checkpoint, fan=3)

    checkpoint = scratch_path(spark, "cp")
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(landing)
        run(checkpoint)
        sizes.append(house.fresh("log").where("delivery LIKE '0-%'").groupBy("delivery").count().agg(F.max("count")).first()[0])
    assert [s for s in sizes[1:] if s] and all(s in (None, 5, 100) for s in sizes) and sizes[-1] in (None, 5)
    assert house.partitions("log", "delivery").count() <= 6
    whole = reduce(DataFrame.unionByName, parts)
    want = rows(first_per_key(whole, keys, [F.col(c) for c in order]))
    assert rows(jobs.latest(house, "log", keys, order).select(*whole.columns)) == want
    run(checkpoint)
    run(scratch_path(spark, "another"))
    assert rows(jobs.latest(house, "log", keys, order).select(*whole.columns)) == want


def test_a_fold_that_breaks_off_loses_nothing(spark, house, monkeypatch):
    log = spark.createDataFrame([(k, t, f"0-x-{t}") for k in range(3) for t in range(5)], "k int, t int, delivery string")
    house.replace("log", log, ["delivery"])
    drop = Warehouse.drop_partitions
    monkeypatch.setattr(Warehouse, "drop_partitions", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        jobs.fold_log(house, "log", ["k"], ["t"], 2)
    assert rows(jobs.latest(house, "log", ["k"], ["t"])) == [(0, 4), (1, 4), (2, 4)]
    monkeypatch.setattr(Warehouse, "drop_partitions", drop)
    jobs.fold_log(house, "log", ["k"], ["t"], 2)
    assert rows(jobs.latest(house, "log", ["k"], ["t"])) == [(0, 4), (1, 4), (2, 4)]
    assert house.read("log").count() <= 6


def test_day_rebuild_survives_a_lost_checkpoint(spark, house):
    """A new checkpoint, and other batches, read all files again: nothing is counted twice."""
    landing = scratch_path(spark, "landing")
    session = jobs.stream_session(spark, 2)
    parts = [make(spark, (1, 1, "2024-01-01 01:00:00", 1)), make(spark, (1, 2, "2024-01-01 02:00:00", 5), (1, 3, "2024-01-02 02:00:00", 7))]

    def rollup(facts):
        return facts.groupBy("event_date").agg(F.count("*").alias("n"), F.sum("v").alias("v"))

    def run(checkpoint, max_files=None):
        stream = jobs.file_stream(session, landing, parts[0].schema, max_files)
        jobs.rebuild_days(stream, house.database, house.location, "landed", "totals", F.to_date("ts"), rollup, checkpoint)

    checkpoint = scratch_path(spark, "cp")
    parts[0].write.mode("append").parquet(landing)
    run(checkpoint)
    parts[1].write.mode("append").parquet(landing)
    run(checkpoint)
    want = [("2024-01-01", 2, 6), ("2024-01-02", 1, 7)]
    assert [(str(d), n, v) for d, n, v in rows(house.fresh("totals"), "event_date", "n", "v")] == want
    for max_files in (None, 1):
        run(scratch_path(spark, "cp"), max_files)
        assert [(str(d), n, v) for d, n, v in rows(house.fresh("totals"), "event_date", "n", "v")] == want


def test_tumbling_totals_leave_the_newest_day_open(spark):
    landing, out, checkpoint = (scratch_path(spark, n) for n in ("landing", "out", "cp"))
    session = jobs.stream_session(spark, 2)
    schemas = []

    def run():
        stream = jobs.file_stream(session, landing, make(spark).schema)
        totals = jobs.tumbling_totals(stream, "ts", "6 hours", ["user_id"], [F.count("*").alias("n")])
        schemas.append(totals.schema)
        jobs.run_to_files(totals, checkpoint, out)

    slices = [
        make(spark, (1, 1, "2024-01-01 01:00:00", 1), (1, 2, "2024-01-02 07:00:00", 1)),
        make(spark, (1, 3, "2024-01-01 02:00:00", 1), (1, 4, "2024-01-02 08:00:00", 1), (1, 5, "2024-01-03 12:00:00", 1)),
    ]
    jobs.replay(slices, landing, run)
    got = rows(spark.read.schema(schemas[0]).parquet(out), "window_start", "n")
    assert got == [(datetime(2024, 1, 1), 1), (datetime(2024, 1, 2), 2)]
    landed = spark.read.schema(SCHEMA).parquet(landing).groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("window_start")).agg(F.count("*").alias("n"))
    late = jobs.late_rows(spark.read.schema(schemas[0]).parquet(out), landed, ["window_start"], "n")
    assert rows(late, "window_start", "n_late") == [(datetime(2024, 1, 1), 1), (datetime(2024, 1, 2), 0)]
