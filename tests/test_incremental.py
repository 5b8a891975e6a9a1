from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import incremental as inc
from tidemark.operators import stored
from tidemark.operators.sets import bag_difference

SCHEMA = "id int, v string, day string"


def table(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_merge_updates_inserts_and_keeps(spark):
    old = table(spark, (1, "a", "d1"), (2, "b", "d1"), (3, "c", "d2"))
    new = table(spark, (2, None, "d1"), (4, "x", "d3"))
    want = [(1, "a", "d1"), (2, None, "d1"), (3, "c", "d2"), (4, "x", "d3")]
    assert rows(inc.merge(old, new, ["id"])) == want


def test_merge_refuses_unclear_keys(spark):
    old = table(spark, (1, "a", "d1"))
    with pytest.raises(inc.BadKeys):
        inc.merge(old, table(spark, (1, "x", "d1"), (1, "y", "d1")), ["id"])
    with pytest.raises(inc.BadKeys):
        inc.merge(old, table(spark, (None, "x", "d1")), ["id"])


def test_merge_excluded_columns_keep_nulls_too(spark):
    old = table(spark, (1, None, "d1"), (2, "b", "d1"))
    new = table(spark, (1, "x", "d9"), (3, "y", "d9"))
    assert rows(inc.merge(old, new, ["id"], exclude=["v"])) == [(1, None, "d9"), (2, "b", "d1"), (3, "y", "d9")]


@pytest.mark.parametrize("how", [inc.merge, inc.delete_insert])
def test_predicate_leaves_closed_rows_beside_new_ones(spark, how):
    old = table(spark, (1, "hey", "blue"), (2, "goodbye", "red"))
    new = table(spark, (1, "hello", "blue"), (2, "yo", "green"), (3, "anyway", "purple"))
    out = how(old, new, ["id"], predicate=F.col("id") != 2)
    assert rows(out) == [(1, "hello", "blue"), (2, "goodbye", "red"), (2, "yo", "green"), (3, "anyway", "purple")]


def test_delete_insert_keeps_every_batch_row(spark):
    old = table(spark, (1, "a", "d1"), (None, "n", "d1"))
    new = table(spark, (1, "x", "d1"), (1, "y", "d1"), (None, "m", "d1"))
    got = rows(inc.delete_insert(old, new, ["id"]), "v")
    assert got == [("m",), ("n",), ("x",), ("y",)]


def test_stored_merge_moves_a_key_and_clears_its_old_partition(spark, house):
    stored.store_merge(house, "t", table(spark, (1, "a", "d1"), (2, "b", "d2")), ["id"], "day")
    stored.store_merge(house, "t", table(spark, (1, "a2", "d2")), ["id"], "day")
    assert rows(house.read("t")) == [(1, "a2", "d2"), (2, "b", "d2")]
    stored.store_merge(house, "t", table(spark, (1, "a2", "d2")), ["id"], "day")
    assert rows(house.read("t")) == [(1, "a2", "d2"), (2, "b", "d2")]


def test_stored_merge_rewrites_only_touched_partitions(spark, house):
    stored.store_merge(house, "t", table(spark, (1, "a", "d1"), (2, "b", "d2"), (3, "c", "d3")), ["id"], "day")
    files = lambda: {f for f in house.read("t").inputFiles() if "day=d2" not in f}
    before = files()
    stored.store_merge(house, "t", table(spark, (2, "bb", "d2"), (4, "new", "d2")), ["id"], "day")
    assert files() == before
    assert rows(house.read("t"), "id", "v") == [(1, "a"), (2, "bb"), (3, "c"), (4, "new")]


def test_stored_merge_with_null_partition(spark, house):
    stored.store_merge(house, "t", table(spark, (1, "a", None), (2, "b", "d2")), ["id"], "day")
    stored.store_merge(house, "t", table(spark, (1, "aa", None), (3, "c", None)), ["id"], "day")
    assert rows(house.read("t"), "id", "v") == [(1, "aa"), (2, "b"), (3, "c")]


@pytest.mark.parametrize("home", [None, "it's", "a\\b", "d 1/2"])
def test_odd_partition_values_are_cleared(spark, house, home):
    stored.store_merge(house, "t", table(spark, (1, "a", home), (2, "b", "d2")), ["id"], "day")
    stored.store_merge(house, "t", table(spark, (1, "aa", "d2")), ["id"], "day")
    assert rows(house.read("t")) == [(1, "aa", "d2"), (2, "b", "d2")]


def test_empty_batch_changes_nothing(spark, house):
    stored.store_merge(house, "t", table(spark, (1, "a", "d1")), ["id"], "day")
    stored.store_merge(house, "t", table(spark, (9, "z", "d9")).limit(0), ["id"], "day")
    assert rows(house.read("t")) == [(1, "a", "d1")]


@pytest.mark.parametrize("cuts", [[50], [20, 40, 60, 80], [1, 99]])
def test_any_split_into_batches_equals_a_full_load(spark, house, cuts):
    source = spark.range(100).select(
        "id", (F.col("id") * 7 % 13).cast("string").alias("v"), F.concat(F.lit("d"), F.col("id") % 4).alias("day")
    )
    edges = [0, *cuts, 100]
    for lo, hi in zip(edges, edges[1:]):
        # Each batch overlaps the one before it.
        stored.store_merge(house, "t", source.where((F.col("id") >= max(lo - 5, 0)) & (F.col("id") < hi)), ["id"], "day")
    assert bag_difference(house.read("t"), source).count() == 0


def events(spark, *data):
    return spark.createDataFrame([(i, datetime.fromisoformat(t)) for i, t in data], "id int, ts timestamp_ntz")


def test_lookback(spark):
    target = events(spark, (1, "2024-01-02 12:00:00"))
    source = events(spark, (2, "2024-01-02 05:59:59"), (3, "2024-01-02 06:00:00"), (4, "2024-01-03 00:00:00"))
    assert rows(inc.lookback(source, target, "ts", 6), "id") == [(3,), (4,)]
    assert inc.lookback(source, target.limit(0), "ts", 6).count() == 3
    assert inc.lookback(source, None, "ts", 6).count() == 3


def test_lookback_does_not_see_older_rows(spark, house):
    """Two steps equal one only for rows inside the lookback."""
    first = events(spark, (1, "2024-01-01 00:00:00"), (2, "2024-01-02 12:00:00"))
    source = first.union(events(spark, (3, "2024-01-02 07:00:00"), (4, "2024-01-01 01:00:00")))
    day = F.date_format("ts", "yyyy-MM-dd")
    stored.store_merge(house, "t", first.withColumn("day", day), ["id"], "day")
    stored.store_merge(house, "t", inc.lookback(source, house.read("t"), "ts", 6).withColumn("day", day), ["id"], "day")
    assert rows(house.read("t"), "id") == [(1,), (2,), (3,)]


def test_replace_window_is_half_open(spark):
    target = events(spark, (1, "2024-01-01 23:59:59"), (2, "2024-01-02 00:00:00"), (3, "2024-01-03 00:00:00"))
    batch = events(spark, (9, "2024-01-02 10:00:00"))
    assert rows(inc.replace_window(target, batch, "ts", "2024-01-02", "2024-01-03"), "id") == [(1,), (3,), (9,)]
    assert rows(inc.replace_window(target, batch, "ts", "2024-01-02", None), "id") == [(1,), (9,)]
    with pytest.raises(ValueError, match="needs its bounds"):
        inc.replace_window(target, batch, "ts", None, None)


def test_batches():
    days = inc.batches("2024-01-03", "2024-01-05", "day", lookback=1)
    assert [b.start.day for b in days] == [2, 3, 4] and days[0].end.day == 3
    assert len(inc.batches("2024-01-01 05:30:00", "2024-01-01 08:00:00", "hour")) == 3
    months = inc.batches("2023-11-15", "2024-02-01", "month")
    assert [(b.start.year, b.start.month) for b in months] == [(2023, 11), (2023, 12), (2024, 1)]
    assert inc.batches("2024-01-01", "2024-01-02", "day", lookback=3, begin="2024-01-01")[0].start == datetime(2024, 1, 1)
    assert [b.start.year for b in inc.batches("2023-05-01", "2025-01-01", "year")] == [2023, 2024]


def test_stored_windows_rerun_one_day(spark, house):
    source = events(spark, (1, "2024-01-01 12:00:00"), (2, "2024-01-02 12:00:00"))
    stored.store_windows(house, "t", source, "ts", "2024-01-01", "2024-01-03")
    stored.store_windows(house, "t", source, "ts", "2024-01-02", "2024-01-03")
    assert rows(house.read("t"), "id") == [(1,), (2,)]
    stored.store_windows(house, "t", source.where("id = 1"), "ts", "2024-01-02", "2024-01-03")
    assert rows(house.read("t"), "id") == [(1,)]
    with pytest.raises(ValueError, match="needs its bounds"):
        stored.store_windows(house, "t", source, "ts", None, None)


def test_hour_windows(spark, house):
    source = events(spark, (1, "2024-01-01 12:10:00"), (2, "2024-01-01 13:10:00"), (3, "2024-01-01 14:00:00"))
    stored.store_windows(house, "t", source, "ts", "2024-01-01 12:00:00", "2024-01-01 15:00:00", size="hour")
    stored.store_windows(house, "t", source.where("id <> 2"), "ts", "2024-01-01 13:00:00", "2024-01-01 14:00:00", size="hour")
    assert rows(house.read("t"), "id") == [(1,), (3,)]


def test_schema_policies(spark):
    old = spark.createDataFrame([(1, "a")], "id int, v string")
    new = spark.createDataFrame([(2, 5)], "id long, w int")
    pair = lambda policy: inc.append(*inc.fit_schema(old, new, policy))
    assert rows(pair("ignore")) == [(1, "a"), (2, None)]
    assert rows(pair("append_new_columns")) == [(1, "a", None), (2, None, 5)]
    synced = pair("sync_all_columns")
    assert synced.columns == ["id", "w"] and synced.schema["id"].dataType.simpleString() == "bigint"
    with pytest.raises(inc.SchemaChange, match="added"):
        pair("fail")
    with pytest.raises(ValueError):
        pair("sometimes")


def test_mutations(spark):
    df = table(spark, (1, "a", "d1"), (2, None, "d1"), (3, "c", "d2"))
    assert rows(inc.update_where(df, F.col("v") == "a", {"v": F.lit("z"), "day": F.col("v")})) == [(1, "z", "a"), (2, None, "d1"), (3, "c", "d2")]
    assert rows(inc.delete_where(df, F.col("v") == "a"), "id") == [(2,), (3,)]
    source = spark.createDataFrame([(3, None), (1, "n")], "id int, v string")
    assert rows(inc.update_from(df, source, ["id"], ["v"]), "id", "v") == [(1, "n"), (2, None), (3, None)]
    assert rows(inc.delete_using(df, source, ["id"]), "id") == [(2,)]


def test_changes(spark):
    old = table(spark, (1, "a", "d1"), (2, None, "d1"), (3, "c", "d2"))
    new = table(spark, (1, "a", "d1"), (2, "b", "d1"), (4, "x", "d2"))
    assert dict(rows(inc.changes(old, new, ["id"]))) == {1: "keep", 2: "update", 3: "keep", 4: "insert"}
    assert dict(rows(inc.changes(old, new, ["id"], full_source=True)))[3] == "delete"


def test_rollup_follows_a_late_row(spark, house):
    """A row from the evening before the newest day reaches facts and rollup alike."""
    def rollup(facts):
        return facts.groupBy("day").agg(F.count("*").alias("n"))

    day = F.date_format("ts", "yyyy-MM-dd")
    first = events(spark, (1, "2024-01-01 12:00:00"), (2, "2024-01-02 03:00:00")).withColumn("day", day)
    second = events(spark, (3, "2024-01-01 22:00:00"), (2, "2024-01-02 03:00:00")).withColumn("day", day)
    for batch in (first, second):
        touched = stored.Increment("day", ["id"], "merge").run(house, "facts", batch)
        stored.store_rollup(house, "daily", house.read("facts"), rollup, "day", touched)
    assert rows(house.read("daily"), "day", "n") == [("2024-01-01", 2), ("2024-01-02", 1)]


def test_rollup_clears_a_day_without_facts(spark, house):
    def rollup(facts):
        return facts.groupBy("day").agg(F.count("*").alias("n"))

    stored.store_rollup(house, "daily", table(spark, (1, "a", "d1"), (2, "b", "d2")), rollup, "day")
    stored.store_rollup(house, "daily", table(spark, (1, "a", "d1")), rollup, "day", {"d2"})
    assert rows(house.read("daily"), "day", "n") == [("d1", 1)]
