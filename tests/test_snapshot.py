from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators.snapshot import Names, Snapshot

T = ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00", "2024-01-04 00:00:00"]
T0, T1, T2, T3 = (datetime.fromisoformat(t) for t in T)


def zones(spark, *data):
    return spark.createDataFrame(list(data), "id int, zone string, n int")


def test_check_strategy_closes_and_opens(spark, house):
    spec = Snapshot(["id"], check_cols=["zone"], hard_deletes="new_record")
    spec.run(house, "h", zones(spark, (1, "JFK", 2), (2, "JFK", 3), (3, "LGA", 1)), T[0])
    out = spec.run(house, "h", zones(spark, (1, "updated", 2), (3, "LGA", 99)), T[1])
    got = rows(out, "id", "zone", "n", "valid_from", "valid_to", "is_deleted")
    assert got == [
        (1, "JFK", 2, T0, T1, "False"),
        (1, "updated", 2, T1, None, "False"),
        (2, "JFK", 3, T0, T1, "False"),
        (2, "JFK", 3, T1, None, "True"),
        (3, "LGA", 1, T0, None, "False"),
    ]
    assert out.select("scd_id").distinct().count() == 5


def test_rerun_changes_nothing(spark, house):
    spec = Snapshot(["id"], hard_deletes="new_record")
    states = [zones(spark, (1, "a", 1), (2, "b", 2)), zones(spark, (1, "aa", 1))]
    spec.run(house, "h", states[0], T[0])
    first = rows(spec.run(house, "h", states[1], T[1]))
    assert rows(spec.run(house, "h", states[1], T[1])) == first
    assert rows(spec.run(house, "h", states[1], T[2])) == first


@pytest.mark.parametrize("later", [T[1], T[2]])
def test_a_run_that_breaks_off_is_mended_by_the_next(spark, house, monkeypatch, later):
    spec = Snapshot(["id"], hard_deletes="new_record")
    states = [zones(spark, (1, "a", 1), (2, "b", 2), (3, "c", 3)), zones(spark, (1, "aa", 1), (3, "c", 3))]
    for table in ("clean", "broken"):
        spec.run(house, table, states[0], T[0])
    want = rows(spec.run(house, "clean", states[1], later))
    write, calls = type(house).overwrite_partitions, []

    def once(self, *args):
        calls.append(args)
        if len(calls) > 1:
            raise RuntimeError("lost")
        return write(self, *args)

    monkeypatch.setattr(type(house), "overwrite_partitions", once)
    with pytest.raises(RuntimeError):
        spec.run(house, "broken", states[1], T[1])
    monkeypatch.setattr(type(house), "overwrite_partitions", write)
    assert rows(spec.run(house, "broken", states[1], later)) == want
    closed = house.read("broken").where("version_set <> 'open'")
    assert closed.count() == closed.select("scd_id").distinct().count()


def test_a_note_left_after_the_open_versions_were_replaced(spark, house, monkeypatch):
    """The run was done but for its note: its closings stay."""
    spec = Snapshot(["id"])
    spec.run(house, "h", zones(spark, (1, "a", 1)), T[0])
    want = rows(spec.run(house, "h", zones(spark, (1, "b", 1)), T[1]))
    house.note("h", "closed-" + T[1].replace(" ", "T").replace(":", ""))
    assert rows(spec.run(house, "h", zones(spark, (1, "b", 1)), T[2])) == want
    assert not house.noted("h")


def test_null_changes_are_changes(spark):
    spec = Snapshot(["id"], check_cols=["zone"])
    history = spec.first(zones(spark, (1, None, 1), (2, "b", 1), (3, None, 1)), T[0])
    out = spec.apply(history, zones(spark, (1, "a", 1), (2, None, 1), (3, None, 1)), T[1])
    assert rows(out.groupBy("id").count()) == [(1, 2), (2, 2), (3, 1)]


def test_timestamp_strategy(spark):
    spec = Snapshot(["id"], strategy="timestamp", updated_column="at")
    make = lambda *d: spark.createDataFrame(list(d), "id int, v string, at timestamp_ntz")
    history = spec.first(make((1, "a", T0), (2, "b", T1)), T[3])
    out = spec.apply(history, make((1, "aa", T2), (2, "changed but not newer", T1)), T[3])
    assert rows(out, "id", "v", "valid_from", "valid_to") == [(1, "a", T0, T2), (1, "aa", T2, None), (2, "b", T1, None)]


def test_invalidate_everything(spark, house):
    spec = Snapshot(["id"], hard_deletes="invalidate")
    spec.run(house, "h", zones(spark, (1, "a", 1), (2, "b", 1)), T[0])
    out = spec.run(house, "h", zones(spark, (1, "a", 1)).limit(0), T[1])
    assert rows(out, "id", "valid_to") == [(1, T1), (2, T1)]


def test_ignore_keeps_absent_keys_open(spark):
    spec = Snapshot(["id"])
    out = spec.apply(spec.first(zones(spark, (1, "a", 1), (2, "b", 1)), T[0]), zones(spark, (1, "a", 1)), T[1])
    assert rows(out, "id", "valid_to") == [(1, None), (2, None)]


@pytest.mark.parametrize("mode", ["invalidate", "new_record"])
def test_returning_key_opens_a_version(spark, house, mode):
    spec = Snapshot(["id"], hard_deletes=mode)
    both, one = zones(spark, (1, "a", 1), (2, "b", 1)), zones(spark, (1, "a", 1))
    for state, t in ((both, T[0]), (one, T[1]), (both, T[2])):
        out = spec.run(house, "h", state, t)
    current = out.where("valid_to IS NULL AND id = 2")
    assert rows(current, "zone", "valid_from") == [("b", T2)]
    assert out.where("id = 2").count() == (3 if mode == "new_record" else 2)


def test_sentinel_end(spark):
    spec = Snapshot(["id"], valid_to_current="9999-12-31 00:00:00")
    end = datetime(9999, 12, 31)
    out = spec.apply(spec.first(zones(spark, (1, "a", 1)), T[0]), zones(spark, (1, "b", 1)), T[1])
    assert rows(out, "zone", "valid_to") == [("a", T1), ("b", end)]
    again = spec.apply(out, zones(spark, (1, "b", 1)), T[2])
    assert rows(again) == rows(out)


def test_names(spark):
    names = Names(valid_to="to_ts", valid_from="from_ts", scd_id="sid", updated_at="seen", is_deleted="gone")
    out = Snapshot(["id"], hard_deletes="new_record", names=names).first(zones(spark, (1, "a", 1)), T[0])
    assert set(out.columns) == {"id", "zone", "n", "sid", "seen", "from_ts", "to_ts", "gone"}
    for bad in (Names(valid_to="zone"), Names(valid_to="valid_from"), Names(valid_to="no good"), Names(valid_to="")):
        with pytest.raises(ValueError):
            Snapshot(["id"], names=bad).first(zones(spark, (1, "a", 1)), T[0])


def test_wrong_settings():
    for bad in ({"strategy": "guess"}, {"strategy": "timestamp"}, {"hard_deletes": "maybe"}):
        with pytest.raises(ValueError):
            Snapshot(["id"], **bad)


def test_new_column_with_all_columns_checked(spark, house):
    spec = Snapshot(["id"])
    spec.run(house, "h", zones(spark, (1, "a", 1), (2, "b", 1)), T[0])
    wider = zones(spark, (1, "a", 1), (2, "b", 1)).withColumn("m", F.when(F.col("id") == 1, 7))
    out = spec.run(house, "h", wider, T[1])
    assert rows(out, "id", "m", "valid_to") == [(1, 7, None), (1, None, T1), (2, None, None)]
    assert rows(spec.run(house, "h", wider, T[2])) == rows(out)


def test_closed_versions_are_not_rewritten(spark, house):
    spec = Snapshot(["id"])
    for i, t in enumerate(T):
        before = {f for f in house.read("h").inputFiles() if "closed" in f} if house.exists("h") else set()
        spec.run(house, "h", zones(spark, (1, f"v{i}", 1)), t)
        assert before <= set(house.read("h").inputFiles())
    assert house.read("h").count() == 4


def test_unclear_keys_are_refused(spark, house):
    for bad in (zones(spark, (1, "a", 1), (1, "b", 1)), zones(spark, (None, "a", 1))):
        with pytest.raises(ValueError, match="NULL or repeated key"):
            Snapshot(["id"]).run(house, "h", bad, T[0])
    assert not house.exists("h")
