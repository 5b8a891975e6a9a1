"""Stored increments: what they read, what they rewrite, and what they refuse."""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import incremental, stored
from tidemark.operators.contracts import Column, Contract, ContractBroken
from tidemark.operators.stored import Increment
from tidemark.sources.warehouse import Warehouse

SCHEMA = "id int, v string, day string"


def table(spark, *data, schema=SCHEMA):
    return spark.createDataFrame(list(data), schema)


def files(house, name="t"):
    return {f.rsplit("/", 2)[1] + "/" + f.rsplit("/", 1)[1] for f in house.read(name).inputFiles()}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- predicates -------------------------------------------------------------------


@pytest.mark.parametrize("strategy", ["merge", "delete+insert"])
def test_predicate_on_a_stored_table(spark, house, strategy):
    old = table(spark, (1, "hey", "blue"), (2, "goodbye", "red"))
    new = table(spark, (1, "hello", "blue"), (2, "yo", "green"), (3, "anyway", "purple"))
    step = Increment("day", ["id"], strategy, predicate="id <> 2")
    for batch in (old, new):
        step.run(house, "t", batch)
    assert rows(house.read("t")) == [(1, "hello", "blue"), (2, "goodbye", "red"), (2, "yo", "green"), (3, "anyway", "purple")]


def test_predicate_and_keys_prune_the_target(spark, house):
    house.replace("t", table(spark, *[(i, "a", f"d{i // 10}") for i in range(100)]), ["day"])
    batch = table(spark, (41, "x", "d7"), (42, "y", "d7"))
    step = Increment("day", ["id"], "merge", predicate="day IN ('d4', 'd5')")
    before = files(house)
    with house.staged(batch) as fresh:
        _, bounds = step._extent(fresh)
        text = plan(step.matches(house.read("t"), fresh, bounds))
    assert bounds == {"id": ("41", "42")}
    assert "day#" in text.split("PartitionFilters: [")[1].split("]")[0] and "d4" in text
    assert "GreaterThanOrEqual(id,41)" in text and "LessThanOrEqual(id,42)" in text
    assert step.run(house, "t", batch) == {"d4", "d7"}
    assert {f for f in files(house) if "d4" not in f and "d7" not in f} == {f for f in before if "d4" not in f and "d7" not in f}
    assert rows(house.read("t").where("id IN (41, 42)")) == [(41, "x", "d7"), (42, "y", "d7")]


def test_random_batches_with_a_predicate_equal_the_pure_function(spark, house):
    draw = random.Random(2)
    step = Increment("day", ["id"], "delete+insert", predicate="v <> 'k' AND day <> 'd1'")
    model = table(spark, *[(i, draw.choice("jk"), f"d{i % 4}") for i in range(30)])
    step.run(house, "t", model)
    held = model.collect()
    for _ in range(3):
        batch = table(spark, *[(draw.choice([None, draw.randrange(40)]), draw.choice(["j", "k", None]), draw.choice(["d0", "d1", "d9", None])) for _ in range(8)])
        held = incremental.delete_insert(spark.createDataFrame(held, SCHEMA), batch, ["id"], F.expr(step.predicate)).collect()
        step.run(house, "t", batch)
        assert rows(house.read("t").select("id", "v", "day")) == rows(spark.createDataFrame(held, SCHEMA))


# --- strategies --------------------------------------------------------------------


def test_the_default_strategy_goes_by_the_keys(spark, house):
    for _ in range(2):
        Increment("day").run(house, "plain", table(spark, (1, "a", "d1")))
        Increment("day", ["id"]).run(house, "keyed", table(spark, (1, "a", "d1"), (1, "b", "d1")))
    assert house.read("plain").count() == 2 and rows(house.read("keyed"), "v") == [("a",), ("b",)]
    for wrong in (Increment("day", strategy="merge"), Increment("day", ["id"], "replace")):
        with pytest.raises(ValueError):
            wrong.run(house, "keyed", table(spark, (1, "a", "d1")))


def test_a_partition_column_among_the_keys_needs_no_search(spark, house, monkeypatch):
    step = Increment("day", ["day", "id"], "merge")
    step.run(house, "t", table(spark, (1, "a", "d1"), (1, "b", "d2")))
    monkeypatch.setattr(Increment, "matches", lambda *a: pytest.fail("the target was searched"))
    assert step.run(house, "t", table(spark, (1, "c", "d2"))) == {"d2"}
    assert rows(house.read("t")) == [(1, "a", "d1"), (1, "c", "d2")]


def test_lookback_reads_the_newest_partition_only(spark, house):
    at = lambda t: datetime.fromisoformat(t)
    schema = "id int, ts timestamp_ntz, day date"
    first = [(1, at("2024-01-01 05:00:00")), (2, at("2024-01-02 03:00:00")), (3, None)]
    source = table(spark, *[(i, t, t and t.date()) for i, t in first], schema=schema)
    assert stored.lookback(house, "t", source, "ts", 6, "day") is source
    Increment("day", ["id"]).run(house, "t", source)
    late = table(spark, (4, at("2024-01-01 20:00:00"), None), (5, at("2024-01-01 22:00:00"), None), schema=schema)
    assert rows(stored.lookback(house, "t", late, "ts", 6, "day"), "id") == [(5,)]


def test_change_counts_equal_the_alignment(spark, house):
    draw = random.Random(7)
    make = lambda n, spread: {draw.randrange(spread): (draw.choice(["a", "b", None]), f"d{draw.randrange(3)}") for _ in range(n)}
    old, new = (table(spark, *[(k, *v) for k, v in make(n, 60).items()]) for n in (40, 30))
    house.replace("t", old, ["day"])
    got = stored.change_counts(house, "t", new, ["id"], "day")
    assert rows(got) == rows(incremental.change_counts(old, new, ["id"]))
    assert rows(stored.change_counts(house, "t", new.limit(0), ["id"], "day")) == [("keep", old.count())]


# --- columns -----------------------------------------------------------------------


def run_policy(spark, house, policy):
    step = Increment("day", ["id"], "merge", on_schema_change=policy)
    step.run(house, policy, table(spark, (1, "a", "d1"), (2, "b", "d2")))
    new = table(spark, (2, 20, "d2"), (3, 30, "d3"), schema="id long, w int, day string")
    for _ in range(2):
        step.run(house, policy, new)
    return house.read(policy)


def test_ignore_keeps_the_columns(spark, house):
    assert rows(run_policy(spark, house, "ignore"), "id", "v", "day") == [(1, "a", "d1"), (2, None, "d2"), (3, None, "d3")]


def test_new_columns_are_added_without_rewriting(spark, house):
    Increment("day", ["id"], "merge").run(house, "t", table(spark, (1, "a", "d1"), (2, "b", "d2")))
    before = files(house)
    new = table(spark, (2, "bb", 20, "d2"), schema="id int, v string, w int, day string")
    for _ in range(2):
        Increment("day", ["id"], "merge", on_schema_change="append_new_columns").run(house, "t", new)
    assert rows(house.read("t"), "id", "v", "w", "day") == [(1, "a", None, "d1"), (2, "bb", 20, "d2")]
    assert {f for f in files(house) if "day=d1" in f} == {f for f in before if "day=d1" in f}


def test_sync_drops_and_widens_in_the_catalog(spark, house):
    Increment("day", ["id"], "merge").run(house, "t", table(spark, (1, 5, "a", "d1"), (2, 6, "b", "d2"), schema="id int, n int, v string, day string"))
    before = files(house)
    step = Increment("day", ["id"], "merge", on_schema_change="sync_all_columns")
    batch = table(spark, (2, 2**40, "d2"), schema="id int, n long, day string")
    for _ in range(2):
        step.run(house, "t", batch)
    out = house.read("t")
    assert rows(out, "id", "n", "day") == [(1, 5, "d1"), (2, 2**40, "d2")] and set(out.columns) == {"id", "n", "day"}
    assert {f for f in files(house) if "day=d1" in f} == {f for f in before if "day=d1" in f}
    # A column that comes back does not bring its old values with it.
    back = table(spark, (3, 7, "c", "d3"), schema="id int, n long, v string, day string")
    Increment("day", ["id"], "merge", on_schema_change="append_new_columns").run(house, "t", back)
    assert rows(house.read("t"), "id", "v") == [(1, None), (2, None), (3, "c")]


def test_other_type_changes_rewrite_the_table(spark, house):
    Increment("day", ["id"], "merge").run(house, "t", table(spark, (1, "5", "d1"), (2, "6", "d2")))
    batch = table(spark, (2, 7, "d2"), schema="id int, v int, day string")
    Increment("day", ["id"], "merge", on_schema_change="sync_all_columns").run(house, "t", batch)
    assert rows(house.read("t"), "id", "v") == [(1, 5), (2, 7)]


def test_refused_columns_change_nothing(spark, house):
    Increment("day", ["id"], "merge").run(house, "t", table(spark, (1, "a", "d1")))
    new = table(spark, (1, 5, "d1"), schema="id int, w int, day string")
    for policy in ("fail", None):
        with pytest.raises(incremental.SchemaChange):
            Increment("day", ["id"], "merge", on_schema_change=policy).run(house, "t", new)
    with pytest.raises(incremental.SchemaChange, match="keys and partition"):
        Increment("day", ["id"], "merge", on_schema_change="sync_all_columns").run(house, "t", table(spark, (1, "a"), schema="id int, v string"))
    with pytest.raises(ValueError, match="unknown schema policy"):
        Increment("day", ["id"], "merge", on_schema_change="sometimes").run(house, "t", new)
    assert rows(house.read("t")) == [(1, "a", "d1")] and house.read("t").columns == ["id", "v", "day"]


# --- contracts ---------------------------------------------------------------------

RULES = Contract([Column("id", "INT", not_null=True), Column("v", "VARCHAR", checks=["v <> 'bad'"]), Column("day", "VARCHAR")])


@pytest.mark.parametrize("strategy", ["append", "delete+insert", "merge"])
def test_a_batch_that_breaks_the_contract_leaves_every_row(spark, house, strategy):
    step = Increment("day", ["id"], strategy, contract=RULES)
    step.run(house, "t", table(spark, (1, "a", "d1"), (2, None, "d2")))
    before, held = files(house), rows(house.read("t"))
    for bad in ((3, "bad", "d1"), (None, "x", "d1")):
        with pytest.raises(PySparkException, match="contract rule broken"):
            step.run(house, "t", table(spark, (1, "new", "d1"), bad))
    with pytest.raises(ContractBroken, match="w"):
        more = table(spark, (1, "a", "d1", 1), schema=SCHEMA + ", w int")
        Increment("day", ["id"], strategy, on_schema_change="append_new_columns", contract=RULES).run(house, "t", more)
    assert files(house) == before and rows(house.read("t")) == held and house.read("t").columns == ["id", "v", "day"]
    step.run(house, "t", table(spark, (1, "good", "d1")))
    assert ("good",) in rows(house.read("t"), "v")


def test_the_first_batch_is_held_to_the_contract_too(spark, house):
    with pytest.raises(PySparkException, match="contract rule broken"):
        Increment("day", contract=RULES).run(house, "t", table(spark, (None, "a", "d1")))
    assert not house.exists("t")


# --- windows -----------------------------------------------------------------------


def events(spark, *data):
    return spark.createDataFrame([(i, datetime.fromisoformat(t)) for i, t in data], "id int, ts timestamp_ntz")


def test_runs_over_disjoint_windows_at_the_same_time(spark, house):
    source = events(spark, *[(24 * d + h, f"2024-01-{d + 1:02d} {h:02d}:00:00") for d in range(8) for h in range(24)])
    spans = [("2024-01-01", "2024-01-03"), ("2024-01-03", "2024-01-05"), ("2024-01-05", "2024-01-07"), ("2024-01-07", "2024-01-09")]
    for name, workers in (("serial", 1), ("parallel", 4)):
        with ThreadPoolExecutor(workers) as pool:
            for done in [pool.submit(stored.store_windows, house, name, source, "ts", a, b) for a, b in spans]:
                done.result()
        # And once more over filled windows, from a source that has lost some of its days.
        fixed = source.where("day(ts) NOT IN (2, 3) AND hour(ts) < 20")
        with ThreadPoolExecutor(workers) as pool:
            for done in [pool.submit(stored.store_windows, house, name, fixed, "ts", a, b) for a, b in spans[:3]]:
                done.result()
    assert rows(house.fresh("serial")) == rows(house.fresh("parallel"))
    assert house.read("serial").count() == 4 * 20 + 2 * 24


def test_emptied_windows_cost_no_job_each(spark, house):
    source = events(spark, *[(d, f"2024-01-{d:02d} 12:00:00") for d in range(1, 29)])
    stored.store_windows(house, "t", source, "ts", "2024-01-01", "2024-01-29")

    def jobs(days):
        spark.sparkContext.setJobGroup(f"windows-{days}", "")
        stored.store_windows(house, "t", source.where(f"day(ts) > {days}"), "ts", "2024-01-01", "2024-01-29")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"windows-{days}"))

    few, many = jobs(1), jobs(26)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert rows(house.read("t"), "id") == [(27,), (28,)] and many <= few


def test_windows_with_a_predicate(spark, house):
    source = events(spark, (1, "2024-01-01 12:00:00"), (2, "2024-01-01 13:00:00"), (3, "2024-01-02 12:00:00"))
    stored.store_windows(house, "t", source, "ts", "2024-01-01", "2024-01-03")
    stored.store_windows(house, "t", source.where("id = 9"), "ts", "2024-01-01", "2024-01-03", predicate="id <> 2")
    assert rows(house.read("t"), "id") == [(2,)]


# --- mutations -----------------------------------------------------------------------


def test_mutations_rewrite_what_they_touch(spark, house):
    data = [(i, "abc"[i % 3], f"d{i // 6}") for i in range(24)]
    house.replace("t", table(spark, *data), ["day"])
    of = lambda days: {f for f in files(house) if f.split("/")[0][4:] in days}
    kept = of({"d0", "d2", "d3"})
    assert stored.update_rows(house, "t", "day", "id = 7", {"v": F.lit("z")}) == {"d1"}
    assert of({"d0", "d2", "d3"}) == kept
    # A whole partition goes without writing; of another, one row.
    assert stored.delete_rows(house, "t", "day", "day = 'd2' OR id = 3") == {"d0", "d2"}
    assert of({"d3"}) <= kept and not of({"d2"})
    # Rows move to a partition that has rows already, and their old one is left empty.
    assert stored.update_rows(house, "t", "day", "day = 'd0'", {"day": F.lit("d3")}) == {"d0", "d3"}
    source = table(spark, (18, None), (99, "x"), schema="id int, v string")
    assert stored.update_rows_from(house, "t", "day", source, ["id"], ["v"]) == {"d3"}
    assert stored.delete_rows_using(house, "t", "day", source.where("id = 99"), ["id"]) == set()
    assert stored.delete_rows_using(house, "t", "day", table(spark, *[(i, "", "") for i in range(6, 12)]), ["id"]) == {"d1"}
    want = [(i, None if i == 18 else v, "d3") for i, v, d in data if d in ("d0", "d3") and i != 3]
    assert rows(house.read("t"), "id", "v", "day") == sorted(want)
    assert {r[0] for r in house.partitions("t", "day").collect()} == {"d3"}
    with pytest.raises(ValueError, match="partitions"):
        stored.update_rows_from(house, "t", "day", source, ["id"], ["day"])


def test_a_merge_that_breaks_off_is_mended_by_repeating_it(spark, house, monkeypatch):
    step = Increment("day", ["id"], "merge")
    step.run(house, "t", table(spark, (1, "a", "d1"), (2, "b", "d2")))
    drop = Warehouse.drop_partitions
    monkeypatch.setattr(Warehouse, "drop_partitions", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        step.run(house, "t", table(spark, (1, "x", "d2")))
    monkeypatch.setattr(Warehouse, "drop_partitions", drop)
    step.run(house, "t", table(spark, (1, "x", "d2")))
    assert rows(house.read("t")) == [(1, "x", "d2"), (2, "b", "d2")]
