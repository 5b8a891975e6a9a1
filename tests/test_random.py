"""Random tables against a plain model of what should happen."""

from __future__ import annotations

from datetime import datetime, timedelta

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import incremental as inc
from tidemark.operators import stored
from tidemark.operators.snapshot import Snapshot
from tidemark.sources.warehouse import Warehouse

few = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
value = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
day = st.sampled_from(["d1", "d2", "d3"])
keyed = st.dictionaries(st.integers(1, 8), st.tuples(value, day), max_size=6)


@few
@given(st.lists(keyed, min_size=1, max_size=4), st.booleans())
def test_stored_merges_follow_the_model(spark, batches, keep_value):
    house = Warehouse.scratch(spark, "random")
    model: dict = {}
    for batch in batches:
        df = spark.createDataFrame([(k, v, d) for k, (v, d) in batch.items()], "id int, v string, day string")
        exclude = ["v"] if keep_value else []
        stored.store_merge(house, "t", df, ["id"], "day", exclude=exclude)
        for k, (v, d) in batch.items():
            model[k] = (model[k][0] if keep_value and k in model else v, d)
    assert dict((k, (v, d)) for k, v, d in house.read("t").select("id", "v", "day").collect()) == model


@few
@given(st.lists(st.dictionaries(st.integers(1, 5), value, max_size=5), min_size=2, max_size=4), st.sampled_from(["ignore", "invalidate", "new_record"]))
def test_histories_follow_the_model(spark, states, mode):
    house = Warehouse.scratch(spark, "random")
    spec = Snapshot(["id"], check_cols=["v"], hard_deletes=mode)
    start = datetime(2024, 1, 1)
    closed, current = [], {}
    for i, state in enumerate(states):
        at = start + timedelta(days=i)
        df = spark.createDataFrame([(k, v) for k, v in state.items()], "id int, v string")
        out = spec.run(house, "h", df, str(at))
        for k, v in state.items():
            if k not in current or current[k][2] == "True" or current[k][0] != v:
                if k in current:
                    closed.append((k, *current[k][:2], at, current[k][2]))
                current[k] = (v, at, "False")
        for k in [k for k in current if k not in state]:
            v, since, dead = current[k]
            if mode == "ignore" or dead == "True":
                continue
            closed.append((k, v, since, at, dead))
            if mode == "new_record":
                current[k] = (v, at, "True")
            else:
                del current[k]
    want = closed + [(k, v, since, None, dead) for k, (v, since, dead) in current.items()]
    flag = ["is_deleted"] if mode == "new_record" else []
    got = rows(out, "id", "v", "valid_from", "valid_to", *flag)
    width = 5 if flag else 4
    assert sorted(map(str, got)) == sorted(str(w[:width]) for w in want)
