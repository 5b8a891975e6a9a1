"""Builds in windows and steps hold the events of every day, not those of one month."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.sources.tables import SCHEMAS

DAYS = ["2023-12-30 23:59:59", "2024-01-01 00:00:00", "2024-01-02 05:00:00", "2024-01-03 06:00:00", "2024-01-31 12:00:00", "2024-02-01 00:00:00", "2024-03-07 08:00:00"]


@pytest.mark.parametrize("days", [DAYS, DAYS[-1:], []])
@pytest.mark.parametrize("name", ["bld_9_microbatch", "bld_11_full_refresh"])
def test_no_day_is_lost(spark, tmp_path, name, days):
    rows = ", ".join(f"({i}, timestamp_ntz'{d}', {i % 3}, 'view', 1.5, null)" for i, d in enumerate(days)) or "(0, null, 0, null, 0, null)"
    events = spark.sql(f"SELECT * FROM VALUES {rows} AS t(event_id, ts, user_id, event_type, value, props)")
    events = events.selectExpr(*[f"CAST({c.split()[0]} AS {c.split()[1]})" for c in SCHEMAS["events"].split(", ")]).where("ts IS NOT NULL")
    events.write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    got = entry.queries()[name](spark, str(tmp_path)).select(names).collect()
    assert sorted(map(tuple, got)) == sorted(cur.fetchall())
