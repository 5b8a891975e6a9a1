"""Every registered query against its SQL."""

from __future__ import annotations

import importlib.util
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SMALL

spec = importlib.util.spec_from_file_location("check", Path(__file__).resolve().parent.parent / "tools" / "check.py")
check = importlib.util.module_from_spec(spec)
spec.loader.exec_module(check)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for path in sorted(Path(SMALL).glob("*.parquet")):
        c.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return c


# How many inventory IDs each family has.
FAMILIES = {
    "src": 11, "prj": 5, "flt": 6, "join": 11, "agg": 13, "win": 9, "sort": 3, "set": 4, "gen": 5, "fn": 25,
    "bld": 14, "snap": 9, "con": 4, "dq": 15, "str": 4, "udf": 3, "mart": 10,
}


# The text operators are tested in tests/llm.
OWN = [n for n in entry.queries() if n.split("_")[0] in FAMILIES]


@pytest.mark.parametrize("name", OWN)
def test_query_equals_its_sql(spark, con, name):
    line = check.compare(spark, con, SMALL, name)
    assert line.startswith("ok"), line
    assert "TYPES" not in line, line


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(OWN) <= set(entry.oracle_sql())


@pytest.mark.parametrize("family", FAMILIES)
def test_inventory_is_covered(family):
    ids = {n.split("_")[1] for n in entry.queries() if n.split("_")[0] == family}
    assert ids == {str(i) for i in range(1, FAMILIES[family] + 1)}
