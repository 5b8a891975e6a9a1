from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark.session import local_session  # noqa: E402
from tidemark.sources.tables import Inputs  # noqa: E402
from tidemark.sources.warehouse import Warehouse  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture
def house(spark):
    return Warehouse.scratch(spark, "test")


@pytest.fixture(scope="session")
def inputs(spark):
    return Inputs(spark, SMALL)


def rows(df, *order):
    """The rows of a small DataFrame as sorted tuples."""
    cols = order or df.columns
    found = [tuple(r) for r in df.select(*cols).collect()]
    return sorted(found, key=lambda t: tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in t))
