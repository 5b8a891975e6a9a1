from __future__ import annotations

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import quality
from tidemark.operators.contracts import Column, Contract, ContractBroken
from tidemark.operators.models import Context, ModelError, arrow_model, pandas_model, run_model
from tidemark.operators.quality import Check

CONTRACT = Contract(
    [
        Column("id", "BIGINT", not_null=True),
        Column("name", "VARCHAR"),
        Column("n", "BIGINT", checks=["n >= 0"]),
    ],
    checks=["n < 100 OR name IS NOT NULL"],
)


def data(spark, *d):
    return spark.createDataFrame(list(d), "id long, name string, n long")


def test_contract_accepts_and_orders_columns(spark, house):
    df = data(spark, (1, None, None), (2, "b", 5)).select("n", "name", "id")
    out = CONTRACT.write(house, "t", df)
    assert out.columns == ["id", "name", "n"] and out.count() == 2


@pytest.mark.parametrize("bad", [(None, "x", 1), (3, "x", -1), (3, None, 500)])
def test_contract_refuses_rows_and_keeps_the_table(spark, house, bad):
    CONTRACT.write(house, "t", data(spark, (1, "a", 1)))
    with pytest.raises(PySparkException, match="contract rule broken"):
        CONTRACT.append(house, "t", data(spark, (2, "ok", 1), bad))
    with pytest.raises(PySparkException, match="contract rule broken"):
        CONTRACT.write(house, "t", data(spark, (2, "ok", 1), bad))
    assert rows(house.read("t")) == [(1, "a", 1)]


def test_contract_mismatches(spark):
    df = spark.createDataFrame([(1, 2, 3)], "id int, name long, extra int")
    found = {(n, why) for n, _, _, why in CONTRACT.mismatches(df)}
    assert found == {("id", "type differs"), ("name", "type differs"), ("n", "missing in query"), ("extra", "missing in contract")}
    with pytest.raises(ContractBroken, match="declared bigint"):
        CONTRACT.enforce(df)
    assert CONTRACT.mismatch_rows(spark, data(spark, (1, "a", 1))).count() == 0
    assert CONTRACT.mismatch_rows(spark, df).count() == 4


def test_contract_violations(spark):
    found = dict(rows(CONTRACT.violations(data(spark, (None, "a", -1), (1, None, 500), (2, "b", None)))))
    assert found == {"not_null(id)": 1, "check(n >= 0)": 1, "check(n < 100 OR name IS NOT NULL)": 1}


def test_row_tests(spark):
    df = data(spark, (1, "a", 5), (1, None, -5), (None, "zzz", None))
    assert quality.not_null(df, "id").count() == 1
    assert rows(quality.unique(df, "id")) == [(1, 2)]
    assert rows(quality.accepted_values(df, "name", ["a"]), "name") == [("zzz",)]
    assert quality.in_range(df, "n", 0, 4).count() == 2
    assert quality.non_negative(df, "n").count() == 1
    assert quality.accepted_range(df, "n", low=-5).count() == 0
    assert quality.accepted_range(df, "n", low=-5, inclusive=False).count() == 1
    assert rows(quality.unique_combination(df, ["id", "name"])) == []
    with pytest.raises(ValueError):
        quality.out_of_range("n")


def test_relationships_ignore_null_children(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (None,)], "p int")
    assert rows(quality.relationships(child, "k", parent, "p")) == [(2,)]


def test_reconciliation(spark):
    total = lambda n, v: spark.createDataFrame([(n, v)], "n long, v double")
    assert quality.reconciles(total(3, 10.0), total(3, 10.9), ["n"], {"v": 1.0}).count() == 0
    assert quality.reconciles(total(3, 10.0), total(3, 11.1), ["n"], {"v": 1.0}).count() == 1
    assert quality.reconciles(total(3, 10.0), total(4, 10.0), ["n"], {"v": 1.0}).count() == 1
    assert quality.reconciles(total(3, None), total(3, 10.0), ["n"], {"v": 1.0}).count() == 1


def test_equal_rows_on_listed_columns(spark):
    left = spark.createDataFrame([(1, "a", 9)], "id int, v string, other int")
    right = spark.createDataFrame([(1, "a")], "id int, v string")
    assert quality.equal_rows(left, right, ["id", "v"]).count() == 0
    with pytest.raises(ValueError):
        quality.equal_rows(left, right)


def test_statuses(spark):
    df = data(spark, *[(i, "a", -i) for i in range(5)])
    bad = quality.out_of_range("n", low=0)
    out = quality.run_suite(
        [
            (
                df,
                [
                    Check("fails", bad),
                    Check("warns", bad, severity="warn"),
                    Check("tolerated", bad, error_over=4),
                    Check("silent", bad, warn_over=4, error_over=10),
                    Check("passes", quality.is_null("id")),
                    Check("by query", failures=quality.unique(df, "name")),
                ],
            )
        ]
    )
    got = {r["test"]: (r["failures"], r["status"]) for r in out.collect()}
    assert got == {
        "fails": (4, "error"), "warns": (4, "warn"), "tolerated": (4, "warn"), "silent": (4, "pass"), "passes": (0, "pass"), "by query": (1, "error"),
    }
    assert dict(rows(quality.totals_by_status(out))) == {"error": 2, "warn": 2, "pass": 2}


def test_suite_scans_a_table_once(spark, inputs):
    checks = [Check(f"c{i}", quality.out_of_range("l_discount", low=i / 100)) for i in range(5)]
    plan = quality.run_suite([(inputs("lineitem"), checks)])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_stored_failures(spark, house):
    bad = quality.non_negative(data(spark, *[(i, "a", -i) for i in range(30)]), "n")
    assert rows(quality.store_failures(house, "f", bad, ["id"], cap=3), "id") == [(1,), (2,), (3,)]
    assert quality.store_failures(house, "f", bad, ["id"]).count() == 29


def test_models(spark, house):
    context = Context({"t": spark.range(3)}, {"s": lambda: spark.range(2)}, {"k": 2}, this="out")
    out = run_model(lambda c, s: c.ref("t").select((F.col("id") * c.config["k"]).alias("x")), context, spark, house)
    assert rows(out) == [(0,), (2,), (4,)] and house.exists("out")
    assert run_model(lambda c, s: c.source("s"), context, spark).count() == 2
    for wrong in (pd.DataFrame({"a": [1]}), pa.table({"a": [1]}), None):
        with pytest.raises(ModelError, match="hand back a Spark DataFrame"):
            run_model(lambda c, s, w=wrong: w, context, spark)
    with pytest.raises(ModelError, match="no ref named 'nope'"):
        run_model(lambda c, s: c.ref("nope"), context, spark)


def test_a_model_that_fails_keeps_the_old_table(spark, house):
    context = Context({}, this="out")
    run_model(lambda c, s: s.range(3), context, spark, house)
    with pytest.raises(ZeroDivisionError):
        run_model(lambda c, s: 1 / 0, context, spark, house)
    assert house.read("out").count() == 3


def test_batch_models(spark):
    df = spark.range(10, numPartitions=3)
    doubled = arrow_model(df, lambda t: t.append_column("d", pa.compute.multiply(t["id"], 2)), "id bigint, d bigint")
    assert doubled.where("d <> id * 2").count() == 0 and doubled.count() == 10
    indexed = pandas_model(df, lambda p: p.set_index("id", drop=False)[["id"]], "id bigint")
    assert indexed.count() == 10
