"""CON and DQ: contracts and data tests."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import numbers
from tidemark.operators import quality
from tidemark.operators.contracts import Column, Contract, ContractBroken
from tidemark.operators.quality import Check
from tidemark.plans import mart_sql, marts
from tidemark.plans.registry import query, total
from tidemark.sources.tables import Inputs
from tidemark.sources.warehouse import Warehouse

CUSTOMER = Contract(
    columns=[
        Column("c_custkey", "BIGINT", not_null=True),
        Column("c_name", "VARCHAR", not_null=True),
        Column("c_nationkey", "INTEGER"),
        Column("c_acctbal", "DOUBLE PRECISION", checks=["c_acctbal >= 0"]),
    ],
    primary_key=["c_custkey"],
)


def customers(inputs: Inputs) -> DataFrame:
    """Customers that meet the contract: debts are written as zero."""
    return inputs("customer").select(
        "c_custkey", "c_name", "c_nationkey", F.greatest("c_acctbal", F.lit(0.0)).alias("c_acctbal")
    )


@query(
    "con_1_columns_and_types",
    """SELECT *, (SELECT count(*) FROM customer) AS rows_written, true AS raised FROM (VALUES
       ('c_name', 'string', CAST(NULL AS VARCHAR), 'missing in query'), ('c_nationkey', 'int', 'string', 'type differs'),
       ('c_mktsegment', CAST(NULL AS VARCHAR), 'string', 'missing in contract')) t(column_name, declared_type, found_type, reason)""",
)
def columns_and_types(inputs: Inputs) -> DataFrame:
    """What is wrong with a draft of the table, column by column; the right one is written."""
    house = Warehouse.scratch(inputs.spark, "contract")
    draft = inputs("customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("c_nationkey"), "c_acctbal", "c_mktsegment"
    )
    try:
        CUSTOMER.enforce(draft)
        raised = False
    except ContractBroken:
        raised = True
    written = CUSTOMER.write(house, "customers", customers(inputs))
    return CUSTOMER.mismatch_rows(inputs.spark, draft).select(
        "*", written.agg(F.count("*")).scalar().alias("rows_written"), F.lit(raised).alias("raised")
    )


def _refused(house: Warehouse, rows: DataFrame) -> bool:
    try:
        CUSTOMER.write(house, "customers", rows)
        return False
    except PySparkException:
        return True


@query(
    "con_2_not_null",
    "SELECT c_custkey, c_name, c_nationkey, greatest(c_acctbal, 0) AS c_acctbal, true AS refused FROM customer",
)
def contract_not_null(inputs: Inputs) -> DataFrame:
    """A rebuild with NULL names is refused; the old rows stay."""
    house = Warehouse.scratch(inputs.spark, "contract")
    CUSTOMER.write(house, "customers", customers(inputs))
    bad = customers(inputs).withColumn("c_name", F.when(F.col("c_acctbal") > 0, F.col("c_name")))
    refused = _refused(house, bad)
    return house.read("customers").withColumn("refused", F.lit(refused))


@query(
    "con_3_check",
    """SELECT rule, failures, true AS refused, (SELECT count(*) FROM customer) AS rows_kept FROM (
       SELECT 'not_null(c_custkey)' AS rule, CAST(0 AS BIGINT) AS failures UNION ALL SELECT 'not_null(c_name)', 0
       UNION ALL SELECT 'check(c_acctbal >= 0)', count(*) FROM customer WHERE c_acctbal < 0)""",
)
def contract_check(inputs: Inputs) -> DataFrame:
    """A rebuild with debts is refused; how many rows break each rule."""
    house = Warehouse.scratch(inputs.spark, "contract")
    CUSTOMER.write(house, "customers", customers(inputs))
    bad = inputs("customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    refused = _refused(house, bad)
    kept = house.read("customers").agg(F.count("*")).scalar()
    return CUSTOMER.violations(bad).select("*", F.lit(refused).alias("refused"), kept.alias("rows_kept"))


@query(
    "con_4_declared_keys",
    """SELECT 'primary_key(l_orderkey, l_linenumber)' AS declared, (SELECT count(*) FROM (SELECT 1 FROM lineitem
         GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) AS failures
       UNION ALL SELECT 'not_null(l_orderkey)', (SELECT count(*) FROM lineitem WHERE l_orderkey IS NULL)
       UNION ALL SELECT 'not_null(l_linenumber)', (SELECT count(*) FROM lineitem WHERE l_linenumber IS NULL)
       UNION ALL SELECT 'foreign_key(l_orderkey)', (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN
         (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'))
       UNION ALL SELECT 'unique(o_orderkey)', (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1))""",
)
def declared_keys(inputs: Inputs) -> DataFrame:
    """Keys are declared in contracts, not enforced; as tests they say where they do not hold."""
    lines, orders = inputs("lineitem"), inputs("orders")
    placed = orders.where("o_orderstatus <> 'P'")
    line_keys = Contract([], primary_key=["l_orderkey", "l_linenumber"], foreign_keys=[("l_orderkey", "placed", "o_orderkey")])
    order_keys = Contract([], unique=[["o_orderkey"]])
    results = quality.run_suite([(lines, line_keys.tests(lines, {"placed": placed})), (orders, order_keys.tests(orders, {}))])
    return results.select(F.col("test").alias("declared"), "failures")


@query(
    "dq_1_not_null",
    """SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL""",
)
def dq_not_null(inputs: Inputs) -> DataFrame:
    documents, labels = inputs("documents").select("doc_id"), inputs("labels").select("doc_id", "quality")
    return quality.not_null(documents.join(labels, "doc_id", "left"), "quality")


@query(
    "dq_2_unique",
    "SELECT sha256(text) AS text, count(*) AS n_records FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
)
def dq_unique(inputs: Inputs) -> DataFrame:
    return quality.unique(inputs("documents"), "text", digest=True)


@query(
    "dq_3_accepted_values",
    """SELECT event_type, count(*) AS n_records FROM events
       WHERE event_type NOT IN ('click', 'view', 'purchase', 'signup') GROUP BY 1""",
)
def dq_accepted_values(inputs: Inputs) -> DataFrame:
    return quality.accepted_values(inputs("events"), "event_type", ["click", "view", "purchase", "signup"])


@query(
    "dq_4_relationships",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""",
)
def dq_relationships(inputs: Inputs) -> DataFrame:
    """Orders whose customer is not among those without debts."""
    orders = inputs("orders").select("o_orderkey", "o_custkey")
    return quality.relationships(orders, "o_custkey", inputs("customer").where("c_acctbal >= 0"), "c_custkey")


@query(
    "dq_5_in_range",
    "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount < 0.01 OR l_discount > 0.09",
)
def dq_in_range(inputs: Inputs) -> DataFrame:
    return quality.in_range(inputs("lineitem").select("l_orderkey", "l_linenumber", "l_discount"), "l_discount", 0.01, 0.09)


@query("dq_6_non_negative", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
def dq_non_negative(inputs: Inputs) -> DataFrame:
    return quality.non_negative(inputs("customer").select("c_custkey", "c_acctbal"), "c_acctbal")


@query("dq_7_accepted_range", "SELECT event_id, value FROM events WHERE value >= 200")
def dq_accepted_range(inputs: Inputs) -> DataFrame:
    """Only an upper bound, which itself is not accepted."""
    return quality.accepted_range(inputs("events").select("event_id", "value"), "value", high=200.0, inclusive=False)


@query(
    "dq_8_unique_combination",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def dq_unique_combination(inputs: Inputs) -> DataFrame:
    return quality.unique_combination(inputs("lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq_9_singular",
    "SELECT event_id, ts FROM events WHERE ts < TIMESTAMP '2024-01-02' OR ts >= TIMESTAMP '2024-01-30'",
)
def dq_singular(inputs: Inputs) -> DataFrame:
    """Events outside a window: a test is any query that should return nothing."""
    start, end = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-02", "2024-01-30"))
    return inputs("events").where((F.col("ts") < start) | (F.col("ts") >= end)).select("event_id", "ts")


@query(
    "dq_10_reconciliation",
    f"""SELECT * FROM (SELECT CAST(sum(n_events) AS BIGINT) AS rollup_n, {total("total_value")} AS rollup_v FROM ({mart_sql.DAILY_EVENTS})),
        (SELECT count(*) AS detail_n, {total("value")} AS detail_v FROM events WHERE event_type <> 'error')""",
)
def dq_reconciliation(inputs: Inputs) -> DataFrame:
    """The daily rollup against a detail that lacks some events: one failing row."""
    rollup = marts.daily_events(inputs).agg(
        F.sum("n_events").alias("n"), numbers.exact_sum("total_value").alias("v")
    )
    detail = inputs("events").where("event_type <> 'error'").agg(
        F.count("*").alias("n"), numbers.exact_sum("value").alias("v")
    )
    return quality.reconciles(rollup, detail, exact=["n"], within={"v": 1.0})


@query(
    "dq_11_equal_rows",
    """SELECT nationkey, sum(l) AS n_left, sum(r) AS n_right FROM (
         SELECT c_nationkey AS nationkey, CAST(1 AS BIGINT) AS l, CAST(0 AS BIGINT) AS r FROM customer
         UNION ALL SELECT s_nationkey, 0, 1 FROM supplier) GROUP BY 1 HAVING sum(l) <> sum(r)""".replace(
        "sum(l) AS", "CAST(sum(l) AS BIGINT) AS"
    ).replace("sum(r) AS", "CAST(sum(r) AS BIGINT) AS"),
)
def dq_equal_rows(inputs: Inputs) -> DataFrame:
    """Two bags of nation keys, and where they differ."""
    left = inputs("customer").select(F.col("c_nationkey").alias("nationkey"))
    right = inputs("supplier").select(F.col("s_nationkey").alias("nationkey"))
    return quality.equal_rows(left, right)


@query(
    "dq_12_unit_test",
    """SELECT 'staged_events derives its time fields' AS test, count(*) AS rows_compared, CAST(0 AS BIGINT) AS differences FROM events""",
)
def dq_unit_test(inputs: Inputs) -> DataFrame:
    """Staged events against the same columns stated another way, on the listed columns only."""
    expected = inputs("events").selectExpr(
        "event_id",
        "CAST(substring(CAST(ts AS STRING), 12, 2) AS INT) AS event_hour",
        "CAST(extract(DAYOFWEEK_ISO FROM ts) AS INT) AS iso_weekday",
        "CAST(substring(CAST(ts AS STRING), 1, 10) AS DATE) AS event_date",
    )
    staged = marts.staged_events(inputs)
    wrong = quality.equal_rows(staged, expected, expected.columns)
    return staged.agg(F.count("*").alias("rows_compared")).select(
        F.lit("staged_events derives its time fields").alias("test"),
        "rows_compared",
        wrong.agg(F.count("*")).scalar().alias("differences"),
    )


@query(
    "dq_13_severity",
    """SELECT test, severity, failures, CASE WHEN failures > error_over AND severity = 'error' THEN 'error'
         WHEN failures > warn_over THEN 'warn' ELSE 'pass' END AS status FROM (
       SELECT 'value cap' AS test, 'warn' AS severity, count(*) AS failures, 0 AS warn_over, 0 AS error_over FROM events WHERE value > 300
       UNION ALL SELECT 'value sign', 'error', count(*), 0, 0 FROM events WHERE value < 0
       UNION ALL SELECT 'few large values', 'error', count(*), 0, 1000000000 FROM events WHERE value > 200
       UNION ALL SELECT 'no errors', 'error', count(*), 0, 0 FROM events WHERE event_type = 'error')""",
)
def dq_severity(inputs: Inputs) -> DataFrame:
    """Four rules over one table, counted in one scan."""
    checks = [
        Check("value cap", quality.out_of_range("value", high=300), severity="warn"),
        Check("value sign", quality.out_of_range("value", low=0)),
        Check("few large values", quality.out_of_range("value", high=200), error_over=1_000_000_000),
        Check("no errors", F.col("event_type") == "error"),
    ]
    return quality.run_suite([(inputs("events"), checks)])


@query(
    "dq_14_stored_failures",
    "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0 ORDER BY c_custkey LIMIT 10",
)
def dq_stored_failures(inputs: Inputs) -> DataFrame:
    """The first failing rows, kept in a table for a look."""
    house = Warehouse.scratch(inputs.spark, "failures")
    failing = quality.non_negative(inputs("customer").select("c_custkey", "c_acctbal"), "c_acctbal")
    return quality.store_failures(house, "negative_balances", failing, ["c_custkey"], cap=10)


SUITE_SQL = """SELECT test, severity, failures, CASE WHEN failures = 0 THEN 'pass' ELSE severity END AS status FROM (
  SELECT 'events.event_id not_null' AS test, 'error' AS severity, (SELECT count(*) FROM events WHERE event_id IS NULL) AS failures
  UNION ALL SELECT 'events.day_part accepted', 'error', CAST(0 AS BIGINT)
  UNION ALL SELECT 'events.value cap', 'warn', (SELECT count(*) FROM events WHERE value > 300)
  UNION ALL SELECT 'events.event_id unique', 'error', (SELECT count(*) FROM (SELECT 1 FROM events GROUP BY event_id HAVING count(*) > 1))
  UNION ALL SELECT 'lineitem.discount in range', 'error', (SELECT count(*) FROM lineitem WHERE l_discount < 0 OR l_discount > 0.1)
  UNION ALL SELECT 'lineitem key unique', 'error', (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))
  UNION ALL SELECT 'lineitem.l_orderkey in orders', 'error', (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
  UNION ALL SELECT 'labels.doc_id in documents', 'error', (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents))
  UNION ALL SELECT 'daily_events reconciles', 'error', CAST(0 AS BIGINT))"""


def project_suite(inputs: Inputs) -> DataFrame:
    """All tests of the project: one scan per table for its row rules, one aggregate per other test."""
    events, lines, labels = marts.staged_events(inputs), inputs("lineitem"), inputs("labels")
    parts = ["overnight", "morning rush", "midday", "evening rush", "night"]
    daily = marts.daily_events(inputs).agg(F.sum("n_events").alias("n"), numbers.exact_sum("total_value").alias("v"))
    detail = inputs("events").agg(F.count("*").alias("n"), numbers.exact_sum("value").alias("v"))
    return quality.run_suite(
        [
            (
                events,
                [
                    Check("events.event_id not_null", quality.is_null("event_id")),
                    Check("events.day_part accepted", quality.not_accepted("day_part", parts)),
                    Check("events.value cap", quality.out_of_range("value", high=300), severity="warn"),
                    Check("events.event_id unique", failures=quality.unique(events, "event_id")),
                ],
            ),
            (
                lines,
                [
                    Check("lineitem.discount in range", quality.out_of_range("l_discount", 0, 0.1)),
                    Check("lineitem key unique", failures=quality.unique_combination(lines, ["l_orderkey", "l_linenumber"])),
                    Check(
                        "lineitem.l_orderkey in orders",
                        failures=quality.relationships(lines, "l_orderkey", inputs("orders"), "o_orderkey"),
                    ),
                ],
            ),
            (
                labels,
                [
                    Check(
                        "labels.doc_id in documents",
                        failures=quality.relationships(labels, "doc_id", inputs("documents"), "doc_id"),
                    ),
                    Check("daily_events reconciles", failures=quality.reconciles(daily, detail, ["n"], {"v": 1.0})),
                ],
            ),
        ]
    )


query("dq_15_suite_results", SUITE_SQL)(project_suite)


@query("dq_15_suite_totals", f"SELECT status, count(*) AS tests FROM ({SUITE_SQL}) GROUP BY 1")
def suite_totals(inputs: Inputs) -> DataFrame:
    return quality.totals_by_status(project_suite(inputs))
