"""SNAP: version histories of suppliers, orders and conversations.

The later states of a table are derived from the table itself: negative
balances are settled, one nation's suppliers leave, and the richest arrive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.snapshot import Names, Snapshot
from tidemark.plans.registry import query
from tidemark.sources.tables import Inputs
from tidemark.sources.warehouse import Warehouse

T0, T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


def first_state(inputs: Inputs) -> DataFrame:
    return inputs("supplier").where("s_acctbal <= 9000")


def second_state(inputs: Inputs) -> DataFrame:
    return third_state(inputs).where("s_nationkey <> 3")


def third_state(inputs: Inputs) -> DataFrame:
    return inputs("supplier").withColumn("s_acctbal", F.greatest("s_acctbal", F.lit(0.0)))


COLUMNS = "s_suppkey, s_name, s_nationkey"
OPEN_END = "CAST(NULL AS TIMESTAMP)"


def versions_sql(gone_end: str = OPEN_END, open_end: str = OPEN_END) -> str:
    """Versions after the first two states; ``gone_end`` closes those of suppliers who left."""
    return f"""SELECT {COLUMNS}, s_acctbal, TIMESTAMP '{T0}' AS valid_from,
          CASE WHEN s_nationkey = 3 THEN {gone_end} WHEN s_acctbal < 0 THEN TIMESTAMP '{T1}' ELSE {open_end} END AS valid_to
        FROM supplier WHERE s_acctbal <= 9000
        UNION ALL SELECT {COLUMNS}, greatest(s_acctbal, 0), TIMESTAMP '{T1}', {open_end} FROM supplier
        WHERE s_nationkey <> 3 AND (s_acctbal < 0 OR s_acctbal > 9000)"""


def with_ids(rows: str, extra: str = "") -> str:
    key = "md5(CAST(s_suppkey AS VARCHAR) || '-' || strftime(valid_from, '%Y-%m-%d %H:%M:%S'))"
    return f"SELECT *, valid_from AS updated_at, {key} AS scd_id{extra} FROM ({rows})"


def history(inputs: Inputs, spec: Snapshot, states=None) -> DataFrame:
    """A stored history after a run per state."""
    house = Warehouse.scratch(inputs.spark, "history")
    out = None
    for state, as_of in states or [(first_state(inputs), T0), (second_state(inputs), T1)]:
        out = spec.run(house, "suppliers", state, as_of)
    return out


@query("snap_1_check_strategy", with_ids(versions_sql()))
def check_strategy(inputs: Inputs) -> DataFrame:
    """The same second state runs twice; the second time changes nothing."""
    states = [(first_state(inputs), T0), (second_state(inputs), T1), (second_state(inputs), T2)]
    return history(inputs, Snapshot(["s_suppkey"], check_cols=["s_name", "s_acctbal"]), states)


@query(
    "snap_2_timestamp_strategy",
    """SELECT *, valid_from AS updated_at, md5(CAST(o_orderkey AS VARCHAR) || '-' || strftime(valid_from, '%Y-%m-%d %H:%M:%S')) AS scd_id
       FROM (SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderdate AS valid_from,
               CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 1 DAY END AS valid_to
             FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'
             UNION ALL SELECT o_orderkey, 'F', o_orderdate + INTERVAL 1 DAY, o_orderdate + INTERVAL 1 DAY, NULL
             FROM orders WHERE o_orderstatus = 'P'
             UNION ALL SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderdate, NULL
             FROM orders WHERE o_orderstatus <> 'P' AND o_orderdate >= TIMESTAMP '2001-01-01')""",
)
def timestamp_strategy(inputs: Inputs) -> DataFrame:
    """Pending orders are finished a day later; finished orders keep their version."""
    orders = inputs("orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    pending = F.col("o_orderstatus") == "P"
    later = orders.select(
        "o_orderkey",
        F.when(pending, "F").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(pending, F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("o_orderdate")).alias("o_orderdate"),
    )
    spec = Snapshot(["o_orderkey"], strategy="timestamp", updated_column="o_orderdate")
    early = orders.where(F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz"))
    return spec.apply(spec.first(early, T0), later, T1)


CLOSED = f"TIMESTAMP '{T1}'"
DELETED_SQL = f"""SELECT *, 'False' AS is_deleted FROM ({versions_sql(CLOSED)})
    UNION ALL SELECT {COLUMNS}, s_acctbal, TIMESTAMP '{T1}', NULL, 'True' FROM supplier
    WHERE s_nationkey = 3 AND s_acctbal <= 9000"""


def _modes() -> str:
    parts = [
        f"SELECT 'ignore' AS mode, *, CAST(NULL AS VARCHAR) AS is_deleted FROM ({versions_sql()})",
        f"SELECT 'invalidate', *, NULL FROM ({versions_sql(CLOSED)})",
        f"SELECT 'new_record', * FROM ({DELETED_SQL})",
    ]
    return " UNION ALL ".join(parts)


@query("snap_3_hard_deletes", with_ids(_modes()))
def hard_deletes(inputs: Inputs) -> DataFrame:
    """A nation's suppliers leave: ignored, closed, or closed with a deletion record."""
    out = None
    for mode in ("ignore", "invalidate", "new_record"):
        spec = Snapshot(["s_suppkey"], check_cols=["s_acctbal"], hard_deletes=mode)
        part = history(inputs, spec).withColumn("mode", F.lit(mode))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


@query("snap_4_current_end_date", with_ids(versions_sql("TIMESTAMP '9999-12-31'", "TIMESTAMP '9999-12-31'")))
def current_end_date(inputs: Inputs) -> DataFrame:
    return history(inputs, Snapshot(["s_suppkey"], check_cols=["s_acctbal"], valid_to_current="9999-12-31 00:00:00"))


@query(
    "snap_5_compound_key",
    f"""SELECT *, valid_from AS updated_at, md5(conv_id || '-' || turn || '-' || strftime(valid_from, '%Y-%m-%d %H:%M:%S')) AS scd_id
        FROM (SELECT conv_id, turn, role, text, TIMESTAMP '{T0}' AS valid_from,
                CASE WHEN length(text) < 200 THEN TIMESTAMP '{T1}' END AS valid_to FROM conversations
              UNION ALL SELECT conv_id, turn, role, text || ' (edited)', TIMESTAMP '{T1}', NULL FROM conversations
              WHERE length(text) < 200)""",
)
def compound_key(inputs: Inputs) -> DataFrame:
    """Short turns are edited; the key is (conversation, turn)."""
    turns = inputs("conversations")
    edited = turns.withColumn(
        "text", F.when(F.length("text") < 200, F.concat("text", F.lit(" (edited)"))).otherwise(F.col("text"))
    )
    spec = Snapshot(["conv_id", "turn"], check_cols=["text"])
    return spec.apply(spec.first(turns, T0), edited, T1)


@query(
    "snap_6_renamed_columns",
    f"""SELECT {COLUMNS}, s_acctbal, valid_from AS seen_from, valid_to AS seen_to, updated_at AS seen_at, scd_id AS version_id,
        true AS bad_name_refused FROM ({with_ids(versions_sql())})""",
)
def renamed_columns(inputs: Inputs) -> DataFrame:
    names = Names(scd_id="version_id", updated_at="seen_at", valid_from="seen_from", valid_to="seen_to")
    out = history(inputs, Snapshot(["s_suppkey"], check_cols=["s_acctbal"], names=names))
    try:
        Snapshot(["s_suppkey"], names=Names(valid_to="s_name")).first(first_state(inputs), T0)
        refused = False
    except ValueError:
        refused = True
    return out.withColumn("bad_name_refused", F.lit(refused))


@query(
    "snap_7_new_source_column",
    with_ids(versions_sql(), f", CASE WHEN valid_from = TIMESTAMP '{T1}' THEN CASE WHEN s_acctbal > 5000 THEN 'A' ELSE 'B' END END AS s_rating"),
)
def new_source_column(inputs: Inputs) -> DataFrame:
    """A rating appears in the source later; older versions have none."""
    rated = second_state(inputs).withColumn("s_rating", F.when(F.col("s_acctbal") > 5000, "A").otherwise("B"))
    states = [(first_state(inputs), T0), (rated, T1)]
    return history(inputs, Snapshot(["s_suppkey"], check_cols=["s_acctbal"]), states)


RETURNED_SQL = f"""SELECT {COLUMNS}, s_acctbal, valid_from,
      CASE WHEN is_deleted = 'True' THEN TIMESTAMP '{T2}' ELSE valid_to END AS valid_to, is_deleted FROM ({DELETED_SQL})
    UNION ALL SELECT {COLUMNS}, greatest(s_acctbal, 0), TIMESTAMP '{T2}', NULL, 'False' FROM supplier WHERE s_nationkey = 3"""


def three_states(inputs: Inputs) -> DataFrame:
    states = [(first_state(inputs), T0), (second_state(inputs), T1), (third_state(inputs), T2)]
    return history(inputs, Snapshot(["s_suppkey"], check_cols=["s_acctbal"], hard_deletes="new_record"), states)


@query(
    "snap_8_version_ids",
    f"""SELECT s_nationkey, count(*) AS versions, count(DISTINCT scd_id) AS ids, count(DISTINCT s_suppkey) AS suppliers
        FROM ({with_ids(RETURNED_SQL)}) GROUP BY 1""",
)
def version_ids(inputs: Inputs) -> DataFrame:
    """As many ids as versions."""
    return three_states(inputs).groupBy("s_nationkey").agg(
        F.count("*").alias("versions"),
        F.count_distinct("scd_id").alias("ids"),
        F.count_distinct("s_suppkey").alias("suppliers"),
    )


@query("snap_9_returning_key", with_ids(RETURNED_SQL))
def returning_key(inputs: Inputs) -> DataFrame:
    """Suppliers who had left come back: their deletion record is closed and a version opens."""
    return three_states(inputs)
