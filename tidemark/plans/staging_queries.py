"""PRJ and FLT: projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates, text
from tidemark.operators import joins, staging
from tidemark.plans import marts
from tidemark.plans.mart_sql import STAGED_EVENTS
from tidemark.plans.registry import day_part_sql, query, r
from tidemark.sources.tables import Inputs, in_window

query("prj_1_staging", STAGED_EVENTS)(marts.staged_events)


@query(
    "prj_2_pattern_flag",
    "SELECT p_partkey, p_name, p_name LIKE '%ring%' AS is_ring FROM part",
)
def pattern_flag(inputs: Inputs) -> DataFrame:
    return inputs("part").select("p_partkey", "p_name", text.matches_flag("p_name", "%ring%").alias("is_ring"))


@query(
    "prj_3_guarded_ratio",
    f"""SELECT l_orderkey, l_linenumber, l_extendedprice,
        CASE WHEN l_discount > 0 AND l_extendedprice > 0
        THEN {r("l_extendedprice * (1 - l_discount) * 100.0::DOUBLE / l_extendedprice", 2)} END AS net_pct FROM lineitem""",
)
def guarded_ratio(inputs: Inputs) -> DataFrame:
    pct = staging.discount_pct("l_extendedprice", "l_discount")
    return inputs("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", pct.alias("net_pct"))


@query("prj_4_day_part", f"SELECT event_id, {day_part_sql('ts')} AS day_part FROM events")
def day_part(inputs: Inputs) -> DataFrame:
    return inputs("events").select("event_id", dates.day_part("ts").alias("day_part"))


@query(
    "prj_5_flag_to_boolean",
    "SELECT l_orderkey, l_linenumber, l_partkey, coalesce(l_returnflag = 'R', false) AS is_returned FROM lineitem",
)
def flag_to_boolean(inputs: Inputs) -> DataFrame:
    flag = text.equals_flag("l_returnflag", "R").alias("is_returned")
    return inputs("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", flag)


@query(
    "flt_1_valid_window",
    """SELECT event_id, ts, value FROM events
       WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20' AND value >= 0 AND value <= 200
         AND ts + INTERVAL 12 HOUR <= TIMESTAMP '2024-01-20'""",
)
def valid_window(inputs: Inputs) -> DataFrame:
    end = F.lit("2024-01-20").cast("timestamp_ntz")
    return staging.stage(
        inputs("events"),
        rename={"event_id": "event_id", "ts": "ts", "value": "value"},
        valid=[
            in_window(F.col("ts"), "2024-01-05", "2024-01-20"),
            (F.col("value") >= 0) & (F.col("value") <= 200),
            dates.plus("ts", "12 hours") <= end,
        ],
    )


@query(
    "flt_2_in_list",
    """SELECT event_id, event_type, value FROM events
       WHERE event_type IN ('purchase', 'signup') OR (event_type NOT IN ('error', 'view') AND value > 100)""",
)
def in_list(inputs: Inputs) -> DataFrame:
    kind = F.col("event_type")
    wanted = kind.isin("purchase", "signup") | (~kind.isin("error", "view") & (F.col("value") > 100))
    return inputs("events").where(wanted).select("event_id", "event_type", "value")


@query(
    "flt_3_scalar_subquery",
    "SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) - INTERVAL 6 HOUR FROM events)",
)
def scalar_subquery(inputs: Inputs) -> DataFrame:
    return staging.newest_rows(inputs("events").select("event_id", "ts"), "ts", "6 hours")


@query(
    "flt_4_row_value_in",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_quantity FROM lineitem WHERE (l_partkey, l_suppkey) IN
       (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 45)""",
)
def row_value_in(inputs: Inputs) -> DataFrame:
    lines = inputs("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    pairs = inputs("lineitem").where("l_returnflag = 'R' AND l_quantity >= 45")
    return staging.rows_in(lines, pairs, ["l_partkey", "l_suppkey"])


@query(
    "flt_5_null_safe_equality",
    """SELECT d.doc_id, l.quality IS NOT DISTINCT FROM l.toxic AS same, l.quality = l.toxic AS plain_equal
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def null_safe_equality(inputs: Inputs) -> DataFrame:
    """Unlabelled documents: NULL-safe equality is true where plain equality is NULL."""
    labelled = joins.lookup(
        inputs("documents").select("doc_id"),
        inputs("labels"),
        {"doc_id": "doc_id"},
        {"quality": "quality", "toxic": "toxic"},
    )
    quality, toxic = F.col("quality"), F.col("toxic")
    return labelled.select(
        "doc_id", quality.eqNullSafe(toxic).alias("same"), (quality == toxic).alias("plain_equal")
    )


@query(
    "flt_6_quantified",
    """SELECT p_partkey, p_brand, p_retailprice FROM part
       WHERE p_retailprice > ALL (SELECT p_retailprice FROM part WHERE p_brand = 'Brand#1' AND p_size < 10)
         AND p_brand = ANY (SELECT p_brand FROM part WHERE p_type = 'PROMO')""",
)
def quantified(inputs: Inputs) -> DataFrame:
    """Parts dearer than all small ones of a brand, of any brand that has promotions."""
    part = inputs("part")
    dear = staging.greater_than_all(
        part.select("p_partkey", "p_brand", "p_retailprice"),
        "p_retailprice",
        part.where("p_brand = 'Brand#1' AND p_size < 10"),
        "p_retailprice",
    )
    return staging.rows_in(dear, part.where("p_type = 'PROMO'"), ["p_brand"])
