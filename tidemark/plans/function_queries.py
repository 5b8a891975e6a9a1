"""FN: scalar functions over whole columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates, numbers, text
from tidemark.plans.registry import query, r
from tidemark.sources.tables import Inputs

DAY = "CAST(o_orderdate AS DATE)"


@query(
    "fn_1_hour_and_iso_weekday",
    """SELECT event_id, CAST(extract(hour FROM ts) AS INTEGER) AS h, CAST(extract(isodow FROM ts) AS INTEGER) AS wd
       FROM events""",
)
def hour_and_weekday(inputs: Inputs) -> DataFrame:
    return inputs("events").select("event_id", F.hour("ts").alias("h"), dates.iso_weekday("ts").alias("wd"))


@query(
    "fn_2_minutes_between",
    f"""SELECT event_id, {r("date_diff('microsecond', date_trunc('day', ts), ts) / 60000000.0::DOUBLE", 2)} AS minutes
        FROM events""",
)
def minutes_between(inputs: Inputs) -> DataFrame:
    midnight = dates.truncate("day", "ts")
    return inputs("events").select("event_id", dates.minutes_between(midnight, "ts").alias("minutes"))


@query(
    "fn_3_interval_arithmetic",
    "SELECT event_id, ts + INTERVAL 12 HOUR AS later, ts - INTERVAL 6 HOUR AS earlier FROM events",
)
def interval_arithmetic(inputs: Inputs) -> DataFrame:
    return inputs("events").select(
        "event_id", dates.plus("ts", "12 hours").alias("later"), dates.plus("ts", "-6 hours").alias("earlier")
    )


@query(
    "fn_4_dateadd",
    f"""SELECT o_orderkey, CAST({DAY} + INTERVAL 1 DAY AS DATE) AS next_day, o_orderdate + INTERVAL 1 MONTH AS next_month,
        o_orderdate - INTERVAL 36 HOUR AS before FROM orders""",
)
def dateadd(inputs: Inputs) -> DataFrame:
    day = F.to_date("o_orderdate")
    return inputs("orders").select(
        "o_orderkey",
        dates.date_add_unit("day", 1, day).cast("date").alias("next_day"),
        dates.date_add_unit("month", 1, "o_orderdate").alias("next_month"),
        dates.date_add_unit("hour", -36, "o_orderdate").alias("before"),
    )


@query(
    "fn_5_datediff",
    """SELECT o_orderkey, date_diff('day', o_orderdate, TIMESTAMP '2001-08-02 12:00:00') AS days,
       date_diff('month', o_orderdate, TIMESTAMP '2001-08-02 12:00:00') AS months,
       date_diff('year', o_orderdate, TIMESTAMP '2001-08-02 12:00:00') AS years,
       date_sub('month', o_orderdate, TIMESTAMP '2001-08-02 12:00:00') AS whole_months FROM orders""",
)
def datediff(inputs: Inputs) -> DataFrame:
    """Boundaries crossed, and whole months that have passed."""
    end = F.lit("2001-08-02 12:00:00").cast("timestamp_ntz")
    return inputs("orders").select(
        "o_orderkey",
        *[dates.boundaries_between(u, "o_orderdate", end).alias(f"{u}s") for u in ("day", "month", "year")],
        dates.elapsed("month", "o_orderdate", end).alias("whole_months"),
    )


@query(
    "fn_6_last_day",
    f"""SELECT o_orderkey, last_day({DAY}) AS month_end,
        CAST(date_trunc('quarter', {DAY}) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end,
        CAST(date_trunc('year', {DAY}) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS year_end FROM orders""",
)
def last_day(inputs: Inputs) -> DataFrame:
    periods = ("month", "quarter", "year")
    ends = [dates.last_day_of(p, "o_orderdate").alias(f"{p}_end") for p in periods]
    return inputs("orders").select("o_orderkey", *ends)


@query(
    "fn_7_date_trunc",
    f"""SELECT event_id, date_trunc('hour', ts) AS hour_start, CAST(date_trunc('month', ts) AS TIMESTAMP) AS month_start,
        CAST(ts AS DATE) AS day, make_date(CAST(year(ts) AS INTEGER), CAST(month(ts) AS INTEGER), 1) AS first_of_month FROM events""",
)
def date_trunc(inputs: Inputs) -> DataFrame:
    return inputs("events").select(
        "event_id",
        dates.truncate("hour", "ts").alias("hour_start"),
        dates.truncate("month", "ts").alias("month_start"),
        F.to_date("ts").alias("day"),
        F.make_date(F.year("ts"), F.month("ts"), F.lit(1)).alias("first_of_month"),
    )


@query(
    "fn_8_zone_conversion",
    """SELECT event_id, ts + INTERVAL 330 MINUTE AS kolkata, ts - INTERVAL 5 HOUR AS new_york FROM events""",
)
def zone_conversion(inputs: Inputs) -> DataFrame:
    """UTC wall-clock times in two zones; the events are all in winter time."""
    return inputs("events").select(
        "event_id",
        dates.to_zone("ts", "UTC", "Asia/Kolkata").alias("kolkata"),
        dates.to_zone("ts", "UTC", "America/New_York").alias("new_york"),
    )


@query(
    "fn_9_calendar_names",
    f"""SELECT o_orderkey, strftime({DAY}, '%a') AS d3, strftime({DAY}, '%A') AS d_long, strftime({DAY}, '%b') AS m3,
        strftime({DAY}, '%B') AS m_long, CAST(date_trunc('week', {DAY}) AS DATE) AS iso_start,
        CAST(date_trunc('week', {DAY} + 1) AS DATE) - 1 AS sunday, CAST(date_trunc('week', {DAY} + 1) AS DATE) + 5 AS saturday,
        CAST(weekofyear({DAY}) AS INTEGER) AS iso_week, CAST((dayofyear({DAY}) - 1) // 7 + 1 AS INTEGER) AS week FROM orders""",
)
def calendar_names(inputs: Inputs) -> DataFrame:
    d = "o_orderdate"
    return inputs("orders").select(
        "o_orderkey",
        dates.day_name(d).alias("d3"),
        dates.day_name(d, short=False).alias("d_long"),
        dates.month_name(d).alias("m3"),
        dates.month_name(d, short=False).alias("m_long"),
        dates.iso_week_start(d).alias("iso_start"),
        dates.week_start(d).alias("sunday"),
        dates.week_end(d).alias("saturday"),
        dates.iso_week_of_year(d).alias("iso_week"),
        dates.week_of_year(d).alias("week"),
    )


@query(
    "fn_10_timestamp_text",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS to_second, strftime(ts, '%d/%m/%Y') AS day_first,
       CAST(date_trunc('second', ts) AS VARCHAR) AS no_fraction, rtrim(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '0') AS full_text
       FROM events""",
)
def timestamp_text(inputs: Inputs) -> DataFrame:
    return inputs("events").select(
        "event_id",
        dates.format_timestamp("ts").alias("to_second"),
        dates.format_timestamp("ts", "dd/MM/yyyy").alias("day_first"),
        dates.timestamp_text(dates.truncate("second", "ts")).alias("no_fraction"),
        dates.timestamp_text("ts").alias("full_text"),
    )


@query(
    "fn_11_current_instant",
    """SELECT count(*) AS n, count(*) FILTER (WHERE ts < current_timestamp::TIMESTAMP) AS before_now,
       count(*) AS before_local, count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-15') AS before_as_of FROM events""",
)
def current_instant(inputs: Inputs) -> DataFrame:
    """Events before now, and before a stated instant, which is what repeatable queries use."""
    return inputs("events").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("ts") < dates.utc_now()).alias("before_now"),
        F.count_if(F.col("ts") < dates.local_now()).alias("before_local"),
        F.count_if(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")).alias("before_as_of"),
    )


@query(
    "fn_12_concat_skips_nulls",
    """SELECT c_custkey, concat(c_name, CASE WHEN c_acctbal < 0 THEN NULL ELSE '+' END, c_nationkey) AS tag FROM customer""",
)
def concat(inputs: Inputs) -> DataFrame:
    sign = F.when(F.col("c_acctbal") >= 0, "+")
    return inputs("customer").select("c_custkey", text.concat_text("c_name", sign, "c_nationkey").alias("tag"))


@query(
    "fn_13_text_functions",
    """SELECT c_custkey, CAST(length(c_name) AS INTEGER) AS n_chars, CAST(position('#' IN c_name) AS INTEGER) AS hash_at,
       replace(c_name, '#', ' no ') AS spelled, right(c_name, 3) AS last3, split_part(c_name, '#', 2) AS number,
       substring(c_mktsegment, 2, 4) AS middle FROM customer""",
)
def text_functions(inputs: Inputs) -> DataFrame:
    return inputs("customer").select(
        "c_custkey",
        F.length("c_name").alias("n_chars"),
        text.position("#", "c_name").alias("hash_at"),
        F.replace("c_name", F.lit("#"), F.lit(" no ")).alias("spelled"),
        F.right("c_name", F.lit(3)).alias("last3"),
        text.split_part("c_name", "#", 2).alias("number"),
        F.substring("c_mktsegment", 2, 4).alias("middle"),
    )


@query(
    "fn_14_string_literals",
    """SELECT c_custkey, 'it''s ' || c_name AS quoted, 'a\\b\\n' || c_mktsegment AS backslash FROM customer""",
)
def string_literals(inputs: Inputs) -> DataFrame:
    """Quotes and backslashes are ordinary characters of a literal."""
    return inputs("customer").select(
        "c_custkey",
        F.concat(F.lit("it's "), "c_name").alias("quoted"),
        F.concat(F.lit("a\\b\\n"), "c_mktsegment").alias("backslash"),
    )


@query("fn_15_hash", "SELECT doc_id, md5(text) AS text_hash, md5(CAST(doc_id AS VARCHAR)) AS id_hash FROM documents")
def hashes(inputs: Inputs) -> DataFrame:
    return inputs("documents").select(
        "doc_id", text.hash_text("text").alias("text_hash"), text.hash_text("doc_id").alias("id_hash")
    )


@query(
    "fn_16_surrogate_key",
    f"""SELECT p_partkey, md5(coalesce(p_brand, '{text.NULL_KEY_TEXT}') || '-' ||
        coalesce(nullif(p_type, 'PROMO'), '{text.NULL_KEY_TEXT}') || '-' || CAST(p_size AS VARCHAR)) AS part_key FROM part""",
)
def surrogate_key(inputs: Inputs) -> DataFrame:
    kind = F.nullif("p_type", F.lit("PROMO"))
    return inputs("part").select("p_partkey", text.surrogate_key("p_brand", kind, "p_size").alias("part_key"))


@query(
    "fn_17_regexp_instr",
    """SELECT doc_id, CAST(CASE WHEN m1 = '' THEN 0 ELSE p1 END AS INTEGER) AS first_number,
       CAST(CASE WHEN m2 = '' THEN 0 ELSE p1 + length(m1) - 1 + strpos(rest, m2) END AS INTEGER) AS second_number,
       CAST(CASE WHEN w = '' THEN 0 ELSE strpos(text, w) END AS INTEGER) AS the_word,
       CAST(CASE WHEN t = '' THEN 0 ELSE strpos(tail, t) + 20 END AS INTEGER) AS number_after_20
       FROM (SELECT *, regexp_extract(rest, '[0-9]+') AS m2 FROM (
         SELECT *, strpos(text, m1) AS p1, substr(text, strpos(text, m1) + length(m1)) AS rest FROM (
           SELECT doc_id, text, regexp_extract(text, '[0-9]+') AS m1, regexp_extract(text, '(?i)license') AS w,
             substr(text, 21) AS tail, regexp_extract(substr(text, 21), '[0-9]+') AS t FROM documents)))""",
)
def regexp_instr(inputs: Inputs) -> DataFrame:
    """Where the first and second number, a word in any case, and a later number begin."""
    return inputs("documents").select(
        "doc_id",
        text.regexp_instr("text", "[0-9]+").alias("first_number"),
        text.regexp_instr("text", "[0-9]+", occurrence=2).alias("second_number"),
        text.regexp_instr("text", "license", flags="i").alias("the_word"),
        text.regexp_instr("text", "[0-9]+", start=21).alias("number_after_20"),
    )


@query(
    "fn_18_numeric_functions",
    """SELECT l_orderkey, l_linenumber, l_partkey, abs(CAST(l_discount - 0.05 AS DECIMAL(10,4))) AS distance,
       round(CAST(l_extendedprice AS DECIMAL(12,2)), 0) AS whole_price,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) % 7 AS DOUBLE) AS price_mod FROM lineitem""",
)
def numeric_functions(inputs: Inputs) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    return inputs("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.abs((F.col("l_discount") - 0.05).cast("decimal(10,4)")).alias("distance"),
        F.round(price, 0).cast("decimal(12,0)").alias("whole_price"),
        (price % 7).cast("double").alias("price_mod"),
    )


LAT, LON = "(user_id % 180 - 90)", "(event_id % 360 - 180)"


@query(
    "fn_19_great_circle",
    f"""SELECT event_id, {r(f'''2 * 6371.0::DOUBLE * asin(sqrt(least(1.0, pow(sin((radians(40.0::DOUBLE) - radians({LAT})) / 2), 2)
        + cos(radians({LAT})) * cos(radians(40.0::DOUBLE)) * pow(sin((radians(-74.0::DOUBLE) - radians({LON})) / 2), 2))))''', 3)} AS km
        FROM events""",
)
def great_circle(inputs: Inputs) -> DataFrame:
    """Distances from coordinates made of the keys to one point."""
    lat, lon = F.col("user_id") % 180 - 90, F.col("event_id") % 360 - 180
    km = numbers.great_circle_km(lat, lon, F.lit(40.0), F.lit(-74.0))
    return inputs("events").select("event_id", numbers.rounded(km, 3).alias("km"))


@query(
    "fn_20_casts",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS BIGINT) AS as_bigint,
       CAST(l_linenumber AS SMALLINT) AS as_smallint, CAST(l_extendedprice AS DECIMAL(12,2)) AS as_numeric,
       CAST(l_linenumber AS DOUBLE) AS as_float, CAST(l_linenumber AS VARCHAR) AS as_text,
       CAST(l_discount > 0 AS VARCHAR) AS bool_text, CAST(CAST(l_shipdate AS VARCHAR) AS TIMESTAMP) AS round_trip,
       CAST(l_linenumber AS BOOLEAN) AS as_bool FROM lineitem""",
)
def casts(inputs: Inputs) -> DataFrame:
    return inputs("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_quantity").cast("bigint").alias("as_bigint"),
        F.col("l_linenumber").cast("smallint").alias("as_smallint"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("as_numeric"),
        F.col("l_linenumber").cast("double").alias("as_float"),
        F.col("l_linenumber").cast("string").alias("as_text"),
        (F.col("l_discount") > 0).cast("string").alias("bool_text"),
        F.col("l_shipdate").cast("string").cast("timestamp_ntz").alias("round_trip"),
        F.col("l_linenumber").cast("boolean").alias("as_bool"),
    )


@query(
    "fn_21_safe_cast",
    """SELECT c_custkey, TRY_CAST(c_mktsegment AS INTEGER) AS bad_int,
       TRY_CAST(split_part(c_name, '#', 2) AS INTEGER) AS good_int, TRY_CAST(c_name AS DATE) AS bad_date FROM customer""",
)
def safe_cast(inputs: Inputs) -> DataFrame:
    return inputs("customer").select(
        "c_custkey",
        numbers.safe_cast("c_mktsegment", "int").alias("bad_int"),
        numbers.safe_cast(text.split_part("c_name", "#", 2), "int").alias("good_int"),
        numbers.safe_cast("c_name", "date").alias("bad_date"),
    )


@query(
    "fn_22_coalesce_nullif_case",
    """SELECT p_partkey, nullif(p_type, 'PROMO') AS kind, coalesce(nullif(p_type, 'PROMO'), p_brand) AS kind_or_brand,
       CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS size_class FROM part""",
)
def coalesce_nullif_case(inputs: Inputs) -> DataFrame:
    kind = F.nullif("p_type", F.lit("PROMO"))
    size = F.when(F.col("p_size") < 10, "small").when(F.col("p_size") < 30, "medium").otherwise("large")
    return inputs("part").select(
        "p_partkey",
        kind.alias("kind"),
        F.coalesce(kind, "p_brand").alias("kind_or_brand"),
        size.alias("size_class"),
    )


@query(
    "fn_23_json_field",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.missing') AS missing
       FROM events""",
)
def json_field(inputs: Inputs) -> DataFrame:
    return inputs("events").select(
        "event_id",
        text.json_field("props", "$.k", "int").alias("k"),
        text.json_field("props", "$.missing").alias("missing"),
    )


@query(
    "fn_24_nan",
    """SELECT doc_id, x, x = 'nan'::DOUBLE AS is_nan, x > 1e300 AS above_all
       FROM (SELECT doc_id, CASE WHEN quality = 0 THEN 'nan'::DOUBLE ELSE quality END AS x FROM labels)""",
)
def nan(inputs: Inputs) -> DataFrame:
    """NaN stays in results, equals itself, and is larger than every number."""
    x = F.when(F.col("quality") == 0, F.lit(float("nan"))).otherwise(F.col("quality").cast("double"))
    return (
        inputs("labels")
        .select("doc_id", x.alias("x"))
        .select("doc_id", "x", (F.col("x") == float("nan")).alias("is_nan"), (F.col("x") > 1e300).alias("above_all"))
    )


@query(
    "fn_25_rounded_precision",
    """SELECT event_id, date_trunc('second', ts + INTERVAL 500000 MICROSECOND) AS to_second,
       date_trunc('millisecond', ts + INTERVAL 500 MICROSECOND) AS to_milli,
       date_trunc('minute', ts + INTERVAL 30 SECOND) AS to_minute FROM events""",
)
def rounded_precision(inputs: Inputs) -> DataFrame:
    return inputs("events").select(
        "event_id",
        dates.round_time("second", "ts").alias("to_second"),
        dates.round_time("millisecond", "ts").alias("to_milli"),
        dates.round_time("minute", "ts").alias("to_minute"),
    )
