from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from tidemark.functions import dates, numbers, text
from tidemark.operators import aggregates, joins, sets, staging, windows


def test_first_per_key_keeps_null_rows(spark):
    src = spark.createDataFrame([(1, None, 1), (1, None, 2), (2, "x", 1), (3, None, 1), (None, "n", 1), (None, "m", 4)], "id int, note string, v int")
    out = aggregates.first_per_key(src, ["id"], [F.col("v")])
    assert rows(out, "id", "v") == [(1, 2), (2, 1), (3, 1), (None, 4)]
    lowest = aggregates.first_per_key(src, ["id"], [F.col("v")], descending=False)
    assert rows(lowest, "id", "v") == [(1, 1), (2, 1), (3, 1), (None, 1)]


def test_first_per_key_keeps_one_row_per_task_before_the_shuffle(spark, tmp_path):
    spark.range(100).select((F.col("id") % 3).alias("k"), "id").write.parquet(f"{tmp_path}/t")
    out = aggregates.first_per_key(spark.read.parquet(f"{tmp_path}/t"), ["k"], [F.col("id")])
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text and text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1
    assert rows(out) == [(0, 99), (1, 97), (2, 98)]


def test_measures_of_one_rollup_are_joined_once(spark):
    dim = spark.createDataFrame([(1,), (2,)], "k int")
    rollup = spark.createDataFrame([(1, 5, 0.5)], "f int, n int, v double")
    out = joins.with_activity(dim, "k", {"n": (rollup, "f"), "v": (rollup, "f")})
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    assert rows(out) == [(1, 5, 0.5), (2, 0, 0.0)]


def test_first_per_key_puts_null_order_last(spark):
    src = spark.createDataFrame([(1, None), (1, 5), (1, 3)], "id int, v int")
    assert rows(aggregates.first_per_key(src, ["id"], [F.col("v")])) == [(1, 5)]
    assert rows(aggregates.first_per_key(src, ["id"], [F.col("v")], descending=False)) == [(1, 3)]


def hot(spark, n=3000):
    """A third and more of the rows in one key, some in a NULL key, and ties in time."""
    key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 20 + 2)
    at = F.timestamp_add("SECOND", (F.col("id") * 7919 % n * 60).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz"))
    value = F.when(F.col("id") % 5 == 0, (F.col("id") % 97).cast("double"))
    return spark.range(n).select("id", key.alias("k"), at.alias("ts"), value.alias("v"))


@pytest.mark.parametrize("limit", [1, 10, 10**9])
def test_numbering_and_filling_do_not_depend_on_the_buckets(spark, limit):
    df = hot(spark)
    bucket = windows.time_bucket(df, ["k"], "ts", max_rows=limit)
    assert (bucket is None) == (limit == 10**9)
    w = Window.partitionBy("k").orderBy("ts", "id")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    plain = df.select("id", F.row_number().over(w).cast("bigint").alias("n"), F.last("v", True).over(upto).alias("f"))
    ours = windows.numbered(df, ["k"], ["ts", "id"], bucket, "n")
    ours = windows.fill_forward(ours, ["k"], ["ts", "id"], bucket, "v", "f")
    assert sets.bag_difference(plain, ours.select("id", "n", "f")).count() == 0


@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_percentiles_are_exact(spark, accuracy):
    df = hot(spark).where("v IS NOT NULL")
    found = aggregates.exact_percentiles(
        df, ["k"], "v", {"p50": 0.5, "p0": 0.0, "p99": 0.99}, {"d25": 0.25, "d100": 1.0}, accuracy=accuracy
    )
    groups: dict = {}
    for k, v in df.select("k", "v").collect():
        groups.setdefault(k, []).append(v)
    got = {r["k"]: r for r in found.collect()}
    assert set(got) == set(groups)
    for k, values in groups.items():
        for name, p in (("p50", 0.5), ("p0", 0.0), ("p99", 0.99)):
            assert got[k][name] == pytest.approx(np.percentile(values, p * 100), abs=1e-9)
        assert got[k]["d25"] == np.percentile(values, 25, method="inverted_cdf")
        assert got[k]["d100"] == max(values)


def test_most_common_breaks_ties(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("a", 2), ("a", 1), ("b", None), ("b", 3)], "k string, v int")
    assert rows(aggregates.most_common(df, ["k"], "v", "m")) == [("a", 1), ("b", 3)]


def test_exact_sums(spark):
    df = spark.range(10_000).select(((F.col("id") * 37 % 1000) / 100).alias("x"), (F.col("id") % 3).alias("k"))
    negative = df.select((-F.col("x")).alias("x"), "k").union(df.where("k = 1"))
    a = negative.groupBy("k").agg(numbers.exact_sum("x").alias("s"))
    b = negative.repartition(7, "x").groupBy("k").agg(numbers.exact_sum("x").alias("s"))
    assert rows(a) == rows(b)
    plain = negative.groupBy("k").agg(F.sum(F.col("x").cast("decimal(18,2)")).cast("double").alias("s"))
    assert rows(a) == rows(plain)
    huge = spark.range(4).select(F.lit(4 * 10**18).alias("u"))
    assert huge.agg(numbers.sum_units("u", 0).cast("string")).first()[0] == str(16 * 10**18)
    assert spark.createDataFrame([], "x double").agg(numbers.exact_sum("x")).first()[0] is None


def doubles(kind, n, draw):
    """Values of one kind: money, tiny, of all sizes, nearly cancelling, halfway cases, the ends of the range."""
    if kind == "money":
        return [round(draw.uniform(-1000, 1000), 2) for _ in range(n)]
    if kind == "tiny":
        return [0.000009] * n + [draw.randrange(1000) * 1e-15 for _ in range(n)]
    if kind == "sizes":
        return [math.ldexp(draw.uniform(-1, 1), draw.randrange(-1074, 1000)) for _ in range(n)]
    if kind == "cancelling":
        held = [math.ldexp(draw.random(), draw.randrange(-60, 60)) for _ in range(n)]
        return held + [-x * (1 + 2**-40) for x in held]
    if kind == "halfway":
        return [2.0**53, 1.0, draw.choice([2.0**-60, 0.0, -(2.0**-60)]), draw.choice([2.0, 0.0])] * draw.choice([1, 3])
    return [5e-324] * draw.randrange(1, 5) + [draw.choice([2.0**-1022, -(2.0**-1074), 1.7e308, -1.7e308, 2.0**24, 2.0**-24, 0.0, -0.0, 2.0**48 - 1])]


def test_exact_totals_of_any_doubles(spark):
    """Equal to the correctly rounded sum, under three partitionings."""
    draw = random.Random(9)
    groups = {}
    for i in range(120):
        kind = ("money", "tiny", "sizes", "cancelling", "halfway", "ends")[i % 6]
        groups[f"{kind}{i}"] = doubles(kind, draw.randrange(1, 60), draw)
    data = [(k, v) for k, values in groups.items() for v in values]
    df = spark.createDataFrame(data, "k string, v double")
    want = {k: math.fsum(values) for k, values in groups.items()}
    for spread in (df, df.repartition(7, "v"), df.coalesce(1)):
        got = {r.k: (r.total, r.mean) for r in aggregates.exact_totals(spread, ["k"], {"total": "v"}, {"mean": "v"}).collect()}
        assert {k: t for k, (t, _) in got.items()} == want
        assert all(mean == want[k] / len(groups[k]) for k, (_, mean) in got.items())


def test_exact_totals_of_odd_values(spark):
    inf, nan = float("inf"), float("nan")
    groups = {
        "nan": [1.0, nan],
        "both": [inf, -inf],
        "up": [inf, 1.0, None],
        "down": [-inf, -inf],
        "none": [None, None],
        "zero": [-0.0, 0.0],
        "over": [1.7e308, 1.7e308],
        "back": [1.7e308, 1.7e308, -1.7e308, None],
        None: [1.5],
    }
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double")
    got = {r.k: r.t for r in aggregates.exact_totals(df, ["k"], {"t": "v"}).collect()}
    assert math.isnan(got.pop("nan")) and math.isnan(got.pop("both"))
    assert got == {"up": inf, "down": -inf, "none": None, "zero": 0.0, "over": inf, "back": 1.7e308, None: 1.5}
    assert aggregates.exact_totals(df.limit(0), ["k"], {"t": "v"}).collect() == []
    assert aggregates.exact_totals(df.where("k = 'up'"), [], {"t": "v", "u": F.lit(0.1)}).first() == (inf, math.fsum([0.1] * 3))


def test_declared_decimals_and_values_that_are_not_finite(spark):
    tiny = spark.range(1000).select(F.lit(0.000009).alias("v"))
    with pytest.raises(Exception, match="more than 2 decimals"):
        tiny.agg(numbers.exact_sum("v")).collect()
    assert tiny.agg(numbers.exact_sum("v", 6)).first()[0] == 0.009
    with pytest.raises(Exception, match="too large"):
        spark.range(1).select(F.lit(1e17).alias("v")).agg(numbers.exact_sum("v")).collect()
    for value in (float("nan"), float("inf"), float("-inf")):
        df = spark.createDataFrame([(1.5,), (value,), (None,)], "v double")
        assert str(df.agg(numbers.exact_sum("v")).first()[0]) == str(value)


def test_rounding_and_ratios(spark):
    one = spark.range(1)
    pick = lambda c: one.select(c).first()[0]
    assert pick(numbers.rounded(F.lit(1.17) / F.lit(24.0), 4)) == 0.0488
    assert pick(numbers.rounded(F.lit(-1.005), 2)) == -1.01
    assert pick(numbers.ratio(F.lit(1), F.lit(0))) is None
    assert pick(numbers.guarded_pct(F.lit(1.0), F.lit(0.0))) is None
    assert pick(numbers.guarded_pct(F.lit(1.0), F.lit(3.0))) == 33.33


def test_powers_of_two(spark):
    df = spark.createDataFrame([(i,) for i in (0, 1, 2, 3, 4, 5, 8, 9, 1024, 1025)], "x long")
    got = dict(rows(df.select("x", numbers.powers_of_two("x"))))
    assert got == {0: 1, 1: 1, 2: 1, 3: 2, 4: 2, 5: 3, 8: 3, 9: 4, 1024: 10, 1025: 11}


def test_frame_exclusions_with_nulls_and_ties(spark):
    df = spark.createDataFrame([(1, 1, 10.0), (2, 1, None), (3, 2, 30.0), (4, 2, 50.0)], "id int, o int, v double")
    frame = Window.orderBy("o").rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    peers = Window.partitionBy("o")
    out = df.select(
        "id",
        windows.avg_excluding_row("v", frame),
        windows.avg_excluding_peers("v", frame, peers, keep_self=False),
        windows.avg_excluding_peers("v", frame, peers, keep_self=True),
    )
    assert rows(out) == [(1, 40.0, 40.0, 30.0), (2, 30.0, 40.0, 40.0), (3, 30.0, 10.0, 20.0), (4, 20.0, 10.0, 30.0)]


def test_top_ranked_keeps_ties(spark):
    df = spark.createDataFrame([("a", "x", 3), ("a", "y", 3), ("a", "z", 1), ("b", "w", 0)], "g string, n string, c int")
    out = windows.top_ranked(df, ["g"], [F.col("c").desc()], 1, "r")
    assert rows(out, "n", "r") == [("w", 1), ("x", 1), ("y", 1)]


def test_zscore_of_equal_values_is_null(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0)], "d int, v double")
    assert rows(windows.zscores(df, "v", "z"), "z") == [(None,), (None,)]


def test_greater_than_all(spark):
    left = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    some = spark.createDataFrame([(1,), (3,)], "y int")
    with_null = spark.createDataFrame([(1,), (None,)], "y int")
    assert rows(staging.greater_than_all(left, "x", some, "y")) == [(5,)]
    assert rows(staging.greater_than_all(left, "x", with_null, "y")) == []
    assert staging.greater_than_all(left, "x", some.limit(0), "y").count() == 3


def test_semi_and_anti_joins_with_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    right = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(staging.rows_in(left, right, ["k"]), "v") == [("a",)]
    assert rows(staging.rows_not_in(left, right, ["k"]), "v") == [("b",), ("n",)]


def test_lookup_defaults_and_roles(spark):
    facts = spark.createDataFrame([(1, 2), (2, None), (9, 1)], "a int, b int")
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "id int, name string")
    out = joins.lookup(facts, dim, {"a": "id"}, {"name": "a_name"}, {"a_name": joins.UNKNOWN})
    out = joins.lookup(out, dim, {"b": "id"}, {"name": "b_name"})
    assert rows(out, "a_name", "b_name") == [("Unknown", "one"), ("one", "two"), ("two", None)]


def test_natural_join_needs_a_shared_column(spark):
    with pytest.raises(ValueError):
        joins.natural(spark.range(1), spark.range(1).withColumnRenamed("id", "x"))


def test_bag_difference_counts_copies(spark):
    left = spark.createDataFrame([(1,), (1,), (None,)], "x int")
    right = spark.createDataFrame([(1,), (None,), (2,)], "x int")
    assert rows(sets.bag_difference(left, right)) == [(1, 2, 1), (2, 0, 1)]


def test_date_spine(spark):
    assert sets.date_spine(spark, "2019-01-01", "2019-02-01").count() == 31
    assert sets.date_spine(spark, "2019-01-01", "2019-04-01", "month").count() == 3
    assert rows(sets.series(spark, 3)) == [(1,), (2,), (3,)]


def test_spine_of_seen_days(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-04",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert sets.spine_of(df, "t").count() == 4
    assert sets.spine_of(df.limit(0), "t").count() == 0


def pick(spark, column):
    return spark.range(1).select(column).first()[0]


def test_cross_dialect_functions(spark):
    d = lambda t: F.lit(t).cast("date")
    assert str(pick(spark, dates.date_add_unit("day", 1, d("2019-01-31")).cast("date"))) == "2019-02-01"
    assert pick(spark, dates.boundaries_between("day", d("2019-01-01"), d("2019-02-01"))) == 31
    assert pick(spark, dates.boundaries_between("day", d("2023-09-01"), d("2023-09-12"))) == 11
    assert str(pick(spark, dates.last_day_of("month", d("2019-02-10")))) == "2019-02-28"
    assert str(pick(spark, dates.last_day_of("quarter", d("2019-02-10")))) == "2019-03-31"
    assert pick(spark, numbers.safe_cast(F.lit("not a number"), "int")) is None
    assert pick(spark, numbers.safe_cast(F.lit("42"), "int")) == 42


def test_listagg(spark):
    df = spark.createDataFrame([(1, "b, c"), (1, "a"), (1, "a"), (1, None)], "k int, v string")
    assert rows(aggregates.ordered_list(df, ["k"], "v", "', '", "l")) == [(1, "a', 'b, c")]


def test_boundaries_and_elapsed(spark):
    a, b = (F.lit(t).cast("timestamp_ntz") for t in ("2023-12-31 23:59:00", "2024-01-01 00:01:00"))
    for unit in ("day", "month", "year", "hour"):
        assert pick(spark, dates.boundaries_between(unit, a, b)) == 1
        assert pick(spark, dates.elapsed(unit, a, b)) == 0
        assert pick(spark, dates.boundaries_between(unit, b, a)) == -1


def test_weeks(spark):
    day = F.lit("2024-03-03").cast("date")  # a Sunday
    assert str(pick(spark, dates.week_start(day))) == "2024-03-03"
    assert str(pick(spark, dates.week_end(day))) == "2024-03-09"
    assert str(pick(spark, dates.iso_week_start(day))) == "2024-02-26"
    assert pick(spark, dates.iso_weekday(day)) == 7
    assert pick(spark, dates.iso_week_of_year(day)) == 9
    assert (pick(spark, dates.day_name(day, False)), pick(spark, dates.month_name(day))) == ("Sunday", "Mar")


def test_time_rounding(spark):
    t = F.lit("2024-01-01 00:00:59.5").cast("timestamp_ntz")
    assert str(pick(spark, dates.round_time("second", t))) == "2024-01-01 00:01:00"
    assert str(pick(spark, dates.round_time("minute", t))) == "2024-01-01 00:01:00"


def test_day_parts(spark):
    hours = {5: "overnight", 6: "morning rush", 9: "morning rush", 10: "midday", 15: "midday", 16: "evening rush", 19: "evening rush", 20: "night", 23: "night"}
    for h, part in hours.items():
        assert pick(spark, dates.day_part(F.lit(f"2024-01-01 {h:02d}:59:59").cast("timestamp_ntz"))) == part


@pytest.mark.parametrize(
    "value,pattern,kwargs,want",
    [
        ("abc 12 345", "[0-9]+", {}, 5),
        ("abc 12 345", "[0-9]+", {"occurrence": 2}, 8),
        ("abc 12", "[0-9]+", {"occurrence": 2}, 0),
        ("aaaa", "aaaa|a", {"occurrence": 2}, 0),
        ("a1b2c3", "[0-9]", {"occurrence": 3}, 6),
        ("a1b2c3", "[0-9]", {"start": 3, "occurrence": 2}, 6),
        ("Hello", "hello", {}, 0),
        ("Hello", "hello", {"flags": "i"}, 1),
        ("Hello", "hello", {"flags": "c"}, 0),
        ("a.b", ".", {"flags": "q"}, 2),
        ("x\ny", "x.y", {}, 1),
        ("x\ny", "x.y", {"flags": "n"}, 0),
        ("x\ny", "^y", {}, 0),
        ("x\ny", "^y", {"flags": "m"}, 3),
        ("x\ny", "^y", {"flags": "w"}, 3),
        ("abc abc", "^bc", {"start": 2}, 0),
        ("abc abc", "bc$", {"start": 2}, 6),
        ("abc", "c", {"start": 9}, 0),
        ("xab ab", "(?<=x)ab", {"start": 2}, 2),
        ("aa bb cc", r"(.)\1", {"occurrence": 2}, 4),
        ("aa bb cc", r"(.)\1", {"start": 2, "occurrence": 2}, 7),
        ("a(b a(b", "(b", {"flags": "q", "occurrence": 2}, 6),
        ("abab cdcd", r"((.)(.))\1", {"occurrence": 2}, 6),
        ("aa bb cc", r"(?<x>.)\k<x>", {"occurrence": 2}, 4),
        ("aa bb cc", r"(?<x>.)\k<x>", {"start": 2, "occurrence": 2}, 7),
        ("abab cdcd", r"(?<p>(?<q>.)(.))\k<p>", {"occurrence": 2}, 6),
        ("xyyx abba", r"(.)(?<in>.)\k<in>\1", {"occurrence": 2}, 6),
        ("k<x> k<x>", r"k<x>", {"occurrence": 2}, 6),
        (None, "a", {}, None),
        (None, "a", {"occurrence": 2}, None),
    ],
)
def test_regexp_instr(spark, value, pattern, kwargs, want):
    df = spark.createDataFrame([(value,)], "s string")
    assert df.select(text.regexp_instr("s", pattern, **kwargs)).first()[0] == want


@pytest.mark.parametrize("day,week", [("2023-01-01", 1), ("2023-01-07", 1), ("2023-01-08", 2), ("2024-12-31", 53), (None, None)])
def test_week_counts_from_the_first_of_january(spark, day, week):
    df = spark.createDataFrame([(day,)], "d string")
    assert df.select(dates.week_of_year(F.to_date("d"))).first()[0] == week


def test_exact_sums_refuse_more_decimals_than_stated(spark):
    df = spark.createDataFrame([(0.004,)] * 3, "v double")
    assert df.select(numbers.exact_sum("v", 3)).first()[0] == 0.012
    with pytest.raises(Exception, match="more than 2 decimals"):
        df.select(numbers.exact_sum("v")).collect()
    large = spark.createDataFrame([(123456789012.25,), (-0.25,), (None,)], "v double")
    assert large.select(numbers.exact_sum("v")).first()[0] == 123456789012.0


def test_regexp_instr_refuses(spark):
    with pytest.raises(ValueError):
        text.regexp_instr("s", "a", flags="z")
    with pytest.raises(ValueError):
        text.regexp_instr("s", "a", occurrence=0)


def test_text(spark):
    df = spark.createDataFrame([("a", None, ""), ("a", "", None)], "x string, y string, z string")
    keys = {r[0] for r in df.select(text.surrogate_key("x", "y", "z")).collect()}
    assert len(keys) == 2
    assert [r[0] for r in df.select(text.concat_text("x", "y", "z")).collect()] == ["a", "a"]
    assert pick(spark, text.split_part(F.lit("a|b|c"), "|", 2)) == "b"
    assert pick(spark, text.split_part(F.lit("a|b|c"), "|", 9)) == ""
    assert pick(spark, text.position("c", F.lit("abc"))) == 3
    assert pick(spark, text.json_field(F.lit('{"k": "x"}'), "$.k", "int")) is None
    assert pick(spark, text.json_field(F.lit("not json"), "$.k")) is None
    assert pick(spark, text.hash_text(F.lit("a"))) == "0cc175b9c0f1b6a831c399e269772661"


def test_constant_comparison_is_not_pushed_wrongly(spark, inputs):
    assert inputs("part").where(F.col("p_size") > 1.5).count() == inputs("part").where(F.col("p_size") >= 2).count()


def test_great_circle(spark):
    km = pick(spark, numbers.great_circle_km(F.lit(40.6413), F.lit(-73.7781), F.lit(51.4700), F.lit(-0.4543)))
    assert km == pytest.approx(5540, abs=15)


def test_differences_and_cuts_ignore_the_session_zone(spark):
    """02:30 does not exist on the night the clocks go forward in New York."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        gap, noon = (F.lit(t).cast("timestamp_ntz") for t in ("2024-03-10 02:30:00.25", "2024-03-11 12:00:00"))
        assert str(pick(spark, dates.truncate("hour", gap))) == "2024-03-10 02:00:00"
        assert str(pick(spark, dates.truncate("millisecond", gap))) == "2024-03-10 02:30:00.250000"
        assert pick(spark, dates.elapsed("hour", gap, noon)) == 33
        assert pick(spark, dates.elapsed("hour", noon, gap)) == -33
        assert pick(spark, dates.minutes_between(gap, noon)) == 2010.0
        assert pick(spark, dates.boundaries_between("hour", gap, noon)) == 34
        assert pick(spark, dates.boundaries_between("week", gap, noon)) == 1
        assert pick(spark, dates.boundaries_between("quarter", noon, gap)) == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
