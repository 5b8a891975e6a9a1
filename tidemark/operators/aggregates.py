"""Aggregations that need more than ``groupBy().agg()``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], descending: bool = True) -> DataFrame:
    """One whole row per key, the one with the largest (or smallest) order values.

    Rows with NULLs are kept, NULL keys form a group like any other, and a
    NULL order value comes last. The limit on the row number is applied in
    every task before the shuffle, one row per key, so a hot key costs nothing
    extra. The order should be total.
    """
    last = [c.desc_nulls_last() if descending else c.asc_nulls_last() for c in order]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*last))
    return df.withColumn("__place", place).where(F.col("__place") == 1).drop("__place")


def ordered_list(df: DataFrame, keys: Sequence[str], value: str, delimiter: str, name: str) -> DataFrame:
    """The distinct values of each group as one text, in value order.

    Copies are dropped before the text is put together, so a group costs its
    number of different values and not its number of rows.
    """
    distinct = df.select(*keys, value).distinct()
    quoted = delimiter.replace("'", "''")
    return distinct.groupBy(*keys).agg(
        F.expr(f"listagg({value}, '{quoted}') WITHIN GROUP (ORDER BY {value})").alias(name)
    )


# Doubles are added in digits of so many bits: a value has four, and 2^36 (7 * 10^10)
# values of one size can be added in bigints.
DIGIT = 24


def exact_totals(
    df: DataFrame, keys: Sequence[str], totals: Mapping[str, str | Column], averages: Mapping[str, str | Column] | None = None
) -> DataFrame:
    """SUM and AVG of any doubles per group, correctly rounded, so the same in whatever order and partitioning.

    Every value is cut into four whole digits of 24 bits below its own power of 2^24.
    Groups are added per power first, in bigints and in parts, and have a few dozen
    powers at most; then the digits of a group are put together once, with carries, and
    rounded once, half to even. All in built-in expressions.

    NULLs are skipped, a group without values has NULL. NaN, or infinities of both signs,
    give NaN, else an infinity gives itself, as in plain addition; so does a total beyond
    the doubles. An average is the rounded total divided by the count.
    """
    measures = [*totals.items(), *(averages or {}).items()]
    each = [F.struct(F.lit(i).alias("__m"), (F.col(c) if isinstance(c, str) else c).cast("double").alias("__v")) for i, (_, c) in enumerate(measures)]
    rows = df.select(*keys, F.inline(F.array(*each)))
    size = F.abs("__v")
    finite = size < float("inf")
    power = F.when(finite, F.when(size > 0, F.floor(F.log2(size) / DIGIT)).otherwise(0).cast("int"))
    # Two steps of half the power: one could pass the range of doubles. Both are exact.
    half = F.pow(F.lit(2.0), F.col("__p") * (-DIGIT // 2))
    rows = rows.withColumn("__p", power).withColumn("__r", F.when(F.col("__p").isNotNull(), size * half * half))
    names = [f"__d{i}" for i in range(4)]
    for name in names:
        rows = rows.withColumn(name, F.floor("__r")).withColumn("__r", (F.col("__r") - F.col(name)) * 2.0**DIGIT)
    signed = [F.sum(F.when(F.col("__v") < 0, -F.col(n)).otherwise(F.col(n))).alias(n) for n in names]
    odd = F.sum(F.when(~finite, F.col("__v"))).alias("__odd")
    by_power = rows.groupBy(*keys, "__m", "__p").agg(*signed, odd, F.count("__v").alias("__n"))
    parts = F.collect_list(F.when(F.col("__p").isNotNull(), F.struct("__p", *names)))
    groups = by_power.groupBy(*keys, "__m").agg(parts.alias("__parts"), F.sum("__odd").alias("__odd"), F.sum("__n").alias("__n"))
    done = _put_together(groups)
    done = done.withColumn("__avg", F.col("__total") / F.col("__n"))
    picked = [F.max(F.when(F.col("__m") == i, F.col("__total" if i < len(totals) else "__avg"))).alias(name) for i, (name, _) in enumerate(measures)]
    return done.groupBy(*keys).agg(*picked)


def _put_together(groups: DataFrame) -> DataFrame:
    """``__total`` from the digit sums per power in ``__parts``."""
    mask, zero = 2**DIGIT - 1, F.lit(0).cast("bigint")
    powers = F.transform("__parts", lambda p: p["__p"])
    # Three more digits above for the carries.
    df = groups.withColumn("__low", F.array_min(powers) - 3).withColumn("__high", F.array_max(powers) + 3)

    def at(b: Column) -> Column:
        term = lambda p: sum((F.when(p["__p"] == b + i, p[f"__d{i}"]).otherwise(zero) for i in range(1, 4)), F.when(p["__p"] == b, p["__d0"]).otherwise(zero))
        return F.aggregate("__parts", zero, lambda s, p: s + term(p))

    def carried(sums: Column) -> Column:
        start = F.struct(zero.alias("carry"), F.array().cast("array<bigint>").alias("digits"))

        def step(a: Column, t: Column) -> Column:
            x = a["carry"] + t
            return F.struct(F.shiftright(x, DIGIT).alias("carry"), F.concat(a["digits"], F.array(x.bitwiseAND(mask))).alias("digits"))

        return F.aggregate(sums, start, step)

    df = df.withColumn("__sums", F.when(F.size("__parts") > 0, F.transform(F.sequence("__low", "__high"), at)))
    df = df.withColumn("__plus", carried(F.col("__sums")))
    negative = F.col("__plus.carry") < 0
    df = df.withColumn("__digits", F.when(negative, carried(F.transform("__sums", lambda t: -t))["digits"]).otherwise(F.col("__plus.digits")))
    df = df.withColumn("__top", F.array_max(F.transform("__digits", lambda d, i: F.when(d != 0, i))))
    digit = lambda i: F.coalesce(F.get("__digits", F.col("__top") - i), zero).cast("decimal(20,0)")
    below = F.array_max(F.transform("__digits", lambda d, i: F.when((i < F.col("__top") - 3) & (d != 0), 1).otherwise(0)))
    # The four highest digits, and one bit that stands for all below: enough to round once.
    lead = ((digit(0) * 2**DIGIT + digit(1)) * 2**DIGIT + digit(2)).cast("decimal(25,0)") * F.lit(Decimal(2 ** (DIGIT + 1)))
    whole = (lead + digit(3) * 2 + below).cast("double")
    shift = (F.col("__low") + F.col("__top") - 3) * DIGIT - 1
    first = F.floor(shift / 2)
    size = whole * F.pow(F.lit(2.0), first) * F.pow(F.lit(2.0), shift - first)
    total = F.when(F.col("__top").isNull(), 0.0).when(negative, -size).otherwise(size)
    return df.withColumn("__total", F.when(F.col("__odd").isNotNull(), F.col("__odd")).when(F.size("__parts") > 0, total))


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """How often each value occurs in each group; NULLs are left out."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__n"))


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    continuous: Mapping[str, float],
    discrete: Mapping[str, float],
    measures: Sequence[tuple[str, Column]] = (),
    mode: str | None = None,
    accuracy: int = 10_000,
    slices: int = 128,
) -> DataFrame:
    """Exact percentiles per group without bringing a group into one task.

    A quantile sketch, made in parts, brackets each wanted percentile: its rank
    error is at most 1/accuracy of the rows, and the bracket reaches four times
    as far on each side. A group of up to ``accuracy`` rows is taken whole.
    Equal values are counted, the values below a bracket are only added up, and
    the few inside are cut into value slices and ranked there. A percentile is
    the value whose range of positions holds the wanted position; a continuous
    one lies between two. NULL values are left out.
    """
    wanted = [*continuous.values(), *discrete.values()]
    margin = 4 / accuracy
    points = [min(max(q, 0.0), 1.0) for p in wanted for q in (p - margin, p + margin)]
    known = df.where(F.col(value).isNotNull()).select(F.struct(*keys).alias("__key"), F.col(value).alias("v"))
    sketch = known.groupBy("__key").agg(
        F.percentile_approx("v", points, accuracy).alias("__b"),
        F.min("v").alias("__min"),
        F.max("v").alias("__max"),
        F.count("*").alias("__total"),
        *[measure.alias(name) for name, measure in measures],
    )
    small = F.col("__total") <= accuracy
    brackets = F.array(
        *[
            F.struct(
                F.lit(i).alias("i"),
                F.when(small, F.col("__min")).otherwise(F.col("__b")[2 * i]).alias("lo"),
                F.when(small, F.col("__max")).otherwise(F.col("__b")[2 * i + 1]).alias("hi"),
            )
            for i in range(len(wanted))
        ]
    )
    counts = known.groupBy("__key", "v").agg(F.count("*").alias("__n"))
    paired = counts.join(sketch, "__key").select("__key", "v", "__n", "__total", F.inline(brackets))
    depth = F.try_divide((F.col("v") - F.col("lo")).cast("double"), (F.col("hi") - F.col("lo")).cast("double"))
    cut = F.when(F.col("v") < F.col("lo"), -1).otherwise(F.coalesce(F.floor(depth * slices), F.lit(0)))
    sliced = paired.where(F.col("v") <= F.col("hi")).withColumn("__group", F.struct("__key", "i", cut.alias("slice")))
    # Running totals go through the slices first: one small row for each.
    order = Window.partitionBy("__group.__key", "__group.i").orderBy("__group.slice")
    totals = sliced.groupBy("__group").agg(F.sum("__n").alias("__rows"))
    starts = totals.select("__group", (F.sum("__rows").over(order) - F.col("__rows")).alias("__start"))
    inside = sliced.where(F.col("__group.slice") >= 0).withColumn(
        "__upto", F.sum("__n").over(Window.partitionBy("__group").orderBy("v"))
    )
    placed = inside.join(starts, "__group").withColumn("__last", F.col("__start") + F.col("__upto"))

    def at(i: int, position: Column) -> Column:
        here = (F.col("__last") - F.col("__n") <= position) & (position < F.col("__last"))
        return F.max(F.when((F.col("i") == i) & here, F.col("v")))

    found, out = [], [F.col(f"__key.{k}").alias(k) for k in keys]
    for i, (name, p) in enumerate(continuous.items()):
        place = (F.col("__total") - 1) * F.lit(p)
        found += [at(i, F.floor(place)).alias(f"lo_{name}"), at(i, F.ceil(place)).alias(f"hi_{name}")]
        lo, hi = F.col(f"lo_{name}"), F.col(f"hi_{name}")
        out.append((lo + (hi - lo) * (place - F.floor(place))).alias(name))
    for i, (name, p) in enumerate(discrete.items(), len(continuous)):
        place = F.greatest(F.ceil(F.col("__total") * F.lit(p)) - 1, F.lit(0))
        found.append(at(i, place).alias(name))
        out.append(F.col(name))
    result = placed.groupBy("__key").agg(F.max("__total").alias("__total"), *found)
    if measures:
        result = result.join(sketch.select("__key", *[name for name, _ in measures]), "__key")
        out += [F.col(name) for name, _ in measures]
    if mode:
        common = counts.groupBy("__key").agg(F.min_by("v", F.struct(-F.col("__n"), F.col("v"))).alias(mode))
        result = result.join(common, "__key")
        out.append(F.col(mode))
    return result.select(*out)


def most_common(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """The value that occurs most often in each group; the smaller one on a tie."""
    counts = value_counts(df, keys, value)
    return counts.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("__n"), F.col(value))).alias(name))


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], measures: Sequence[Column]) -> DataFrame:
    """Several groupings in one pass, with ``grouping_id`` to tell them apart."""
    columns: list[str] = []
    for s in sets:
        columns += [c for c in s if c not in columns]
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns]).agg(
        F.grouping_id().alias("grouping_id"), *measures
    )
