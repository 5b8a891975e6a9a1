"""Window functions.

``Window`` without a partition is used only on rollups whose row count is
bounded by the calendar (one row per day) or by a list of categories. Windows
over detail rows are cut into buckets of the order column, so that one hot key
is many groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import truncate
from tidemark.functions.numbers import rounded


def _whole():
    """All rows of a rollup."""
    return Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def rolling_avg(value: Column | str, order: str, rows: int, scale: int = 2) -> Column:
    """Average over this row and the ``rows - 1`` before it, summed exactly."""
    w = Window.orderBy(order).rowsBetween(-(rows - 1), Window.currentRow)
    v = F.col(value) if isinstance(value, str) else value
    return F.try_divide(F.sum(v.cast(f"decimal(38,{scale})")).over(w).cast("double"), F.count(v).over(w).cast("double"))


def change_from_previous(value: str, order: str) -> Column:
    """This row's value minus the previous row's; NULL on the first row."""
    return F.col(value) - F.lag(value).over(Window.orderBy(order))


def rank_over_all(order: Column) -> Column:
    """Rank over a rollup; equal values share a rank."""
    return F.rank().over(Window.orderBy(order))


def top_ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, name: str) -> DataFrame:
    """Rows ranked ``k`` or better in their group, ties included.

    The filter on the rank lets Spark keep only each task's best rows before
    the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.rank().over(w)).where(F.col(name) <= k)


def share_of_total(rollup: DataFrame, value: str, name: str, places: int = 2) -> DataFrame:
    """Each rollup row's percentage of the whole.

    The total is taken over the rollup's few rows, so that the facts under it
    are scanned once; a subquery for the total would scan them again.
    """
    total = F.sum(value).over(_whole()).cast("double")
    return rollup.withColumn(name, rounded(F.try_divide(F.col(value) * F.lit(100.0), total), places))


def zscores(rollup: DataFrame, value: str, name: str, places: int = 3) -> DataFrame:
    """Distance from the mean in sample standard deviations, over a rollup's rows."""
    mean, sd = F.avg(value).over(_whole()), F.stddev_samp(value).over(_whole())
    return rollup.withColumn(name, rounded(F.try_divide(F.col(value) - mean, sd), places))


def time_bucket(df: DataFrame, keys: Sequence[str], ts: str, max_rows: int = 2_000_000) -> Column | None:
    """The coarsest cut of a timestamp that leaves no group of a key too large.

    The largest key is measured first, by a count made in parts; if it is small
    enough no cut is needed and the answer is None. Else the largest (key, day)
    is, and hours, minutes and seconds only as far as needed.
    """
    for unit in (None, "day", "hour", "minute", "second"):
        bucket = None if unit is None else truncate(unit, ts)
        group = [F.col(k) for k in keys] + ([] if bucket is None else [bucket.alias("__bucket")])
        sizes = df.groupBy(*group).agg(F.count("*").alias("__n"))
        if (sizes.agg(F.max("__n")).first()[0] or 0) <= max_rows:
            return bucket
    return F.col(ts)


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column | None, name: str) -> DataFrame:
    """``row_number`` per key, safe for hot keys.

    ``bucket`` must never fall while the order columns rise, such as the hour
    of the leading timestamp. Rows are numbered inside (key, bucket), and the
    counts of earlier buckets, pre-aggregated, are added. The order must be
    total within a key. Without a bucket it is a plain window per key.
    """
    if bucket is None:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return df.withColumn(name, place.cast("bigint"))
    rows = _grouped(df, keys, bucket)
    counts = rows.groupBy("__group").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(_bucket_order(keys)) - F.col("__n")
    starts = counts.select("__group", before.alias("__before"))
    local = rows.withColumn("__local", F.row_number().over(Window.partitionBy("__group").orderBy(*order)))
    joined = local.join(starts, "__group")
    return joined.select(*df.columns, (F.col("__before") + F.col("__local")).alias(name))


def fill_forward(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column | None, value: str, name: str) -> DataFrame:
    """The last non-NULL value at or before each row of its key (``IGNORE NULLS``).

    Hot keys are cut into buckets as in :func:`numbered`: a bucket's rows see
    their own bucket, and beyond it the last known value of earlier buckets.
    """
    if bucket is None:
        upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(name, F.last(value, ignorenulls=True).over(upto))
    rows = _grouped(df, keys, bucket)
    rank = F.when(F.col(value).isNotNull(), F.struct(*order))
    ends = rows.groupBy("__group").agg(F.max_by(value, rank).alias("__end"))
    earlier = _bucket_order(keys).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("__group", F.last("__end", ignorenulls=True).over(earlier).alias("__carried"))
    inside = Window.partitionBy("__group").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn("__seen", F.last(value, ignorenulls=True).over(inside))
    return local.join(carried, "__group").select(*df.columns, F.coalesce("__seen", "__carried").alias(name))


def _grouped(df: DataFrame, keys: Sequence[str], bucket: Column) -> DataFrame:
    """Add the (key, bucket) of each row as one struct.

    Structs compare their fields NULL-safely, so NULL keys join, and the window
    and the join on the struct share one shuffle.
    """
    return df.withColumn("__group", F.struct(*keys, bucket.alias("__bucket")))


def _bucket_order(keys: Sequence[str]):
    return Window.partitionBy(*[F.col(f"__group.{k}") for k in keys]).orderBy("__group.__bucket")


def avg_excluding_row(value: str, frame: Window, scale: int = 2) -> Column:
    """Average over a frame without the current row (``EXCLUDE CURRENT ROW``).

    The row's own part is taken off the frame's exact sum and count.
    """
    v = F.col(value).cast(f"decimal(38,{scale})")
    total = F.coalesce(F.sum(v).over(frame), F.lit(0)) - F.coalesce(v, F.lit(0))
    n = F.count(v).over(frame) - F.when(v.isNull(), 0).otherwise(1)
    return F.try_divide(total.cast("double"), n.cast("double"))


def avg_excluding_peers(value: str, frame: Window, peers: Window, keep_self: bool, scale: int = 2) -> Column:
    """Average over a frame without the rows that tie with the current one.

    ``EXCLUDE GROUP`` leaves out the current row as well, ``EXCLUDE TIES``
    (``keep_self``) keeps it. ``frame`` must hold all peers, as RANGE frames do.
    """
    v = F.col(value).cast(f"decimal(38,{scale})")
    own, known = F.coalesce(v, F.lit(0)), F.when(v.isNull(), 0).otherwise(1)
    total = F.coalesce(F.sum(v).over(frame), F.lit(0)) - F.coalesce(F.sum(v).over(peers), F.lit(0))
    n = F.count(v).over(frame) - F.count(v).over(peers)
    if keep_self:
        total, n = total + own, n + known
    return F.try_divide(total.cast("double"), n.cast("double"))
