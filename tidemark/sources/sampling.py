"""Stable row positions and the samples built on them.

A position is a row's place in file order, or in a stated order, counted from
zero over the whole data set. No global window is used: each input split
counts its own rows, and only the per-split counts are put in sequence.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path


# So many splits are looked up in an array that goes with the tasks, 32 bytes each; beyond, rows join to them.
MAX_LOOKUP = 200_000


def split_starts(rows: DataFrame) -> DataFrame:
    """One row per split: the task that reads it, its rows' places there, and where they belong in file order.

    The counting scan reads no data column. Its result is written, so that later plans
    read one small row per split and not the files.
    """
    split = ["__file", "__block"]
    local = rows.select(
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.spark_partition_id().alias("task"),
        F.monotonically_increasing_id().alias("__seq"),
    )
    counts = local.groupBy(*split, "task").agg(F.min("__seq").alias("first"), F.count("*").alias("__rows"))
    path = scratch_path(rows.sparkSession, "splits")
    counts.write.parquet(path)
    counts = rows.sparkSession.read.schema(counts.schema).parquet(path)
    # Running totals in two steps, files first, so that no window holds more
    # than the splits of one file or one row per file.
    files = counts.groupBy("__file").agg(F.sum("__rows").alias("__file_rows"))
    before_file = F.sum("__file_rows").over(Window.orderBy(*file_order("__file"))) - F.col("__file_rows")
    files = files.select("__file", before_file.alias("__file_start"))
    in_file = Window.partitionBy("__file").orderBy("__block")
    return (
        counts.withColumn("__block_start", F.sum("__rows").over(in_file) - F.col("__rows"))
        .join(files, "__file")
        .select(
            "task",
            F.xxhash64(*split).alias("split"),
            "first",
            (F.col("__file_start") + F.col("__block_start") - F.col("first")).alias("shift"),
        )
    )


def file_positions(rows: DataFrame, name: str = "__pos", max_lookup: int = MAX_LOOKUP) -> DataFrame:
    """Add each row's 0-based position in file order (path, then place in file).

    ``rows`` must come straight from a file source. One scan counts the rows of every
    split, the other reads them. The rows stay where they are read: a scalar subquery
    hands every task the starts of all splits, by task, and a row looks up its own. So a
    filter on the position works in the scan's own stage. Only beyond ``max_lookup``
    splits do rows join to the starts instead.

    If the files were split otherwise the second time, the first row tells, and the job
    ends; it never gives wrong positions.
    """
    starts = split_starts(rows)
    local = rows.select(
        "*",
        F.xxhash64("_metadata.file_path", "_metadata.file_block_start").alias("__split"),
        F.monotonically_increasing_id().alias("__seq"),
    )
    lost = F.raise_error(F.lit("the files were split differently while they were counted; run again")).cast("bigint")
    if starts.count() > max_lookup:
        shift = starts.select(F.col("split").alias("__split"), F.col("shift").alias("__shift"))
        placed = local.join(shift, "__split", "left")
        return placed.withColumn(name, F.coalesce("__shift", lost) + F.col("__seq")).drop("__split", "__seq", "__shift")
    by_task = starts.groupBy("task").agg(F.sort_array(F.collect_list(F.struct("first", "shift", "split"))).alias("held"))
    # A place for every task up to the last, also for those without rows.
    filled = by_task.agg(F.max("task").alias("last"), F.map_from_entries(F.collect_list(F.struct("task", "held"))).alias("tasks"))
    lookup = filled.select(F.transform(F.sequence(F.lit(0), F.coalesce("last", F.lit(0))), lambda t: F.col("tasks")[t])).scalar()
    local = local.withColumn("__held", F.get(lookup, F.spark_partition_id()))
    held, seq = F.col("__held"), F.col("__seq")
    # Most tasks read one split; one that reads several small files looks for the last that began before the row.
    own = F.when(F.size(held) == 1, F.get(held, F.lit(0))).otherwise(F.element_at(F.filter(held, lambda h: h["first"] <= seq), -1))
    placed = local.withColumn("__own", own)
    known = F.col("__own.split") == F.col("__split")
    return placed.withColumn(name, F.when(known, F.col("__own.shift") + seq).otherwise(lost)).drop("__split", "__seq", "__held", "__own")


def file_order(path: str) -> list[Column]:
    """Folder, then Spark's part number as a number, then name: part 99999 comes before part 100000."""
    folder, part = F.regexp_extract(path, r"^(.*)/[^/]*$", 1), F.regexp_extract(path, r"/part-(\d+)[^/]*$", 1)
    return [folder, F.coalesce(part.try_cast("bigint"), F.lit(-1)), F.col(path)]


def ordered_positions(df: DataFrame, order: list[str], name: str = "__pos") -> DataFrame:
    """(order columns, 0-based position) of each row in a stated order, which must be total.

    Only the order columns are sorted. They are written once (a range-partitioned
    sort, balanced by sampling) and read back in file order, so that positions
    cannot change if an executor is lost halfway.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "sorted")
    keys = df.select(*order)
    keys.orderBy(*order).write.parquet(path)
    return file_positions(spark.read.schema(keys.schema).parquet(path), name)


def stride(
    rows: DataFrame,
    every: int,
    limit: int | None = None,
    row_id: str | None = None,
    one_split: bool = False,
    skip: int = 0,
) -> DataFrame:
    """Keep positions 0, n, 2n, … of file-source rows, at most ``limit`` of them.

    ``row_id`` is put first and holds the 1-based position. The cap counts
    sampled rows from the start of the file: the k-th sampled row sits at
    position ``(k - 1) * every``, so the cap is a plain filter. A single file
    that cannot be split (``one_split``) is one task, whose own count is the
    position: it is read once, and no further than the cap. ``skip`` leaves out
    its first rows.
    """
    if one_split:
        head = rows if limit is None else rows.limit(limit * every + skip)
        positioned = head.withColumn("__pos", F.monotonically_increasing_id() - skip).where(F.col("__pos") >= 0)
    else:
        positioned = file_positions(rows)
    return _take(positioned, rows.columns, every, limit, row_id)


def every_nth(
    df: DataFrame, order: list[str], every: int, limit: int | None = None, row_id: str | None = None
) -> DataFrame:
    """Like :func:`stride`, for any DataFrame in a stated total order.

    The positions are found from the order columns alone, and the sampled ones then pick
    their rows: a broadcast while they are few.
    """
    picked = _take(ordered_positions(df, order), ["__pos", *order], every, limit, None)
    picked = picked.select("__pos", *[F.col(c).alias(f"__key_{c}") for c in order])
    same = [F.col(c).eqNullSafe(F.col(f"__key_{c}")) for c in order]
    rows = df.join(picked, reduce(and_, same))
    first = [(F.col("__pos") + 1).alias(row_id)] if row_id else []
    return rows.select(*first, *df.columns)


def _take(positioned: DataFrame, columns: list[str], every: int, limit: int | None, row_id: str | None) -> DataFrame:
    if every < 1:
        raise ValueError("the sampling step must be 1 or more")
    kept = positioned.where(F.col("__pos") % every == 0)
    if limit is not None:
        kept = kept.where(F.col("__pos") < limit * every)
    first = [(F.col("__pos") + 1).alias(row_id)] if row_id else []
    return kept.select(*first, *columns)
