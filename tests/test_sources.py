from __future__ import annotations

import gzip
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from tidemark.functions import dates, text
from tidemark.operators import staging
from tidemark.session import scratch_path, scratch_root, size_shuffles
from tidemark.sources import csvload, sampling
from tidemark.sources.tables import Inputs, freshness


def write_gzip(tmp_path, text, name="sample.csv.gz"):
    path = tmp_path / name
    with gzip.open(path, "wt") as out:
        out.write(text)
    return str(path)


def test_sampled_gzip_rows_keep_their_file_positions(spark, tmp_path):
    path = write_gzip(tmp_path, "id,name\n10,a\n20,b\n30,c\n40,d\n50,e\n")
    df = csvload.load_csv(
        spark, path, {"id": "BIGINT", "name": "VARCHAR"}, sample_every=2, limit=2, row_number_column="file_row"
    )
    assert df.columns == ["file_row", "id", "name"]
    assert rows(df) == [(1, 10, "a"), (3, 30, "c")]


@pytest.mark.parametrize("limit,want", [(None, 334), (1, 1), (100, 100), (1000, 334)])
def test_one_gzip_file_and_many_plain_ones_agree(spark, tmp_path, limit, want):
    spark.range(0, 1000, numPartitions=1).write.option("header", True).csv(str(tmp_path / "plain"))
    path = write_gzip(tmp_path, "id\n" + "".join(f"{i}\n" for i in range(1000)))
    found = [
        rows(csvload.load_csv(spark, p, {"id": "BIGINT"}, sample_every=3, limit=limit, row_number_column="n"))
        for p in (path, str(tmp_path / "plain"))
    ]
    assert found[0] == found[1] == [(i + 1, i) for i in range(0, 1000, 3)][:limit]
    assert len(found[0]) == want


def test_sampled_gzip_parses_quotes_blanks_and_times(spark, tmp_path):
    text = 'id,name,at\n1,"a, b",2024-01-02 03:04:05\n\n2,c,\n3,"say ""hi""",2024-01-03 00:00:00\n4,N/A,\n5,,2024-01-04 00:00:00\n'
    path = write_gzip(tmp_path, text)
    types = {"at": "TIMESTAMP", "id": "BIGINT", "name": "VARCHAR"}
    df = csvload.load_csv(spark, path, types, sample_every=2, row_number_column="n")
    assert csvload.load_csv(spark, path, types, sample_every=2, row_number_column="value").columns[0] == "value"
    plain = tmp_path / "plain.csv"
    plain.write_text(text)
    other = csvload.load_csv(spark, str(plain), types, sample_every=2, row_number_column="n")
    assert df.columns == other.columns == ["n", "at", "id", "name"] and df.dtypes == other.dtypes
    assert rows(df, "n", "id", "name", "at") == rows(other, "n", "id", "name", "at")
    assert rows(df, "name") == [("a, b",), ('say "hi"',), (None,)]
    assert [r[:2] for r in rows(df, "n", "id")] == [(1, 1), (3, 3), (5, 5)]
    bad = write_gzip(tmp_path, "id\nx\n2\n", "bad.csv.gz")
    with pytest.raises(Exception, match="not of type bigint: x"):
        csvload.load_csv(spark, bad, {"id": "BIGINT"}, sample_every=2).collect()


def test_csv_keeps_listed_columns_in_listed_order(spark, tmp_path):
    path = write_gzip(tmp_path, "a,b,c\n1,x,2019-01-02 03:04:05\n2,,\n3,N/A,2019-01-02 00:00:00\n")
    df = csvload.load_csv(spark, path, {"c": "TIMESTAMP", "b": "VARCHAR"})
    assert [f.dataType.simpleString() for f in df.schema] == ["timestamp_ntz", "string"]
    assert {r["b"] for r in df.collect()} == {"x", None, "N/A"}


def test_csv_bad_value_fails(spark, tmp_path):
    path = write_gzip(tmp_path, "a\n1\nx\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        csvload.load_csv(spark, path, {"a": "BIGINT"}).collect()


def test_csv_missing_column(spark, tmp_path):
    path = write_gzip(tmp_path, "a\n1\n")
    with pytest.raises(ValueError, match="no column b"):
        csvload.load_csv(spark, path, {"b": "BIGINT"})


def test_positions_run_over_many_files_and_splits(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(0, 10_000, numPartitions=7).withColumn("k", F.col("id") * 2).write.option("header", True).csv(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        df = csvload.load_csv(spark, path, {"id": "BIGINT"}, sample_every=37, row_number_column="n")
        found = sorted((r["n"], r["id"]) for r in df.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == [(i + 1, i) for i in range(0, 10_000, 37)]


@pytest.mark.parametrize("name", ["bad.csv", "bad.csv.gz"])
def test_one_failure_rule_for_samples_of_any_file(spark, tmp_path, name):
    """A value that does not fit fails the read if its row is kept, and only then, however the file is packed."""
    text = "id,at\n1,2024-01-01 00:00:00\nx,yesterday\n3,2024-01-03 00:00:00\n4,soon\n"
    path = write_gzip(tmp_path, text, name) if name.endswith(".gz") else str(tmp_path / name)
    if not name.endswith(".gz"):
        (tmp_path / name).write_text(text)
    types = {"id": "BIGINT", "at": "TIMESTAMP"}
    assert rows(csvload.load_csv(spark, path, types, sample_every=2), "id") == [(1,), (3,)]
    with pytest.raises(Exception, match="at: not of type timestamp_ntz: soon"):
        csvload.load_csv(spark, path, types, sample_every=3).collect()
    with pytest.raises(Exception, match="not of type"):
        csvload.load_csv(spark, path, types, row_number_column="n").collect()


def test_sampled_rows_do_not_move(spark, tmp_path):
    """Without broadcasts: one scan counts, without data columns, one reads; no exchange holds a data column."""
    path = str(tmp_path / "many")
    spark.range(0, 5000, numPartitions=5).withColumn("wide", F.repeat(F.lit("x"), 20)).write.option("header", True).csv(path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = csvload.load_csv(spark, path, {"id": "BIGINT", "wide": "VARCHAR"}, sample_every=50, row_number_column="n")
        text = df._jdf.queryExecution().executedPlan().toString()
        got = rows(df, "n", "id")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == [(i + 1, i) for i in range(0, 5000, 50)]
    # The reading scan has only filters and projections above it; subqueries are drawn behind a colon.
    spine = [line for line in text.splitlines() if ":" not in line[: len(line) - len(line.lstrip(" :+-"))]]
    assert text.count("FileScan csv") == 1
    assert not [line for line in spine if line.lstrip(" +-").startswith(("Exchange", "SortMergeJoin", "BroadcastHashJoin", "Sort"))]


def test_positions_by_join_beyond_the_lookup(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 300, numPartitions=6).write.parquet(path)
    source = spark.read.schema("id long").parquet(path)
    for most in (0, 100):
        assert rows(sampling.file_positions(source, max_lookup=most)) == [(i, i) for i in range(300)]


def test_small_files_that_share_a_task(spark, tmp_path):
    """Several splits in one task, empty files among them."""
    path = str(tmp_path / "t")
    spark.range(0, 400, numPartitions=40).where("id % 40 < 20 OR id > 200").write.parquet(path)
    found = rows(sampling.file_positions(spark.read.schema("id long").parquet(path)), "__pos", "id")
    kept = [i for i in range(400) if i % 40 < 20 or i > 200]
    assert found == list(enumerate(kept))


def test_every_nth_keeps_nulls_and_reads_rows_once(spark, tmp_path):
    df = spark.createDataFrame([(k, f"v{k}") for k in [None, *range(50, 0, -1)]], "k int, v string")
    out = sampling.every_nth(df, ["k"], 10, limit=3, row_id="n")
    assert rows(out) == [(1, None, "vNone"), (11, 10, "v10"), (21, 20, "v20")]


def test_every_nth_of_an_ordered_table(spark):
    df = spark.range(100).select((99 - F.col("id")).alias("k"))
    out = sampling.every_nth(df, ["k"], 30, row_id="row")
    assert rows(out) == [(1, 0), (31, 30), (61, 60), (91, 90)]
    with pytest.raises(ValueError):
        sampling.every_nth(df, ["k"], 0)


def test_seed_types(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text("code,n,x,flag,day,at,label\n007,1,1.5,true,2024-01-02,2024-01-02 03:04:05,N/A\n008,2,2,false,2024-01-03,2024-01-03 00:00:00,b\n")
    df = csvload.load_seed(spark, str(path), {"code": "VARCHAR"})
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    assert kinds == {
        "code": "string", "n": "bigint", "x": "double", "flag": "boolean", "day": "date", "at": "timestamp_ntz", "label": "string",
    }
    assert df.first()["code"] == "007" and df.first()["label"] == "N/A"


def test_reload_with_unknown_column_changes_nothing(spark, house):
    csvload.reload_seed(house, "s", spark.createDataFrame([(1, "a")], "id long, name string"))
    with pytest.raises(ValueError, match="extra"):
        csvload.reload_seed(house, "s", spark.createDataFrame([(2, "b", 1)], "id long, name string, extra int"))
    assert rows(house.read("s")) == [(1, "a")]
    csvload.reload_seed(house, "s", spark.createDataFrame([(3,)], "id long"))
    assert rows(house.read("s")) == [(3, None)]
    csvload.reload_seed(house, "s", spark.createDataFrame([(4, 1)], "id long, extra int"), full_refresh=True)
    assert rows(house.read("s")) == [(4, 1)]


def test_spark_types():
    assert csvload.spark_type("NUMERIC(10,2)") == "decimal(10,2)"
    assert csvload.spark_type("varchar(20)") == "string"
    assert csvload.spark_type("Double Precision") == "double"
    assert csvload.spark_type("TIMESTAMP WITH TIME ZONE") == "timestamp"


def test_failed_build_keeps_the_old_table(spark, house):
    house.replace("t", spark.range(3))
    with pytest.raises(PySparkException):
        house.replace("t", spark.range(5).select(F.raise_error(F.lit("no")).cast("bigint").alias("id")))
    assert house.read("t").count() == 3
    house.replace("t", house.read("t").where("id > 0"))
    assert rows(house.read("t")) == [(1,), (2,)]


def test_interrupted_swap_is_undone(spark, house):
    house.replace("t", spark.range(3))
    house._rename("t", "t__backup")
    house.replace("t", spark.range(4))
    assert house.read("t").count() == 4
    house._rename("t", "t__backup")
    house.recover("t")
    assert house.read("t").count() == 4


def test_vacuum_drops_superseded_builds(spark, house):
    import os

    for n in (1, 2, 3):
        house.replace("t", spark.range(n))
    folder = f"{house.location}/t"
    assert len([d for d in os.listdir(folder) if not d.startswith(".")]) == 3
    house.vacuum("t")
    assert len([d for d in os.listdir(folder) if not d.startswith(".")]) == 1
    assert house.read("t").count() == 3


def test_staged_rows_are_dropped_at_the_end(spark, house):
    with house.staged(spark.range(5)) as df:
        assert df.count() == 5
    assert [t for t in spark.catalog.listTables(house.database) if not t.isTemporary] == []


def test_drop_partitions(spark, house):
    """Rows and files go; rows that come back later are alone in their partition."""
    df = spark.range(10).withColumn("p", F.when(F.col("id") % 4 < 3, F.concat(F.lit("a+b/ c'%"), F.col("id") % 4)))
    house.replace("t", df, ["p"])
    known = {r["p"] for r in house.partitions("t", "p").collect()}
    assert known == {None, "a+b/ c'%0", "a+b/ c'%1", "a+b/ c'%2"}
    house.drop_partitions("t", "p", [None, "a+b/ c'%1"])
    assert {r["p"] for r in house.read("t").collect()} == {"a+b/ c'%0", "a+b/ c'%2"}
    house.drop_partitions("t", "p", [None, "a+b/ c'%1"])
    house.append("t", df.where("id IN (1, 3)"), ["p"])
    assert sorted(r["id"] for r in house.read("t").where("p IS NULL OR p LIKE '%1'").collect()) == [1, 3]


def test_empty_and_sample_modes(spark, inputs):
    empty = Inputs(spark, inputs.folder, empty=True)
    assert empty("events").count() == 0 and empty("events").schema == inputs("events").schema
    sample = Inputs(spark, inputs.folder, sample=("2024-01-02", "2024-01-03"))
    days = sample("events").select(F.to_date("ts").alias("d")).distinct().collect()
    assert [str(r["d"]) for r in days] == ["2024-01-02"]
    assert sample("nation").count() == 25


def test_freshness_of_nothing(spark):
    df = spark.createDataFrame([], "ts timestamp_ntz")
    assert freshness(df, "ts", "2024-01-01 00:00:00").first()["age_seconds"] is None


def test_scratch_folder_is_the_shared_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or scratch_root(spark) == named.rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_size_shuffles(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 10 * 2**40) == 81920
        assert size_shuffles(spark, 1) == spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


# The rows that staging must keep or drop.
TRIPS = [
    (1, "2019-01-07 08:15:00", "2019-01-07 08:45:30", 20.0, "N"),
    (2, "2019-01-12 23:50:00", "2019-01-13 00:05:00", 25.0, "Y"),
    (3, "2019-01-08 12:00:00", "2019-01-08 12:00:00", 5.0, None),
    (4, "2019-01-08 01:00:00", "2019-01-08 14:00:00", 50.0, None),
    (5, "2019-01-09 10:00:00", "2019-01-09 10:10:00", 623261.66, None),
]


def test_staging_of_intervals(spark):
    """Rules drop empty, long and implausible rows; the rest is renamed, derived and filled in one step."""
    raw = spark.createDataFrame(TRIPS, "id long, a string, b string, total double, flag string")
    raw = raw.select("id", F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"), "total", "flag", F.lit(None).cast("double").alias("extra"))
    out = staging.stage(
        raw,
        rename={"id": "key", "extra": "surcharge"},
        derive={**staging.time_fields("a", "start"), "minutes": dates.minutes_between("a", "b"), "held": text.equals_flag("flag", "Y")},
        fill={"surcharge": 0.0},
        valid=[(F.col("b") > F.col("a")) & (F.col("b") <= dates.plus("a", "12 hours")), F.col("total").between(0, 2000)],
    )
    got = rows(out, "key", "start_hour", "start_iso_weekday", "start_day_part", "minutes", "held", "surcharge")
    assert got == [(1, 8, 1, "morning rush", 30.5, False, 0.0), (2, 23, 6, "night", 15.0, True, 0.0)]


def test_pattern_flag_in_staging(spark):
    places = spark.createDataFrame([(1, "Newark Airport"), (2, "JFK Airport"), (3, "Midtown Center"), (4, None)], "k int, place string")
    out = staging.stage(places, rename={"k": "k"}, derive={"is_airport": text.matches_flag("place", "%Airport%")})
    assert dict(rows(out, "k", "is_airport")) == {1: True, 2: True, 3: False, 4: False}


def test_part_numbers_are_numbers(spark):
    """part-100000 comes after part-99999, as Spark wrote them."""
    import shutil

    folder = scratch_path(spark, "parts")
    for number, value in ((99999, "first"), (100000, "second")):
        spark.createDataFrame([(value,)], "v string").coalesce(1).write.parquet(f"{folder}-{number}")
        (part,) = Path(f"{folder}-{number}").glob("part-*.parquet")
        Path(folder).mkdir(exist_ok=True)
        shutil.copy(part, f"{folder}/part-{number}-x.parquet")
    got = sampling.file_positions(spark.read.schema("v string").parquet(folder))
    assert rows(got, "v", "__pos") == [("first", 0), ("second", 1)]


def test_append_refuses_unknown_columns(spark, house):
    house.append("t", spark.createDataFrame([(1,)], "a int"))
    for extra in ("1 AS a, 2 AS b", "2 AS b"):
        with pytest.raises(ValueError, match="differ in columns"):
            house.append("t", spark.sql(f"SELECT {extra}"))
    assert house.read("t").count() == 1
