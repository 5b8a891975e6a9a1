"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: short lineage, safe from lost executors."""
    folder = scratch_path(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for each node of ``edges`` (a, b); label is one node of its component.

    Every round, each node picks its smallest neighbour, picks are followed four
    steps, and the graph is contracted to what they lead to, until no edge is
    left. Ids should be hashes: then picks do not form long chains and each round
    loses a constant share of the nodes. A hub costs no more than its edges,
    since minima and joins on it are split over tasks. Self loops and repeated
    edges are allowed; null ends are ignored.
    """
    edges = stored(edges.where("a <> b").distinct(), "edges")
    found = None
    while True:
        if edges.isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pick = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label"))
        pick = stored(pick, "picks")
        for _ in range(2):
            step = pick.select(F.col("node").alias("label"), F.col("label").alias("__next"))
            pick = pick.join(step, "label").select("node", F.col("__next").alias("label"))
        pick = stored(pick, "picks")
        if found is None:
            found = pick
        else:
            step = pick.select(F.col("node").alias("label"), F.col("label").alias("__next"))
            found = found.join(step, "label", "left").select("node", F.coalesce("__next", "label").alias("label"))
            found = stored(found, "labels")
        a = pick.select(F.col("node").alias("a"), F.col("label").alias("x"))
        b = pick.select(F.col("node").alias("b"), F.col("label").alias("y"))
        ends = edges.join(a, "a").join(b, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        edges = stored(ends.distinct(), "edges")
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("label"))
    return found
