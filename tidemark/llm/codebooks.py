"""Vector codes: vectors cut into parts, and each part named by its nearest codebook entry.

Lloyd's rounds with resident members. Every part of every vector is a member of one
codebook entry and lies with the others of its cell (position, entry, salt). Each round

1. the owners add up their resident members, and the few sums give the new entries;
2. the members look for their nearest entry where they lie; those that keep their entry
   stay in place, and only those that change it move to their new cell, in one shuffle.

Later rounds move few parts. Each round's members are a written table in the shared
scratch folder, so a lost executor costs a part of one step; the table before it is
deleted then. Sent to the tasks: the codebooks, ``parts * entries`` pieces of a vector.
The number of salts grows with the table, so a cell holds about ``CELL`` members even if
all vectors are alike.

All arithmetic is on integers and exact: components become ``floor(scale * x)``, means
are floors, ties go to the lower entry. Where numbers are too large for exact doubles,
Python's integers take over.

Rows whose vector is null, or holds a null or non-finite component, take no part; nor do
components of 2**40 and beyond (as non-finite) and vectors of another length than the
most frequent one (of two, the longer). A length that the parts do not divide gives the
first parts one component more. Rows with a null id come after all others; repeated rows
count each. With fewer rows than entries the codebooks are that short. Errors beyond a
long are the greatest long. An empty table has no codes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import discard, stored
from tidemark.session import scratch_path

CELL = 100_000  # members that a cell should hold
LIMIT = 2.0**40
LONGEST = 2**63 - 1

Books = list[list[list[int]]]  # by position, entry, component


def usable(vectors: DataFrame, vector_col: str) -> DataFrame:
    """The rows that take part, with ``v`` as doubles."""
    rows = vectors.withColumn("v", F.col(vector_col).cast("array<double>"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= LIMIT)
    rows = rows.where(F.col("v").isNotNull() & ~F.exists("v", bad))
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return rows.where(F.size("v") == (sizes["size"] if sizes else 0))


def nearest(x: np.ndarray, book: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each row's nearest entry, exactly; ties to the lower entry."""
    top = max([1, int(np.abs(x).max(initial=0)), *[abs(c) for entry in book for c in entry]])
    # Below 2**53 all sums are exact in doubles, whatever their order.
    kind = np.float64 if 4 * max(1, x.shape[1]) * top * top < 2**53 else object
    a, b = x.astype(kind), np.array(book, dtype=kind).reshape(len(book), x.shape[1])
    d = (a * a).sum(axis=1, initial=0)[:, None] + (b * b).sum(axis=1, initial=0)[None, :] - 2 * a.dot(b.T)
    entry = np.argmin(d, axis=1)
    return entry, d[np.arange(len(d)), entry]


def by_position(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(position, rows, components) for each position in a batch of members."""
    lists = batch.column("part")
    offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    position = batch.column("position").to_numpy()
    for p in np.unique(position):
        rows = np.flatnonzero(position == p)
        width = offsets[rows[0] + 1] - offsets[rows[0]]
        yield int(p), rows, flat[offsets[rows][:, None] + np.arange(width)]


def reassign(books: Books, errors: bool = False):
    """A function for ``mapInArrow`` that adds each member's nearest entry as ``to``, and its error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            to, error = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, object)
            for p, rows, x in by_position(batch):
                to[rows], error[rows] = nearest(x, books[p])
            if errors:
                far = pa.array([min(int(e), LONGEST) for e in error], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("position"), pa.array(to), far], ["row", "position", "to", "error"])
            else:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(to)], [*batch.schema.names, "to"])

    return run


def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count and sum of each component of the members of each entry, one set per batch."""
    for batch in batches:
        found = []
        entry = batch.column("entry").to_numpy()
        for p, rows, x in by_position(batch):
            kind = np.int64 if int(np.abs(x).max(initial=0)) * len(x) < 2**62 else object
            for e in np.unique(entry[rows]):
                held = x[entry[rows] == e].astype(kind)
                total = held.sum(axis=0)
                found += [(p, int(e), i, len(held), str(total[i])) for i in range(x.shape[1])]
        columns = list(zip(*found)) or [[]] * 5
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["position", "entry", "i", "n", "total"])


def updated(members: DataFrame, books: Books) -> Books:
    """The codebooks whose entries are the floors of their members' means; unused entries stay.

    One row per position, entry and component comes to the driver.
    """
    partial = members.mapInArrow(sums, "position int, entry int, i int, n long, total string")
    grouped = partial.groupBy("position", "entry", "i").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    new = [[list(entry) for entry in book] for book in books]
    for r in grouped.collect():
        new[r["position"]][r["entry"]][r["i"]] = int(r["total"]) // r["n"]
    return new


def cut(width: int, parts: int) -> list[tuple[int, int]]:
    """(start, end) of each part."""
    ends = np.cumsum([0, *[width // parts + (i < width % parts) for i in range(parts)]]).tolist()
    return list(zip(ends, ends[1:]))


MEMBER = "row long, part array<long>, position int, entry int, salt int"


class Members:
    """All parts, each in the cell of its entry: what stayed in place and what moved there."""

    def __init__(self, frame: DataFrame, folders: list[str], salts: int):
        self.frame, self.folders, self.salts = frame, folders, salts

    @classmethod
    def first(cls, vectors: DataFrame, books: Books, pieces: list[tuple[int, int]], rows: int) -> Members:
        """Every part in the cell of its first entry; the one shuffle of all parts."""
        salts = max(1, -(-rows // (len(books[0]) * CELL)))
        whole = F.posexplode(F.array(*[F.slice("u", a + 1, b - a) for a, b in pieces])).alias("position", "part")
        salt = F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int").alias("salt")
        tagged = vectors.select("row", whole, salt).mapInArrow(reassign(books), "row long, position int, part array<long>, salt int, to int")
        frame, folder = housed(tagged)
        return cls(frame, [folder], salts)

    def migrated(self, books: Books) -> Members:
        """The members after a reassignment; only those that change their entry are shuffled."""
        spark, folder = self.frame.sparkSession, scratch_path(self.frame.sparkSession, "stayed")
        tagged = self.frame.mapInArrow(reassign(books), f"{MEMBER}, to int")
        # Written where they are read, apart from each other by whether they stay.
        tagged.withColumn("moves", (F.col("to") != F.col("entry")).cast("int")).write.partitionBy("moves").parquet(folder)
        parts = spark.read.schema(f"{MEMBER}, to int, moves int").parquet(folder)
        moved, other = housed(parts.where("moves = 1"))
        stayed = parts.where("moves = 0").select(*moved.columns)
        for old in self.folders:
            discard(spark, old)
        return Members(stayed.unionByName(moved), [folder, other], self.salts)


def housed(tagged: DataFrame) -> tuple[DataFrame, str]:
    """Members brought by a shuffle to the cells of their entries, and their folder."""
    spark, folder = tagged.sparkSession, scratch_path(tagged.sparkSession, "moved")
    cells = tagged.select("row", "part", "position", F.col("to").alias("entry"), "salt")
    cells.repartition("position", "entry", "salt").write.parquet(folder)
    return spark.read.schema(MEMBER).parquet(folder), folder


def compressed(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
) -> tuple[DataFrame, Books]:
    """(id, label, entries, error) of every row that takes part, and the codebooks.

    ``entries`` lists the index of the nearest entry of each part, ``error`` adds the
    squared distances.
    """
    spark = vectors.sparkSession
    units = F.transform("v", lambda x: F.floor(x * scale).cast("long"))
    kept = usable(vectors, vector_col).select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), units.alias("u"))
    kept = stored(kept.withColumn("row", F.monotonically_increasing_id()), "vectors")
    start = [list(r["u"]) for r in kept.orderBy(F.col("id").asc_nulls_last(), "u").limit(entries).select("u").collect()]
    names = "row long, position int, to int, error long"
    if not start:
        coded, books = spark.createDataFrame([], names), [[] for _ in range(parts)]
    else:
        pieces = cut(len(start[0]), parts)
        books = [[u[a:b] for u in start] for a, b in pieces]
        members = Members.first(kept, books, pieces, kept.count())
        for r in range(rounds):
            books = updated(members.frame, books)
            if r < rounds - 1:
                members = members.migrated(books)
        coded = members.frame.mapInArrow(reassign(books, errors=True), names)
    # A vector's parts and its own row meet by grouping.
    both = coded.unionByName(kept.select("row", "id", "label", F.lit(True).alias("own")), allowMissingColumns=True)
    code = F.transform(F.sort_array(F.collect_list(F.when(F.col("position").isNotNull(), F.struct("position", "to")))), lambda p: p["to"])
    error = F.sum(F.col("error").cast("decimal(38,0)"))
    rows = both.groupBy("row").agg(F.max("id").alias("id"), F.max("label").alias("label"), code.alias("entries"), error.alias("error"))
    return rows.select(F.col("id").alias(id_col), F.col("label").alias(label_col), "entries", as_long(F.col("error")).alias("error")), books


def as_long(exact: Column) -> Column:
    return F.least(exact, F.lit(LONGEST).cast("decimal(38,0)")).cast("long")


def books_digest(books: Books) -> str:
    """sha256 of all components, by part, entry and place."""
    return hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()


def decoded(books: Books, entries: list[int], scale: int = 4096) -> list[float]:
    """The vector that a code stands for."""
    return [c / scale for book, e in zip(books, entries) for c in book[e]]


def digests(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", salts: int = 16) -> DataFrame:
    """id, code in hex, error, the error of all rows of a label, and a digest of the codebooks."""
    rows, books = compressed(vectors, id_col, label_col=label_col)
    rows = stored(rows, "codes")
    code = F.array_join(F.transform("entries", lambda e: F.lpad(F.lower(F.hex(e)), 2, "0")), "")
    # A label may hold any share of the rows: they meet its sum in several places.
    totals = rows.groupBy(F.col(label_col).alias("__label")).agg(as_long(F.sum(F.col("error").cast("decimal(38,0)"))).alias("label_error"))
    totals = totals.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = rows.withColumn("__at", F.pmod(F.xxhash64(id_col, "entries"), F.lit(salts)).cast("int"))
    met = rows.join(totals, F.col(label_col).eqNullSafe(F.col("__label")) & (F.col("__at") == F.col("__salt")))
    return met.select(id_col, code.alias("code"), "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
