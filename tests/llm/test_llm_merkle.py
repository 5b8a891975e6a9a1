"""The Merkle manifest against its definition."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tidemark.llm import merkle
from tidemark.sources.tables import scan

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def path_of(levels, i):
    steps = []
    for nodes in levels[:-1]:
        first = i // 16 * 16
        run = nodes[first : first + 16]
        steps.append(("".join(run[: i - first]), "".join(run[i - first + 1 :])))
        i //= 16
    return steps


def brute(rows):
    trees, held = {}, {}
    for row in rows:
        held.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(held, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        held[name].sort(key=lambda x: x[:3])
        trees[name] = levels_of([x[2] for x in held[name]])
    top = levels_of([trees[name][-1][0] for name in names])
    found = []
    for place, name in enumerate(names):
        for i, (_, _, own, row) in enumerate(held[name]):
            steps = path_of(trees[name], i) + path_of(top, place)
            node = own
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                node = leaf((*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])))
            for a, b in steps:
                node = H(a, node, b)
            root = top[-1][0]
            found.append((row[0], own, trees[name][-1][0], root, H(*[a + b for a, b in steps]), node, node == root))
    return found


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


def test_given_documents(spark):
    docs = scan(spark, SMALL, "documents")
    got = merkle.checked(docs).collect()
    assert ordered(got) == ordered(brute([tuple(r) for r in docs.select(*merkle.FIELDS).collect()]))
    assert 0 < sum(r.verified for r in got) < len(got)


@pytest.mark.parametrize("sizes", [[1], [1, 2, 15, 16, 17, 255, 256, 257, *[1] * 10]])
def test_sizes_at_the_edges_of_levels(spark, sizes):
    rows = [(i, f"s{k:03d}", "en", None, f"Text {i}") for k, n in enumerate(sizes) for i in range(n)]
    assert ordered(merkle.checked(spark.createDataFrame(rows, SCHEMA)).collect()) == ordered(brute(rows))


def test_hot_source_repeated_rows_and_nulls(spark):
    """One source beyond a block of 4,096, half of it one row; nulls, empty and clashing columns."""
    draw = random.Random(4)
    rows = [(5, "hot", "en", 1, "Same")] * 2500 + [(i, "hot", None, None, f"É{i}") for i in range(2500)]
    rows += [
        (
            draw.choice([None, 1, 2, draw.randrange(-99, 99)]),
            draw.choice([None, "", "a", "é", "z", "\U0001f600", "￮"]),
            draw.choice([None, "", "en"]),
            draw.choice([None, 3]),
            draw.choice([None, "", "Ab", "x" * 9]),
        )
        for _ in range(400)
    ]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("leaf", "rank", "path", "h", "root", "kids", "levels"):
        docs = docs.withColumn(name, F.lit(1))
    assert ordered(merkle.checked(docs).collect()) == ordered(brute(rows))


def test_empty_table(spark):
    empty = merkle.checked(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == []
    assert empty.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_proofs_hold_for_other_tables(spark):
    """The operator itself: any leaves, any source, columns carried along; each proof leads to the root."""
    rows = spark.range(700).select(F.col("id").alias("k"), (F.col("id") % 3).cast("string").alias("g"), F.col("id").alias("x"))
    found = merkle.proofs(rows.withColumn("leaf", merkle.leaf_of(F.col("k"), F.col("x"))), "k", "g", ["x"])
    assert found.where(merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).where("x = k").count() == 700
    widths = F.aggregate("path", F.lit(0), lambda n, s: F.greatest(n, F.length(s["left"]) + F.length(s["right"])))
    assert found.agg(F.max(widths)).first()[0] == 15 * 64


def test_proofs_are_emitted_without_joins(spark):
    plan = merkle.checked(scan(spark, SMALL, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan
