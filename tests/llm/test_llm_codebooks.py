"""Vector codes against the definition, in plain integers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tidemark.llm import codebooks
from tidemark.sources.tables import scan

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, parts=8, entries=16, rounds=6):
    kept = [
        (i, [math.floor(4096 * x) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    members = [[r[1][p * width : (p + 1) * width] for r in kept] for p in range(parts)]
    books = [m[:entries] for m in members]

    def assigned():
        distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
        return [[min((distance(x, c), e) for e, c in enumerate(books[p])) for x in members[p]] for p in range(parts)]

    for _ in range(rounds):
        found, after = assigned(), []
        for p in range(parts):
            held = [[x for x, (_, to) in zip(members[p], found[p]) if to == e] for e in range(len(books[p]))]
            after.append([[sum(c) // len(h) for c in zip(*h)] if h else books[p][e] for e, h in enumerate(held)])
        books = after
    found = assigned()
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    errors = [sum(found[p][j][0] for p in range(parts)) for j in range(len(kept))]
    by_label = {}
    for r, error in zip(kept, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + error
    codes = ["".join(f"{found[p][j][1]:02x}" for p in range(parts)) for j in range(len(kept))]
    return [(r[0], c, e, by_label[r[2]], digest) for r, c, e in zip(kept, codes, errors)]


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


def test_given_vectors(spark):
    table = scan(spark, SMALL, "embeddings")
    rows = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    assert ordered(codebooks.digests(table).collect()) == ordered(brute(rows))


def test_odd_rows_ties_and_large_numbers(spark, monkeypatch):
    """Nulls, repeated rows and ids, equal vectors, many cells, numbers beyond exact doubles, clashing columns."""
    monkeypatch.setattr(codebooks, "CELL", 1)
    draw = random.Random(3)
    bad = [None, [1.0, None] * 8, [float("nan")] * 16, [float("inf")] * 16]
    rows = [(draw.choice([None, 1, 2, draw.randrange(99)]), [draw.random() - 0.5 for _ in range(16)], draw.choice([None, 1, 2])) for _ in range(80)]
    rows += [(i, v, 1) for i, v in enumerate(bad)] + [(7, [0.5] * 16, 1)] * 60
    rows += [(5, [1e6 * (i + 1) for i in range(16)], 3), (6, [-1e8] * 16, 3)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("row", "v", "u", "id", "part", "position", "entry", "salt", "to", "error", "entries"):
        table = table.withColumn(name, F.lit(1))
    assert ordered(codebooks.digests(table).collect()) == ordered(brute(rows))


@pytest.mark.parametrize("n", [0, 3])
def test_few_rows(spark, n):
    rows = [(i, [float(i)] * 8, None) for i in range(n)]
    got = codebooks.digests(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert ordered(got.collect()) == (ordered(brute(rows)) if n else [])


def test_lengths_that_do_not_divide(spark):
    """The most frequent length takes part; its first parts are one longer."""
    rows = [(i, [i / 8 + k for k in range(11)], 0) for i in range(20)] + [(50, [1.0], 0)]
    got, books = codebooks.compressed(spark.createDataFrame(rows, SCHEMA), rounds=2)
    assert got.count() == 20 and [len(b[0]) for b in books] == [2, 2, 2, 1, 1, 1, 1, 1]


def test_codes_come_back_near_their_vectors(spark):
    table = scan(spark, SMALL, "embeddings")
    got, books = codebooks.compressed(table)
    vectors = {r.vec_id: np.array(r.embedding, float) for r in table.collect()}
    gaps = [((vectors[r.vec_id] - codebooks.decoded(books, r.entries)) ** 2).sum() for r in got.collect()]
    spread = ((np.stack(list(vectors.values())) - np.mean(list(vectors.values()), axis=0)) ** 2).sum(1).mean()
    assert np.mean(gaps) < 0.9 * spread


def test_only_what_changes_its_entry_is_shuffled(spark):
    """Later rounds move a small share of the parts."""
    table = scan(spark, SMALL, "embeddings")
    units = F.transform("embedding", lambda x: F.floor(x.cast("double") * 4096).cast("long"))
    kept = table.select(units.alias("u"), F.col("vec_id").alias("row"))
    start = [list(r.u) for r in kept.orderBy("row").limit(16).collect()]
    pieces = codebooks.cut(len(start[0]), 8)
    books = [[u[a:b] for u in start] for a, b in pieces]
    members, moved = codebooks.Members.first(kept, books, pieces, 500), []
    for _ in range(4):
        books = codebooks.updated(members.frame, books)
        members = members.migrated(books)
        moved.append(spark.read.parquet(members.folders[1]).count())
        assert members.frame.count() == 8 * table.count()
    assert moved[-1] < moved[0] / 2 and moved[0] < 8 * table.count() * 0.6
