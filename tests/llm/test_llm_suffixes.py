"""Suffix-array dedup against a count of every window."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import suffixes
from tidemark.llm.gsaca import suffix_array

L = suffixes.LENGTH


def brute(texts):
    """(n_bytes, n_removed, n_spans, digest) of every text."""
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + L] for b in bodies for i in range(len(b) - L + 1))
    out = []
    for b in bodies:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - L + 1):
            if seen[b[i : i + L]] > 1:
                gone[i : i + L] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_grouping_sorts_suffixes(text):
    assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def corpus():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé ß.") for _ in range(rng.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, other = text(60), text(90)
    texts = [text(80) + passage + text(rng.randint(0, 50)) for _ in range(12)]
    texts += [text(20) + other[k:] + text(9) for k in range(0, 40, 7)] + [other] * 3
    texts += [None, "", "short", "short", "x" * 199, "y" * 200, "z" * 500, "z" * 201, "ab" * 300]
    texts += [passage[: L // 2] + passage[L // 2 :] + passage, text(4000)]
    near = text(150).split(" ")
    for i in range(15):
        edited = list(near)
        edited[rng.randrange(len(near))] = word()
        texts.append(" ".join(edited))
    return texts


@pytest.mark.parametrize("many", [suffixes.MANY, 2])
def test_removal_equals_brute_force(spark, many):
    texts = corpus()
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, h int").repartition(5)
    found = suffixes.repeated_spans
    suffixes.repeated_spans = lambda d, c: found(d, c, many)
    try:
        got = {r[0]: tuple(r)[1:] for r in suffixes.digests(docs).collect()}
    finally:
        suffixes.repeated_spans = found
    assert got == dict(enumerate(brute(texts)))


def test_null_ids_and_repeated_rows(spark):
    text = "".join(random.Random(1).choice("abcdef ") for _ in range(400))
    docs = spark.createDataFrame([(None, text), (1, text), (1, "alone"), (None, None)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in suffixes.digests(docs).collect() if r.doc_id)
    assert got == [(1, 5, 0, 0), (1, 400, 400, 1)]
    assert suffixes.digests(docs).count() == 4


def test_removed_keeps_columns_and_characters(spark):
    shared = "é" * 150
    docs = spark.createDataFrame([(1, "a" + shared, 7), (2, "b" + shared + "ü", 8), (3, None, 9)], "doc_id long, text string, spans int")
    got = {r.doc_id: (r.text, r.spans) for r in suffixes.removed(docs).collect()}
    assert suffixes.removed(docs).columns == docs.columns
    # The first byte of ü continues the run of é: its other byte cannot stay alone.
    assert got == {1: ("a", 7), 2: ("b", 8), 3: (None, 9)}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.digests(docs).count() == 0
