"""Packing: ids of many texts at once, and the terms that many documents of a shard hold."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import packing
from tidemark.llm.vocabularies import BYTE_BPE, BYTE_BPE_ADDED

ODD = [*"abZ\u00e9'\u2019.,!#09 \n\t\r\x0b\x0c\x1c\x1f\x85\xa0\u1680\u2000\u2009\u200a\u2028\u2029\u202f\u205f\u3000\u8a9e\u00df\u00c0\u0663\u00bd\u0301\U0001d518\U0001f600", "'s", "'ll", "  ", " the", "don't", "<|endoftext|>", "\n\n"]


@pytest.mark.parametrize("chunk", [packing.CHUNK, 40])
def test_ids_of_many_texts_are_those_of_each(monkeypatch, chunk):
    monkeypatch.setattr(packing, "CHUNK", chunk)
    draw = random.Random(5)
    texts = ["".join(draw.choices(ODD, k=draw.randrange(30))) for _ in range(1500)] + [None, "", " ", "\u00e9 ", "\u00c0\u00a0 a", "\u2029 a"]
    for encode, marked in ((packing.encoder(*BYTE_BPE, BYTE_BPE_ADDED), True), (packing.encoder(*BYTE_BPE), False), (packing.encoder(BYTE_BPE[0], r"\w+|\W"), False)):
        given = pa.array(["left out", *texts])[1:]
        got = [ids[b - c : b].tolist() for ids, counts in encode.rows(given) for b, c in zip(np.cumsum(counts).tolist(), counts.tolist())]
        assert got == [encode(t or "").tolist() for t in texts]
        assert any(BYTE_BPE_ADDED["<|endoftext|>"] in ids for ids in got) == marked
    assert list(encode.rows(pa.array([], pa.string()))) == []


def test_each_distinct_word_is_encoded_once(monkeypatch):
    encode, seen = packing.encoder(*BYTE_BPE, BYTE_BPE_ADDED), []
    plain = encode.plain
    monkeypatch.setattr(encode, "plain", lambda text, *a: seen.append(text) or plain(text, *a))
    texts = ["Anblewh sttible athawh. " * 50 + "thonre wasé" for _ in range(200)]
    (ids, counts), = encode.rows(pa.array(texts))
    assert sum(map(len, seen)) < len(texts[0])
    assert ids.tolist() == plain(texts[0]).tolist() * 200 and set(counts.tolist()) == {len(ids) // 200}


def test_term_counts_of_rows():
    rows = [np.array(x, np.uint16) for x in ([5, 65535, 5, 0], [], [65535], [])]
    terms, tfs = packing.term_counts(np.concatenate(rows), np.array([len(r) for r in rows], np.int32))
    assert terms.to_pylist() == [[0, 5, 65535], [], [65535], []] and tfs.to_pylist() == [[1, 2, 1], [], [1], []]


def test_scores_with_common_terms():
    draw = np.random.default_rng(3)
    terms = [np.sort(np.concatenate([draw.choice(40, 20, False), 100 + draw.choice(5000, 15, False)])) for _ in range(300)]
    tfs = [draw.integers(1, 9, len(t)) for t in terms]
    sizes, idf = draw.integers(100, 1000, 300), draw.random(1 << 16)
    shard, asked = packing.build(sizes.copy(), terms, tfs, sizes, idf, 500.0)
    assert len(shard.common) == 40 and len(shard.doc) == 300 * 15
    weigh = lambda t, f, n: idf[t] * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * n / 500))
    for seed in (0, 7, 299):
        want = [sum(weigh(t, f, n) for t, f in zip(ts, fs) if t in asked[seed]) for ts, fs, n in zip(terms, tfs, sizes)]
        assert np.allclose(shard.scores(asked[seed]), want, rtol=1e-12)
