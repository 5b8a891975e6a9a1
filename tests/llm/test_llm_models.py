"""Nearest neighbours, packing, pieces, chat, classifier."""

from __future__ import annotations

import itertools
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tidemark.llm import chat, neighbours, ordinal, packing, pieces
from tidemark.llm.vocabularies import BYTE_BPE, PIECES

# --- neighbours ----------------------------------------------------------------------


def exact(rows, queries, k):
    out = {}
    for q, v in queries:
        near = []
        own = True
        for i, w in rows:
            if own and i == q and w == v:
                own = False
                continue
            near.append((float(np.sqrt(((np.array(w) - np.array(v)) ** 2).sum())), i))
        out[q] = sorted(near)[:k]
    return out


def test_neighbours_of_a_small_table(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in rng.normal(size=6).astype(np.float32)]) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(120)] + [(5000, rows[7][1])]
    odd = [(2000, None), (2100, [0.0] * 6), (2200, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2300, [float("nan")] * 6), (2400, [1.0, 2.0]), (None, [1.0] * 6), (2500, [float("inf")] * 6)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows + odd], "vec_id long, embedding array<float>, node string")
    got = {}
    for r in neighbours.nearest(df, F.col("id") % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = exact(rows, [(i, v) for i, v in rows if i % 100 == 0], 10)
    assert got.keys() == want.keys()
    hits = 0
    for q, near in got.items():
        assert [r for r, _, _ in sorted(near)] == list(range(1, 11))
        hits += len({i for _, i, _ in near} & {i for _, i in want[q]})
    assert hits >= 0.9 * 10 * len(want)
    # The query's copies come first, smaller ids before larger ones.
    assert [(i, s) for _, i, s in sorted(got[0])] == [(1000 + i, 0.0) for i in range(10)]


def test_neighbours_of_few_and_of_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [3.0, 0.0])], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, neighbours.nearest(df, F.col("id") == 0).collect()))
    assert got == [(0, 1, 1, 2**0.5), (0, 2, 2, 2.0)]
    assert neighbours.nearest(df.limit(0), F.col("id") == 0).count() == 0
    assert neighbours.nearest(df.where("vec_id = 0"), F.col("id") == 0).count() == 0


def test_recall_of_the_index(spark):
    df = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    want = exact(rows, [(i, v) for i, v in rows if i % 100 == 0], 10)
    got = {}
    for r in neighbours.nearest(df, F.col("id") % 100 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert sum(len(got[q] & {i for _, i in near}) for q, near in want.items()) >= 9 * len(want)


# --- packing -------------------------------------------------------------------------


def ids_of(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def check_packing(rows, texts, padding):
    """Pieces cover every document once and sequences are gapless; ``texts`` by id."""
    sequences, places = {}, {}
    for r in rows:
        ids = texts[r.doc_id]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        places.setdefault(r.doc_id, []).append((r.start, r.length))
    for d, found in places.items():
        at = 0
        for start, length in sorted(found):
            assert start == at
            at += length
        assert at == len(texts[d])
    assert places.keys() == texts.keys()
    used = padded = 0
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at and length > 0
            at += length
        assert at <= packing.WINDOW
        used, padded = used + at, padded + (packing.WINDOW - at if at & (at - 1) else 0)
    assert padded <= padding * used


@pytest.mark.parametrize("shard", [packing.SHARD, 30])
def test_packing_of_the_small_corpus(spark, monkeypatch, shard):
    monkeypatch.setattr(packing, "SHARD", shard)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("n", F.lit("clash"))
    texts = {r.doc_id: ids_of(r.text) for r in docs.collect()}
    check_packing(packing.packed(docs, *BYTE_BPE).collect(), texts, 0.05)


def test_packing_of_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [(1, None), (2, ""), (3, "<|endoftext|> a  b\n c "), (4, long), (5, "é😀"), (6, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check_packing(packing.packed(docs, *BYTE_BPE).collect(), {d: ids_of(t) for d, t in rows}, 0.5)
    assert packing.packed(docs.limit(0), *BYTE_BPE).count() == 0
    twins = spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id long, text string")
    assert packing.packed(twins, *BYTE_BPE).agg(F.sum("length")).first()[0] == 2 * len(ids_of("a b"))


def test_checksums_of_pieces():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 50000, 700)
    crcs = packing.prefix_crcs(ids)
    for start in (0, 16, 320):
        for end in (start + 16, 640, 700):
            want = zlib.crc32(ids[start:end].astype("<u4").tobytes())
            before = crcs[start // 16 - 1] if start else 0
            assert packing.piece_crc(before, crcs[-(-end // 16) - 1], end - start) == want


def test_related_documents_share_windows():
    """A seed takes the neighbour with its words, not the one beside it."""
    terms = [np.array([1, 2]), np.array([3, 4]), np.array([1, 2]), np.array([3, 4])]
    ones = [np.ones(2)] * 4
    idf = np.ones(10)
    shard, asked = packing.build(np.array([600, 590, 424, 434]), terms, ones, np.array([600, 590, 424, 434]), idf, 500.0)
    assert [[d for d, _, _ in w] for w in packing.fill(shard, asked)] == [[0, 2], [1, 3]]


# --- pieces --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Pieces(PIECES)


def all_ways(vocabulary, word):
    into, _ = vocabulary.lattice(word)

    def back(end):
        if not end:
            yield 0.0, ()
        for start, ids, score in into[end]:
            for s, before in back(start):
                yield s + score, before + ids

    return sorted(back(len(word)), key=lambda w: -w[0])


@pytest.mark.parametrize("word", ["▁the", "▁thanedble", "▁réeux", "▁x漢y", "▁ing.\n", "a"])
def test_nbest_of_a_word_is_exact(vocabulary, word):
    got = vocabulary.best(word, 5)
    want = all_ways(vocabulary, word)[:5]
    assert [round(s, 6) for s, _ in got] == [round(s, 6) for s, _ in want]
    assert len({ids for _, ids in got}) == len(got)


@pytest.mark.parametrize("text", ["the thanedble of", "réeux aa bb", "the the the", "", None])
def test_nbest_of_a_text_is_exact(vocabulary, text):
    words = pieces.WORD.findall(vocabulary.model.normalize(text or ""))
    ways = itertools.product(*[all_ways(vocabulary, w)[:4] for w in words])
    want = sorted(-sum(s for s, _ in way) for way in ways)[:4]
    got = vocabulary.nbest(text, 4)
    assert [round(s, 6) for s, _ in got] == [round(-s, 6) for s in want]


def test_a_very_long_word(vocabulary):
    """Time and memory grow with the word."""
    import random
    import time
    import tracemalloc

    draw = random.Random(1)
    word = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000))
    began = time.perf_counter()
    ways = vocabulary.best("▁" + word[:20_000], 2)
    first = time.perf_counter() - began
    assert len(ways) == 2 and ways[0][0] >= ways[1][0] and first < 60
    tracemalloc.start()
    text = vocabulary.nbest(word[:20_000], 3)
    assert len(text) == 3 and tracemalloc.get_traced_memory()[1] < 10**9
    tracemalloc.stop()


@pytest.mark.parametrize("text", ["plain words", "  two  spaces ", "tab\tand\nline", "漢字 and é😀", "a b", "\x00\x07", "x" * 5000])
def test_round_trip(vocabulary, text):
    whole = vocabulary.model.normalize(text).replace(pieces.SPACE, " ").removeprefix(" ")
    for _, ids in vocabulary.nbest(text, 3):
        assert vocabulary.decode(ids) == whole


def test_pieces_of_a_table(spark):
    docs = spark.createDataFrame([(1, "some words", 1), (1, "some words", 1), (2, None, 1), (None, "", 1)], "doc_id long, text string, scores int")
    got = pieces.encoded(docs, PIECES).collect()
    assert len(got) == 4 and all(r.round_trip and r.crcs[0] == r.ids_crc32 for r in got)
    assert pieces.encoded(docs.limit(0), PIECES).count() == 0


# --- chat ----------------------------------------------------------------------------


def turns():
    rng = random.Random(4)
    say = lambda n: " ".join("word" for _ in range(n))
    rows = []
    for c in range(60):
        at = 0
        if c % 3 == 0:
            rows.append((c, at, "system", say(60) + "."))
            at += 1
        for _ in range(rng.randint(1, 4)):
            rows += [(c, at, "user", say(rng.randint(4, 9)) + "?"), (c, at + 1, "assistant", say(200) + "\n" + say(150))]
            at += 2
    return rows


SCHEMA = "conv_id long, turn int, role string, text string"


@pytest.mark.parametrize("block", [chat.BLOCK, 2])
def test_roles_are_recovered(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK", block)
    df = spark.createDataFrame(turns(), SCHEMA)
    model = chat.train(df.where("conv_id < 30"))
    held = df.where("conv_id >= 30")
    got = {(r.conv_id, r.turn): r for r in chat.formatted(held.drop("role"), model).collect()}
    assert len(got) == held.count()
    assert all(got[c, t].role == role and got[c, t].rendered == f"<|{role}|>\n{text}\n<|end|>" for c, t, role, text in turns() if c >= 30)


def test_blocks_give_one_long_viterbi_run(spark):
    model = chat.train(spark.createDataFrame(turns(), SCHEMA))
    rng = random.Random(8)
    texts = [" ".join("w" for _ in range(rng.randint(1, 300))) for _ in range(23)]
    whole = chat.decoded(model, texts, chat.NONE)
    score, back = None, []
    for i in range(0, 23, 5):
        m = chat.reduced(model, texts[i : i + 5])
        score = m[chat.NONE] if score is None else (score[:, None] + m[: chat.NONE]).max(0)
        back.append(score)
    best = sum((model.step[a, b] for a, b in zip(whole, whole[1:])), model.start[whole[0]])
    best += sum(e[r] for (_, e), r in zip(model.moves(texts), whole))
    assert np.isclose(score.max(), best)


def test_markers_and_odd_rows(spark):
    model = chat.train(spark.createDataFrame(turns(), SCHEMA))
    text = "User: hi?\nAssistant: hello\nthere\n### Human: bye"
    rows = [(1, 0, None, text), (1, 0, None, text), (2, None, None, None), (None, 3, None, "")]
    got = sorted(chat.formatted(spark.createDataFrame(rows, SCHEMA).drop("role"), model).collect(), key=str)
    mine = [(r.part, r.role, r.rendered) for r in got if r.conv_id == 1]
    assert sorted(mine) == [(0, "user", "<|user|>\nhi?\n<|end|>"), (1, "assistant", "<|assistant|>\nhello\nthere\n<|end|>"), (2, "user", "<|user|>\nbye\n<|end|>")]
    assert len(got) == 5
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.formatted(empty.drop("role"), chat.train(empty)).count() == 0


# --- classifier ----------------------------------------------------------------------


def test_grades_on_held_out_documents(spark):
    rng = random.Random(6)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnop") + rng.choice("qrstuv")
    rows = []
    for i in range(1500):
        text = [word() for _ in range(60)]
        if i % 3 == 0:
            text[rng.randrange(60)] = rng.choice(["vile", "hateful"])
        if i % 3 == 1:
            text = [w + "!!#" for w in text]
        rows.append((i, " ".join(text), i % 3, "x"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, grade int, score string")
    model = ordinal.train(docs, docs.where("doc_id < 1200").select(F.col("doc_id").alias("id"), "grade"), 3)
    assert (np.diff(model.thresholds) > 0).all()
    got = {r.doc_id: r for r in ordinal.score(docs, model).collect()}
    held = [(got[i], g) for i, _, g, _ in rows if i >= 1200]
    assert sum(r.kept == (g == 2) for r, g in held) > 0.95 * len(held)
    assert sum(round(r.expected_grade) == g for r, g in held) > 0.9 * len(held)


def test_classifier_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (1, None), (None, "a"), (2, "")], "doc_id long, text string")
    none = spark.createDataFrame([(1, None), (None, 2), (7, 9)], "id long, grade int")
    model = ordinal.train(docs, none, 3)
    got = ordinal.score(docs, model).collect()
    assert len(got) == 4 and {r.score for r in got} == {0.0}
    assert ordinal.score(docs.limit(0), model).count() == 0


def test_gradient_steps_raise_the_likelihood():
    rng = np.random.default_rng(0)
    documents = [np.array([g, 10 + rng.integers(5)]) for g in (0, 1, 2) for _ in range(50)]
    model = ordinal.fit(documents, np.repeat([0, 1, 2], 50), 3)
    tails = model.tails(np.array([model.weights[[g]].sum() for g in (0, 1, 2)]))
    assert (np.diff(tails.sum(1)) > 0.3).all()


@pytest.mark.parametrize("word", ["▁", "▁blein.\nWas", "▁anenor.\nOf", "▁Ñrrbo&&&", "aaaaaaa", "▁aaa aaa", "日本\0x", "▁un\U0001f600der,"])
def test_words_are_put_together_from_stretches(vocabulary, word):
    score, ids, second = vocabulary.known_word(word)
    ways = vocabulary.best(word, 2)
    assert (score, ids) == ways[0]
    assert second == (ways[0][0] - ways[1][0] if len(ways) > 1 else math.inf)


def test_a_stretch_is_segmented_once(monkeypatch):
    vocabulary, asked = pieces.Pieces(PIECES), []
    first = vocabulary.first
    monkeypatch.setattr(vocabulary, "first", lambda stretch: asked.append(stretch) or first(stretch))
    vocabulary.nbest("anenor. anenor, anenor.\nAnenor", 1)
    assert len(asked) == len(set(asked)) and sum("anenor" in a for a in asked) == 1


def test_neighbours_beyond_the_gap_are_not_ranked():
    terms = [np.array([1, 2, 3]), np.array([1, 2, 3]), np.array([1, 2]), np.array([1]), np.array([4])]
    sizes = np.array([700, 500, 400, 300, 200])
    shard, asked = packing.build(sizes, terms, [np.ones(len(t)) for t in terms], sizes, np.ones(1 << 16), 500.0)
    shard.length[0] = 0
    assert packing.neighbours(shard, asked[0], np.arange(5), 324) == [1, 3]  # of 1 and 2 only the better one
    assert packing.neighbours(shard, asked[0], np.arange(5)) == [1, 2, 3]


def test_rarest_tokens_of_rows():
    rng = np.random.default_rng(2)
    idf = np.round(rng.random(1 << 16), 2)
    rows = [np.unique(rng.integers(0, 1 << 16, n)) for n in [0, 1, 5, 0, 3, 200, 2, 1, 0]]
    rarest = np.argsort(-idf, kind="stable")
    rank = np.argsort(rarest, kind="stable")
    for part in (slice(0, 9), slice(1, 6), slice(0, 1), slice(0, 0)):
        lists = packing.lists(rows).slice(part.start, part.stop - part.start)
        wanted = [(ids[np.lexsort((ids, -idf[ids]))[:2]].tolist() + [-1, -1])[:2] for ids in rows[part]]
        assert [list(x) for x in zip(*map(np.ndarray.tolist, packing.rarest_two(lists, rank, rarest)))] == wanted
        assert packing.last_of(lists, np.full(len(wanted), -7)).tolist() == [int(r[-1]) if len(r) else -7 for r in rows[part]]


def test_one_encoder_per_worker():
    assert packing.loaded(*BYTE_BPE, ()) is packing.loaded(*BYTE_BPE, ())
    lists = packing.lists([np.array([9, 1]), np.zeros(0, int), np.array([2])]).slice(1, 2)
    assert [r.tolist() for r in packing.rows_of(lists)] == [[], [2]]
