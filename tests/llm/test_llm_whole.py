"""Forms and sizes that a shorter search, a cap or a fixed block would lose."""

from __future__ import annotations

import json
import textwrap
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import chat, htmltext, neighbours, ordinal, packing, secretscan
from tidemark.llm.registry import QUERIES
from tidemark.llm.vocabularies import BYTE_BPE, BYTE_BPE_ADDED
from test_llm_models import SCHEMA, turns
from test_llm_texts import ARTICLE, BODY, PKCS8, RSA, SSH, b64

# --- packing -------------------------------------------------------------------------


def test_all_terms_of_a_seed_count():
    """The neighbour shares only words beyond the 32 heaviest of the seed."""
    seed = np.arange(100)
    terms = [seed, np.arange(40, 50), np.arange(200, 210)]
    tfs = [np.ones(len(t)) for t in terms]
    idf = np.linspace(5, 1, 300)
    sizes = np.array([600, 200, 424])
    shard, asked = packing.build(sizes, terms, tfs, sizes, idf, 400.0)
    shard.length[0] = 0
    assert packing.neighbours(shard, asked[0], np.arange(3)) == [1]


@pytest.mark.parametrize("text", ["<|endoftext|> a  b\n c ", "a <|endoftext|><|endoftext|>  b", "x<|endoftext|", "plain  text\n\n <|endoftext|>"])
def test_added_tokens_are_those_of_the_library(text):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert packing.encoder(*BYTE_BPE, BYTE_BPE_ADDED)(text).tolist() == t.encode(text, add_special_tokens=False).ids


def test_packing_query_takes_added_tokens(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a <|endoftext|> b", "en", "x", 17)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op10_lexical_packing"](spark, str(tmp_path)).first().doc_tokens == 5


# --- secrets -------------------------------------------------------------------------

LINES = "\n".join(textwrap.wrap(b64(PKCS8), 64))
HEADER = lambda s: b64(s.encode()).rstrip("=")


@pytest.mark.parametrize(
    "text,kinds",
    [
        (f"see /keys/{b64(RSA)} here", ["key64"]),
        (f"key_{b64(PKCS8)}", ["key64"]),
        (f"x/{b64(SSH)}", ["key64"]),
        (f"{b64(RSA)}/tail", ["key64"]),
        (json.dumps({"private_key": f"-----BEGIN PRIVATE KEY-----\n{LINES}\n-----END PRIVATE KEY-----\n"}), ["pem"]),
        (json.dumps({"k": LINES}), ["key64"]),
        (f"key:\n{LINES}\nend of it", ["key64"]),
        (f"-----BEGIN PRIVATE KEY-----\n{LINES}\n-----END PRIVATE KEY-----", ["pem"]),
        (f"t {HEADER('{' + chr(10) + ' ' + chr(34) + 'alg' + chr(34) + ': ' + chr(34) + 'HS256' + chr(34) + '}')}.e30.c2ln", ["jwt"]),
        (f"t {HEADER(chr(10) + '{' + chr(34) + 'alg' + chr(34) + ': ' + chr(34) + 'HS256' + chr(34) + '}')}.e30.c2ln", ["jwt"]),
        (f"key:\n{LINES[:-9]}\nend of it", []),
        ("MAKE THE MAIN\nMIDDLE MEET MB\nMA", []),
    ],
)
def test_keys_in_other_forms(text, kinds):
    found = sorted(secretscan.confirmed_spans(text))
    assert [secretscan.KINDS[k] for _, k, _ in found] == kinds
    hidden = secretscan.masked(text, "")
    assert not kinds or all(line[8:40] not in hidden for line in (LINES.split("\n")[0], b64(RSA), b64(SSH)))


# --- chat ----------------------------------------------------------------------------


def test_blocks_of_a_conversation_in_one_turn(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 8)
    rows = [(None, None, f"text {i:04d}") for i in range(300)] + [(1, 5, f"text {i:04d}") for i in range(300)]
    rows += [(2, i // 3, f"{i:04d}") for i in range(100)] + [(2, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    blocks = {}
    for r in chat.rows_of(df).collect():
        blocks.setdefault(r.conv, {}).setdefault(r.block, []).append((r.turn is not None, r.turn, r.text or ""))
    assert {c: sum(map(len, b.values())) for c, b in blocks.items()} == {None: 300, 1: 300, 2: 101}
    for held in blocks.values():
        assert max(map(len, held.values())) == 8 and len(held) == -(-sum(map(len, held.values())) // 8)
        order = [row for b in sorted(held) for row in sorted(held[b])]
        assert order == sorted(order)
    model = chat.train(spark.createDataFrame(turns(), SCHEMA))
    assert chat.formatted(df, model).count() == len(rows)


# --- pages ---------------------------------------------------------------------------


@pytest.mark.parametrize(
    "rest",
    ["<article>{}</article>", "<div>{}</div>"],
)
def test_main_text_of_two_parts(rest):
    html = f"<main><article>{BODY * 3}</article>{rest.format(BODY)}<div class=comments>{BODY}</div><div class=related>{BODY}</div></main>"
    assert htmltext.main_text(html) == "\n".join([ARTICLE] * 4)


# --- classifier ----------------------------------------------------------------------


def test_capitals_of_the_whole_text():
    assert ordinal.features("aaaaaaB" * 70) != ordinal.features("aaaaaab" * 70)
    text = "Aaaaaaa aaaaa" * 7
    trait = lambda n: zlib.crc32(f"\0capitals\0{n}".encode()) % ordinal.BUCKETS
    assert trait(10 * sum(map(str.isupper, text)) // len(text)) in ordinal.features(text)
    assert trait(1) in ordinal.features("aaaaaaB" * 70)


# --- neighbours ----------------------------------------------------------------------


def clustered(n, seed, spread=0.35, clusters=400, dim=64):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    return centres[rng.integers(0, clusters, n)] + rng.normal(size=(n, dim)) * spread


def test_the_ratio_alone_chooses_lists():
    """All lists within the ratio, however many, found over the graph; more while they hold too few vectors."""
    rng = np.random.default_rng(5)
    points, queries = rng.normal(size=(400, 64)), rng.normal(size=(20, 64))
    graph = neighbours.Graph.over(points)
    for ratio, least in ((1.15, 11), (1.4, 11), (1.0, 950)):
        shares = []
        for q, chosen in zip(queries, graph.within(queries, ratio, np.full(400, 100), least)):
            d = np.sqrt(((points - q) ** 2).sum(1))
            assert len(chosen) >= -(-least // 100)
            near = set(np.flatnonzero(d <= ratio * d.min()).tolist())
            shares.append(len(near & set(chosen.tolist())) / len(near))
        assert np.mean(shares) >= 0.9
    assert max(map(len, graph.within(queries, 1.4, np.full(400, 100), 11))) > 300


def test_centroids_are_measured_where_a_beam_is_too_narrow(monkeypatch):
    """No beam grows with the number of lists within the ratio, and none of those lists is missed."""
    rng = np.random.default_rng(6)
    points, queries = rng.normal(size=(600, 32)), rng.normal(size=(12, 32))
    graph, beams, search = neighbours.Graph.over(points), [], neighbours.Graph.search
    monkeypatch.setattr(neighbours.Graph, "search", lambda self, q, beam=neighbours.BEAM: (beams.append(beam), search(self, q, beam))[1])
    for q, chosen in zip(queries, graph.within(queries, 1.4, np.full(600, 100), 11)):
        d = np.sqrt(((points - q) ** 2).sum(1))
        assert sorted(chosen.tolist()) == np.flatnonzero(d <= 1.4 * d.min()).tolist() and len(chosen) > neighbours.BEAM
    assert max(beams) <= neighbours.BEAM


def test_bundles_hold_every_entry_once(monkeypatch):
    """A vector is sent once to a bundle, with its lists there; a query asks all parts of a long list."""
    monkeypatch.setattr(neighbours, "BUNDLE", 10)
    entries = np.array([4, 4, 35, 0, 9, 1, 10, 3])
    bundles = neighbours.Bundles.of(entries)
    chosen = [[0, 1, 2], [2], [], [7, 4, 0], [5, 3]]
    lists, node = pa.array(chosen, pa.list_(pa.int32())), np.array([5, -3, 2, 2**62, 0])
    row, bundle, there = bundles.split(lists, node)
    assert len(set(zip(row.tolist(), bundle.tolist()))) == len(row)
    assert sorted((r, l) for r, own in zip(row.tolist(), there.to_pylist()) for l in own) == sorted((r, l) for r, own in enumerate(chosen) for l in own)
    asked, places, names = bundles.split(lists)
    held = {(b, l) for b, own in zip(places.tolist(), names.to_pylist()) for l in own}
    assert {(b, l) for b, own in zip(bundle.tolist(), there.to_pylist()) for l in own} <= held
    assert sum(l == 2 for _, l in held) == 4 and len({b for b, l in held if l == 2}) == 4
    assert places.max() < len(bundles) and [len(x) for x in bundles.split(pa.array([], pa.list_(pa.int32())))] == [0, 0, 0]


def test_clustered_vectors_are_pruned():
    """50,000 vectors: boundary vectors are in several lists, few lists are read, and recall is at least 0.9."""
    x = clustered(50_000, 5)
    k = 10
    sample = x[np.random.default_rng(1).choice(len(x), 12_000, replace=False)]
    graph = neighbours.Graph.over(neighbours.balanced_centroids(sample, 24))
    ratio = neighbours.fitted_ratio(graph, sample, k)
    lists = [l for i in range(0, len(x), 1024) for l in neighbours.lists_of(*graph.search(x[i : i + 1024], neighbours.POST_BEAM))]
    sizes = np.array([len(l) for l in lists])
    assert sizes.max() <= neighbours.REPLICAS and 0.2 < (sizes > 1).mean() < 1
    held = np.bincount([l[0] for l in lists], minlength=len(graph.points))
    asked = np.arange(0, len(x), 250)
    chosen = graph.within(x[asked], ratio, held, k + 1)
    assert np.mean([len(c) for c in chosen]) < 0.3 * len(graph.points)
    node, flat = np.repeat(np.arange(len(x)), sizes), np.concatenate(lists)
    at, far = neighbours.best_in_lists(x[node], flat, node, x[asked], pa.array(chosen, pa.list_(pa.int32())), k + 1)
    true = np.argsort(neighbours.distances(x[asked], x), axis=1)[:, : k + 1]
    found = [len(set(node[a].tolist()) & set(t.tolist())) / (k + 1) for a, t in zip(at, true)]
    assert np.mean(found) >= 0.9
    for q, a, f in zip(asked, at, far):
        assert np.array_equal(f, np.sqrt(((x[node[a]] - x[q]) ** 2).sum(1)))


def test_long_lists_and_many_queries_in_several_tasks(spark, monkeypatch):
    """Bundles, blocks of queries and lists beyond a bundle change nothing; ties go to smaller ids."""
    monkeypatch.setattr(neighbours, "BUNDLE", 40)
    monkeypatch.setattr(neighbours, "QUERIES", 3)
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.integers(-2, 3, 3)]) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = {}
    for r in neighbours.nearest(df, F.col("id") % 20 == 0, k=5).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    usable = [(i, np.array(v)) for i, v in rows if any(v)]
    for q, v in usable:
        if q % 20 == 0:
            near = sorted((float(np.sqrt(((w - v) ** 2).sum())), i) for i, w in usable if i != q)[:5]
            assert sorted(got[q]) == [(n, i, s) for n, (s, i) in enumerate(near, 1)]


# --- repeated rows and order ---------------------------------------------------------


@pytest.mark.parametrize("doc_id", [3, None])
def test_packing_of_many_repeated_rows(spark, monkeypatch, doc_id):
    """More rows than a shard holds, all alike; and shards that stay empty."""
    monkeypatch.setattr(packing, "SHARD", 500)
    docs = spark.createDataFrame([(doc_id, "one text again and again")] * 1501, "doc_id long, text string")
    got = packing.packed(docs, *BYTE_BPE).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)
    assert sum(r.length for r in got) == 1501 * got[0].doc_tokens
    filled = {}
    for r in got:
        filled[r.sequence_id] = filled.get(r.sequence_id, 0) + r.length
    assert max(filled.values()) <= packing.WINDOW and len(filled) <= -(-sum(filled.values()) // packing.WINDOW) + 4


def test_packing_does_not_depend_on_the_order_of_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pieces = [
        sorted((r.doc_id, r.start, r.length, r.offset) for r in packing.packed(d, *BYTE_BPE).collect())
        for d in (docs.coalesce(1), docs.repartition(6), docs.orderBy("n_chars"))
    ]
    assert pieces[0] == pieces[1] == pieces[2]


# --- structures that are no keys ------------------------------------------------------


def test_a_digest_is_no_key():
    """SEQ{SEQ{OID sha256, NULL}, OCTET digest}: the form of an encrypted key, without encryption."""
    from test_llm_texts import der

    digest = der(0x30, der(0x30, der(0x06, bytes.fromhex("608648016503040201")), der(0x05)), der(0x04, bytes(range(32))))
    sealed = der(0x30, der(0x30, der(0x06, bytes.fromhex("2a864886f70d01050d")), der(0x05)), der(0x04, bytes(range(32))))
    for data, kinds in ((digest, []), (sealed, ["key64", "keyhex"])):
        spans = secretscan.confirmed_spans(f"{b64(data)} {data.hex()}")
        assert [secretscan.KINDS[k] for _, k, _ in sorted(spans)] == kinds


# --- one model ------------------------------------------------------------------------


def test_the_fit_does_not_depend_on_the_partitioning(spark):
    """Two texts under one id: the same one is taken, however the rows lie."""
    rows = [(i, f"{'good fine clear' if i % 3 == 2 else 'bad poor' if i % 3 else 'plain'} text number {i % 7}") for i in range(90)]
    rows += [(i, f"another text {i}") for i in range(0, 90, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    grades = spark.createDataFrame([(i, i % 3) for i in range(90)], "id long, grade int")
    models = [ordinal.train(d, grades, 3) for d in (docs.coalesce(1), docs.repartition(5), docs.orderBy("text"))]
    assert all(np.array_equal(m.weights, models[0].weights) for m in models)


def test_broadcasts_are_of_stated_things_only():
    """The rules of the library hold here too, but for checked broadcasts."""
    from pathlib import Path

    allowed = {"sparkContext.broadcast(", "F.broadcast(chosen)"}
    for path in (Path(packing.__file__).parent).glob("*.py"):
        code = path.read_text()
        for good in allowed:
            code = code.replace(good, "")
        for bad in ("broadcast(", "localCheckpoint", "toPandas", "crossJoin", ".rdd", "toLocalIterator"):
            assert bad not in code, (path, bad)
