"""N-gram Jaccard join against all pairs."""

from __future__ import annotations

import random
import re
import string

import numpy as np
import pytest

from tidemark.llm import graph, jaccard

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[root(i)] = root(j)
    lowest = {}
    for i, (d, _) in enumerate(rows):
        lowest[root(i)] = min(d, lowest.get(root(i), d))
    return {d: (len(s), lowest[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))}


def corpus():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = []
    for size in (3, 5, 8, 30, 120, 400):
        base = [word() for _ in range(size)]
        for edits in (0, 0, 1, 1, 2, 3, 5, 8):
            text = list(base)
            for _ in range(edits):
                text[rng.randrange(size)] = word()
            rows.append(" ".join(text))
    passage = " ".join(word() for _ in range(40))
    rows += [" ".join(word() for _ in range(60)) + " " + passage for _ in range(15)]
    rows += [None, "", " \n ", "One two", "one TWO", "x", "É é", "é é", "a\x0bb c\x0cd", "a b c d"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("k,percent,block", [(4, 85, 1024), (5, 80, 3)])
def test_components_equal_brute_force(spark, monkeypatch, k, percent, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = corpus()
    docs = spark.createDataFrame([(d, t, "n", 0) for d, t in rows], "doc_id long, text string, node string, keys int").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs, k, percent).collect()}
    assert got == brute(rows, k, percent)


@pytest.mark.parametrize("seed", range(5))
def test_grouped_prefix_join_connects_what_is_similar(seed):
    rng = np.random.default_rng(seed)
    base = [rng.choice(400, n, replace=False) for n in (5, 20, 60)]
    sets = []
    for _ in range(60):
        s = base[rng.integers(3)].copy()
        s[rng.integers(len(s), size=rng.integers(0, 4))] = rng.integers(400, 500)
        sets.append(np.unique(s).astype(np.uint64))
    want = graph_of(sets, lambda a, b: 100 * len(a & b) >= 85 * len(a | b))
    links = jaccard.grouped_prefix_join(sets, 85)
    assert all(100 * len(set(sets[i]) & set(sets[j])) >= 85 * len(set(sets[i]) | set(sets[j])) for i, j in links)
    assert parts(len(sets), links) == want


def graph_of(sets, similar):
    own = [set(s.tolist()) for s in sets]
    return parts(len(sets), [(i, j) for i in range(len(sets)) for j in range(i) if similar(own[i], own[j])])


def parts(n, links):
    label = list(range(n))
    for _ in range(n):
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
    return label


def test_one_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(3, text, 1), (1, text, 2), (1, text, 2), (2, text + " end", 3), (9, "other words", 4), (None, text, 5), (8, None, 6), (7, "", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long")
    kept = jaccard.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n) for r in kept.collect()) == [(False, 1, 2), (False, 7, 7), (False, 8, 6), (False, 9, 4), (True, 0, 5)]


def test_components_of_paths_hubs_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.label for r in graph.components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.near_duplicates(docs).count() == 0


def test_a_null_id_bridges_two_documents(spark):
    """5 - null - 7: what links over a text without an id is one component."""
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(words), " ".join([*words[:272], *"abcdefgh"]), " ".join([*words[:244], *"abcdefghijklmnop"])]
    rows = [(5, texts[0]), (None, texts[1]), (7, texts[2])]
    found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()
    assert {r.doc_id: r.component_id for r in found if r.doc_id} == {5: 5, 7: 5}
    same = jaccard.near_duplicates(spark.createDataFrame([(1, texts[0]), (2, texts[1]), (7, texts[2])], "doc_id long, text string"), 4, 85)
    assert {r.component_id for r in same.collect()} == {1}


def test_one_id_for_many_documents(spark):
    """800 documents of one id: every text is looked at once, and repeated rows once for all."""
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join([*words, f"x{i % 400}"])) for i in range(800)] + [(2, "quite another text of five words")]
    found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()
    assert len(found) == 801 and {(r.doc_id, r.component_id) for r in found} == {(1, 1), (2, 2)}


@pytest.mark.parametrize("percent", [50, 80, 85])
def test_similar_sets_share_a_key_whatever_is_common(percent):
    rng = np.random.default_rng(percent)
    for size in [1, 2, 3, 5, 8, 17, 40, 100, 333, 900] * 6:
        tokens = np.unique(rng.integers(0, 2**64, size, np.uint64))
        most = size * (100 - percent) // percent  # elements that may be added, or as many in all
        other = np.unique(np.concatenate([tokens, rng.integers(0, 2**64, most, np.uint64)]))
        fewer = rng.choice(tokens, -(-size * percent // 100), replace=False)
        common = np.sort(rng.choice(other, rng.integers(0, len(other) + 1), replace=False))
        for near in (other, np.sort(fewer)):
            for hidden in (common, tokens, np.zeros(0, np.uint64)):
                assert np.isin(jaccard.keys(tokens, percent, hidden), jaccard.keys(near, percent, hidden)).any()


def test_unlike_sets_share_no_key():
    rng = np.random.default_rng(1)
    passage = rng.integers(0, 2**64, 12, np.uint64)
    sets = [np.unique(np.concatenate([passage, rng.integers(0, 2**64, n, np.uint64)])) for n in rng.integers(200, 500, 400).tolist()]
    found = [np.unique(jaccard.keys(s, 80, np.sort(passage))) for s in sets]
    values, counts = np.unique(np.concatenate(found), return_counts=True)
    shared = values[counts > 1]
    assert sum(np.isin(f, shared).any() for f in found) < 20


def test_shared_passages_are_found_once_per_text(spark):
    words = lambda i: " ".join(f"w{i}x{j}" for j in range(30))
    rows = [(i, f"{words(i)} one licence for all of these texts") for i in range(20)] + [(50 + i, words(99)) for i in range(30)]
    docs = spark.createDataFrame([*rows, (None, None), (90, "")], "doc_id long, text string")
    assert len(jaccard.common_shingles(docs, 5, "text")) == 3
    assert len(jaccard.common_shingles(docs.limit(0), 5, "text")) == 0


def test_a_long_passage_makes_no_family_of_unlike_texts(spark, monkeypatch):
    """A third of every text is one passage that no sampled text tells of: families stay those of the copies."""
    monkeypatch.setattr(jaccard, "SAMPLE", 1)
    passage = " ".join(f"licence{j}" for j in range(60))
    words = lambda i, j: f"w{i}x{j}"
    rows = [(i, " ".join([*(words(i // 2, j) for j in range(100)), *(["and"] * (i % 2)), passage])) for i in range(120)]
    seen, join = [], jaccard.links_in_families

    def noted(members, *rest):
        seen.extend(members.groupBy("family").count().collect())
        return join(members, *rest)

    monkeypatch.setattr(jaccard, "links_in_families", noted)
    found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: i - i % 2 for i in range(120)}
    assert max(r["count"] for r in seen) < 20


def test_keys_are_given_up_in_one_order(spark):
    """Of the keys that two sets share, those given up leave at least one, however often others have them."""
    rng = np.random.default_rng(4)
    base = [np.unique(rng.integers(0, 2**64, n, np.uint64)) for n in (1, 3, 9, 40, 160)]
    passage = rng.integers(0, 2**64, 200, np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(b, -(-len(b) * 9 // 10), replace=False), rng.choice(passage, len(b) // 2, replace=False)])) for b in base for _ in range(12)]
    for hidden in (jaccard.NONE, np.sort(passage)[:60]):
        found = [jaccard.keys(s, 80, hidden) for s in sets]
        keyed = spark.createDataFrame([(i, int(k)) for i, f in enumerate(found) for k in f.view(np.int64)], "node long, key long")
        left = spark.createDataFrame([(i, *jaccard.surplus(f, len(s), 80)) for i, (f, s) in enumerate(zip(found, sets))], "node long, left0 int, left1 int")
        links = [tuple(r) for r in jaccard.key_links(keyed.unionByName(keyed), left).collect()]
        label = parts(len(sets), links)
        own = [set(s.tolist()) for s in sets]
        near = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(own[i] & own[j]) >= 80 * len(own[i] | own[j])]
        assert near and all(label[i] == label[j] for i, j in near)


def test_rows_that_are_likely_among_others(spark):
    spots = [0, -1, 5, 32767, 32768, 1 << 24, -(1 << 40) + 7, 2**63 - 1, 123456789, 40]
    rows = spark.createDataFrame([(s, "t") for s in [*spots, 41, 6, 99]], "spot long, text string")
    members = spark.createDataFrame([(s,) for s in spots * 2], "spot long")
    got = jaccard.likely_among(rows, members)
    assert got.columns == ["spot", "text", "likely"]
    assert {r.spot: r.likely for r in got.collect()} == {s: s in spots for s in [*spots, 41, 6, 99]}
    assert not any(r.likely for r in jaccard.likely_among(rows, members.limit(0)).collect())
