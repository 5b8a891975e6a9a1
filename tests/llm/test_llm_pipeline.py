"""The pipeline's stages on a small corpus, each against brute force on its own input."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SMALL
from test_llm_jaccard import brute as components_of
from test_llm_models import check_packing, ids_of
from test_llm_suffixes import brute as digests_of
from tidemark.llm import queries, secretscan
from tidemark.llm.registry import QUERIES
from tidemark.session import scratch_path
from tidemark.sources.tables import scan


@pytest.fixture(scope="module")
def stages(spark):
    """The input of every stage, and the result of the last."""
    frames = [scan(spark, SMALL, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        folder = scratch_path(spark, f"test-{name}")
        stage(spark, frames[-1], SMALL).write.parquet(folder)
        frames.append(spark.read.parquet(folder))
    return frames


def test_stages_keep_the_columns_of_documents(stages):
    assert all(sorted(f.dtypes) == sorted(stages[0].dtypes) for f in stages[:-1])


def test_quality_keeps_what_the_sql_keeps(stages):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = {r[0] for r in con.execute(f"SELECT doc_id FROM ({queries.QUALITY_SQL}) WHERE kept").fetchall()}
    kept = {r.doc_id: r for r in stages[1].collect()}
    assert kept.keys() == want
    assert all(kept[r.doc_id] == r for r in stages[0].select(stages[1].columns).collect() if r.doc_id in kept)


def test_one_near_copy_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    want = {lowest for _, lowest in components_of(rows, 5, 80).values()}
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(want)


def test_repeated_passages_go(stages):
    rows = stages[2].collect()
    want = dict(zip([r.doc_id for r in rows], digests_of([r.text for r in rows])))
    got = {r.doc_id: r for r in stages[3].collect()}
    assert got.keys() == want.keys()
    for d, (size, gone, _, _) in want.items():
        assert size - gone - 6 <= len(got[d].text.encode()) <= size - gone
        assert got[d].n_chars == len(got[d].text)


def test_secrets_are_hidden(stages):
    before = {r.doc_id: r.text for r in stages[3].collect()}
    after = {r.doc_id: r.text for r in stages[4].collect()}
    assert after == {d: secretscan.masked(t, "[{kind}]") for d, t in before.items()}


def test_packing_holds_every_document(stages):
    check_packing(stages[5].collect(), {r.doc_id: ids_of(r.text) for r in stages[4].collect()}, 0.05)


def test_every_operator_is_registered():
    numbers = sorted(int(n.split("_")[0][2:]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [n.split("_")[0] for n in entry.oracle_sql() if n.startswith("op")] == ["op2"]
