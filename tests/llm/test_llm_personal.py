"""Personal data: base patterns against plain scans, estimates against known ones, spans against planted ones."""

from __future__ import annotations

import hashlib
import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SMALL
from tidemark.llm import personal
from tidemark.llm.queries import QUERIES
from tidemark.sources.tables import scan

# The contract's patterns, as they are stated.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(digits[::-1])) % 10 == 0


def plain(text):
    bare = lambda m: re.sub(r"[^0-9]", "", m[0])
    spans = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    spans += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    spans += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(bare(m)) <= 19 and luhn(bare(m))]
    spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(bare(m)) <= 15]
    return sorted(spans)


BITS = ["a", "b.", "@", ".", "1", "25", "300", "-", " ", "+4", "(", ")", "x@y.z", "1.2.3.4", "0255", "4111111111111111", "+1 (555) 123-4567", "é"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(BITS), max_size=25).map("".join))
def test_base_patterns_equal_a_plain_scan(text):
    assert sorted(personal.base_spans(text)) == plain(text)


def test_base_of_the_given_documents(spark):
    texts = {r.doc_id: r.text for r in scan(spark, SMALL, "documents").collect()}
    got = QUERIES["op12_personal_data"](spark, SMALL).collect()
    assert {r.doc_id for r in got} == set(texts) and len(got) == len(texts)
    for r in got:
        spans = plain(texts[r.doc_id])
        written = ",".join(f"{personal.BASE[k]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in spans) for i in range(4)]
        assert set(filter(None, written.split(","))) <= set(r.spans.split(","))
    # Invented prose holds nothing else.
    assert sum(r.n_more for r in got) == 0


def iban(draw):
    body = "".join(draw.choice("0123456789") for _ in range(18))
    check = 98 - int(body + "131400") % 97
    return f"DE{check:02d}{body}"


def corpus(n, seed=1):
    """Texts and the places of true spans, among others of the same shapes."""
    draw = random.Random(seed)
    number = lambda k: "".join(draw.choice("123456789") for _ in range(k))
    given = sorted(personal.GIVEN)
    name = lambda: f"{draw.choice(given)} {draw.choice(['Miller', 'Schmidt', 'Moreau', 'Ortega', 'Lindqvist', 'Okafor'])}"
    ssn = lambda: f"{draw.randrange(100, 600)}-{draw.randrange(10, 99)}-{draw.randrange(1000, 9999)}"
    tel = lambda: f"({number(3)}) {number(3)}-{number(4)}"
    true = [
        ("ssn", "the social security number {} is on file", ssn),
        ("ssn", "ssn {} was given", ssn),
        ("ssn", "she wrote {} on the form", ssn),
        ("tel", "please call {} after noon", tel),
        ("tel", "my phone is {} at work", tel),
        ("tel", "reached on {} yesterday", tel),
        ("iban", "transfer it to iban {} today", lambda: iban(draw)),
        ("iban", "it went to {} last week", lambda: iban(draw)),
        ("name", "signed by {} in person", name),
        ("name", "we met {} there", name),
        ("name", "dear {} thank you", name),
        ("street", "she lives at {} now", lambda: f"{number(2)} {draw.choice(['Oak', 'Mill', 'King'])} Street"),
        ("birth", "was born on {} in town", lambda: f"{draw.randrange(10, 28)}.{draw.randrange(10, 12)}.19{draw.randrange(30, 99)}"),
        ("mail", "write to {} soon", lambda: f"{draw.choice(given).lower()} (at) mail{number(2)} (dot) org"),
    ]
    false = [
        ("order {} has shipped", lambda: f"9{number(2)}-{number(2)}-0000"),
        ("part no. {} is out of stock", lambda: f"000-{number(2)}-{number(4)}"),
        ("see isbn {} for that", lambda: f"978 {number(1)}{number(2)} {number(4)} {number(1)}1"),
        ("table 4: 12 19 33 {} 81 7 44", lambda: f"{number(3)} {number(3)} {number(4)}"),
        ("version {} was released", lambda: f"{draw.randrange(10, 28)}.{draw.randrange(10, 12)}.20{draw.randrange(14, 24)}"),
        ("issue {} published", lambda: f"20{draw.randrange(14, 24)}-0{draw.randrange(1, 9)}-1{draw.randrange(0, 9)}"),
        ("model {} is new", lambda: f"ZQ{number(2)} {number(4)} {number(4)} {number(4)}"),
        ("we went to {} there", lambda: f"{draw.choice(['Saint', 'North'])} {draw.choice(['River', 'Park'])}"),
        ("and {} University is large", lambda: f"{draw.choice(['Charles', 'Victor'])} River"),
    ]
    fill = lambda: " ".join(draw.choice(["plain", "words", "about", "weather", "and", "then", "some", "more", "rain"]) for _ in range(draw.randrange(30, 60)))
    rows, planted = [], set()
    for i in range(n):
        text = fill()
        for _ in range(draw.randrange(0, 3)):
            if draw.random() < 0.5:
                kind, frame, make = draw.choice(true)
                before = frame.index("{}") + len(text) + 2
                value = make()
                planted.add((i, kind, before, before + len(value)))
            else:
                frame, make = draw.choice(false)
                value = make()
            text = f"{text}. {frame.format(value)} {fill()}"
        rows.append((i, text))
    return rows, planted


def test_planted_spans_are_found_and_others_are_not(spark):
    rows, planted = corpus(3000)
    got = personal.found(spark.createDataFrame(rows, "doc_id long, text string")).where("spans <> ''").collect()
    spans = {(r.doc_id, k, int(a), int(b)) for r in got for k, a, b in (s.split(":") for s in r.spans.split(","))}
    assert len(spans & planted) >= 0.95 * len(planted)
    assert len(spans & planted) >= 0.95 * len(spans)


def test_votes_alone_would_do_worse(spark):
    """The labelers disagree with the truth more often than the classifier does."""
    rows, planted = corpus(1500, seed=2)
    by_doc = {}
    for i, kind, a, b in planted:
        by_doc.setdefault(i, set()).add((personal.KINDS.index(kind), a, b))
    wrong = np.zeros(len(personal.LABELERS))
    cast = np.zeros(len(personal.LABELERS))
    for i, text in rows:
        for a, kind, b, votes, _ in personal.seen(text):
            truth = (kind, a, b) in by_doc.get(i, set())
            for j, v in enumerate(votes):
                cast[j] += 1
                wrong[j] += v == "0" or (v == "+") != truth
    assert (wrong / cast).min() > 0.05


def test_reliabilities_are_recovered():
    """Votes drawn from known rates: EM finds the rates and the share of true spans."""
    draw = np.random.default_rng(3)
    n = 20_000
    truth = draw.random(n) < 0.35
    rates = np.array([[[0.7, 0.2, 0.1], [0.5, 0.4, 0.1], [0.3, 0.5, 0.2], [0.2, 0.6, 0.2], [0.1, 0.8, 0.1], [0.6, 0.3, 0.1]]])
    rates = np.concatenate([rates, rates[:, :, ::-1] * 0.9 + 0.1 / 3])
    given = np.stack([[draw.choice(3, p=rates[int(t), j]) for t in truth] for j in range(6)], axis=1)
    patterns, counts = np.unique(given, axis=0, return_counts=True)
    model = personal.reliabilities(np.full(len(patterns), 5), patterns, counts.astype(float), steps=200)
    assert np.abs(model.rates[:, 5] - rates).max() < 0.06 and abs(model.prior[5] - 0.35) < 0.05
    p = model.posterior(np.full(n, 5), given)
    assert ((p > 0.5) == truth).mean() > max(((given[:, j] == 2) == truth).mean() for j in range(6))


def test_odd_rows(spark):
    rows = [(None, None), (1, ""), (1, "a@b.co"), (1, "a@b.co"), (2, "é\U0001f600 +1 555 123 4567 x"), (None, "1.2.3.4")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("id", "spans", "s", "kind", "votes", "at"):
        docs = docs.withColumn(name, F.lit(1))
    got = {(r.doc_id, r.spans): (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in personal.found(docs).collect()}
    assert got == {
        (None, ""): (0, 0, 0, 0),
        (1, ""): (0, 0, 0, 0),
        (1, "email:0:6"): (1, 0, 0, 0),
        (2, "phone:3:18"): (0, 0, 0, 1),
        (None, "ip:0:7"): (0, 1, 0, 0),
    }
    assert personal.found(docs).count() == len(rows) and personal.found(docs.limit(0)).collect() == []


def test_fit_is_the_same_for_any_partitioning(spark):
    rows, _ = corpus(300, seed=5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [sorted(map(tuple, personal.found(d).collect())) for d in (docs.coalesce(1), docs.repartition(7))]
    assert found[0] == found[1]


def test_redaction_hides_every_span(spark):
    rows, _ = corpus(200, seed=6)
    docs = spark.createDataFrame([*rows, (None, None)], "doc_id long, text string")
    spans = personal.stored(personal.scanned(docs), "spans")
    model = personal.train(spans)
    after = personal.redact(docs, model)
    assert after.columns == docs.columns and after.where("text is null").count() == 1
    hidden = {r.doc_id: r.text for r in after.collect()}
    texts = dict(rows)
    for r in personal.judged(spans, model).where("spans <> ''").collect():
        for kind, a, b in (s.split(":") for s in r.spans.split(",")):
            assert texts[r.doc_id][int(a) : int(b)] not in hidden[r.doc_id] and f"[{kind}]" in hidden[r.doc_id]


@pytest.mark.parametrize("bit", ["a", "1", "1.", "a@", "+1(", "A1 ", "Ab Cd. ", "1:", " at x", "dot at a ", "12-", "1 Aa ", "AB12 "])
def test_time_grows_with_the_text(bit):
    began = time.perf_counter()
    personal.seen(bit * (300_000 // len(bit)))
    assert time.perf_counter() - began < 20
