"""Personal data: base spans against the plain patterns, the label model, added spans."""

import hashlib
import re

import numpy as np
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelspark.llm.pii import (
    KINDS, Span, Taken, base_spans, dawid_skene, find, fit, listed, luhn, masked, proposed_spans,
)

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text: str) -> list[tuple]:
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(found)


def test_luhn():
    assert luhn("4111111111111111") and luhn("0" * 12) and not luhn("4111111111111112")


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="0123456789.+ -()@aZ_%é\n", max_size=60))
@example("a@b.c@d.e f@g.h")
@example("1.2.3.4.5.6.7.8 1.2.3.300 001.002.003.004")
@example("4111-1111 1111-1111 4111111111111111 41111111111111110000")
@example("+1 (132) 555-1352 161.17.88.162")
def test_base_spans(text):
    assert [(s.start, s.kind, s.end) for s in base_spans(text)] == plain_spans(text)


def test_base_spans_are_linear():
    for text in ("a" * 10**6, "1" * 10**6, "+1 " * 10**5, "a@" * 10**5, "1." * 10**5, "@" * 10**5):
        base = base_spans(text)
        proposed_spans(text, base)


def test_taken():
    taken = Taken([Span(0, 2, 5), Span(1, 4, 8)])
    assert [taken.leaves(Span(0, a, b)) for a, b in [(0, 2), (0, 3), (5, 6), (8, 9)]] == [True, False, False, True]
    taken.add(Span(0, 8, 9))
    assert not taken.leaves(Span(0, 7, 10)) and taken.leaves(Span(0, 9, 10))


def test_labelers_are_told_apart():
    draw = np.random.default_rng(0)
    truth = draw.random(4000) < 0.4
    rates = [0.95, 0.9, 0.8, 0.55]
    patterns = {}
    for y in truth:
        given_ = tuple(int(1 if (draw.random() < r) == y else -1) for r in rates)
        patterns[given_] = patterns.get(given_, 0) + 1
    rows = sorted(patterns.items())
    posterior, reliability = dawid_skene([v for v, _ in rows], np.array([float(n) for _, n in rows]))
    assert np.allclose(reliability[:, 1, 2], rates, atol=0.06)
    share = sum(p * n for p, (_, n) in zip(posterior, rows, strict=True)) / 4000
    assert abs(share - truth.mean()) < 0.05


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = find(docs, fit(docs)).collect()
    assert len(rows) == docs.count()
    for row in rows:
        base = [Span(k, a, b) for a, k, b in plain_spans(row["text"])]
        numbers = [sum(s.kind == k for s in base) for k in range(4)]
        assert numbers == [row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]]
        assert row["base_sha256"] == hashlib.sha256(listed(base).encode()).hexdigest()
        spans = row["spans"].split(",") if row["spans"] else []
        assert {f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in base} <= set(spans)
        assert len(spans) == len(base) + row["n_added"]
        order = [(int(s.split(":")[1]), KINDS.index(s.split(":")[0])) for s in spans]
        assert order == sorted(order)


def test_swallowed_spans_are_added(spark):
    texts = ["call +1 (132) 555-1352 161.17.88.162 now", "mail a@b.org", "+44 20 7946 0958", "ip 10.0.0.1"]
    swallowed = spark.createDataFrame([(t,) for t in texts * 5], "text string")
    found = {r["text"]: r for r in find(swallowed, fit(swallowed)).collect()}
    assert "phone:5:22" in found[texts[0]]["spans"] and found[texts[0]]["n_phone"] == 0


def test_odd_documents(odd_documents, no_documents):
    rows = find(odd_documents, fit(odd_documents)).collect()
    assert len(rows) == odd_documents.count()
    nothing = hashlib.sha256(b"").hexdigest()
    for row in rows:
        if not row["text"] or not row["text"].strip():
            assert (row["spans"], row["base_sha256"], row["n_added"]) == ("", nothing, 0)
    last = next(r for r in rows if r["doc_id"] == 9)
    assert last["spans"] == "email:11:18,ip:36:43"
    hidden = find(odd_documents, fit(odd_documents)).select("doc_id", masked(F.col("text"), F.col("spans")).alias("m"))
    assert {r["doc_id"]: r["m"] for r in hidden.collect()}[9] == "mail me at <email> or <|endoftext|> <ip> now"
    assert find(no_documents, fit(no_documents)).count() == 0
