"""Periodic runs against a plain search over all stretches."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelspark.llm import periodic_runs
from panelspark.llm.periodic_runs import find_runs, runs_of, scan, surviving_segments
from panelspark.llm.queries import planted_repeats


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if words[q:] == words[: len(words) - q])


def plain_runs(words, least):
    """Maximal stretches by definition: every lag, every stretch of matches, its smallest period."""
    found, n = set(), len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q) and smallest_period(words[i : j + q]) == q:
                found.add((i, j + q - i, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def messy(draw):
    """Words with planted repeats of many periods, nested and adjacent."""
    words = []
    for _ in range(draw.randint(0, 6)):
        block = [draw.choice("abcdefgh"[: draw.randint(1, 8)]) for _ in range(draw.randint(1, 12))]
        words += block * draw.randint(1, 6) + block[: draw.randint(0, len(block))]
        words += [draw.choice("abcxyz0123456789") for _ in range(draw.randint(0, 8))]
        if draw.random() < 0.2:
            words += words
    return words


@pytest.mark.parametrize("seed", range(150))
def test_scan_equals_the_definition(seed):
    draw = random.Random(seed)
    texts = [messy(draw) for _ in range(5)]
    least = draw.choice([2, 4, 12, 12])
    rows = scan(pa.array([" ".join(w) for w in texts]), least).to_pylist()
    for words, row in zip(texts, rows, strict=True):
        runs = plain_runs(words, least)
        assert [tuple(r.values()) for r in row["runs"]] == runs
        assert row["collapsed"] == plain_collapse(words, runs)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=80), st.integers(2, 14))
def test_runs_of_few_words(words, least):
    assert runs_of(np.array(words, dtype=np.int64), least) == plain_runs(words, least)


def test_splitting_recurses():
    # x splits; then a, b, c occur once in each part, and only the middle survives.
    words = np.array([0, 1, 2, 9, 3, 4, 3, 4, 3, 4, 8, 0, 1, 2])
    assert surviving_segments(words, np.array([0]), np.array([14]), 4) == [(4, 10)]
    assert surviving_segments(words, np.array([], dtype=int), np.array([], dtype=int)) == []


def test_long_texts():
    """Large lags, a text of one word, and a word that breaks a run."""
    draw = random.Random(1)
    block = [str(draw.randrange(10_000)) for _ in range(7_000)]
    rows = scan(
        pa.array([" ".join(["x"] + block * 3 + ["y"]), "w " * 200_000, " ".join(["w"] * 50 + ["v"] + ["w"] * 60)])
    ).to_pylist()
    assert [tuple(r.values()) for r in rows[0]["runs"]] == [(1, 21_000, 7_000)]
    assert rows[0]["collapsed"] == " ".join(["x", *block, "y"])
    assert [tuple(r.values()) for r in rows[1]["runs"]] == [(0, 200_000, 1)]
    assert [tuple(r.values()) for r in rows[2]["runs"]][:1] == [(0, 50, 1)]
    assert rows[1]["collapsed"] == "w"


def test_documents_with_planted_repeats(documents):
    """The query's repeats, by its definition in plain Python, and all runs of the given texts."""
    import zlib

    planted = documents.select("doc_id", planted_repeats(F.col("doc_id"), F.col("text")).alias("text"))
    rows = find_runs(planted).collect()
    texts = {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}
    assert len(rows) == len(texts)
    hit = 0
    for row in rows:
        words = [w.decode() for w in texts[row["doc_id"]].encode().split()]
        h, n = zlib.crc32(str(row["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            hit += 1
        if n < 700:
            runs = plain_runs(words, 12)
            assert [tuple(r) for r in row["runs"]] == runs
            assert row["collapsed"] == plain_collapse(words, runs)
    assert hit > 5 and sum(len(r["runs"]) > 0 for r in rows) > 5


def test_odd_documents(odd_documents, no_documents, monkeypatch):
    monkeypatch.setattr(periodic_runs, "BATCH_BYTES", 64)
    docs = odd_documents.withColumn("Runs", F.lit("x")).withColumn("found", F.lit("x"))
    found = find_runs(docs)
    assert [c.lower() for c in found.columns].count("runs") == 1 and {"found", "a.b"} <= set(found.columns)
    rows = found.collect()
    assert len(rows) == odd_documents.count()
    for row in rows:
        words = (row["text"] or "").encode().split()
        assert row["runs"] == [] and row["collapsed"] == b" ".join(words).decode()
    assert find_runs(no_documents).count() == 0
