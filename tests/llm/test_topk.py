"""Exact top-k against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.llm import topk
from panelspark.llm.topk import top_k


def brute(rows, k=10):
    usable = [
        (i, [math.floor(1024 * x) for x in v])
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in usable:
        if q % 100 == 0:
            scored = sorted(
                (-sum(x * y for x, y in zip(a, b, strict=True)), i)
                for i, b in usable
                if i != q and len(a) == len(b)
            )
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_small_blocks(spark, monkeypatch, seed):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 7)
    monkeypatch.setattr(topk, "RUN_BLOCKS", 3)
    monkeypatch.setattr(topk, "GROUP_QUERIES", 2)
    draw = random.Random(seed)
    rows = [(i, [draw.choice([-1.0, 0.0, 0.25, 1.0]) for _ in range(4)]) for i in range(0, 900, 3)]
    rows += [(300, rows[0][1]), (7, None), (8, []), (9, [1.0, None, 0.0, 0.0]), (None, [1.0] * 4)]
    rows += [(10, [math.nan] * 4), (11, [math.inf] * 4), (12, [1.0, 2.0]), (200, [3.0, 4.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(map(tuple, top_k(frame, F.col("vec_id") % 100 == 0).collect()))
    assert found == brute(rows)


def test_large_components_stay_exact(spark):
    rows = [(i, [(-1.0) ** i * 300000.0 + i / 7, 299999.0 - i]) for i in range(0, 50, 5)]
    rows += [(100, [4e5, 4e6]), (7, [2.5e6, 1.0])]  # beyond four bytes, scores within a LONG
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, top_k(frame, F.col("vec_id") % 100 == 0).collect())) == brute(rows)


def test_scores_beyond_a_long_end_there(spark):
    rows = [(100, [1e12, 1.0]), (1, [1e12, 1.0]), (2, [-1e12, 5.0]), (3, [0.0, 2.0]), (4, [1e30, 0.0]), (5, [2e12, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = [tuple(r)[2:] for r in top_k(frame, F.col("vec_id") % 100 == 0).orderBy("rank").collect()]
    most = 2**63 - 1
    assert found[3:] == [(3, 2 * 1024**2), (2, -most)] and {(i, s) for i, s in found[:3]} == {(4, most), (5, most), (1, most)}


def test_empty_and_extra_columns(spark):
    frame = spark.createDataFrame(
        [(100, [1.0], 5, "x"), (1, [2.0], 6, "y")], "vec_id long, embedding array<float>, score int, rank string"
    )
    assert [tuple(r) for r in top_k(frame, F.col("vec_id") % 100 == 0).collect()] == [(100, 1, 1, 2 * 1024**2)]
    assert top_k(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert top_k(frame, F.lit(False)).count() == 0


def test_blocks_are_skipped():
    """Vectors in 40 directions: most pairs of a query and a block are never scored, none is missed."""
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(40, 16)) * 900
    vectors = np.floor(centres[draw.integers(0, 40, 8000)] + draw.normal(size=(8000, 16)) * 40).astype(np.int64)
    order = np.lexsort((np.arange(8000), topk.nearest(vectors.astype(float), topk.chained(vectors[::31].astype(float)))))
    blocks = [(order[i : i + 128], order[i : i + 128], vectors[order[i : i + 128]]) for i in range(0, 8000, 128)]
    asked = np.arange(0, 8000, 100)
    found, scored = topk.best_of_run([(asked, asked, vectors[asked])], blocks, 10)
    assert scored < 0.25 * len(asked) * len(blocks)
    for q in asked.tolist():
        scores = vectors @ vectors[q]
        best = sorted((-int(s), i) for i, s in enumerate(scores.tolist()) if i != q)[:10]
        assert [(-s, i) for _, own, i, s in found if own == q] == best
