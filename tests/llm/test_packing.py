"""Packing: the segment tree against a plain search, and the exact round trip."""

import random
from collections import Counter

import numpy as np
import pytest

from panelspark.llm.packing import best_fit_decreasing, pack
from panelspark.llm.token_counts import encoder


@pytest.mark.parametrize("seed", range(40))
def test_best_fit(seed):
    draw = random.Random(seed)
    capacity = draw.randint(1, 50)
    lengths = [draw.randint(1, capacity) for _ in range(draw.randint(0, 60))]
    free = []
    for n in sorted(lengths, reverse=True):
        fitting = [f for f in free if f >= n]
        if fitting:
            free.remove(min(fitting))
        free.append((min(fitting) if fitting else capacity) - n)
    rows = best_fit_decreasing(lengths, capacity)
    assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
    assert sorted(capacity - sum(lengths[i] for i in r) for r in rows) == sorted(free)


def unpacked(rows, width: int) -> Counter:
    """``(doc_id, ids of its parts)`` of all documents, parts joined in order."""
    parts = {}
    for row in rows:
        ids, positions = np.frombuffer(row["input_ids"], "<u2"), np.frombuffer(row["position_ids"], "<u2")
        ends = row["cu_seqlens"]
        assert len(ids) == len(positions) == width and ends[0] == 0 and ends[-1] == row["n_tokens"] <= width
        assert not ids[ends[-1] :].any() and not positions[ends[-1] :].any()
        for key, part, a, b in zip(row["doc_ids"], row["parts"], ends[:-1], ends[1:], strict=True):
            assert positions[a:b].tolist() == list(range(b - a))
            parts.setdefault((key, part), []).append(ids[a:b].tolist())
    return parts


def test_round_trip(documents, vocabulary):
    rows = pack(documents, vocabulary, row_tokens=512, shard_bytes=1 << 17).collect()
    assert len({r["shard"] for r in rows}) > 1
    assert len({(r["shard"], r["row"]) for r in rows}) == len(rows)
    parts = unpacked(rows, 512)
    for doc in documents.collect():
        ids, part = [], 0
        while (doc["doc_id"], part) in parts:
            (found,) = parts.pop((doc["doc_id"], part))
            ids += found
            part += 1
        assert ids == encoder(vocabulary).ids([doc["text"]])[0]
    assert not parts
    filled = sum(r["n_tokens"] for r in rows) / (512 * len(rows))
    assert filled > 0.97


def test_reruns_agree(documents, vocabulary):
    a = pack(documents, vocabulary).collect()
    b = pack(documents.repartition(5), vocabulary).collect()
    order = lambda r: (r["shard"], r["row"])
    assert sorted(a, key=order) == sorted(b, key=order)


def test_odd_documents(odd_documents, no_documents, vocabulary):
    rows = pack(odd_documents, vocabulary, row_tokens=1000, shard_bytes=1 << 16).collect()
    parts = unpacked(rows, 1000)
    model = encoder(vocabulary)
    tokens = Counter()
    for (key, _), found in parts.items():
        tokens[key] += sum(map(len, found))
    expected = Counter()
    for doc in odd_documents.collect():
        expected[doc["doc_id"]] += len(model.ids([doc["text"] or ""])[0])
    assert tokens == +expected
    assert len(parts[None, 0]) == 2 and 4 not in tokens and 3 not in tokens
    assert pack(no_documents, vocabulary).count() == 0
