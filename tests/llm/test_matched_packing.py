"""Large-item matching: the plan against brute force, and the exact round trip."""

import random
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest

from panelspark.llm.matched_packing import Plan, cut, pieces, place, sequences
from panelspark.llm.token_counts import encoder


def planned(counts, capacity):
    """Items of each sequence as ``(offset, length)``, after checking that runs cover all ranks."""
    plan, rows, ranks = Plan(counts, capacity), {}, Counter()
    for run in plan.runs:
        assert run.rank == ranks[run.length]
        ranks[run.length] += run.pieces
        for i in range(run.pieces):
            place_ = rows.setdefault(run.first + i // run.per, [])
            place_.append((run.offset + i % run.per * run.length, run.length))
    assert ranks == Counter(counts)
    assert sorted(rows) == list(range(plan.sequences))
    for items in rows.values():
        end = 0
        for offset, length in sorted(items):
            assert offset == end
            end += length
        assert end <= capacity
    return rows


def most_pairs(lengths, capacity):
    @lru_cache(None)
    def best(rest):
        if len(rest) < 2:
            return 0
        a, others = rest[0], rest[1:]
        found = best(others)
        for i, b in enumerate(others):
            if a + b <= capacity:
                found = max(found, 1 + best(others[:i] + others[i + 1 :]))
        return found

    return best(tuple(sorted(lengths)))


@pytest.mark.parametrize("seed", range(60))
def test_large_pieces_take_the_fewest_sequences(seed):
    draw = random.Random(seed)
    capacity = draw.randint(3, 40)
    lengths = [draw.randint(capacity // 3 + 1, capacity) for _ in range(draw.randint(0, 11))]
    rows = planned(Counter(lengths), capacity)
    assert all(len(items) <= 2 for items in rows.values())
    assert len(rows) == len(lengths) - most_pairs(lengths, capacity)


@pytest.mark.parametrize("seed", range(60))
def test_small_pieces_take_the_best_gap(seed):
    """The same gaps as when pieces are placed one by one after the matching."""
    draw = random.Random(seed)
    capacity = draw.randint(3, 60)
    lengths = [draw.randint(1, capacity) for _ in range(draw.randint(0, 80))]
    large = [n for n in lengths if 3 * n > capacity]
    free = [capacity - sum(n for _, n in r) for r in planned(Counter(large), capacity).values()]
    for n in sorted((n for n in lengths if 3 * n <= capacity), reverse=True):
        fitting = [f for f in free if f >= n]
        if fitting:
            free.remove(min(fitting))
        free.append((min(fitting) if fitting else capacity) - n)
    rows = planned(Counter(lengths), capacity)
    assert sorted(capacity - sum(n for _, n in r) for r in rows.values()) == sorted(free)


def test_cut():
    assert cut(5, 10) == [(0, 5)] and cut(10, 10) == [(0, 10)]
    assert cut(23, 10) == [(0, 3), (3, 10), (13, 10)]
    assert cut(30, 10) == [(0, 10), (10, 10), (20, 10)]


def restored(placed, capacity):
    """Ids per document from the packed sequences, checked against the rows of the pieces."""
    rows = placed.collect()
    assert all(r["ids_crc32"] == zlib.crc32(r["ids"]) and len(r["ids"]) == 4 * r["length"] for r in rows)
    packed = {r["sequence_id"]: r for r in sequences(placed).collect()}
    assert set(packed) == {r["sequence_id"] for r in rows}
    parts = {}
    for row in packed.values():
        ids, at = np.frombuffer(row["input_ids"], "<u4"), 0
        for key, piece, start, length in row["segments"]:
            parts.setdefault((key, piece, start), []).append(ids[at : at + length].tolist())
            at += length
        assert at == row["n_tokens"] == len(ids) <= capacity
    return parts


def test_round_trip(documents, vocabulary):
    parts = restored(place(documents.repartition(3), vocabulary, capacity=256), 256)
    model, total = encoder(vocabulary), 0
    for doc in documents.collect():
        ids = [*model.ids([doc["text"]])[0], 2]
        for number, (start, length) in enumerate(cut(len(ids), 256)):
            (found,) = parts.pop((doc["doc_id"], number, start))
            assert found == ids[start : start + length]
        total += len(ids)
    assert not parts
    used = place(documents, vocabulary).agg({"sequence_id": "max"}).first()[0] + 1
    assert total / (1024 * used) > 0.99


def test_odd_documents(odd_documents, no_documents, vocabulary):
    parts = restored(place(odd_documents, vocabulary, capacity=1000), 1000)
    model, expected, found = encoder(vocabulary), Counter(), Counter()
    for doc in odd_documents.collect():
        expected[doc["doc_id"]] += len(model.ids([doc["text"] or ""])[0]) + 1
    for (key, _, _), copies in parts.items():
        found[key] += sum(map(len, copies))
    assert found == expected
    assert parts[3, 0, 0] == [[2]] and parts[4, 0, 0] == [[2]]
    assert len(parts[None, 0, 0]) == 2 and len(parts[1, 0, 0]) == 2
    assert place(no_documents, vocabulary).count() == 0


def test_ranks_are_counted_within_tasks(documents, vocabulary):
    rows = pieces(documents.repartition(4), vocabulary).collect()
    seen = {}
    for r in rows:
        seen.setdefault((r["task"], r["length"]), []).append(r["rank"])
    assert len({r["task"] for r in rows}) > 1
    assert all(sorted(ranks) == list(range(len(ranks))) for ranks in seen.values())
