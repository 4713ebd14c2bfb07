"""Fingerprints and their components against brute force."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from panelspark.llm.components import components
from panelspark.llm.simhash import (
    ball,
    fingerprint,
    fingerprint_components,
    keep_one,
    links,
    near_duplicates,
)


def brute_fingerprint(text: str | None) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints: list[int], distance: int) -> list[int]:
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if ((a ^ prints[j]) & (2**64 - 1)).bit_count() <= distance:
                a_, b_ = sorted((root(i), root(j)))
                parent[b_] = a_
    return [root(i) for i in range(len(prints))]


def test_hash_is_that_of_spark(spark):
    text = "größe of it"
    ours = xxhash.xxh64_intdigest(text.encode(), 42)
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] % 2**64 == ours


@pytest.mark.parametrize("text", [None, "", " \t", "One", "a b", "Ä B c", "x y z", "A b c d e f", "a b c " * 50])
def test_fingerprint(text):
    assert fingerprint(text, 3) % 2**64 == brute_fingerprint(text)


def test_components_of_documents(documents):
    found = {r["doc_id"]: r for r in near_duplicates(documents).collect()}
    ids = sorted(found)
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    prints = [brute_fingerprint(texts[i]) for i in ids]
    roots = brute_components(prints, 2)
    assert [found[i]["fingerprint"] for i in ids] == [f"{p:016x}" for p in prints]
    assert [found[i]["component_id"] for i in ids] == [ids[r] for r in roots]


@pytest.mark.parametrize(("seed", "distance"), [(0, 2), (1, 2), (2, 2), (3, 0)])
def test_close_prints_and_chains(spark, seed, distance):
    draw = random.Random(seed)
    prints = [draw.getrandbits(64) for _ in range(20)]
    for _ in range(150):  # chains of flips, and several within one ball
        prints.append(prints[-1 if draw.random() < 0.5 else draw.randrange(len(prints))] ^ (1 << draw.randrange(64)))
        prints[-1] ^= 1 << draw.randrange(64)
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    frame = spark.createDataFrame(list(enumerate(signed)), "key long, fp long")
    found = frame.join(fingerprint_components(frame, "key", distance), "fp").collect()
    assert {r["key"]: r["component"] for r in found} == dict(enumerate(brute_components(prints, distance)))


def test_ball_and_odd_distance(spark):
    assert len(ball(1)) == 65 and len(ball(2)) == 65 + 64 * 63 // 2 == len(set(ball(2)))
    with pytest.raises(ValueError, match="even"):
        links(spark.createDataFrame([(1,)], "fp long"), 3)


def test_long_chain(spark):
    order = list(range(300))
    random.Random(5).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:], strict=False)), "a long, b long")
    found = components(edges).collect()
    assert len(found) == 300 and {r["label"] for r in found} == {0}


def test_odd_documents(odd_documents, no_documents):
    rows = near_duplicates(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert {r["component_id"] for r in rows if not (r["text"] or "").strip()} == {3}
    assert {r["fingerprint"] for r in rows if not (r["text"] or "").strip()} == {"0" * 16}
    assert {r["component_id"] for r in rows if r["doc_id"] is None} == {None}
    assert {r["component_id"] for r in rows if r["doc_id"] in (7, 8)} == {7}
    kept = keep_one(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 3, 6, 7, 9]
    assert near_duplicates(no_documents).count() == 0 and keep_one(no_documents).count() == 0
