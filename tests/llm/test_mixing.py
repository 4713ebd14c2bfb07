"""The mix: targets, systematic sampling, repeatability."""

import random

import pytest
from pyspark.sql import functions as F

from panelspark.llm.common import word_count
from panelspark.llm.mixing import emitted, mix, size_class, source_targets


def brute_targets(sizes: dict, share=1.5, cap=2.0) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(names)}
    target, full = {}, set()
    left = share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in full]
        total = sum(weight[s] for s in free)
        over = [s for s in free if total and left * weight[s] / total >= cap * sizes[s]]
        if not over:
            target.update({s: left * weight[s] / total for s in free})
            return target
        for s in over:
            target[s] = cap * sizes[s]
            full.add(s)
            left -= target[s]
        if len(full) == len(names):
            return target


@pytest.mark.parametrize("seed", range(6))
def test_targets_against_rounds_of_resharing(spark, seed):
    draw = random.Random(seed)
    sizes = {s: draw.choice([0, 1, 5, 100, 1000, 20000]) for s in [None, "", "a", "B", "é", "zz"][: seed + 1]}
    rows = [(s, n) for s, n in sizes.items()]
    found = source_targets(spark.createDataFrame(rows, "source string, size long")).collect()
    expected = brute_targets(sizes)
    assert {r["source"] for r in found} == set(sizes)
    for row in found:
        assert row["target"] == pytest.approx(expected[row["source"]], rel=1e-9, abs=1e-9)


def test_taken_words_come_near_the_target(spark):
    draw = random.Random(1)
    rows = [
        (i, draw.choice("aaaabc"), min(20000, int(draw.paretovariate(1.1) * 20))) for i in range(4000)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long")
    found = mix(docs)
    assert found.count() == len(rows)
    assert found.where("copies > 2 OR copies < 0 OR taken <> copies * size").count() == 0
    per = found.groupBy("source").agg(F.sum("taken"), F.first("target"), F.max("size")).collect()
    for _, taken, target, largest in per:
        assert abs(taken - target) <= 1.5 * largest
    again = mix(docs.repartition(7)).select("doc_id", "copies")
    assert sorted(again.collect()) == sorted(found.select("doc_id", "copies").collect())
    assert emitted(found).count() == found.agg(F.sum("copies")).first()[0]


def test_size_classes_grow_with_the_size(spark):
    found = spark.range(5000).select("id", size_class(F.col("id")).alias("c")).orderBy("id").collect()
    classes = [r["c"] for r in found]
    assert classes == sorted(classes) and classes[:128] == list(range(128))
    assert classes[-1] < 128 + 64 * 6


def test_odd_documents(odd_documents, no_documents):
    sized = odd_documents.withColumn("size", word_count(F.col("text")))
    found = mix(sized).collect()
    assert len(found) == odd_documents.count()
    by_size = {r["text"]: r["size"] for r in found}
    assert by_size[None] == by_size[""] == by_size[" \n\t "] == 0
    assert all(r["taken"] == r["copies"] * r["size"] for r in found)
    assert mix(no_documents.withColumn("size", word_count(F.col("text")))).count() == 0
