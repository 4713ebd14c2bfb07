"""Toxicity: the likelihood's gradient path, held-out accuracy, located sentences, odd input."""

import numpy as np
from pyspark.sql import functions as F

from panelspark.llm.queries import op4_toxicity
from panelspark.llm.toxicity import (
    Evidence, ToxicityModel, fit, fit_noisy_or, score_documents, without_doubles,
)

GATE = "/root/testdata/sf0.01"


def test_noisy_or_by_hand():
    model = ToxicityModel(leak=0.1, bias=-1.0, weights={"bad$": 2.0, "wor": 3.0})
    score, sentences = model.scorer()("All is well. This is bad! It is worse and bad. Fine.")
    p = [1 / (1 + np.exp(-x)) for x in (1.0, 4.0)]
    assert [round(s, 9) for _, _, s in sentences] == [round(x, 9) for x in p]
    assert score == 1 - 0.9 * (1 - p[0]) * (1 - p[1])
    assert model.scorer()("")[0] == model.scorer()(None)[0] == model.scorer()("well")[0] == 1 - 0.9


def test_training_finds_the_planted_feature():
    draw = np.random.default_rng(1)
    bags = []
    for _ in range(600):
        sentences = [[int(x)] for x in draw.integers(1, 5, 4)]
        toxic = draw.random() < 0.3
        if toxic:
            sentences.append([0])
        bags.append((int(toxic or draw.random() < 0.05), sentences))
    leak, bias, weights = fit_noisy_or(bags, 5)
    assert 0.01 < leak < 0.12
    assert weights[0] + bias > 2 > 0 > max(weights[1:]) + bias


def test_evidence_by_beginnings():
    evidence = Evidence({"idio$": 0, "wor": 1, "ab$": 2})
    assert evidence.of_words(["idiot", "idio", "worn", "wo", "ab", "abc"]) == [0, 1, 2]


def test_held_out_documents(spark):
    found = op4_toxicity(spark, GATE)
    labels = spark.read.parquet(f"{GATE}/labels.parquet")
    assert found.where("score < 0 OR score > 1 OR predicted <> cast(score >= 0.3 as int)").count() == 0
    held = found.join(labels, "doc_id").where("held_out")
    right = held.where("predicted = toxic").count()
    assert right >= 0.9 * held.count() > 50
    offending = found.where("predicted = 1 AND score > 0.9").select(F.size("offending").alias("n"))
    assert offending.where("n > 0").count() >= 0.8 * offending.count()


def test_located_sentences_are_spans_of_the_text(spark):
    docs = spark.read.parquet(f"{GATE}/documents.parquet")
    labels = spark.read.parquet(f"{GATE}/labels.parquet")
    model = fit(docs, labels)
    evidence = Evidence({f: i for i, f in enumerate(model.weights)})
    for row in score_documents(docs, model).where(F.size("offending") > 0).limit(20).collect():
        for span in row["offending"]:
            words = row["text"][span["start"] : span["end"]].lower()
            assert evidence.of_words("".join(c if c.isalpha() else " " for c in words).split())


def test_odd_documents(spark, odd_documents, no_documents):
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (2, 0), (7, 0), (None, 1), (3, None), (99, 1)], "doc_id long, toxic int"
    )
    model = fit(odd_documents, labels)
    rows = score_documents(odd_documents, model).collect()
    assert len(rows) == odd_documents.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert [c.lower() for c in rows[0].asDict()].count("score") == 1
    nothing = fit(odd_documents, labels.limit(0))
    assert {r["score"] for r in score_documents(odd_documents, nothing).collect()} == {0.0}
    assert score_documents(no_documents, model).count() == 0


def test_features_that_say_the_same():
    counted = {"los": (115, 105), "lost": (104, 104), "lostr": (104, 104), "lostra$": (50, 50), "idi": (9, 9),
               "mor": (100, 50), "moro": (20, 20)}
    assert without_doubles(counted) == ["idi", "lost", "mor", "moro"]
