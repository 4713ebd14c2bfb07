"""The pipeline's stages against brute force, odd rows, and the registered queries."""

from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from panelspark.llm.queries import llm_oracles, llm_queries
from panelspark.llm.token_counts import encoder
from tests.llm.test_simhash import brute_components, brute_fingerprint
from verification.compare import connect, differences

SMALL, GATE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages_are_the_dealt_ones():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_duplicates", "decontamination", "mixing", "packing"]


@pytest.fixture(scope="module")
def steps(spark):
    """The rows after each stage."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = [docs]
    for _, function in corpus_pipeline.STAGES:
        found.append(function(spark, found[-1], SMALL).cache())
    return found


def test_each_stage_against_brute_force(spark, steps):
    docs, known, single, clean, mixed, packed = ([r for r in s.collect()] for s in steps)
    assert Counter(known) == Counter(r for r in docs if any(c.isalpha() for c in r["text"] or ""))
    ids = sorted(r["doc_id"] for r in known)
    texts = {r["doc_id"]: r["text"] for r in known}
    roots = brute_components([brute_fingerprint(texts[i]) for i in ids], 2)
    assert sorted(r["doc_id"] for r in single) == sorted({ids[r] for r in roots})
    items = [" ".join(r["text"].lower().split()) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    dirty = {r["doc_id"] for r in single if any(t in " ".join(r["text"].lower().split()) for t in items)}
    assert {r["doc_id"] for r in clean} == {r["doc_id"] for r in single} - dirty
    assert set(mixed) <= set(clean) and max(Counter(mixed).values()) <= 2
    words = lambda rows: sum(len(r["text"].split()) for r in rows)
    assert words(mixed) == pytest.approx(1.5 * words(clean), rel=0.25)
    model = encoder(corpus_pipeline.vocabulary("byte_bpe_50k.json"))
    tokens = Counter()
    for r in mixed:
        tokens[r["doc_id"]] += len(model.ids([r["text"]])[0])
    found = Counter()
    for row in packed:
        for key, n in zip(row["doc_ids"], np.diff(row["cu_seqlens"]), strict=True):
            found[key] += int(n)
    assert found == +tokens


def test_columns_are_those_of_documents(steps):
    assert all(s.columns == steps[0].columns for s in steps[1:-1])


def test_run_and_its_registration(spark, steps):
    found = llm_queries()["pipeline"](spark, SMALL).collect()
    order = lambda r: (r["shard"], r["row"])
    assert sorted(found, key=order) == sorted(steps[-1].collect(), key=order)
    assert corpus_pipeline.ORACLE_SQL is None


def test_odd_documents(spark, odd_documents, no_documents):
    for start in (odd_documents.withColumn("n_chars", odd_documents.doc_id), no_documents):
        docs = start
        for _, function in corpus_pipeline.STAGES[:-1]:
            docs = function(spark, docs, SMALL).cache()
            assert docs.columns == start.columns
        assert (docs.count() > 0) == (start.count() > 0)
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
        assert (len(packed) > 0) == (docs.count() > 0)


def test_every_operator_has_a_query():
    names = llm_queries()
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in names if n != "pipeline"}


@pytest.mark.parametrize("name", llm_oracles())
def test_matches_sql(spark, name):
    assert differences(spark, connect(GATE), GATE, llm_queries()[name], llm_oracles()[name]) == []
