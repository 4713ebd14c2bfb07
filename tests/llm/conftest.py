from __future__ import annotations

import random

import pytest

import public_tokenizers

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def vocabulary() -> str:
    return str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """NULLs in every column, empty, blank and very long texts, repeated rows, clashing columns."""
    draw = random.Random(3)
    words = ["".join(draw.choice("abcdefghij") for _ in range(5)) for _ in range(400)]
    long = " ".join(draw.choice(words) for _ in range(60_000))
    rows = [
        (1, "the cat sat on the mat and the dog lay by the door", "en", "a"),
        (1, "the cat sat on the mat and the dog lay by the door", "en", "a"),
        (2, "le chat est sur le tapis et le chien est devant la porte", "fr", "a"),
        (3, None, None, None),
        (4, "", "en", "b"),
        (5, " \n\t ", "en", None),
        (6, "123 456 --- !!!", None, "b"),
        (7, long, "en", "c"),
        (8, long, "en", "c"),
        (None, "a row without a key, twice", "en", "c"),
        (None, "a row without a key, twice", "en", "c"),
        (9, "mail me at x@y.org or <|endoftext|> 1.2.3.4 now", "en", ""),
    ]
    schema = "doc_id long, text string, lang string, source string"
    clashing = (
        "cast(7 as int) as n_tokens, 'x' as Score, 'x' as fingerprint, 'x' as component_id, 'x' as copies, "
        "'x' as target, 'x' as items, 'x' as lang_pred, 'x' as spans, 'x' as fp, 'x' as `a.b`"
    )
    return spark.createDataFrame(rows, schema).selectExpr("*", *clashing.split(", "))


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
