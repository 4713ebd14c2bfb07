"""Token counts against the library of the vocabulary's file."""

import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelspark.llm.token_counts import batches, count_tokens, encoder, split_safely

os.environ["TOKENIZERS_PARALLELISM"] = "false"


@pytest.fixture(scope="module")
def library(vocabulary):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary)


def test_ids_equal_the_library_on_every_code_point(vocabulary, library):
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b 1{chr(c)}2 {chr(c)}{chr(c)} x  {chr(c)}.{chr(c)}' {chr(c)}\n" for c in points]
    ours = encoder(vocabulary).ids(texts)
    theirs = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert ours == theirs


@settings(max_examples=60, deadline=None)
@given(text=st.text(alphabet="ab1 \n\t.'é中<|>", max_size=200), limit=st.integers(1, 20))
def test_pieces_add_up(vocabulary, text, limit):
    pieces = list(split_safely(text, limit))
    assert "".join(pieces) == text
    model = encoder(vocabulary)
    assert sum(len(x) for x in model.ids(pieces)) == len(model.ids([text])[0])


def test_batches_keep_everything_in_order():
    pieces = [(i, "x" * n) for i, n in enumerate([5, 50, 1, 1, 200, 3])]
    found = list(batches(pieces, 60))
    assert [p for b in found for p in b] == pieces
    assert all(len(b) == 1 or sum(len(t) for _, t in b) <= 60 for b in found)


def test_counts_on_documents(documents, vocabulary, library):
    rows = count_tokens(documents, vocabulary).select("text", "n_bytes", "n_tokens", "over_limit").collect()
    assert len(rows) == documents.count()
    for row in rows:
        n = len(library.encode(row["text"], add_special_tokens=False).ids)
        assert (row["n_bytes"], row["n_tokens"]) == (len(row["text"].encode()), n)
        assert row["over_limit"] == (n > 512)


def test_odd_documents(odd_documents, no_documents, vocabulary, library):
    found = count_tokens(odd_documents, vocabulary)
    assert [c.lower() for c in found.columns].count("n_tokens") == 1
    rows = found.collect()
    assert len(rows) == odd_documents.count()
    for row in rows:
        body = row["text"] or ""
        expected = len(library.encode(body, add_special_tokens=False).ids)
        assert (row["n_bytes"], row["n_tokens"]) == (len(body.encode()), expected)
    assert count_tokens(no_documents, vocabulary).count() == 0


def test_sentencepiece_file(odd_documents):
    import public_tokenizers
    import sentencepiece

    path = str(public_tokenizers.path("piece_bpe_32k.model"))
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for row in count_tokens(odd_documents.where("doc_id < 7"), path).collect():
        assert row["n_tokens"] == len(model.encode(row["text"] or ""))


@pytest.mark.parametrize(
    "run", [" ", "\n", "\t", " \n", "　\t ", "\r\n  "], ids=["blank", "break", "tab", "two", "wide", "mixed"]
)
@pytest.mark.parametrize("after", ["", "word", "<|endoftext|>", " x", "\nx", "7", "!"])
def test_white_space_of_any_length(vocabulary, library, run, after):
    for n in (4_000, 5_000):
        body = "start" + run * n + after + " end" + run * n + after
        expected = library.encode(body, add_special_tokens=False).ids
        assert encoder(vocabulary).ids([body])[0] == expected


@pytest.mark.parametrize("body", [" " * 3_000_000, "\n" * 1_000_000 + "x", "a" + " \n" * 750_000 + "b", "\t" * 1_500_000])
def test_millions_of_white_space(vocabulary, library, body):
    expected = library.encode(body, add_special_tokens=False).ids
    assert encoder(vocabulary).ids([body])[0] == expected


@pytest.mark.parametrize("body", ["a" * 2_000_000, "é" * 600_000, "!" * 1_000_000, "7" * 1_000_000])
def test_millions_of_characters_without_a_blank(vocabulary, library, body):
    assert encoder(vocabulary).lengths([body]) == [len(library.encode(body, add_special_tokens=False).ids)]
