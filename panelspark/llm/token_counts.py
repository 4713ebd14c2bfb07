"""Token counts: lengths only, from Arrow batches cut by bytes.

Texts are encoded in batches of about ``BATCH_BYTES``. A text over ``PIECE_CHARS`` is cut where the
pre-tokenizer breaks anyway, so its pieces have as many tokens as the whole text. Only the lengths
leave the Python worker.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import without

BATCH_BYTES = 1 << 20
PIECE_CHARS = 1 << 16

# A blank between two characters that are no white space: the blank starts the next token, and no
# pattern of a byte-level vocabulary looks across it.
_SAFE = re.compile(r"(?<=[^\s]) (?=[^\s])")
#: Runs of white space of this length are cut out: the pattern's lookahead would exhaust its stack on them.
WHITE_RUN = 1 << 12
_WHITE = re.compile(
    r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % WHITE_RUN
)


def split_safely(text: str, limit: int = PIECE_CHARS) -> Iterator[str]:
    """Pieces of about ``limit`` characters whose tokens add up to those of ``text``.

    Joined they are ``text`` again. Where no safe blank comes, a piece is longer than ``limit``.
    """
    start = 0
    while len(text) - start > limit:
        cut = _SAFE.search(text, start + limit)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def white_runs(text: str, specials: tuple[str, ...]) -> Iterator[tuple[str, bool]]:
    """``text`` in order as ``(part, whether it is a long run of white space)``.

    The pre-tokenizer takes such a run as one unit, but leaves its last character to what follows;
    before a special token or the end of the text nothing follows.
    """
    start = 0
    for run in _WHITE.finditer(text):
        end = run.end()
        if end < len(text) and not text.startswith(specials, end):
            end -= 1
        if start < run.start():
            yield text[start : run.start()], False
        yield text[run.start() : end], True
        start = end
    if start < len(text):
        yield text[start:], False


class Encoder:
    """``lengths`` and ``ids`` of texts, by the library that the file's kind belongs to.

    A byte-level ``.json`` whose ranks lie beside it as ``.tiktoken`` is encoded from the ranks:
    the same ids (tests compare them over all code points) in a quarter of the time. Special
    strings in a text become their special token, as is the default of ``tokenizers``.
    """

    def __init__(self, path: str):
        self.path = path
        if path.endswith(".model"):
            import sentencepiece

            self._model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._encode = lambda texts: self._model.encode(texts, num_threads=1)
            self.splits, self.size = False, self._model.vocab_size()
        else:
            ranks = _twin(path)
            if ranks:
                import tiktoken

                special, pattern = _specials(path), _pattern()
                self._model = tiktoken.Encoding(
                    "ranks", pat_str=pattern, mergeable_ranks=_ranks(ranks), special_tokens=special
                )
                self._specials = tuple(special)
                self._encode = lambda texts: [self._ranked(t) for t in texts]
                self.splits, self.size = True, self._model.max_token_value + 1
            else:
                os.environ["TOKENIZERS_PARALLELISM"] = "false"
                from tokenizers import Tokenizer

                self._model = Tokenizer.from_file(path)
                self._model.no_truncation()
                self._model.no_padding()
                self._encode = lambda texts: [
                    e.ids for e in self._model.encode_batch_fast(texts, add_special_tokens=False)
                ]
                self.splits, self.size = False, self._model.get_vocab_size()

    def _ranked(self, text: str) -> list[int]:
        if len(text) < WHITE_RUN:
            return self._model.encode(text, allowed_special="all")
        ids = []
        for part, white in white_runs(text, self._specials):
            if white:
                ids += self._model._encode_single_piece(part.encode())
            else:
                ids += self._model.encode(part, allowed_special="all")
        return ids

    def encoded(self, texts: list[str]) -> Iterator[tuple[int, list[int]]]:
        """``(index of the text, ids)`` for each piece of each text, encoded batch by batch."""
        if self.splits:
            pieces = [(i, p) for i, text in enumerate(texts) for p in split_safely(text)]
        else:
            pieces = list(enumerate(texts))
        for batch in batches(pieces):
            for (i, _), ids in zip(batch, self._encode([p for _, p in batch]), strict=True):
                yield i, ids

    def ids(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text."""
        return [x.tolist() for x in self.arrays(texts, "<u4")]

    def arrays(self, texts: list[str], kind: str) -> list[np.ndarray]:
        """The ids of each text as an array; only one batch is held as Python numbers at a time."""
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        for i, ids in self.encoded(texts):
            parts[i].append(np.array(ids, dtype=kind))
        nothing = np.zeros(0, dtype=kind)
        return [np.concatenate(p) if len(p) > 1 else p[0] if p else nothing for p in parts]

    def lengths(self, texts: list[str]) -> list[int]:
        """The number of ids of each text."""
        out = [0] * len(texts)
        for i, ids in self.encoded(texts):
            out[i] += len(ids)
        return out


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary."""
    return Encoder(path)


def _twin(path: str) -> str | None:
    if path.endswith(".tiktoken"):
        return path
    import json

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    pre = spec.get("pre_tokenizer") or {}
    plain = (
        pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space", True)
        and not spec.get("normalizer")
        and not spec["model"].get("ignore_merges")
    )
    twin = path.removesuffix(".json") + ".tiktoken"
    return twin if plain and os.path.exists(twin) else None


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def _specials(path: str) -> dict[str, int]:
    if not path.endswith(".json"):
        return {}
    import json

    with open(path, encoding="utf-8") as file:
        return {t["content"]: t["id"] for t in json.load(file)["added_tokens"] if t["special"]}


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def batches(
    pieces: list[tuple[int, str]], budget: int = BATCH_BYTES
) -> Iterator[list[tuple[int, str]]]:
    """Runs of pieces of about ``budget`` bytes; a larger piece is a batch of its own."""
    batch, size = [], 0
    for piece in pieces:
        n = len(piece[1].encode())
        if batch and size + n > budget:
            yield batch
            batch, size = [], 0
        batch.append(piece)
        size += n
    if batch:
        yield batch


def token_count(text: Column, path: str) -> Column:
    """The number of tokens of ``text`` (NULL counts as empty)."""

    def count(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = encoder(path)
        for array in arrays:
            yield pa.array(model.lengths([x or "" for x in array.to_pylist()]), pa.int64())

    # The annotations are strings here; Spark needs the types.
    count.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(count, "long")(text)


def count_tokens(docs: DataFrame, path: str, limit: int = 512, text: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    One row per input row, repeated rows included. NULL and empty texts have 0 bytes and 0 tokens. Texts
    of any length are counted whole, also where they have long runs without a blank or of blanks alone.
    Columns of these names in ``docs`` are replaced. An empty table gives an empty result.
    """
    body = F.col(text)
    return without(docs, ["n_bytes", "n_tokens", "over_limit"]).select(
        "*",
        F.coalesce(F.octet_length(body), F.lit(0)).cast("long").alias("n_bytes"),
        token_count(body, path).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
