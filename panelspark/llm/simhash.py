"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within ``max_distance`` bits share a variant that differs from each by at most half of
it. So every distinct fingerprint emits all its variants within half the distance, the variants are
shuffled, and fingerprints that meet in a variant are linked. A variant has at most as many
distinct fingerprints as a ball has variants (65 for distance 2), whatever the data. All fingerprints
of a variant are within ``max_distance`` of each other, so links to the least of them connect the same
documents as all pairs would.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import quoted, stored, without
from panelspark.llm.components import components

BITS = 64
HASH_SEED = 42
#: Shingles hashed at a time, so memory does not grow with the length of a text.
CHUNK = 1 << 16

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str | None, words: int) -> int:
    """The fingerprint of a text as a signed number; 0 without words.

    Letters A to Z are lowered; words are runs without white space (blank, 9 to 13); shingles are
    ``words`` words in a row, repeats included, or the whole sequence if it is shorter. A bit is set
    if more than half of the shingles' XXH64 values have it.
    """
    tokens = (text or "").encode().translate(_LOWER).split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words, len(tokens))
    n = len(tokens) - k + 1
    spans = zip(starts[:n].tolist(), ends[k - 1 :].tolist(), strict=True)
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for first in range(0, n, CHUNK):
        size = min(CHUNK, n - first)
        values = np.fromiter(
            (digest(joined[a:b], HASH_SEED) for a, b in _take(spans, size)), np.uint64, size
        )
        octets = values.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def _take(pairs: Iterator, n: int) -> Iterator:
    for _ in range(n):
        yield next(pairs)


def simhash(text: Column, words: int) -> Column:
    """``fingerprint`` as a column."""

    def convert(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in arrays:
            yield pa.array([fingerprint(x.as_py(), words) for x in array], pa.int64())

    convert.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(convert, "long")(text)


def ball(radius: int) -> list[int]:
    """All masks of at most ``radius`` bits, as signed numbers."""
    masks = [
        sum(1 << i for i in bits)
        for size in range(radius + 1)
        for bits in combinations(range(BITS), size)
    ]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def links(classes: DataFrame, max_distance: int) -> DataFrame:
    """Verified links ``a, b`` between the distinct fingerprints ``fp`` of ``classes``."""
    if max_distance % 2:
        raise ValueError("max_distance must be even: both sides go half the way")
    masks = F.array(*[F.lit(m).cast("long") for m in ball(max_distance // 2)])
    variants = classes.select("fp", F.explode(masks).alias("mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant")
    )
    least = F.min("fp").over(Window.partitionBy("variant"))
    return (
        variants.select("fp", least.alias("a"))
        .where("fp <> a")
        .select("a", F.col("fp").alias("b"))
        .distinct()
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance)
    )


def fingerprint_components(prints: DataFrame, key: str, max_distance: int) -> DataFrame:
    """``fp, label, component`` for each distinct ``fp``.

    ``component`` is the least key in reach, ``label`` the least fingerprint.
    """
    classes = stored(prints.groupBy("fp").agg(F.min(key).alias("least")))
    linked = components(links(classes, max_distance)).withColumnRenamed("node", "fp")
    labelled = classes.join(linked, "fp", "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label")
    )
    labelled = stored(labelled)
    leasts = labelled.groupBy("label").agg(F.min("least").alias("component"))
    return labelled.join(leasts, "label").select("fp", "label", "component")


def near_duplicates(
    docs: DataFrame,
    words: int = 3,
    max_distance: int = 2,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``docs`` with ``fingerprint`` (16 hex digits) and ``component_id``.

    Fingerprints that differ in at most ``max_distance`` bits are linked, and components follow the
    links. ``component_id`` is the least key of the component (NULL if no member has one). Every
    row stays, repeated rows too. NULL, empty and blank texts have the fingerprint zero and are linked
    like any other. ``docs`` is stored once with its fingerprints; select the columns you need first.
    Output names replace input columns.
    """
    base = without(docs, ["fingerprint", "component_id", "fp"])
    prints = stored(base.withColumn("fp", simhash(F.col(text), words)))
    return with_components(prints, key, max_distance)


def with_components(prints: DataFrame, key: str, max_distance: int) -> DataFrame:
    """Stored rows with a fingerprint ``fp``: ``fingerprint`` and ``component_id`` in its place."""
    found = fingerprint_components(prints.select(key, "fp"), key, max_distance).drop("label")
    columns = [quoted(c) for c in prints.columns if c != "fp"]
    return prints.join(found, "fp").select(
        *columns,
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def keep_one(
    docs: DataFrame,
    words: int = 3,
    max_distance: int = 2,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the least key.

    Of repeated rows with that key one stays (the first in the stored order); a component without
    keys keeps one row. Columns are those of ``docs``.
    """
    row = "__row"
    prints = stored(
        docs.withColumn("__fp", simhash(F.col(text), words)).withColumn(
            row, F.monotonically_increasing_id()
        )
    )
    slim = prints.select(F.col(key).alias("key"), F.col("__fp").alias("fp"), row)
    found = fingerprint_components(slim, "key", max_distance)
    # One candidate for each fingerprint first, so that hot fingerprints meet as one row.
    order = F.struct(F.col("key").isNull().alias("none"), "key", row)
    firsts = slim.groupBy("fp").agg(F.min(order).alias("first"))
    winners = (
        firsts.join(found, "fp")
        .groupBy("label")
        .agg(F.min("first").alias("first"))
        .select(F.col(f"first.{row}").alias(row))
    )
    return prints.join(winners, row, "left_semi").drop("__fp", row)
