"""How sources of a language differ in their words, on hash-consed segment trees of term counts.

The kept terms of a language are cut into blocks; over each block every group (language, source) has
a segment tree whose leaves are its term counts. Trees are hash-consed: leaves with the same count are one
node, and so are inner nodes with the same two children, whatever the group and the place. Two groups are compared
by walking both trees at once from the roots. At each level a pair of nodes that occurs several times is kept
once; it is priced once, from the prices of its children, and its price counts wherever it
occurs. Frequent terms lie in blocks of their own, so the blocks of rare terms, mostly zeros, shrink to a few pairs.

A price depends on the totals of the two groups, so it is kept per pair of groups, and in both
directions. All arithmetic is on integers; sums of prices of blocks are the sums over all terms.

Blocks are dealt to tasks with a chunk of sources on either side, so neither a large vocabulary nor many
sources gather in one task.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import stored

#: Terms of the contract in UTF-8: ASCII letters and everything beyond ASCII.
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
#: p is 1 + floor(UNIT * (count + 1) / (N + V)).
UNIT = 1_000_000_000
MIN_DOCS = 3
TOP_TERMS = 200
#: Kept terms of a block.
BLOCK_TERMS = 1 << 12
#: Sources on each side of a task.
SOURCES = 32
#: Different terms that a task counts before it hands them on.
HELD_TERMS = 1_000_000


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def term_counts(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences, and documents that hold the term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def handed() -> Iterator[pa.RecordBatch]:
            for (lang_, source_), (n, of) in held.items():
                columns = [
                    pa.repeat(lang_, len(n)),
                    pa.repeat(source_, len(n)),
                    pa.array(n, pa.binary()).cast(pa.string()),
                    pa.array(n.values(), pa.int64()),
                    pa.array(map(of.__getitem__, n), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])
            held.clear()

        size = 0
        for batch in batches:
            for lang_, source_, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # Lower-casing bytes changes A to Z alone.
                found = TERM.findall(body.encode().lower())
                n, of = held.setdefault((lang_, source_), (Counter(), Counter()))
                size -= len(n)
                n.update(found)
                of.update(set(found))
                size += len(n)
                if size > HELD_TERMS:
                    yield from handed()
                    size = 0
        yield from handed()

    clean = docs.select(_text(lang), _text(source), _text(text))
    part = clean.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return part.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def exact_p(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / (total + kept)) without rounding at any size."""
    scaled = (count + 1).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return F.call_function("div", scaled, (total + kept).cast("decimal(20,0)")) + 1


def exact_f(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); p and q are at most UNIT + 1, so the square fits a LONG."""
    return F.call_function("div", (p - q) * (p - q), q)


class Nodes:
    """Hash-consed segment trees of several groups over the same terms, level by level.

    ``levels[0]`` holds the leaf ids of each group (rows) and place (columns); each further level the ids of
    the nodes over two of the level below, equal ids for equal pairs of children. Places beyond
    the last term hold the leaf ``absent``, which costs nothing.
    """

    def __init__(self, counts: np.ndarray):
        groups, terms = counts.shape
        self.values, ids = np.unique(counts, return_inverse=True)
        self.absent = len(self.values)
        width = 1 << max(terms - 1, 0).bit_length()
        leaves = np.full((groups, width), self.absent, dtype=np.int64)
        leaves[:, :terms] = ids.reshape(groups, terms)
        self.levels, self.children = [leaves], []
        while self.levels[-1].shape[1] > 1:
            below = self.levels[-1]
            kinds = int(below.max(initial=0)) + 1
            pairs, ids = np.unique(below[:, ::2] * kinds + below[:, 1::2], return_inverse=True)
            self.children.append(np.stack([pairs // kinds, pairs % kinds]))
            self.levels.append(ids.reshape(groups, -1))


def shared_pairs(nodes: Nodes, a: int, b: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The different pairs of leaves of two trees, and for each level where a pair's children are below."""
    x, y = nodes.levels[-1][a], nodes.levels[-1][b]
    steps = []
    for left_right in reversed(nodes.children):
        x, y = left_right[:, x].ravel(), left_right[:, y].ravel()  # all left children, then all right
        kinds = max(int(y.max(initial=0)) + 1, 1)
        pairs, ids = np.unique(x * kinds + y, return_inverse=True)
        steps.append(ids.reshape(2, -1))
        x, y = pairs // kinds, pairs % kinds
    return np.stack([x, y]), steps


def leaf_p(nodes: Nodes, total: int, kept: int) -> np.ndarray:
    """p of each leaf for a group of ``total`` occurrences; 1 for the leaf that is absent."""
    p = [1 + UNIT * (int(count) + 1) // (total + kept) for count in nodes.values]
    return np.array([*p, 1], dtype=np.int64)


def pair_price(nodes: Nodes, a: int, b: int, p_a: np.ndarray, p_b: np.ndarray) -> tuple[int, int]:
    """The sums of f over all terms with q from ``b``, and with q from ``a``."""
    (x, y), steps = shared_pairs(nodes, a, b)
    p, q = p_a[x], p_b[y]
    square = (p - q) * (p - q)
    price = np.stack([square // q, square // p])
    for ids in reversed(steps):
        price = price[:, ids[0]] + price[:, ids[1]]
    return int(price[0, 0]), int(price[1, 0])


def block_prices(rows: pd.DataFrame) -> pd.DataFrame:
    """The prices of all pairs of sources of one task: the first chunk against the second.

    ``rows`` holds a row without a term for each source (its total in ``n``) and one for each count above 0.
    """
    head = rows[rows["term"].isna()]
    lang, terms, kept = head["lang"].iloc[0], int(head["terms"].iloc[0]), int(head["kept"].iloc[0])
    sources = head["source"].tolist()
    totals, sides = head["n"].tolist(), head["side"].tolist()
    out = []
    if terms:
        body = rows[rows["term"].notna()].sort_values(["whole", "term"], ascending=[False, True])
        place, _ = pd.factorize(body["term"])
        group = pd.Index(sources).get_indexer(body["source"])
        counts = np.zeros((len(sources), terms), dtype=np.int64)
        counts[group, place] = body["n"].to_numpy()
        nodes = Nodes(counts)
        p = [leaf_p(nodes, total, kept) for total in totals]
    for a in range(len(sources)):
        for b in range(a + 1, len(sources)):
            # With two different chunks, pairs within one belong to another task.
            if {sides[a], sides[b]} in ({0, 1}, {2}):
                there, back = pair_price(nodes, a, b, p[a], p[b]) if terms else (0, 0)
                out += [(lang, sources[a], sources[b], there), (lang, sources[b], sources[a], back)]
    return pd.DataFrame(out, columns=["lang", "source", "item", "price"])


def audit(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    block_terms: int = BLOCK_TERMS,
    sources_at_once: int = SOURCES,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how each source differs from the others and from its language.

    Each language keeps the terms of at least ``min_docs`` of its rows. Part ``pair`` has for each source all
    other sources of the language, with the sum over all kept terms of f(p of the source, p of the other).
    Part ``term`` has the ``top_terms`` kept terms of the source with the greatest f(p of the source, p of the
    language) among those that it holds and whose p is above the language's. Ranks go by falling value,
    then by the item.

    NULL text, language and source count as ''. A group without kept terms has counts of 0; in a language
    without kept terms all pair values are 0. Texts of any length are counted whole, repeated rows as often as
    they occur; other columns are ignored. An empty table gives no rows.
    """
    counted = stored(term_counts(docs, text, lang, source))
    kept = (
        counted.groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("whole"))
        .where(F.col("docs") >= min_docs)
        # Terms of similar frequency share blocks.
        .withColumn("octave", F.length(F.bin("whole")))
        .select("lang", "term", "whole", "octave")
    )
    kept = stored(kept)
    # The octave is dealt into blocks by hash; ``blocks`` holds how many terms each of them got.
    sizes = kept.groupBy("lang", "octave").agg(F.count("*").alias("size"))
    parts = sizes.withColumn("parts", F.ceil(F.col("size") / block_terms))
    dealt = kept.join(parts.select("lang", "octave", "parts"), ["lang", "octave"]).withColumn(
        "part", F.pmod(F.xxhash64("term"), F.col("parts"))
    )
    blocks = dealt.groupBy("lang", "octave", "part").agg(F.count("*").alias("terms"))
    rows = stored(
        counted.join(dealt, ["lang", "term"]).select(
            "lang", "source", "term", "n", "whole", "octave", "part"
        )
    )

    languages = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("whole").alias("total"))
    groups = (
        docs.select(_text(lang).alias("lang"), _text(source).alias("source"))
        .distinct()
        .join(rows.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left")
        .join(languages, "lang", "left")
        .na.fill(0, ["n", "kept", "total"])
    )
    # Chunks of sources by number; a window over the sources of a language, never over documents.
    by_source = Window.partitionBy("lang").orderBy("source")
    numbered = stored(
        groups.withColumn("chunk", F.floor((F.row_number().over(by_source) - 1) / sources_at_once).cast("int"))
    )
    pairs = _pair_values(rows, blocks, numbered)
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    all_pairs = pairs.withColumn("rank", F.row_number().over(ranked)).withColumn("part", F.lit("pair"))

    totals = numbered.select("lang", "source", F.col("n").alias("group_total"), "kept", "total")
    held = rows.join(totals, ["lang", "source"])
    p = exact_p(F.col("n"), F.col("group_total"), F.col("kept"))
    q = exact_p(F.col("whole"), F.col("total"), F.col("kept"))
    terms = (
        held.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
        .where("p > q")
        .select("lang", "source", "item", exact_f(F.col("p"), F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= top_terms)
        .withColumn("part", F.lit("term"))
    )
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return all_pairs.select(columns).unionByName(terms.select(columns))


def _pair_values(rows: DataFrame, blocks: DataFrame, groups: DataFrame) -> DataFrame:
    """The value of every ordered pair of sources of a language, from the prices of all blocks."""
    chunks = groups.groupBy("lang").agg((F.max("chunk") + 1).alias("chunks"))
    # A source of chunk c meets each chunk d in the task (min, max) of both. Its side there tells the
    # chunks of a task apart: 0 and 1, or 2 where a chunk meets itself.
    meets = (
        groups.join(chunks, "lang")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("first", F.least("chunk", "other"))
        .withColumn("second", F.greatest("chunk", "other"))
        .withColumn(
            "side",
            F.when(F.col("chunk") == F.col("other"), 2).when(F.col("chunk") < F.col("other"), 0).otherwise(1),
        )
        .select("lang", "source", "first", "second", "side", F.col("n").alias("group_total"), "kept")
    )
    heads = meets.join(blocks, "lang", "left").select(
        "lang",
        "source",
        "first",
        "second",
        "side",
        F.coalesce("octave", F.lit(0)).alias("octave"),
        F.coalesce("part", F.lit(0).cast("long")).alias("part"),
        F.coalesce("terms", F.lit(0).cast("long")).alias("terms"),
        "kept",
        F.lit(None).cast("string").alias("term"),
        F.lit(0).cast("long").alias("whole"),
        F.col("group_total").alias("n"),
    )
    bodies = rows.join(meets, ["lang", "source"]).select(
        "lang",
        "source",
        "first",
        "second",
        "side",
        "octave",
        "part",
        F.lit(0).cast("long").alias("terms"),
        "kept",
        "term",
        "whole",
        "n",
    )
    prices = (
        heads.unionByName(bodies)
        .groupBy("lang", "octave", "part", "first", "second")
        .applyInPandas(block_prices, "lang string, source string, item string, price long")
    )
    return prices.groupBy("lang", "source", "item").agg(F.sum("price").alias("value"))
