"""Benchmark decontamination by latent semantic retrieval.

Terms are the words of the benchmark, weighted by a damped inverse document frequency, so neither names nor
common words decide alone. A distributed randomised SVD of the TF-IDF passages of all documents gives a latent
basis.
Windows of every document, as long as the items and overlapping, are compared with the items in the
latent space: the product of a window with an item's direction estimates the share of the item that the
window holds. Windows above ``CANDIDATE_SHARE`` are candidates, and only they are verified, in the words
themselves: the longest common subsequence with the item, and the answer, the item's last part. A
window that is close in the latent space and holds the whole answer may share less of the
wording (a paraphrase).

Items that the basis describes badly (less than ``WEAK_DIRECTION`` of their weight) have no such estimate;
for them alone, windows that hold enough of their words in any order are the candidates.

A benchmark of any size is taken in blocks of ``ITEMS_PER_BLOCK`` items, each with its own basis, and
``BLOCKS_PER_PASS`` blocks share a pass over the documents. A pass is fitted and its hits are stored before
the next is read, so what the driver holds and what is sent to the tasks is bounded.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DataType, DoubleType, IntegralType, LongType, StructType

from panelspark.llm.common import quoted, stored, without

ITEMS_PER_BLOCK = 256
BLOCKS_PER_PASS = 16
RANK, OVERSAMPLE = 192, 16
#: Rounds of the SVD, and the weight of all items together against all passages: a basis of passages
#: alone spends its rank on common words and hardly tells items apart.
ROUNDS, ITEM_WEIGHT = 2, 9.0
#: Words of a passage for document frequencies and for the SVD.
PASSAGE = 64
#: Windows begin at multiples of GRID words; classes of item lengths have windows of their own.
GRID = 8
#: Share of an item that a window must hold by the latent estimate to be a candidate.
CANDIDATE_SHARE = 0.6
#: Shares of an item, and of its answer, that the common subsequence must hold.
MATCH_SHARE, ANSWER_SHARE = 0.75, 0.5
#: The same for a window whose latent estimate is at least CLOSE_SHARE.
CLOSE_SHARE, CLOSE_MATCH, CLOSE_ANSWER = 0.6, 0.6, 1.0
#: Below this share of an item's squared weight in the basis, its latent estimate is not used.
WEAK_DIRECTION = 0.3
#: Cells (a term in a passage) of a stored row, and those whose products are made at a time.
ROW_CELLS, PAIR_CELLS = 1 << 18, 1 << 14
#: Rows of the products of terms that travel together, and cells of those products that a task holds.
TERM_BLOCK, STRIP_CELLS = 64, 1 << 24
#: Words searched at a time: bounds the memory of a task whatever the length of a text.
CHUNK_WORDS = 1 << 17

#: A weight is the inverse document frequency to this power: common words keep a part in the estimate, so
#: an item whose names are changed is still near. It is at least LEAST_WEIGHT.
DAMPING, LEAST_WEIGHT = 0.25, 0.4

#: Marks that part words wherever they stand (fixed values); others are dropped from within a word.
MARKS = ".,;:!?()[]{}\"|#$%&*"

_OTHER = re.compile(r"[\W_]+")
#: Scripts written without blanks: kana, ideographs. Each character is a word.
_UNSPACED = re.compile("([\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff])")


def tokens_of(text: str | None) -> list[str]:
    """Lowered runs without white space and common marks; single characters in scripts without blanks."""
    text = (text or "").lower()
    if not text.isascii() and _UNSPACED.search(text):
        text = _UNSPACED.sub(r" \1 ", text)
    for mark in MARKS:
        text = text.replace(mark, " ")
    return text.split()


def plain(tokens: list[str]) -> list[str]:
    """The letters and digits of each token; tokens without any are left out."""
    if "".join(tokens).isalnum():
        return tokens
    return [w for w in (t if t.isalnum() else _OTHER.sub("", t) for t in tokens) if w]


def words_of(text: str | None) -> list[str]:
    """The words of a text. Items and documents are read alike, so a copy has the words of its item."""
    return plain(tokens_of(text))


def term_numbers(words: list[str], terms: dict[str, int]) -> np.ndarray:
    """The term of each word, -1 for other words."""
    return np.fromiter(map(terms.get, words, repeat(-1)), np.int32, len(words))


@dataclass(frozen=True)
class Items:
    """A block of the benchmark: its words, terms and length classes."""

    ids: list
    words: list[list[str]]
    terms: dict[str, int]

    def counts(self) -> np.ndarray:
        table = np.zeros((len(self.ids), len(self.terms)), np.float32)
        for i, ws in enumerate(self.words):
            np.add.at(table[i], [self.terms[w] for w in ws], 1.0)
        return table

    def classes(self) -> list[tuple[int, list[int]]]:
        """``(stride, items)``: windows of three strides hold any item of at most two whole."""
        by_stride: dict[int, list[int]] = {}
        for i, ws in enumerate(self.words):
            stride = GRID
            while 2 * stride < len(ws):
                stride = max(stride + GRID, int(stride * 1.4) // GRID * GRID)
            by_stride.setdefault(stride, []).append(i)
        return sorted(by_stride.items())


def read_items(benchmark: DataFrame, key: str, text: str) -> Iterator[Items]:
    """The benchmark in blocks; items without words and repeated items of one key do not count."""
    rows = benchmark.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).cast(_id_type(benchmark, key)).alias("id"), F.col(text).alias("text")
    )
    ids, words = [], []
    # One block of items is held at a time; toLocalIterator fetches a partition after the other.
    for row in rows.distinct().orderBy("id", "text").toLocalIterator():
        found = words_of(row["text"])
        if found:
            ids.append(row["id"])
            words.append(found)
        if len(ids) == ITEMS_PER_BLOCK:
            yield _items(ids, words)
            ids, words = [], []
    if ids:
        yield _items(ids, words)


def _id_type(benchmark: DataFrame, key: str) -> DataType:
    """BIGINT for whole numbers, otherwise the type as given."""
    given = benchmark.select(F.col(key)).schema[0].dataType
    return LongType() if isinstance(given, IntegralType) else given


def _items(ids: list, words: list[list[str]]) -> Items:
    vocabulary = sorted({w for ws in words for w in ws})
    return Items(ids, words, {w: i for i, w in enumerate(vocabulary)})


def _passage_terms(text: str | None, terms: dict[str, int]) -> tuple[np.ndarray, np.ndarray, int]:
    """``(passage, term)`` of each word that is a term, and the number of passages of the text."""
    numbers = term_numbers(words_of(text), terms)
    at = np.flatnonzero(numbers >= 0)
    return at // PASSAGE, numbers[at].astype(np.int64), -(-len(numbers) // PASSAGE)


def passage_cells(docs: DataFrame, text: str, terms: dict[str, int]) -> DataFrame:
    """The terms of every passage of all documents, stored, so texts are taken apart once.

    A row holds many passages: ``sizes`` has the number of different terms of each, ``terms`` those terms,
    increasing within a passage, and ``counts`` how often each stands there. None is above ``PASSAGE``.
    """
    size = len(terms)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, filled = [], 0

        def row() -> pa.RecordBatch:
            columns = [[b"".join(column)] for column in zip(*held, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], ["sizes", "terms", "counts"])

        for batch in batches:
            for cell in batch.column(0):
                passage, term, n = _passage_terms(cell.as_py(), terms)
                cells, counts = np.unique(passage * size + term, return_counts=True)
                sizes = np.bincount(cells // size, minlength=n)
                held.append(
                    (
                        sizes.astype("u1").tobytes(),
                        (cells % size).astype("<u4").tobytes(),
                        counts.astype("u1").tobytes(),
                    )
                )
                filled += len(cells) + n
                if filled > ROW_CELLS:
                    yield row()
                    held, filled = [], 0
        if held:
            yield row()

    return stored(docs.select(text).mapInArrow(convert, "sizes binary, terms binary, counts binary"))


def term_weights(cells: DataFrame, size: int) -> np.ndarray:
    """The weight of each of the ``size`` terms over the passages of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.zeros(size, np.int64), 0
        for batch in batches:
            for sizes, terms in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total += len(sizes)
                seen += np.bincount(np.frombuffer(terms, "<u4"), minlength=size)
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict(
            {
                "term": pa.array([*some.tolist(), -1], pa.int64()),
                "n": pa.array([*seen[some].tolist(), total], pa.int64()),
            }
        )

    found = cells.select("sizes", "terms").mapInArrow(count, "term long, n long")
    rows = found.groupBy("term").agg(F.sum("n").alias("n")).collect()  # one for each term
    seen = np.zeros(size)
    passages = 0
    for row in rows:
        if row["term"] < 0:
            passages = row["n"]
        else:
            seen[row["term"]] = row["n"]
    weights = np.log((passages + 1.0) / (seen + 1.0)) ** DAMPING
    return np.maximum(weights, LEAST_WEIGHT)


def add_products(
    sums: np.ndarray, low: int, term: np.ndarray, counts: np.ndarray, sizes: np.ndarray, weights: np.ndarray
) -> None:
    """Adds the products of normalised TF-IDF passages, term by later or equal term, to ``sums``.

    ``sums`` has the rows of the terms from ``low`` on, and all columns. ``term`` and ``counts`` lie passage by
    passage, ``sizes`` of each, the terms of a passage increasing.
    """
    entries = counts * weights[term]
    passage = np.repeat(np.arange(len(sizes)), sizes)
    norms = np.sqrt(np.bincount(passage, entries**2, len(sizes)))
    entries = entries / np.maximum(norms[passage], 1e-9)
    # Each place with those from it to the end of its passage.
    firsts = np.flatnonzero((term >= low) & (term < low + len(sums)))
    rest = np.cumsum(sizes)[passage[firsts]] - firsts
    ends = np.cumsum(rest)
    seconds = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - rest - firsts, rest)
    rows = np.repeat((term[firsts] - low) * sums.shape[1], rest)
    np.add.at(sums.ravel(), rows + term[seconds], np.repeat(entries[firsts], rest) * entries[seconds])


def _added(parts: DataFrame, blocks: int) -> DataFrame:
    """The sums of ``sums`` (doubles) and ``n`` by block; a task holds the sums of its blocks."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        passages: dict[int, int] = {}
        for batch in batches:
            for number, data, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                matrix = np.frombuffer(data, "<f8")
                if number in sums:
                    sums[number] += matrix
                else:
                    sums[number] = matrix.copy()
                passages[number] = passages.get(number, 0) + n
        for number, matrix in sums.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([number], pa.int32()),
                    "sums": pa.array([matrix.tobytes()], pa.binary()),
                    "n": pa.array([passages[number]], pa.int64()),
                }
            )

    dealt = parts.repartition(min(blocks, 32), "block")
    return dealt.mapInArrow(add, "block int, sums binary, n long")


def term_products(cells: DataFrame, places: np.ndarray, weights: np.ndarray) -> DataFrame:
    """A'A of the normalised TF-IDF passages A of all documents, stored by blocks of ``TERM_BLOCK`` terms.

    ``places`` has the number of each stored term among the ``weights``, increasing, -1 for others. A row has a
    block's terms by the terms from the block's first one on (the matrix is symmetric), and ``n`` the passages.
    A task holds ``STRIP_CELLS`` cells of the matrix at most; a larger one is made strip by strip.
    """
    size = len(weights)
    strip = max(STRIP_CELLS // size // TERM_BLOCK, 1) * TERM_BLOCK

    def of_strip(low: int) -> DataFrame:
        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, passages = np.zeros((min(strip, size - low), size)), 0
            for batch in batches:
                for data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    sizes, terms, counts = map(np.frombuffer, data, ("u1", "<u4", "u1"))
                    passages += len(sizes)
                    term = places[terms]
                    own = term >= 0
                    passage = np.repeat(np.arange(len(sizes)), sizes)[own]
                    term, counts = term[own], counts[own].astype(np.float64)
                    sizes = np.bincount(passage, minlength=len(sizes))
                    # Some thousand cells at a time: a passage has up to PASSAGE products for each.
                    ends = np.cumsum(sizes)
                    cuts = np.unique(np.searchsorted(ends, np.arange(0, len(term) + PAIR_CELLS, PAIR_CELLS)))
                    for a, b in zip(cuts, [*cuts[1:], len(sizes)], strict=True):
                        if a < b:
                            part = slice(ends[a] - sizes[a], ends[b - 1])
                            add_products(sums, low, term[part], counts[part], sizes[a:b], weights)
            if not passages:
                return
            for first in range(0, len(sums), TERM_BLOCK):
                data = sums[first : first + TERM_BLOCK, low + first :].astype("<f8").tobytes()
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array([(low + first) // TERM_BLOCK], pa.int32()),
                        "sums": pa.array([data], pa.binary()),
                        "n": pa.array([passages], pa.int64()),
                    }
                )

        return cells.mapInArrow(multiply, "block int, sums binary, n long")

    strips = [of_strip(low) for low in range(0, size, strip)]
    return stored(_added(reduce(DataFrame.unionAll, strips), -(-size // TERM_BLOCK)))


def latent_basis(
    cells: DataFrame, places: np.ndarray, items: Items, weights: np.ndarray, seed: int = 11
) -> np.ndarray:
    """An orthonormal basis (terms by RANK) of the leading right singular vectors.

    A holds the normalised TF-IDF passages of all documents and the items, weighted. Each round multiplies A'A
    with a matrix, at first a random one and then the orthonormal factor of the last product. The part of
    the documents is multiplied on the cluster by blocks of terms.
    """
    size, width, block = len(items.terms), RANK + OVERSAMPLE, TERM_BLOCK
    blocks = -(-size // block)
    products = term_products(cells, places, weights)
    passages = max(products.agg(F.max("n")).first()[0] or 0, len(items.ids))
    own = items.counts() * weights
    own /= np.maximum(np.sqrt((own**2).sum(axis=1)), 1e-9)[:, None]
    draw = np.random.default_rng(seed).standard_normal((size, width), dtype=np.float32)
    for _ in range(ROUNDS):

        def multiply(
            batches: Iterator[pa.RecordBatch], draw: np.ndarray = draw
        ) -> Iterator[pa.RecordBatch]:
            total = np.zeros((size, draw.shape[1]))
            found = False
            for batch in batches:
                for number, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    first, found = number * block, True
                    part = np.frombuffer(data, "<f8").reshape(-1, size - first)
                    rows = len(part)
                    # The block's own square has only its upper half; what follows stands for both halves.
                    square = np.triu(part[:, :rows], 1)
                    total[first : first + rows] += part @ draw[first:] + square.T @ draw[first : first + rows]
                    total[first + rows :] += part[:, rows:].T @ draw[first : first + rows]
            if found:
                for number in range(blocks):
                    data = total[number * block : (number + 1) * block].astype("<f8").tobytes()
                    yield pa.RecordBatch.from_pydict(
                        {
                            "block": pa.array([number], pa.int32()),
                            "sums": pa.array([data], pa.binary()),
                            "n": pa.array([0], pa.int64()),
                        }
                    )

        parts = products.select("block", "sums").mapInArrow(multiply, "block int, sums binary, n long")
        total = (own.T @ (own @ draw)) * (ITEM_WEIGHT * passages / len(items.ids))
        for row in _added(parts, blocks).collect():  # a row for a block
            matrix = np.frombuffer(row["sums"], "<f8").reshape(-1, width)
            total[row["block"] * block :][: len(matrix)] += matrix
        draw = np.linalg.svd(total, full_matrices=False)[0].astype(np.float32)
        width = draw.shape[1]
    return draw[:, :RANK]


def common_subsequence(item: list[str], window: list[str]) -> list[bool]:
    """Which words of ``item`` a longest common subsequence with ``window`` uses."""
    n, m = len(item), len(window)
    table = np.zeros((n + 1, m + 1), np.int32)
    for i in range(n - 1, -1, -1):
        equal = np.fromiter(map(item[i].__eq__, window), bool, m)
        best = np.where(equal, table[i + 1, 1:] + 1, table[i + 1, :-1])
        # The maximum over all later starts, since a row never rises from left to right.
        table[i, :-1] = np.maximum.accumulate(best[::-1])[::-1]
    used, i, j = [False] * n, 0, 0
    while i < n and j < m:
        if item[i] == window[j] and table[i, j] == table[i + 1, j + 1] + 1:
            used[i] = True
            i, j = i + 1, j + 1
        elif table[i + 1, j] >= table[i, j + 1]:
            i += 1
        else:
            j += 1
    return used


def verified(item: list[str], window: list[str], close: bool = False) -> float:
    """The share of the item in the common subsequence; 0 if it or the answer's share is too small.

    The answer is the last third of the item. ``close`` windows, by the latent estimate, need all of the
    answer but less of the item.
    """
    have = set(window)
    held = sum(map(have.__contains__, item))
    if held < (CLOSE_MATCH if close else MATCH_SHARE) * len(item):
        return 0.0
    used = common_subsequence(item, window)
    share, answer = sum(used) / len(item), used[-max(1, len(item) // 3) :]
    if share >= MATCH_SHARE and sum(answer) >= ANSWER_SHARE * len(answer):
        return share
    if close and share >= CLOSE_MATCH and sum(answer) >= CLOSE_ANSWER * len(answer):
        return share
    return 0.0


def previous(numbers: np.ndarray) -> np.ndarray:
    """For each place, the last place before it with the same term; -1 if there is none."""
    at = np.flatnonzero(numbers >= 0)
    order = at[np.argsort(numbers[at], kind="stable")]
    same = numbers[order[1:]] == numbers[order[:-1]]
    before = np.full(len(numbers), -1, np.int64)
    before[order[1:][same]] = order[:-1][same]
    return before


def overlaps(numbers: np.ndarray, before: np.ndarray, stride: int, table: np.ndarray) -> np.ndarray:
    """For each window of three strides and each item, how many words of the item the window has.

    ``table`` has the count of each term (row) in each item. A window has a term once, at its first place
    there. A place lies in three windows, and is first in all that begin after the place before it.
    """
    strides = -(-len(numbers) // stride)
    sums = np.zeros((strides, table.shape[1]), table.dtype)
    places = np.flatnonzero(numbers >= 0)
    places = places[table.any(axis=1)[numbers[places]]]
    owns = places // stride
    # How many strides before its own the earliest window begins in which it is first.
    ages = np.minimum(owns - before[places] // stride - 1, 2)
    for age in range(3):
        here, own = places[ages == age], owns[ages == age]
        if not len(here):
            continue
        firsts = np.flatnonzero(np.diff(own, prepend=-1))
        held = np.add.reduceat(table[numbers[here]], firsts, axis=0, dtype=table.dtype)
        for back in range(age + 1):
            windows = own[firsts] - back
            inside = windows >= 0
            sums[windows[inside]] += held[inside]
    return sums


class Searcher:
    """Finds the items of a block in documents."""

    def __init__(self, items: Items, weights: np.ndarray, basis: np.ndarray):
        self.items = items
        # The last row is that of words that are no term.
        self.latent = np.zeros((len(weights) + 1, basis.shape[1]), np.float32)
        self.latent[:-1] = weights[:, None] * basis
        weighted = items.counts() * weights.astype(np.float32)
        vectors = weighted @ basis
        norms, whole = (vectors**2).sum(axis=1), (weighted**2).sum(axis=1)
        weak = norms < WEAK_DIRECTION * whole
        # A window's product with a target estimates the share of the item that it holds.
        targets = np.where(weak[:, None], 0.0, vectors / np.maximum(norms, 1e-6)[:, None])
        self.classes = [
            (s, np.array(xs), targets[xs].T.astype(np.float32), np.flatnonzero(weak[xs]))
            for s, xs in items.classes()
        ]
        self.reach = max((3 * s for s, _ in items.classes()), default=0)

    @cached_property
    def tables(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """By class, for its weak items: how often each has each term, and the words that a window must hold.

        Made by the task that searches, so it is not sent.
        """
        counts, tables = self.items.counts(), []
        for _, members, _, weak in self.classes:
            sizes = np.array([len(self.items.words[i]) for i in members[weak]])
            kind = np.min_scalar_type(int(sizes.max(initial=1)))  # no sum is larger than an item
            table = np.ascontiguousarray(counts[members[weak]].T.astype(kind))
            tables.append((table, np.ceil(MATCH_SHARE * sizes).astype(kind)))
        return tables

    def search(self, texts: list[str | None]) -> list[dict]:
        """For each text, the verified items and their shares."""
        found: list[dict] = [{} for _ in texts]
        held: list[str] = []
        owners: list[tuple[int, int]] = []  # (end of the tokens, text)
        for number, text in enumerate(texts):
            tokens = words_of(text)
            # A long text is searched in parts that overlap by the longest window.
            for first in range(0, max(len(tokens), 1), CHUNK_WORDS):
                held += tokens[first : first + CHUNK_WORDS + self.reach]
                owners.append((len(held), number))
                if len(held) >= CHUNK_WORDS:
                    self._search(held, owners, found)
                    held, owners = [], []
        if held:
            self._search(held, owners, found)
        return found

    def _search(self, tokens: list[str], owners: list, found: list[dict]) -> None:
        numbers = term_numbers(tokens, self.items.terms)
        size = -(-len(tokens) // GRID)
        padded = np.full(size * GRID, -1, np.int64)
        padded[: len(numbers)] = numbers
        cells = self.latent[padded[::GRID]]
        for place in range(1, GRID):
            cells += self.latent[padded[place::GRID]]
        ends = [e for e, _ in owners]
        before = None
        for (stride, members, targets, weak), (table, least) in zip(self.classes, self.tables, strict=True):
            step = stride // GRID
            starts = np.arange(0, size, step)
            stops = np.minimum(starts + 3 * step, size)
            alone = cells[::step].copy()
            for place in range(1, step):
                more = cells[place::step]
                alone[: len(more)] += more
            windows = alone.copy()
            windows[:-1] += alone[1:]
            windows[:-2] += alone[2:]
            held = windows @ targets
            near = held >= CANDIDATE_SHARE
            if len(weak):
                before = previous(numbers) if before is None else before
                near[:, weak] = overlaps(numbers, before, stride, table)[: len(starts)] >= least
            for row, column in zip(*np.nonzero(near), strict=True):
                low, high = int(starts[row]) * GRID, min(int(stops[row]) * GRID, len(tokens))
                close = bool(held[row, column] >= CLOSE_SHARE)
                self._verify(tokens, low, high, int(members[column]), close, ends, owners, found)

    def _verify(self, tokens, low, high, index, close, ends, owners, found) -> None:
        """Compares an item with the part of the window that lies in each of its documents."""
        place = bisect_right(ends, low)
        while place < len(owners) and low < high:
            stop, number = owners[place]
            item_id = self.items.ids[index]
            if found[number].get(item_id, 0.0) < 1.0:
                share = verified(self.items.words[index], tokens[low : min(stop, high)], close)
                if share:
                    found[number][item_id] = max(share, found[number].get(item_id, 0.0))
            low, place = max(low, stop), place + 1


def fitted(
    docs: DataFrame, benchmark: DataFrame, text: str, item_key: str, item_text: str
) -> Iterator[list[Searcher]]:
    """The searchers of one pass after the other, one for each block of the benchmark."""
    blocks = read_items(benchmark, item_key, item_text)
    while together := list(islice(blocks, BLOCKS_PER_PASS)):
        union = {w: i for i, w in enumerate(sorted({w for b in together for w in b.terms}))}
        cells = passage_cells(docs, text, union)
        weights = term_weights(cells, len(union))
        searchers = []
        for items in together:
            numbers = [union[w] for w in items.terms]
            own, places = weights[numbers], np.full(len(union), -1, np.int32)
            places[numbers] = np.arange(len(numbers))
            searchers.append(Searcher(items, own, latent_basis(cells, places, items, own)))
        yield searchers


def _hits(text: Column, searchers: list[Searcher], type_: ArrayType) -> Column:
    kind = to_arrow_type(type_)

    def convert(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in arrays:
            texts = array.to_pylist()
            rows: list[dict] = [{} for _ in texts]
            for searcher in searchers:
                for row, more in zip(rows, searcher.search(texts), strict=True):
                    for item, share in more.items():
                        row[item] = max(share, row.get(item, 0.0))
            yield pa.array(
                [[{"item_id": i, "share": s} for i, s in sorted(r.items())] for r in rows], kind
            )

    convert.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    udf = F.arrow_udf(convert, type_)
    return udf.asNondeterministic()(text)


def find_items(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``docs`` with ``items``: the benchmark items that a document holds, with their shares.

    One row per input row, repeated rows too; no document is shuffled. A document without hits, with a
    NULL or empty text, or an empty benchmark gives an empty list. Items without words never hit; items
    of equal text all hit. Ids that are whole numbers become BIGINT, others stay as they are; an item with
    a NULL id cannot be named and is left out here (``without_items`` searches it too). An input column
    ``items`` is replaced.
    """
    base = without(docs, ["items"])
    hit = StructType().add("item_id", _id_type(benchmark, item_key)).add("share", DoubleType())
    found, first = base.withColumn("items", F.array().cast(ArrayType(hit))), True
    for searchers in fitted(base, benchmark, text, item_key, item_text):
        found = found if first else stored(found)  # the hits of a pass, before the next
        first = False
        found = found.withColumn("__more", _hits(F.col(text), searchers, ArrayType(hit))).withColumn(
            "items", F.concat("items", "__more")
        ).drop("__more")
    return found


def without_items(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, whatever its id; the columns of ``docs``."""
    marked = docs.withColumn("__text", F.col(text)).select(
        F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("__row"), "__text"
    )
    # Ids do not matter here: rows without one are searched like the others.
    items = benchmark.select(F.lit(0).cast("long").alias("id"), F.col(item_text).alias("text"))
    found = find_items(marked, items, "__text", "id", "text")
    return found.where(F.size("items") == 0).select("__row.*")
