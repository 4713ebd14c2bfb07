"""Documents packed whole into as few sequences as possible by large-item matching.

Texts are encoded, end with one closing id, and only those longer than a sequence are cut. Pieces above a
third of a sequence are large: at most two share a sequence, so they are paired by a greedy matching (the
longest with the longest that still fits), which leaves as few sequences as large pieces allow.
The other pieces, in decreasing length, go to the smallest gap that takes them.

Only lengths decide where a piece goes. The packing is therefore planned over all data at once from the
number of pieces of each length: at most ``capacity`` numbers reach the driver at any size of the
input. The plan is a list of runs ("the next 5,000 pieces of length 300, one to a sequence, from sequence
71,000 on, at offset 700"). Each piece then finds its run from its length and its rank among the pieces
of that length, a count within its task plus the counts of the tasks before; no piece needs another.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import stored
from panelspark.llm.token_counts import encoder

CAPACITY = 1024
#: The id that closes every document.
END_ID = 2
#: Documents encoded at a time in a task.
DOCS_AT_ONCE = 256

_SCHEMA = pa.schema(
    [
        ("key", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("ids_crc32", pa.int64()),
        ("task", pa.int32()),
        ("rank", pa.int64()),
    ]
)
_DDL = (
    "key long, piece int, start long, length long, ids binary, ids_crc32 long, task int, rank long"
)


class Run(NamedTuple):
    """``pieces`` pieces of one length, ``per`` to a sequence, from sequence ``first`` on."""

    length: int
    rank: int  # of the run's first piece among the pieces of its length
    pieces: int
    per: int
    first: int
    offset: int


class Plan:
    """Runs for all pieces; see the functions below for how they come about."""

    def __init__(self, counts: Mapping[int, int], capacity: int):
        self.capacity = capacity
        self.left = {n: c for n, c in sorted(counts.items(), reverse=True) if c}
        self.used = dict.fromkeys(self.left, 0)
        self.gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free: (first, sequences)
        self.sequences = 0
        self.runs: list[Run] = []
        self._match_large()
        self._fill_gaps()
        self.runs.sort(key=lambda run: (-run.length, run.rank))

    def _place(self, length: int, pieces: int, per: int, first: int, offset: int) -> None:
        if pieces:
            self.runs.append(Run(length, self.used[length], pieces, per, first, offset))
            self.used[length] += pieces
            self.left[length] -= pieces

    def _free(self, free: int, first: int, sequences: int) -> None:
        if free and sequences:
            self.gaps[free].append((first, sequences))

    def _partner(self, length: int, large: list[int]) -> int | None:
        """The longest large length beside ``length`` of which pieces are left."""
        for other in large:
            fits = other <= length and length + other <= self.capacity
            if fits and self.left[other] > (other == length):
                return other
        return None

    def _match_large(self) -> None:
        """Pairs; any maximum matching can be changed into this one pair by pair."""
        large = [n for n in self.left if 3 * n > self.capacity]
        for length in large:
            while self.left[length]:
                other = self._partner(length, large)
                first = self.sequences
                if other is None:
                    count = self.left[length]
                    self._place(length, count, 1, first, 0)
                elif other == length:
                    count = self.left[length] // 2
                    self._place(length, 2 * count, 2, first, 0)
                else:
                    count = min(self.left[length], self.left[other])
                    self._place(length, count, 1, first, 0)
                    self._place(other, count, 1, first, length)
                self.sequences += count
                self._free(self.capacity - length - (other or 0), first, count)

    def _fill_gaps(self) -> None:
        """Best fit in decreasing length; a gap that took a piece is the next best while it fits."""
        for length in [n for n in self.left if 3 * n <= self.capacity]:
            while self.left[length]:
                free = min((f for f, g in self.gaps.items() if f >= length and g), default=None)
                if free is None:
                    free, first = self.capacity, self.sequences
                    count = -(-self.left[length] // (free // length))
                    self.sequences += count
                else:
                    first, count = self.gaps[free].pop()
                per, offset = free // length, self.capacity - free
                full = min(count, self.left[length] // per)
                self._place(length, full * per, per, first, offset)
                self._free(free - per * length, first, full)
                if full < count:  # fewer pieces than places are left for the next sequence
                    rest = self.left[length]
                    self._place(length, rest, rest, first + full, offset)
                    self._free(free - rest * length, first + full, 1)
                    self._free(free, first + full + 1, count - full - 1)

    def arrays(self) -> dict[str, np.ndarray]:
        """The runs as columns, for a search by the place of a piece among all, longest first."""
        table = np.array(self.runs, dtype=np.int64).reshape(-1, len(Run._fields))
        columns = dict(zip(Run._fields, table.T, strict=True))
        columns["at"] = np.concatenate([[0], np.cumsum(columns["pieces"])])[:-1].astype(np.int64)
        columns["before"] = np.zeros(self.capacity + 1, dtype=np.int64)
        begins = columns["rank"] == 0
        columns["before"][columns["length"][begins]] = columns["at"][begins]
        return columns


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of a document; only the first may be shorter than the rest."""
    first = length % capacity or min(length, capacity)
    return [(0, first), *((s, capacity) for s in range(first, length, capacity))]


def pieces(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The encoded pieces of all documents, with the task that made them and their rank in it."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, end = encoder(path), np.array([end_id], dtype="<u4")
        task, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                some = batch.slice(at, DOCS_AT_ONCE)
                texts = [x or "" for x in some.column(1).to_pylist()]
                rows = []
                for k, ids in zip(some.column(0).to_pylist(), model.arrays(texts, "<u4"), strict=True):
                    ids = np.concatenate([ids, end])
                    for number, (start, length) in enumerate(cut(len(ids), capacity)):
                        raw = ids[start : start + length].tobytes()
                        rows.append((k, number, start, length, raw, zlib.crc32(raw), task, seen[length]))
                        seen[length] += 1
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)],
                    schema=_SCHEMA,
                )

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(convert, _DDL)


def place(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece with its place in a sequence.

    Columns: ``key``, ``piece`` (from 0), ``start`` (ids of the document before it), ``length``, ``ids``
    (little-endian, four bytes each), ``ids_crc32``, ``sequence_id`` and ``offset`` (from 0 on, without
    gaps in a sequence).

    Every input row is packed once, repeated rows as often as they occur; rows with a NULL key keep it. A
    NULL or empty text is the closing id alone. A text of any length is cut into pieces of ``capacity``
    ids of which the first may be shorter. Pieces of equal length are interchangeable; which of them
    takes which place depends on the files of the input. Other columns are not carried. An empty
    table gives no rows.
    """
    # Stored, so that the numbers of the tasks and the ranks in them hold whatever is run again.
    cuts = stored(pieces(docs, path, capacity, end_id, key, text))
    per_task = cuts.groupBy("length", "task").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select(
        "length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    # At most ``capacity`` rows: the lengths that occur.
    counts = {r["length"]: r["n"] for r in cuts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = Plan(counts, capacity).arrays()

    def find(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        length, rank = lengths.to_numpy(), ranks.to_numpy()
        run = np.searchsorted(runs["at"], runs["before"][length] + rank, side="right") - 1
        nth = rank - runs["rank"][run]
        sequence = runs["first"][run] + nth // runs["per"][run]
        offset = runs["offset"][run] + nth % runs["per"][run] * length
        return pa.StructArray.from_arrays(
            [pa.array(sequence), pa.array(offset)], names=["sequence_id", "offset"]
        )

    find.__annotations__ = {"lengths": pa.Array, "ranks": pa.Array, "return": pa.Array}
    spot = F.arrow_udf(find, "struct<sequence_id: long, offset: long>")
    return (
        cuts.join(before, ["length", "task"])
        .withColumn("spot", spot("length", F.col("rank") + F.col("before")))
        .select("key", "piece", "start", "length", "ids", "ids_crc32", "spot.sequence_id", "spot.offset")
    )


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences of :func:`place`: ``sequence_id, n_tokens, segments, input_ids``.

    ``segments`` holds ``key, piece, start, length`` in order; ``input_ids`` the ids of all. A group
    holds at most one sequence. No pieces, no sequences.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "key", "piece", "start", "length", "ids")))
    joined = F.aggregate("parts", F.lit(b""), lambda ids, part: F.concat(ids, part["ids"]))
    return (
        placed.groupBy("sequence_id")
        .agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
        .select(
            "sequence_id",
            "n_tokens",
            F.transform(
                "parts", lambda p: F.struct(p["key"], p["piece"], p["start"], p["length"])
            ).alias("segments"),
            joined.alias("input_ids"),
        )
    )
