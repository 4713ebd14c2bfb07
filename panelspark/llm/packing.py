"""Token ids packed into rows of a fixed length by best-fit decreasing.

Texts are encoded, texts longer than a row are cut into pieces without loss, and pieces are dealt to
shards by hash. Within a shard, pieces in decreasing length go to the fullest open row that still
takes them; a segment tree over the free places finds that row. A packed row holds its ids and the
positions within each segment as little-endian binary, and the cumulative segment lengths.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.token_counts import Encoder, encoder

ROW_TOKENS = 2048
#: Text bytes of a shard; the number of shards follows from the bytes of all texts.
SHARD_BYTES = 8 << 20
#: Tokens packed together at most: bounds the memory of a task whatever the shard holds.
POOL_TOKENS = 32 << 20
#: Rows put out at a time.
BATCH_ROWS = 512

_PIECES = "array<struct<part: int, n: int, ids: binary>>"
_SCHEMA = pa.schema(
    [
        ("shard", pa.int64()),
        ("row", pa.int32()),
        ("n_tokens", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("parts", pa.list_(pa.int32())),
        ("cu_seqlens", pa.list_(pa.int32())),
        ("input_ids", pa.binary()),
        ("position_ids", pa.binary()),
    ]
)
_DDL = (
    "shard long, row int, n_tokens int, doc_ids array<long>, parts array<int>, "
    "cu_seqlens array<int>, input_ids binary, position_ids binary"
)


class CapacityTree:
    """Open rows by free places; ``take`` finds the smallest number of free places that suffices."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.filled = [0] * (2 * self.width)  # open rows below each node
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        node = free + self.width
        while node:
            self.filled[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """``(free, row)`` of the best fit, taken out; of equals the last added."""
        filled, node = self.filled, need + self.width
        if not filled[node]:
            while node > 1 and (node & 1 or not filled[node + 1]):
                node >>= 1
            if node == 1:
                return None
            node += 1
            while node < self.width:
                node *= 2
                if not filled[node]:
                    node += 1
        free = node - self.width
        while node:
            filled[node] -= 1
            node >>= 1
        return free, self.rows[free].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """The items (as indices) of each row; lengths are taken in decreasing order, ties as they come."""
    tree, rows = CapacityTree(capacity), []
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[item]
        found = tree.take(n)
        if found is None:
            rows.append([item])
            free, row = capacity, len(rows) - 1
        else:
            free, row = found
            rows[row].append(item)
        if free > n:
            tree.add(free - n, row)
    return rows


def id_type(model: Encoder) -> str:
    """Two bytes for an id where the vocabulary allows it."""
    return "<u2" if model.size <= 1 << 16 else "<u4"


def pieces(text: Column, path: str, row_tokens: int, kind: str) -> Column:
    """The ids of a text in pieces of at most ``row_tokens``, as binary; none for an empty text."""

    def convert(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        struct = pa.struct([("part", pa.int32()), ("n", pa.int32()), ("ids", pa.binary())])
        model = encoder(path)
        for array in arrays:
            out = []
            for ids in model.arrays([x or "" for x in array.to_pylist()], kind):
                parts = [ids[c : c + row_tokens] for c in range(0, len(ids), row_tokens)]
                out.append(
                    [{"part": i, "n": len(p), "ids": p.tobytes()} for i, p in enumerate(parts)]
                )
            yield pa.array(out, pa.list_(struct))

    convert.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(convert, _PIECES)(text)


def pack(
    docs: DataFrame,
    path: str,
    row_tokens: int = ROW_TOKENS,
    pad_id: int = 0,
    key: str = "doc_id",
    text: str = "text",
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Packed rows of the tokens of all texts.

    Columns: ``shard, row`` (number within the shard), ``n_tokens``, ``doc_ids`` and ``parts`` of the
    segments, ``cu_seqlens`` (0, then the end of each segment), ``input_ids`` (``row_tokens`` ids of two
    bytes, or four if the vocabulary needs it, the places after ``n_tokens`` filled with ``pad_id``) and
    ``position_ids`` (0, 1, ... from each segment's start; 0 in the filling; as many bytes each).

    Every token of every input row is in exactly one segment, repeated rows as often as they occur;
    part i of a document starts at token i * row_tokens. Texts without tokens (NULL, empty) take
    no place. Rows with a NULL key have a NULL in ``doc_ids``. Equal input gives equal rows.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    shards = max(1, -(-size // shard_bytes))
    kind = id_type(encoder(path))
    cut = docs.select(
        F.col(key).cast("long").alias("key"),
        F.explode(pieces(F.col(text), path, row_tokens, kind)).alias("p"),
    ).select("key", "p.part", "p.n", "p.ids")
    # The ids are part of the hash, so equal or missing keys spread; one task for each shard.
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("key", "part", "ids"), F.lit(shards)))
    ordered = dealt.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions(
        "shard", F.desc("n"), "key", "part", "ids"
    )

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, tokens, first = None, 0, 0
        pool: list[tuple[int | None, int, int, bytes]] = []
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("shard", "key", "part", "n", "ids")))
            for at, key_, part, n, ids in rows:
                if pool and (at != shard or tokens + n > POOL_TOKENS):
                    done = _packed_rows(pool, row_tokens, kind, pad_id)
                    yield from _batches(shard, first, done)
                    first = first + len(done) if at == shard else 0
                    pool, tokens = [], 0
                shard = at
                pool.append((key_, part, n, ids))
                tokens += n
        if pool:
            yield from _batches(shard, first, _packed_rows(pool, row_tokens, kind, pad_id))

    return ordered.mapInArrow(fill, _DDL)


def _packed_rows(pool: list, row_tokens: int, kind: str, pad_id: int) -> list[tuple]:
    """``(segments, n_tokens)`` of each row; the ids are joined when a row is put out."""
    bins = best_fit_decreasing([n for _, _, n, _ in pool], row_tokens)
    width = np.dtype(kind).itemsize
    pad = np.full(row_tokens, pad_id, dtype=kind).tobytes()
    counting = np.arange(row_tokens, dtype=kind).tobytes()
    return [([pool[i] for i in b], width, pad, counting) for b in bins]


def _batches(shard: int, first: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(rows), BATCH_ROWS):
        columns: list[list] = [[] for _ in _SCHEMA]
        for number, (segments, width, pad, counting) in enumerate(rows[start : start + BATCH_ROWS]):
            ends = np.cumsum([0, *(n for _, _, n, _ in segments)]).tolist()
            used = ends[-1] * width
            positions = b"".join(counting[: n * width] for _, _, n, _ in segments)
            values = (
                shard,
                first + start + number,
                ends[-1],
                [k for k, _, _, _ in segments],
                [p for _, p, _, _ in segments],
                ends,
                b"".join(ids for _, _, _, ids in segments) + pad[used:],
                positions + bytes(len(pad) - used),
            )
            for column, value in zip(columns, values, strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA
        )
