"""Keyed upsert as DataFrame operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def last_write_wins(
    batch: DataFrame, pk: Sequence[str], measures: Sequence[str], seq: Column | str
) -> DataFrame:
    """One row per key: the measures of the row that came last in ``seq`` order.

    An aggregate, so a key that holds most of the batch is reduced before the shuffle.  A
    later NULL wins over an earlier value too.
    """
    order = F.col(seq) if isinstance(seq, str) else seq
    return batch.groupBy(*pk).agg(*[F.max_by(m, order).alias(m) for m in measures])


def upsert(
    target: DataFrame,
    batch: DataFrame,
    pk: Sequence[str],
    measures: Sequence[str],
    seq: Column | str,
) -> DataFrame:
    """The target after inserting the batch, keys present already taking the new measures.

    The same for a batch of any size: its last row per key, and the rows of the target whose key it does
    not hold.  AQE broadcasts the batch's keys if it measures them small, and shuffles otherwise.
    A key that is several times in the target becomes one row if the batch holds it; others stay
    as they are, also those with a NULL.  A batch row with a NULL in its key raises.
    """
    latest = last_write_wins(batch, pk, measures, seq)
    refused = F.raise_error(F.lit(f"NULL in the key {list(pk)} of a batch"))
    latest = latest.withColumns(
        {c: F.when(F.col(c).isNull(), refused).otherwise(F.col(c)) for c in pk}
    )
    kept = target.join(latest.select(*pk), list(pk), "left_anti")
    return kept.select(*pk, *measures).unionByName(latest)


def merge_by_arrival(
    target: DataFrame,
    batch: DataFrame,
    pk: Sequence[str],
    measures: Sequence[str],
    seq: Column | str,
    arrived: str = "arrived",
) -> DataFrame:
    """The target after a batch, each key with the measures that arrived last, in whichever of the two.

    Both sides have ``arrived``, the time at which a row's source arrived, and so has the result; a NULL is
    the earliest time.  Rows that arrived at the same time go to the batch, and within it to the last in
    ``seq`` order.  One aggregate over both sides, reduced before the shuffle: batches merged in any
    order give the same rows, and a batch merged again changes nothing.
    """
    order = F.col(seq) if isinstance(seq, str) else seq
    new = batch.select(*pk, *measures, arrived, order.alias("_seq"), F.lit(1).alias("_side"))
    kind = new.schema["_seq"].dataType
    old = target.select(
        *pk, *measures, arrived, F.lit(None).cast(kind).alias("_seq"), F.lit(0).alias("_side")
    )
    latest = F.max_by(F.struct(*measures, arrived), F.struct(arrived, "_side", "_seq"))
    merged = old.unionByName(new).groupBy(*pk).agg(latest.alias("_last"))
    return merged.select(*pk, "_last.*")
