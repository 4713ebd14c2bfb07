"""Mixing sources to target weights by systematic sampling.

The expected copies of the documents of a source are added up in a fixed order, one random offset
per source is added, and a document is emitted once per integer boundary that its interval crosses.
The order is by size, so the words taken stay within about one document of the target.

The running sum never needs a source in one task: it is built from sums per size class, sums per
part of a size class, and a window inside each part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import quoted, stored, without

#: Expected copies are whole multiples of 1 / UNIT, so sums are exact in any order.
UNIT_BITS = 24
UNIT = 1 << UNIT_BITS
#: Size classes: exact below CLASS_STEPS, then CLASS_STEPS to an octave.
CLASS_STEPS = 64
#: Hex digits of the part of a document within its size class (16 ** digits parts).
PART_DIGITS = 3


def source_targets(
    sized: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    size: str = "size",
    source: str = "source",
) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target``.

    Sources in code-point order, NULL last, weigh ``weights`` in turn and share ``share`` of all
    sizes; no target is above ``cap`` times its source's size, and the excess is reshared by weight.
    With a level t, the target is least(weight * t, cap * size): sources reach their cap in the order
    of cap * size / weight, so t follows from running sums in that order. If all caps together
    are below the total, every source is at its cap. A source without words has target 0.
    """
    per = sized.groupBy(F.col(source).alias("source")).agg(
        F.coalesce(F.sum(size), F.lit(0)).alias("source_size")
    )
    # Windows without a partition: one row per source, never per document.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"),
    )
    limits = per.select("source", "source_size", weight.alias("w")).withColumn(
        "limit", F.col("source_size") * F.lit(float(cap))
    )
    order = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = limits.select(
        "source",
        "source_size",
        "w",
        "limit",
        (F.sum("source_size").over(everything) * F.lit(float(share))).alias("total"),
        F.coalesce(F.sum("limit").over(before), F.lit(0.0)).alias("full"),
        F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("open_w"),
    ).withColumn("t", (F.col("total") - F.col("full")) / F.col("open_w"))
    # t falls from the first source that it leaves below its limit on, so the level is the largest.
    below = F.when(F.col("w") * F.col("t") < F.col("limit"), F.col("t"))
    return (
        level.withColumn("level", F.max(below).over(everything))
        .select(
            "source",
            "source_size",
            F.when(
                F.col("level").isNull() | (F.col("limit") <= F.col("w") * F.col("level")),
                F.col("limit"),
            )
            .otherwise(F.col("w") * F.col("level"))
            .alias("target"),
        )
    )


def hex_number(text: Column, digits: int) -> Column:
    """A number from the first hex digits of the MD5 of a text: the same in any engine."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def size_class(size: Column) -> Column:
    """A number that grows with the size: the size itself, then its leading bits."""
    octave = F.length(F.bin(F.greatest(size, F.lit(1)))) - 1
    shift = F.greatest(octave - (CLASS_STEPS.bit_length() - 1), F.lit(0)).cast("int")
    return shift * F.lit(CLASS_STEPS).cast("long") + F.call_function("shiftright", size, shift)


def systematic_copies(
    sized: DataFrame,
    targets: DataFrame,
    key: str = "doc_id",
    size: str = "size",
    source: str = "source",
    seed: str = "mix",
) -> DataFrame:
    """``sized`` with ``source_size``, ``target`` and ``copies``, how often a document is emitted.

    Documents of a source lie in the order of (size class, part by MD5 of the key, size, key);
    equal rows are interchangeable. With expected copies e = target / source_size (in whole units)
    and the sum p of those before, copies is floor(p + e + u) - floor(p + u) for the offset u of
    the source, a number from the MD5 of the seed and the source. Reruns agree.
    """
    rate = F.floor(F.try_divide(F.col("target"), F.col("source_size")) * UNIT).cast("long")
    rates = targets.select(
        F.col("source").alias("__source"),
        F.col("source_size").alias("__source_size"),
        F.col("target").alias("__target"),
        F.coalesce(rate, F.lit(0)).alias("__rate"),
    )
    name = F.coalesce(F.concat(F.lit("s:"), F.col(source)), F.lit("null"))
    rows = sized.select(
        "*",
        name.alias("__name"),
        size_class(F.col(size)).alias("__class"),
        hex_number(F.coalesce(F.col(key).cast("string"), F.lit("")), PART_DIGITS).alias("__part"),
    )
    rates = rates.select(
        "*",
        F.coalesce(F.concat(F.lit("s:"), F.col("__source")), F.lit("null")).alias("__name"),
    ).drop("__source")

    parts = rows.groupBy("__name", "__class", "__part").agg(F.count(F.lit(1)).alias("__n"))
    classes = parts.groupBy("__name", "__class").agg(F.sum("__n").alias("__n"))
    in_source = Window.partitionBy("__name").orderBy("__class")
    in_class = Window.partitionBy("__name", "__class").orderBy("__part")
    past = (Window.unboundedPreceding, -1)
    zero = F.lit(0)
    class_starts = classes.select(
        "__name",
        "__class",
        F.coalesce(F.sum("__n").over(in_source.rowsBetween(*past)), zero).alias("__class_start"),
    )
    part_starts = (
        parts.select(
            "__name",
            "__class",
            "__part",
            F.coalesce(F.sum("__n").over(in_class.rowsBetween(*past)), zero).alias("__part_start"),
        )
        .join(class_starts, ["__name", "__class"])
        .join(rates, "__name")
        .select(
            "__name",
            "__class",
            "__part",
            "__source_size",
            "__target",
            "__rate",
            ((F.col("__class_start") + F.col("__part_start")) * F.col("__rate")).alias("__start"),
        )
    )
    in_part = (
        Window.partitionBy("__name", "__class", "__part")
        .orderBy(F.col(size), F.col(key))
        .rowsBetween(*past)
    )
    joined = rows.join(part_starts, ["__name", "__class", "__part"])
    offset = (hex_number(F.concat(F.lit(f"{seed}|"), F.col("__name")), 6) * (UNIT // 16**6)).cast(
        "long"
    )
    below = F.col("__start") + F.coalesce(F.sum("__rate").over(in_part), zero) + offset
    kept = [F.col(quoted(c)) for c in sized.columns if c.lower() not in {"source_size", "target", "copies"}]
    return (
        joined.withColumn("__below", below)
        .select(
            *kept,
            F.col("__source_size").alias("source_size"),
            F.col("__target").alias("target"),
            (
                F.shiftright(F.col("__below") + F.col("__rate"), UNIT_BITS)
                - F.shiftright(F.col("__below"), UNIT_BITS)
            )
            .cast("int")
            .alias("copies"),
        )
    )


def mix(
    sized: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    key: str = "doc_id",
    size: str = "size",
    source: str = "source",
    seed: str = "mix",
) -> DataFrame:
    """``sized`` with ``source_size``, ``target``, ``copies`` and ``taken`` (copies times size).

    One row per input row; rows that the mix leaves out have 0 copies. NULL sources are a source of
    their own, NULL keys come first, documents without words take no words. ``sized`` is stored
    once, since it is read for the sums and for the rows. Output names replace input columns.
    """
    base = stored(without(sized, ["source_size", "target", "copies", "taken"]))
    targets = source_targets(base, weights, share, cap, size, source)
    return systematic_copies(base, targets, key, size, source, seed).withColumn(
        "taken", F.col("copies").cast("long") * F.col(size)
    )


def emitted(mixed: DataFrame) -> DataFrame:
    """The rows of the mix, each as often as it is emitted."""
    copies = F.explode(F.expr("sequence(1, copies)"))
    return mixed.where("copies > 0").withColumn("__copy", copies).drop("__copy")
