"""Picks up documents that landed since the last run and loads them.

The same load as :mod:`panelspark.plans.loads`, run once per scheduled call: the stream
remembers in its checkpoint which files it has seen, processes the new ones and stops.  The
upsert is idempotent, so a micro-batch that is repeated after a failure changes nothing.
The later file wins by its time, as in the batch load, within a call and between calls: stored rows
keep their arrival, so an older file that lands late does not replace a newer one.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelspark.schema import TableSpec
from panelspark.sources.store import upsert_table


def checkpoint_dir(spark: SparkSession, name: str, fallback: str | None = None) -> str:
    """Folder for a stream's progress below the shared one the session names in
    ``spark.checkpoint.dir``; ``fallback`` is used only where that is not set."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not shared:
        raise ValueError("set spark.checkpoint.dir or give a fallback folder")
    local = shared.startswith(("file:", "/"))
    if local and shared == fallback and not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError(f"{shared} is a folder of this machine; executors do not share it")
    return f"{shared}/{name}"


def load_new_documents(
    spark: SparkSession,
    landing: str,
    root: str,
    spec: TableSpec,
    to_rows: Callable[[DataFrame], DataFrame],
    *,
    fallback: str | None = None,
) -> None:
    """Loads the files that are new in ``landing``; ``to_rows`` decodes them as in the batch load."""
    documents = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .schema("value STRING")
        .load(landing)
        .select(
            F.col("_metadata.file_path").alias("document"),
            F.col("_metadata.file_modification_time").alias("arrived"),
            F.col("value").alias("body"),
        )
    )

    def load(batch: DataFrame, _: int) -> None:
        upsert_table(batch.sparkSession, root, spec, to_rows(batch), "seq", arrived="seq.arrived")

    # One progress folder per pair of landing folder and table.
    route = sha256(f"{landing}\n{root}".encode()).hexdigest()[:16]
    progress = checkpoint_dir(spark, f"load_{spec.name}_{route}", fallback)
    query = (
        documents.writeStream.foreachBatch(load)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
