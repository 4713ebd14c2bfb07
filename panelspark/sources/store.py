"""The stored tables: Parquet directories per year, replaced as a whole, and a list of the
current ones.

``<root>/<table>/data/load=<id>/period_year=<y>/`` holds the rows of one year as one load
left them; it is written once and never changed.  ``<root>/<table>/current/n=<k>-<id>/`` is a
small JSON list saying which load is current for each year.  A load rewrites only the years
its batch touches and becomes visible when the next list is complete; if the job dies before, at
whatever step, readers still see the previous list and the load can be run again, since no name is
used twice.  One writer per table; ``prune`` deletes what no list needs any more.

Every stored row carries ``_arrived``, the time at which its source arrived, so loads in any order
leave the same table: an older source that is loaded late does not replace a newer one.  Rows that break a
rule reject their batch or go to ``<root>/<table>/rejected/load=<id>/``, as the caller asks.
"""

from __future__ import annotations

import re
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from panelspark.operators.upsert import merge_by_arrival
from panelspark.schema import TableSpec, broken_rule_names, narrow, normalise_codes, rule_counts

#: Column of the stored files that readers do not see.
ARRIVED = "_arrived"


class LoadRejected(ValueError):
    """A batch breaks the rules of its table; nothing was written."""


def _folder(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no folder."""
    system, there = _folder(spark, path)
    if not system.exists(there):
        return []
    return [status.getPath().getName() for status in system.listStatus(there)]


def _lists(spark: SparkSession, base: str) -> list[tuple[int, str]]:
    """The complete lists as (number, name), newest first.

    The writer marks a list it has finished; one it died over has no mark and is passed by.
    """
    numbered = []
    for name in _names(spark, f"{base}/current"):
        match = re.fullmatch(r"n=(\d+)(?:-\w+)?", name)
        if match:
            numbered.append((int(match[1]), name))
    newest_first = sorted(numbered, reverse=True)
    system, _ = _folder(spark, base)
    mark = lambda name: _folder(spark, f"{base}/current/{name}/_SUCCESS")[1]
    return [(n, name) for n, name in newest_first if system.exists(mark(name))]


def _listed(spark: SparkSession, base: str, name: str) -> dict[int, str]:
    """The load that holds each year, by one list."""
    rows = spark.read.schema("period_year INT, load STRING").json(f"{base}/current/{name}")
    return {r["period_year"]: r["load"] for r in rows.collect()}  # one row per calendar year


def _current(spark: SparkSession, base: str) -> tuple[int, dict[int, str]]:
    """Number of the newest list, and the load that holds each year."""
    for number, name in _lists(spark, base):
        return number, _listed(spark, base, name)
    return 0, {}


def prune(spark: SparkSession, root: str, spec: TableSpec, keep: int = 2) -> None:
    """Deletes the lists before the newest ``keep``, and all loads that no kept list names.

    For when no load is running; readers of the kept lists are not disturbed.
    """
    base = f"{root}/{spec.name}"
    kept = _lists(spark, base)[: max(keep, 1)]
    if not kept:
        return
    named = {load for _, name in kept for load in _listed(spark, base, name).values()}
    system, _ = _folder(spark, base)
    for name in _names(spark, f"{base}/current"):
        if name not in {n for _, n in kept}:
            system.delete(_folder(spark, f"{base}/current/{name}")[1], True)
    for folder in ("data", "staged"):
        for name in _names(spark, f"{base}/{folder}"):
            if name.removeprefix("load=") not in named:
                system.delete(_folder(spark, f"{base}/{folder}/{name}")[1], True)


def _read_years(
    spark: SparkSession, base: str, spec: TableSpec, loads: dict[int, str]
) -> DataFrame:
    """The rows of some years with their arrival; files of before it was kept have a NULL there."""
    schema = StructType([*spec.schema.fields, StructField(ARRIVED, TimestampType())])
    if not loads:
        return spark.createDataFrame([], schema)
    paths = [f"{base}/data/load={load}/period_year={year}" for year, load in sorted(loads.items())]
    return spark.read.schema(schema).parquet(*paths)


def read_table(
    spark: SparkSession, root: str, spec: TableSpec, years: tuple[int, int] | None = None
) -> DataFrame:
    """A stored table; ``years`` limits which directories are listed at all."""
    base = f"{root}/{spec.name}"
    _, loads = _current(spark, base)
    if years:
        loads = {y: load for y, load in loads.items() if years[0] <= y <= years[1]}
    return _read_years(spark, base, spec, loads).select(*spec.schema.names)


def read_rejected(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """The rows that loads have set aside: the table's columns, ``broken`` (rules) and the ``load``."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spec.schema)
    schema = f"{columns}, broken ARRAY<STRING>, load STRING"
    try:
        return spark.read.schema(schema).parquet(f"{root}/{spec.name}/rejected")
    except AnalysisException:  # no load has set rows aside
        return spark.createDataFrame([], schema)


def upsert_table(
    spark: SparkSession,
    root: str,
    spec: TableSpec,
    batch: DataFrame,
    seq: Column | str,
    *,
    arrived: Column | str | None = None,
    on_breach: str = "reject",
) -> int:
    """Upserts a batch into a stored table and returns the number of batch rows.

    ``arrived`` is the time at which a row's source arrived, by default the time of this call.  For a key, the
    row that arrived last stays, whichever load brought it; ``seq`` orders rows of the batch that share key
    and arrival.  Rows that break NOT NULL or a length reject the whole batch (``on_breach="reject"``)
    or are set aside with the rules they break (``"quarantine"``, see :func:`read_rejected`).
    """
    if on_breach not in ("reject", "quarantine"):
        raise ValueError(f"unknown on_breach {on_breach!r}")
    base, load = f"{root}/{spec.name}", uuid4().hex
    column = lambda c: F.col(c) if isinstance(c, str) else c
    time = F.current_timestamp() if arrived is None else column(arrived)
    ready = normalise_codes(batch.withColumns({"_seq": column(seq), ARRIVED: time}), spec)
    checked = narrow(ready, spec, "_seq", ARRIVED).withColumn("broken", broken_rule_names(spec))

    # The batch is evaluated once: documents are not decoded again for the merge.  What the load must know
    # of it is observed as it is written; the observation ends in the writing stage, so no row counts twice.
    seen = Observation(f"load_{load}")
    counted = checked.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.collect_set(F.when(F.size("broken") == 0, spec.period_year)).alias("years"),  # calendar years
        *rule_counts(spec).values(),
    )
    staged = f"{base}/staged/load={load}"
    flagged = counted.withColumn("accepted", F.size("broken") == 0)
    flagged.write.partitionBy("accepted").parquet(staged)
    try:
        facts = seen.get
        breaches = {rule: facts[rule] for rule in rule_counts(spec) if facts[rule]}
        if breaches and on_breach == "reject":
            raise LoadRejected(f"{spec.name}: {breaches}")
        if breaches:
            system, rejected = _folder(spark, f"{base}/rejected/load={load}")
            system.mkdirs(rejected.getParent())
            system.rename(_folder(spark, f"{staged}/accepted=false")[1], rejected)
        if facts["years"]:
            accepted = spark.read.schema(checked.schema).parquet(f"{staged}/accepted=true")
            _merge(spark, base, spec, accepted, set(facts["years"]), load)
        return facts["rows"]
    finally:
        system, there = _folder(spark, staged)
        system.delete(there, True)


def _merge(
    spark: SparkSession, base: str, spec: TableSpec, ready: DataFrame, touched: set[int], load: str
) -> None:
    number, loads = _current(spark, base)
    before = _read_years(spark, base, spec, {y: l for y, l in loads.items() if y in touched})
    merged = merge_by_arrival(before, ready, spec.key, [spec.measure], "_seq", ARRIVED)

    # Rebalance: files of even size per year, a year that holds most rows is split over tasks.
    (
        merged.withColumn("period_year", spec.period_year)
        .hint("rebalance", "period_year")
        .write.partitionBy("period_year")
        .parquet(f"{base}/data/load={load}")
    )
    listed = {**loads, **{year: load for year in touched}}
    (
        spark.createDataFrame(sorted(listed.items()), "period_year INT, load STRING")
        .coalesce(1)
        .write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
        .json(f"{base}/current/n={number + 1}-{load}")
    )
