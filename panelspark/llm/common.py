"""Shared by the corpus operators: intermediate tables, clashing columns, sampling by hash."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word rules: blank and the control characters 9 to 13.
SPACE_CLASS = r"\x20\x09-\x0D"


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    A session on one machine without that setting (tests) gets a folder of its own; a cluster must
    set it, because a local folder of the driver is out of the executors' reach.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _own_folder()


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="panelspark-")


def ship_package(spark: SparkSession) -> None:
    """Gives executors this package where they cannot import it anyway, once per Spark context.

    Jobs are submitted with the package installed, on ``PYTHONPATH`` or by ``--py-files``. A session
    started from another folder gets it as a zip of its sources.
    """
    root = Path(__file__).resolve().parents[2]
    places = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if any(p and Path(p).resolve() == root for p in places):
        return
    context = spark.sparkContext
    if any(str(f).endswith("panelspark-sources.zip") for f in context.listFiles):
        return
    archive = Path(tempfile.mkdtemp(prefix="panelspark-")) / "panelspark-sources.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for source in (root / "panelspark").rglob("*.py"):
            file.write(source, source.relative_to(root))
    context.addPyFile(str(archive))


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back.

    Cuts the lineage in a way that survives the loss of executors. The files go when the driver's
    file system closes.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/panelspark-{uuid.uuid4().hex}"
    df.write.parquet(path)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return spark.read.schema(df.schema).parquet(path)


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without columns that the operator is about to add, whatever their case.

    An input column of the same name as an output column is replaced by it.
    """
    taken = {name.lower() for name in names}
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in taken])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def hash_unit(key: Column) -> Column:
    """A number from 0 to below 1 that depends on the key alone, for samples that reruns repeat."""
    return F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 30)) / F.lit(float(1 << 30))


def word_count(text: Column) -> Column:
    """The number of runs without white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE_CLASS}]+")), F.lit(0)).cast("long")
