"""A small table kept as numbered snapshots, which readers can use while it is updated.

Snapshot n lies in ``out/v=n`` and counts once Spark's commit marker is there.  A micro-batch writes the snapshot of
its own number from the last one before it, so a batch that runs again writes the same snapshot again, and a reader
always finds a complete one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Snapshots that stay: the newest, and earlier ones that a reader may still be reading.
KEPT = 3


def _folder(spark: SparkSession, out: str):
    """(file system, path) of ``out`` on whatever store it names."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(out)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def complete_versions(spark: SparkSession, out: str) -> list[int]:
    """Numbers of the snapshots that were written to their end, ascending."""
    fs, path = _folder(spark, out)
    if not fs.exists(path):
        return []
    jvm = spark.sparkContext._jvm
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    numbers = sorted(int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit())
    return [n for n in numbers if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{out.rstrip('/')}/v={n}/_SUCCESS"))]


def read_current(spark: SparkSession, out: str) -> DataFrame:
    """The newest complete snapshot."""
    versions = complete_versions(spark, out)
    if not versions:
        raise FileNotFoundError(f"no complete snapshot in {out}")
    return spark.read.parquet(f"{out.rstrip('/')}/v={versions[-1]}")


def merge_version(changed: DataFrame, out: str, number: int, keys: Sequence[str]) -> None:
    """Write snapshot ``number``: the rows of ``changed`` replace those of the same keys (nulls are equal)."""
    spark = changed.sparkSession
    before = [n for n in complete_versions(spark, out) if n < number]
    changed = changed.persist()
    try:
        table = changed
        if before:
            old = spark.read.parquet(f"{out.rstrip('/')}/v={before[-1]}")
            new_keys = changed.select(*[F.col(k).alias(f"_{k}") for k in keys])
            same = F.lit(True)
            for k in keys:
                same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
            table = old.join(new_keys, same, "left_anti").unionByName(changed)
        table.write.mode("overwrite").parquet(f"{out.rstrip('/')}/v={number}")
    finally:
        changed.unpersist()
    fs, _ = _folder(spark, out)
    for n in [n for n in complete_versions(spark, out) if n <= number][:-KEPT]:
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out.rstrip('/')}/v={n}"), True)
