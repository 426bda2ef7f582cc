"""Speaker profile documents (S10): JSON with an explicit schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vocalis.operators.kb import PROFILE_SCHEMA
from vocalis.session import scratch_path

#: Folders of a profile store; a speaker's document is in the one that its id hashes to.
BUCKETS = 64


def write_profiles(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON document per speaker (JSON lines, one file per task)."""
    df.write.mode(mode).json(path)


def read_profiles(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Read profile documents; ``multiline`` for pretty-printed one-per-file
    documents as the reference stores them."""
    return spark.read.schema(PROFILE_SCHEMA).option("multiLine", multiline).json(path)


def upsert_profiles(old: DataFrame, new: DataFrame, now: Column | None = None) -> DataFrame:
    """``old`` with the documents of ``new`` in place of those of the same speaker; their ``updated_at`` becomes the
    write time ``now``.

    A speaker's stored documents are one, the newest; of several new ones the newest is taken; of equally
    new ones the greatest as JSON, so the result does not depend on the order of rows.
    """
    columns = old.columns
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    ranked = both.select("speaker_id", "_new", F.struct(*columns).alias("p"),
                         F.struct("_new", "updated_at", F.to_json(F.struct(*columns)).alias("text")).alias("_rank"))
    best = ranked.groupBy("speaker_id").agg(F.max_by("p", "_rank").alias("p"), F.max("_new").alias("_new"))
    stamp = F.when(F.col("_new") == 1, F.current_timestamp() if now is None else now).otherwise(F.col("p.updated_at"))
    return best.select(*[(stamp if c == "updated_at" else F.col(f"p.{c}")).alias(c) for c in columns])


def _bucket(speaker: str | Column = "speaker_id") -> Column:
    return F.pmod(F.xxhash64(speaker), F.lit(BUCKETS)).cast("int")


_STORED = T.StructType([*PROFILE_SCHEMA.fields, T.StructField("bucket", T.IntegerType())])


def write_profile_store(df: DataFrame, path: str) -> None:
    """Profile documents as JSON lines in ``BUCKETS`` folders, one file each."""
    df.withColumn("bucket", _bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").json(path)


def read_profile_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_STORED).json(path).drop("bucket")


def upsert_profile_store(spark: SparkSession, path: str, new: DataFrame, now: Column | None = None) -> None:
    """Upsert documents into a store: only the folders of the speakers in ``new`` are read and written again.

    The new content of those folders is complete in the shared folder before any of them is replaced.
    """
    touched = [r[0] for r in new.select(_bucket()).distinct().collect()]  # BUCKETS at most
    if not touched:
        return
    old = spark.read.schema(_STORED).json(path).where(F.col("bucket").isin(touched)).drop("bucket")
    ready = scratch_path(spark, "profile-upsert")
    upsert_profiles(old, new.select(*old.columns), now).write.mode("overwrite").parquet(ready)
    spark.read.parquet(ready).withColumn("bucket", _bucket()).repartition("bucket").write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").json(path)
