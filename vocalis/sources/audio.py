"""Audio file sources and sinks."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_audio(spark: SparkSession, root: str, pattern: str = "*.wav") -> DataFrame:
    """Recursive ``*.wav`` discovery -> (path, length, content).

    Listing and reading happen on the executors (``binaryFile``); nothing
    is collected on the driver.  An empty folder gives an empty frame; the
    caller decides whether to warn and stop.
    """
    df = (spark.read.format("binaryFile")
          .option("pathGlobFilter", pattern)
          .option("recursiveFileLookup", "true")
          .load(root))
    return df.select(F.regexp_replace("path", "^file:", "").alias("path"), "length", "content")


def write_features(features: DataFrame, path: str, mode: str = "status") -> None:
    """Keep successes, drop ``status``, overwrite Parquet."""
    ok = (F.col("status") == "ok") if mode == "status" else (F.col("duration_s") > 0)
    features.filter(ok).drop("status").write.mode("overwrite").parquet(path)


def _writer(root: str):
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            sizes = []
            for rel, blob in zip(pdf["rel_path"], pdf["content"]):
                target = os.path.join(root, rel)
                os.makedirs(os.path.dirname(target), exist_ok=True)
                tmp = f"{target}.part-{os.getpid()}"
                with open(tmp, "wb") as fh:
                    fh.write(bytes(blob))
                os.replace(tmp, target)  # idempotent under task retries
                sizes.append(len(blob))
            yield pd.DataFrame({"rel_path": pdf["rel_path"], "bytes": sizes})
    return run


def write_binary_files(df: DataFrame, root: str) -> DataFrame:
    """Write each row's ``content`` to ``root/rel_path`` from the executors.

    Needs ``root`` to be a POSIX path every executor mounts (the shared
    checkpoint folder on NFS/FUSE).  Returns (rel_path, bytes); the write
    happens when that frame is evaluated.
    """
    root = root[len("file:"):] if root.startswith("file:") else root
    return df.select("rel_path", "content").mapInPandas(_writer(root), "rel_path string, bytes long")
