"""Small relational helpers shared by the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def order_by(df: DataFrame, *cols: Column | str) -> DataFrame:
    """O1: global sort (range-partitioned shuffle, then per-partition sort)."""
    return df.orderBy(*cols)


def successes(df: DataFrame, mode: str = "status") -> DataFrame:
    """Keep successful feature rows.

    ``mode="status"`` keeps ``status = 'ok'`` (augmentation job);
    ``mode="duration"`` keeps ``duration_s > 0`` (plain feature job).
    """
    if mode == "status":
        return df.filter(F.col("status") == "ok")
    return df.filter(F.col("duration_s") > 0)


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """P5: projection without the given columns (pruned from the scan)."""
    return df.drop(*names)


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Round-robin ``df`` over ``partitions`` tasks for a CPU-heavy per-row stage; None leaves it as it is."""
    return df.repartition(partitions) if partitions else df


def first_rows(df: DataFrame, keys: Sequence[str], order: str, largest: bool = False) -> DataFrame:
    """The rows with the smallest (largest) ``order`` value per key.

    A hash aggregate finds the value and an equi-join (null-safe on the keys)
    fetches the rows; ``min_by`` of a struct would sort the whole input.
    """
    best = df.groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]).agg(
        (F.max(order) if largest else F.min(order)).alias("_best"))
    same = F.col(order) == F.col("_best")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    return df.join(best, same).drop("_best", *[f"_key{i}" for i in range(len(keys))])


_EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def epoch_micros(df: DataFrame, col: str) -> Column:
    """Microseconds since the epoch, independent of the session time zone:
    a TIMESTAMP_NTZ (wall clock, as the driver tables store it) is read as
    UTC; a TIMESTAMP is an instant already."""
    from pyspark.sql.types import TimestampNTZType
    if isinstance(df.schema[col].dataType, TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, `{col}`)")
    return F.unix_micros(F.col(col).cast("timestamp"))
