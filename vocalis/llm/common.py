"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalis.session import ensure_checkpoint_dir, scratch_path, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ready(spark: SparkSession) -> None:
    """Shared scratch folder known, package importable in Python workers."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back (cuts lineage, survives lost executors)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it in ``fn`` any number of times."""
    return F.transform(F.array(value), fn)[0]


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def with_columns_from_text(df: DataFrame, make: Callable[[], Callable[[list[str | None]], list[pa.Array]]],
                           added: str) -> DataFrame:
    """``df`` without its column ``_text``, with columns computed from it in Arrow batches.

    ``make`` runs once per task and gives the function from a batch's texts to the arrays of ``added`` (a DDL
    schema).  The other columns pass through as they are.
    """
    names = [c for c in df.columns if c != "_text"]
    fields = ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)
    new = [f.split()[0] for f in added.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            arrays = fn(batch.column("_text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + arrays, names=names + new)

    return df.mapInArrow(run, f"{fields}, {added}" if fields else added)
