"""Stream sources and sinks.

The engine takes any streaming frame with the Kafka column shape
(``key`` binary, ``value`` binary, ``timestamp``).  With the Kafka
connector on the classpath ``audio_stream(format="kafka")`` subscribes;
otherwise a Parquet folder with the same columns stands in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

MESSAGE_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("timestamp", T.TimestampType()),
])


#: Messages of a landed file; a trigger of n messages takes n // LANDED_MESSAGES files.
LANDED_MESSAGES = 50
#: Folders a landed folder is split into, like the partitions of a topic; each is drained by a query of its own.
LANES = 8


def lane(lanes: int) -> Column:
    """The lane of all messages that one task lands."""
    return F.pmod(F.spark_partition_id(), F.lit(lanes))


def land_messages(messages: DataFrame, path: str, per_file: int = LANDED_MESSAGES,
                  by: str | Sequence[str] | None = None) -> None:
    """Append messages to a folder for ``audio_stream``, at most ``per_file`` in a file.

    Spark's file source counts its offsets in files.  Cutting what arrives into small files (whatever the size of the
    files it came in) makes a file the unit that the stream's offset limit needs; ``by`` keeps columns as folders.
    """
    w = messages.write.mode("append").option("maxRecordsPerFile", per_file)
    (w.partitionBy(by) if by else w).parquet(path)


def landed_stream(spark: SparkSession, path: str, max_messages: int = LANDED_MESSAGES, per_file: int = LANDED_MESSAGES,
                  schema: T.StructType = MESSAGE_SCHEMA) -> DataFrame:
    """A landed folder as a stream of at most ``max_messages`` messages a micro-batch; a restart goes on after the
    last committed file."""
    if max_messages < per_file:
        raise ValueError(f"a micro-batch takes at least one file of {per_file} messages")
    return audio_stream(spark, path, max_per_trigger=max_messages // per_file, schema=schema)


def audio_stream(spark: SparkSession, path: str | None = None, fmt: str = "parquet",
                 max_per_trigger: int | None = 50, schema: T.StructType = MESSAGE_SCHEMA,
                 **options: str) -> DataFrame:
    """Audio messages as an unbounded table.

    ``fmt="kafka"``: pass ``kafka.bootstrap.servers`` / ``subscribe`` in
    ``options``; starts at the earliest offsets, ``max_per_trigger``
    offsets per micro-batch.  File formats: ``max_per_trigger`` files per
    micro-batch.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("startingOffsets", options.pop("startingOffsets", "earliest"))
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    else:
        reader = reader.schema(schema)
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path) if path else reader.load()


def start_sink(df: DataFrame, out: str | None, checkpoint: str, trigger: str | None = "5 seconds",
               available_now: bool = False, fmt: str = "parquet", mode: str = "append",
               name: str | None = None, **options: str) -> StreamingQuery:
    """Start a checkpointed sink.

    ``trigger`` is a processing-time interval (the reference's 5 s);
    ``available_now`` drains what is there in rate-limited batches and
    stops.  ``fmt="console"`` previews (O5: ``numRows``/``truncate`` in
    ``options``).
    """
    w = df.writeStream.outputMode(mode).format(fmt).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    for k, v in options.items():
        w = w.option(k, v)
    w = w.trigger(availableNow=True) if available_now else (w.trigger(processingTime=trigger) if trigger else w)
    return w.start(out) if out and fmt not in ("console", "memory") else w.start()


def start_numbered_sink(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Drain in rate-limited micro-batches, each written with its ``batch_id``; a repeated batch replaces itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch_id={batch_id}")

    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def preview(df: DataFrame, n: int = 20, truncate: bool = True) -> None:
    """Console preview of a batch frame (20 rows, like the reports)."""
    df.show(n, truncate=truncate)


def preview_rows(df: DataFrame, n: int = 20) -> DataFrame:
    """O5 as a frame: the rows ``preview`` would print (a limit on an
    ordered frame plans as TakeOrderedAndProject)."""
    return df.limit(n)


def drain(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for an ``availableNow`` query to finish and surface its error."""
    if query.awaitTermination(timeout_s) is False:
        query.stop()
        raise TimeoutError(f"the query did not finish within {timeout_s} s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


def drain_all(queries: Sequence[StreamingQuery]) -> None:
    """Wait for ``availableNow`` queries that run side by side; the error of one stops the others."""
    try:
        for query in queries:
            drain(query)
    finally:
        for query in queries:
            query.stop()
