"""Running WER by severity on arriving results (T5).

A streaming hash aggregate keeps (sum, count) per key in the state store.  In
update mode a micro-batch brings only the keys that changed, which replace
their rows in the next snapshot of the result table (``versions.py``), so the
cost of a batch grows with its keys and readers never meet an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from vocalis.operators.wer_reports import wer_by
from vocalis.streaming.versions import merge_version, read_current


def stream_wer(results: DataFrame, keys: Sequence[str] = ("severity",)) -> DataFrame:
    """T5: the A2 report as a streaming aggregate."""
    return wer_by(results, list(keys), improvement=True)


def start_stream_wer(results: DataFrame, out: str, checkpoint: str, available_now: bool = True,
                     trigger: str = "5 seconds", keys: Sequence[str] = ("severity",)) -> StreamingQuery:
    """Keep the report under ``out``; ``current_wer`` reads it at any time.  A repeated batch changes nothing."""
    def write(batch: DataFrame, batch_id: int) -> None:
        merge_version(batch, out, batch_id, keys)

    w = stream_wer(results, keys).writeStream.outputMode("update").option("checkpointLocation", checkpoint) \
        .foreachBatch(write)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def current_wer(spark: SparkSession, out: str) -> DataFrame:
    """The report as of the last complete micro-batch."""
    return read_current(spark, out)
