"""Deciding a rate-limited client's requests bucket by bucket.

Whether a request is admitted depends on every admission of the client before it, but only through the last ``limit``
admitted times.  So the work is split in two.  A chain walks over each uninterrupted run of a client's buckets, but it sees of
a bucket only the sorted request times, eight bytes a request, and does one binary search per admission; it gives the
admitted times with which each bucket begins.  Then all buckets are decided in parallel from these, with the whole rows.
A bucket is a slice of time of at most about ``BUCKET_ROWS`` requests, so neither step holds more than that of a
client at once, however long the burst.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vocalis.operators.admission import admit
from vocalis.session import scratch_path

#: Requests of a bucket, about; slots of time with more are cut evenly.
BUCKET_ROWS = 50_000
#: Crowded slots are broadcast up to this many.
MAX_BROADCAST_SLOTS = 100_000

_BUCKET = ["client_id", "_slot", "_part"]


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_buckets(e: DataFrame, slot_us: int, rows: int) -> DataFrame:
    """``e`` (client_id, request_id, ts_us) with its bucket: a slot of time, cut into equal parts where it is crowded."""
    e = e.withColumn("_slot", F.floor(F.col("ts_us") / slot_us))
    crowded = _kept(e.groupBy("client_id", "_slot").agg(F.count(F.lit(1)).alias("n"), F.min("ts_us").alias("_first"), F.max("ts_us").alias("_last"))
                    .where(F.col("n") > rows).select(F.col("client_id").alias("_client"), F.col("_slot").alias("_crowded"),
                                                     F.ceil(F.col("n") / rows).alias("_parts"), "_first", "_last"), "rate-slots")
    n = crowded.count()
    if n == 0:
        return e.withColumn("_part", F.lit(0).cast("long"))
    joined = e.join(F.broadcast(crowded) if n <= MAX_BROADCAST_SLOTS else crowded,
                    F.col("client_id").eqNullSafe(F.col("_client")) & (F.col("_slot") == F.col("_crowded")), "left")
    part = F.floor((F.col("ts_us") - F.col("_first")) * F.col("_parts") / (F.col("_last") - F.col("_first") + 1))
    return joined.withColumn("_part", F.coalesce(part, F.lit(0)).cast("long")).drop("_client", "_crowded", "_parts", "_first", "_last")


def runs_of_buckets(times: DataFrame, window_us: int) -> DataFrame:
    """``times`` (bucket, times) with ``_run``: the first time of the buckets that follow each other without an idle gap of
    the window, after which nothing admitted before counts any more."""
    ends = times.select(*_BUCKET, F.col("times")[0].alias("first"), F.element_at("times", -1).alias("last"))
    order = Window.partitionBy("client_id").orderBy("_slot", "_part")
    before = F.lag("last").over(order)
    begins = F.when(before.isNull() | (F.col("first") - before >= window_us), F.col("first"))
    runs = ends.withColumn("_begins", begins).withColumn("_run", F.last("_begins", ignorenulls=True).over(order)) \
        .select(F.col("client_id").alias("_client"), F.col("_slot").alias("_s"), F.col("_part").alias("_p"), "_run")
    return times.join(runs, F.col("client_id").eqNullSafe(F.col("_client")) & (F.col("_slot") == F.col("_s")) & (F.col("_part") == F.col("_p"))) \
        .drop("_client", "_s", "_p")


def _chain(limit: int, window_us: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, recent = None, []
        for batch in batches:
            entries = []
            where = zip(batch.column("client_id").to_pylist(), batch.column("_run").to_pylist())
            for k, now in enumerate(where):
                if group is None or now != group:
                    group, recent = now, []
                entries.append(list(recent))
                ts = batch.column("times")[k].values.to_numpy()
                admit(ts, limit, window_us, recent)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in _BUCKET), pa.array(entries, pa.list_(pa.int64()))],
                                             names=[*_BUCKET, "_recent"])
    return run


def _decide(limit: int, window_us: int):
    """Rows come bucket by bucket, each begun by a row without a request that carries the admitted times."""
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        recent: list[int] = []
        for pdf in it:
            head = pdf["_head"].to_numpy()
            ts, ids, clients = (pdf[c].to_numpy() for c in ("ts_us", "request_id", "client_id"))
            allowed, wait = np.zeros(len(pdf), dtype=bool), np.zeros(len(pdf), dtype=np.int64)
            starts = [0, *np.flatnonzero(head).tolist(), len(pdf)]
            for i, j in zip(starts, starts[1:]):
                if i < j and head[i]:
                    recent, i = [int(t) for t in pdf["_recent"].iloc[i]], i + 1
                if i < j:
                    allowed[i:j], wait[i:j] = admit(ts[i:j], limit, window_us, recent)
            real = ~head
            yield pd.DataFrame({"client_id": clients[real], "request_id": ids[real], "ts_us": ts[real], "allowed": allowed[real],
                                "wait_us": wait[real]})
    return run


def decide_buckets(e: DataFrame, limit: int, window_us: int, slot_us: int, schema: str, partitions: int | None = None,
                   rows: int | None = None) -> DataFrame:
    """The decisions on ``e`` (client_id, request_id, ts_us, none of them null).

    Where no client has more requests than a bucket, each client is one.
    """
    rows = rows or BUCKET_ROWS
    busiest = e.groupBy("client_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
    if busiest <= rows:
        e = e.withColumn("_slot", F.lit(0).cast("long")).withColumn("_part", F.lit(0).cast("long"))
        begin = e.select(*_BUCKET).distinct().withColumn("_recent", F.array().cast("array<long>"))
        return _decided(e, begin, limit, window_us, schema, partitions)
    e = with_buckets(e, slot_us, rows)
    times = _kept(e.groupBy(*_BUCKET).agg(F.sort_array(F.collect_list("ts_us")).alias("times")), "rate-times")
    chained = runs_of_buckets(times, window_us)
    chained = (chained.repartition(partitions, "client_id", "_run") if partitions else chained.repartition("client_id", "_run")) \
        .sortWithinPartitions("client_id", "_run", "_slot", "_part") \
        .mapInArrow(_chain(limit, window_us), "client_id long, _slot long, _part long, _recent array<long>")
    return _decided(e, chained, limit, window_us, schema, partitions)


def _decided(e: DataFrame, begin: DataFrame, limit: int, window_us: int, schema: str, partitions: int | None) -> DataFrame:
    """All buckets of ``e``, each from the admitted times that ``begin`` (bucket, _recent) gives for it."""
    heads = begin.select("client_id", F.lit(0).cast("long").alias("request_id"), F.lit(0).cast("long").alias("ts_us"), "_slot", "_part",
                           "_recent", F.lit(True).alias("_head"))
    both = e.select("client_id", "request_id", "ts_us", "_slot", "_part", F.lit(None).cast("array<long>").alias("_recent"),
                    F.lit(False).alias("_head")).unionByName(heads)
    both = both.repartition(partitions, *_BUCKET) if partitions else both.repartition(*_BUCKET)
    return both.sortWithinPartitions(*_BUCKET, F.desc("_head"), "ts_us", "request_id").mapInPandas(_decide(limit, window_us), schema)
