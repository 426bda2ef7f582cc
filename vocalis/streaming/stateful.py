"""Keyed stateful stream operators (T3 reassembly, T4 rate limiting).

Both are ``transformWithStateInPandas`` processors: state lives in the checkpointed
state store, partitioned by key, and is read and written entry by entry, so a
micro-batch costs what it touches and not what is stored, and a restart
resumes where the last committed batch left it.  Event-time timers drop state once the
watermark has passed.  Processing-time timers are not used: they make Spark schedule an
empty batch after every batch, so an ``availableNow`` drain would never finish.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vocalis.operators.admission import admit
from vocalis.operators.relational import epoch_micros

# Fixed value: the state store that keeps state entry by entry.
_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _entrywise_state(spark: SparkSession) -> None:
    """Queries started from now on keep their state in the entry-wise store; a restarted one keeps its own."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _STORE)


# ------------------------------------------------------------------ T3
REASSEMBLY_OUTPUT = "file_id long, from_index long, to_index long, text string, done boolean, total long"


def _clean(t) -> str:
    return "" if t is None else str(t).strip()


class _Reassembly(StatefulProcessor):
    """State of a file: the next index, and an entry for each chunk that came ahead of it."""

    def __init__(self, timeout_ms: int):
        self._timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._head = handle.getValueState("head", "next_index long, total long, closed boolean, timer long")
        self._pending = handle.getMapState("pending", "chunk_index long", "text string")

    def _store(self, nxt: int, total: int | None, closed: bool, timer: int | None, now_ms: int) -> None:
        """Keep the head and let its one timer end a timeout from now."""
        due = now_ms + self._timeout_ms
        if due != timer:
            if timer is not None:
                self._handle.deleteTimer(timer)
            self._handle.registerTimer(due)
        self._head.update((nxt, total, closed, due))

    @staticmethod
    def _out(*row) -> pd.DataFrame:
        return pd.DataFrame([row], columns=["file_id", "from_index", "to_index", "text", "done", "total"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        file_id, watermark = int(key[0]), timerValues.getCurrentWatermarkInMs()
        known = self._head.exists()
        nxt, total, closed, timer = self._head.get() if known else (0, None, False, None)
        fresh: dict[int, str] = {}
        seen, last_ms = known, 0
        for pdf in rows:
            for idx, txt, tot, at in zip(pdf["chunk_index"], pdf["text"], pdf["total"], pdf["et_ms"]):
                if not known and at < watermark - self._timeout_ms:
                    continue  # older than any state kept: its file is over
                seen, last_ms = True, max(last_ms, int(at))
                if int(idx) >= nxt and not closed:
                    fresh[int(idx)] = _clean(txt)
                if tot is not None and not pd.isna(tot):
                    total = int(tot)
        if not seen:
            return
        start, parts = nxt, []
        while True:
            if nxt in fresh:
                parts.append(fresh.pop(nxt))
                if known and self._pending.containsKey((nxt,)):
                    self._pending.removeKey((nxt,))
            elif known and self._pending.containsKey((nxt,)):
                parts.append(self._pending.getValue((nxt,))[0])
                self._pending.removeKey((nxt,))
            else:
                break
            nxt += 1
        for idx, txt in fresh.items():
            self._pending.updateValue((idx,), (txt,))
        done = total is not None and nxt >= total
        self._store(nxt, total, closed or done, timer, max(watermark, last_ms))
        if nxt > start:
            yield self._out(file_id, start, nxt - 1, " ".join(p for p in parts if p), done, total)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self._head.exists():
            return
        nxt, total, closed, timer = self._head.get()
        if timer != expiredTimerInfo.getExpiryTimeInMs():
            return
        if closed:
            self._head.clear()
            self._pending.clear()
            return
        # give up on the gap; the closed file stays known for another timeout so late chunks are ignored
        pending = sorted((k[0], v[0]) for k, v in self._pending.iterator())
        self._pending.clear()
        self._store(nxt, total, True, None, timerValues.getCurrentWatermarkInMs())
        if pending:
            yield self._out(int(key[0]), nxt, pending[-1][0], " ".join(t for _, t in pending if t), False, total)


def stream_reassembly(chunks: DataFrame, event_time: str, key: str = "file_id", index: str = "chunk_index",
                      text: str = "text", total: str = "total", timeout: str = "10 minutes") -> DataFrame:
    """Buffer out-of-order chunks per file and emit each newly
    contiguous run (trimmed, empties dropped, space-joined) as soon as it is
    complete; ``done`` when the run reaches ``total``.  Joining a file's
    emitted runs in order gives the batch W1 transcript.

    The stream gets a watermark of ``timeout``.  A file that stops receiving
    chunks for that long is flushed (``done`` false).  Finished and flushed
    files stay known for another timeout, so a chunk sent again is not
    emitted again; chunks older than that are dropped.
    """
    _entrywise_state(chunks.sparkSession)
    c = chunks.select(F.col(key).cast("long").alias("file_id"), F.col(index).cast("long").alias("chunk_index"),
                      F.col(text).alias("text"), F.col(total).cast("long").alias("total"),
                      F.col(event_time).alias("et"), F.unix_millis(event_time).alias("et_ms"))
    return c.withWatermark("et", timeout).groupBy("file_id").transformWithStateInPandas(
        _Reassembly(_duration_ms(timeout)), REASSEMBLY_OUTPUT, "append", "EventTime")


# ------------------------------------------------------------------ T4
RATE_OUTPUT = "client_id long, request_id long, ts_us long, allowed boolean, wait_us long"
#: Requests of one entry of a client's spool.
SPOOL_ROWS = 1024


def merge_sorted(pieces: list[Iterator[np.ndarray]]) -> Iterator[np.ndarray]:
    """Blocks of (ts, request_id) rows in order, from pieces that each give their blocks in order; a block of each
    piece is held."""
    held: list[np.ndarray | None] = [next(p, None) for p in pieces]
    while any(h is not None for h in held):
        ts, rid = min((int(h[-1, 0]), int(h[-1, 1])) for h in held if h is not None)
        out = []
        for k, block in enumerate(held):
            if block is None:
                continue
            n = int(((block[:, 0] < ts) | ((block[:, 0] == ts) & (block[:, 1] <= rid))).sum())
            if n:
                out.append(block[:n])
            held[k] = block[n:] if n < len(block) else next(pieces[k], None)
        rows = np.concatenate(out)
        yield rows[np.lexsort((rows[:, 1], rows[:, 0]))]


class _RateLimit(StatefulProcessor):
    """State of a client: its last admitted times.  A micro-batch of more than one frame is sorted through the state
    store, so that only a block of each frame is held in memory."""

    def __init__(self, limit: int, window_us: int):
        self._limit, self._window_us = limit, window_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._kept = handle.getValueState("kept", "kept array<long>, timer long")
        self._spool = handle.getMapState("spool", "piece int, block int", "requests binary")

    def _blocks(self, piece: int, n: int) -> Iterator[np.ndarray]:
        for block in range(n):
            data = self._spool.getValue((piece, block))[0]
            self._spool.removeKey((piece, block))
            yield np.frombuffer(data, dtype="<i8").reshape(-1, 2)

    def _in_order(self, rows: Iterator[pd.DataFrame]) -> Iterator[np.ndarray]:
        first = None
        sizes: list[int] = []
        for pdf in rows:
            piece = pdf[["ts_us", "request_id"]].to_numpy(dtype="<i8")
            piece = piece[np.lexsort((piece[:, 1], piece[:, 0]))]
            if first is None and not sizes:
                first = piece
                continue
            for one in ([first, piece] if first is not None else [piece]):
                cuts = range(0, len(one), SPOOL_ROWS)
                for block, at in enumerate(cuts):
                    self._spool.updateValue((len(sizes), block), (np.ascontiguousarray(one[at:at + SPOOL_ROWS]).tobytes(),))
                sizes.append(len(cuts))
            first = None
        if first is not None:
            yield first
        else:
            yield from merge_sorted([self._blocks(k, n) for k, n in enumerate(sizes)])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = self._kept.get() if self._kept.exists() else None
        kept, timer, last = list(state[0]) if state else [], state[1] if state else None, 0
        for part in self._in_order(rows):
            ts = part[:, 0]
            allowed, wait = admit(ts, self._limit, self._window_us, kept)
            last = max(last, int(ts[-1]))
            yield pd.DataFrame({"client_id": int(key[0]), "request_id": part[:, 1], "ts_us": ts, "allowed": allowed, "wait_us": wait})
        # nothing admitted counts any more once the watermark is a window past the last request
        due = max((last + self._window_us) // 1000 + 1, timerValues.getCurrentWatermarkInMs() + 1)
        if due != timer:
            if timer is not None:
                self._handle.deleteTimer(timer)
            self._handle.registerTimer(due)
        self._kept.update((kept, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self._kept.exists() and self._kept.get()[1] == expiredTimerInfo.getExpiryTimeInMs():
            self._kept.clear()
        return iter(())


def stream_rate_limit(events: DataFrame, key: str = "client_id", ts: str = "ts", tie: str = "request_id",
                      limit: int = 3, window_us: int = 60_000_000, lateness: str = "10 minutes") -> DataFrame:
    """T4: the W4 limiter on a stream keyed by client.  Each micro-batch's
    requests of a client are decided in (time, tie) order against the
    admitted timestamps kept in state (at most ``limit`` per client, dropped
    one window after the client's last request).  Requests of a client are
    expected in time order across batches; one that comes late is decided in
    arrival order, one later than ``lateness`` is dropped by the watermark."""
    _entrywise_state(events.sparkSession)
    e = events.select(F.col(key).cast("long").alias("client_id"), F.col(tie).cast("long").alias("request_id"),
                      epoch_micros(events, ts).alias("ts_us")).withColumn("et", F.timestamp_micros("ts_us"))
    return e.withWatermark("et", lateness).groupBy("client_id").transformWithStateInPandas(
        _RateLimit(limit, window_us), RATE_OUTPUT, "append", "EventTime")


def _duration_ms(text: str) -> int:
    n, unit = text.split()
    scale = {"second": 1_000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}
    return int(float(n) * scale[unit.rstrip("s")])
