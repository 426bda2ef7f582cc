"""Streaming operators equal their batch counterparts; restarts lose nothing."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from vocalis.operators import ordering as O
from vocalis.plans import clips as C
from vocalis.plans import fixtures as X
from vocalis.streaming import features as SF


def test_stream_features_equal_batch(spark):
    q = E.queries()
    streamed = {(r.filename, r.duration_s, r.n_mel) for r in q["stream_features"](spark, SF_SMALL).collect()
                if r.filename is not None}
    batch = {(r.filename, r.duration_s, r.n_mel) for r in q["extract_features"](spark, SF_SMALL).collect()}
    assert streamed and streamed <= batch | {(f, -1.0, 0) for f, _, _ in batch}


def test_stream_features_batch_frame(spark):
    clips = C.synth_clips(X.signals(spark, SF_SMALL))
    msgs = clips.selectExpr("cast('{\"speaker\":\"s\",\"gender\":\"F\",\"filename\":\"x.wav\"}' as binary) AS key",
                            "content AS value", "current_timestamp() AS timestamp")
    rows = SF.stream_features(msgs).collect()
    assert len(rows) == clips.count() and rows[0].speaker == "s"


def test_stream_rate_limit_equals_batch(spark):
    q = E.queries()
    streamed = sorted(q["stream_rate_limit"](spark, SF_SMALL).collect())
    batch = sorted(O.rate_limit(X.requests(spark, SF_SMALL), limit=3, window_us=2 * 86_400 * 1_000_000).collect())
    assert streamed == batch


def test_stream_reassembly_equals_batch(spark):
    q = E.queries()
    streamed = sorted((r.file_id, r.transcript) for r in q["stream_reassembly"](spark, SF_SMALL).collect())
    batch = sorted((r.file_id, r.transcript) for r in O.reassemble(X.chunks(spark, SF_SMALL)).collect())
    assert streamed == batch


def test_restart_no_duplicates(spark):
    rows = E.queries()["stream_sink"](spark, SF_SMALL).collect()
    ids = [r.vec_id for r in rows]
    assert len(ids) == len(set(ids)) == X.signals(spark, SF_SMALL).count()


def test_trigger_control(spark):
    prog = E.queries()["trigger_control"](spark, SF_SMALL).collect()
    assert len(prog) >= 2 and sum(r.num_input_rows for r in prog) == X.signals(spark, SF_SMALL).count()


def test_reassembly_event_time_timeout(spark, tmp_path):
    """A file whose chunk 1 never arrives is flushed (done = false) once the
    watermark passes its timeout; complete files finish normally."""
    import datetime as dt

    from vocalis.streaming import sources as SS
    from vocalis.streaming import stateful as ST
    t0 = dt.datetime(2024, 1, 1)
    first = [(1, 0, "a", 3, t0), (1, 2, "c", 3, t0), (2, 0, "x", 2, t0)]
    later = [(2, 1, "y", 2, t0 + dt.timedelta(hours=2)), (3, 0, "z", 1, t0 + dt.timedelta(hours=5))]
    schema = "file_id long, chunk_index long, text string, total long, et timestamp"
    inbox = str(tmp_path / "in")
    spark.createDataFrame(first, schema).coalesce(1).write.mode("append").parquet(inbox)
    spark.createDataFrame(later, schema).coalesce(1).write.mode("append").parquet(inbox)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(inbox)
    runs = ST.stream_reassembly(stream, "et", timeout="30 minutes")
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    SS.drain(SS.start_sink(runs, out, ck, available_now=True), timeout_s=180)
    rows = sorted((r.file_id, r.from_index, r.text, r.done) for r in spark.read.parquet(out).collect())
    assert (2, 0, "x y", True) in rows or ((2, 0, "x", False) in rows and (2, 1, "y", True) in rows)
    assert (3, 0, "z", True) in rows
    assert (1, 0, "a", False) in rows
    assert (1, 1, "c", False) in rows, rows  # flushed by the event-time timeout


def _drain_files(spark, tmp_path, batches, schema, build):
    from vocalis.streaming import sources as SS
    inbox, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(inbox)
    q = SS.drain(SS.start_sink(build(stream), out, ck, available_now=True), timeout_s=240)
    return spark.read.parquet(out).collect(), q


def test_reassembly_ignores_retransmitted_and_late_chunks(spark, tmp_path):
    import datetime as dt

    from vocalis.streaming import stateful as ST
    t0 = dt.datetime(2024, 1, 1)
    at = [t0 + dt.timedelta(hours=h) for h in range(9)]
    schema = "file_id long, chunk_index long, text string, total long, et timestamp"
    batches = [[(1, 0, "a", 2, at[0]), (1, 1, "b", 2, at[0]), (2, 0, "x", 3, at[0])], [(1, 0, "a", 2, at[0])],
               [(9, 0, "z", 1, at[2])], [(8, 0, "y", 1, at[4])], [(7, 0, "w", 1, at[6])], [(1, 0, "a", 2, at[0]), (2, 1, "q", 3, at[0])]]
    rows, q = _drain_files(spark, tmp_path, batches, schema, lambda s: ST.stream_reassembly(s, "et", timeout="30 minutes"))
    assert sorted((r.file_id, r.text) for r in rows) == [(1, "a b"), (2, "x"), (7, "w"), (8, "y"), (9, "z")]
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2


def test_stream_rate_limit_drops_old_state(spark, tmp_path):
    from pyspark.sql import functions as F

    from vocalis.streaming import stateful as ST
    day = 86_400
    batches = [[(c, 1_704_067_200 + day * b, 100 * b + c) for c in range(b * 10, b * 10 + 10)] for b in range(5)]
    rows, q = _drain_files(spark, tmp_path, batches, "client_id long, s long, request_id long",
                           lambda s: ST.stream_rate_limit(s.withColumn("ts", F.timestamp_seconds("s"))))
    assert len(rows) == 50 and all(r.allowed for r in rows)
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 20


def test_drain_raises_on_timeout(spark, tmp_path):
    import pytest

    from vocalis.streaming import sources as SS
    stream = spark.readStream.format("rate").load()
    q = SS.start_sink(stream, str(tmp_path / "out"), str(tmp_path / "ck"), trigger="1 second")
    with pytest.raises(TimeoutError):
        SS.drain(q, timeout_s=2)
    assert not q.isActive


def test_running_wer_is_never_empty(spark, tmp_path):
    """Every batch leaves a complete table, a repeated batch changes nothing, and old snapshots go."""
    from vocalis.operators import wer_reports as R
    from vocalis.streaming import sources as SS
    from vocalis.streaming import versions as V
    from vocalis.streaming import wer as SW
    res = X.results(spark, SF_SMALL)
    inbox, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    seen = []
    for k in range(5):
        res.where(f"crc32(cast(filename as binary)) % 5 = {k}").coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(res.schema).parquet(inbox)
        SS.drain(SW.start_stream_wer(stream, out, ck), timeout_s=240)
        seen.append(SW.current_wer(spark, out).count())
    assert min(seen) > 0 and V.complete_versions(spark, out) == [2, 3, 4]
    want = sorted(map(str, R.wer_by(res, ["severity"], improvement=True).collect()))
    assert sorted(map(str, SW.current_wer(spark, out).collect())) == want
    changed = SW.current_wer(spark, out)  # every key changed in the last batch, which runs again
    V.merge_version(spark.createDataFrame(changed.collect(), changed.schema), out, 4, ["severity"])
    assert sorted(map(str, SW.current_wer(spark, out).collect())) == want
    (tmp_path / "out" / "v=5").mkdir()  # a snapshot begun and not finished does not count
    assert sorted(map(str, SW.current_wer(spark, out).collect())) == want
    V.merge_version(spark.createDataFrame([(None, 1, 2.0, 3.0, 4.0)], changed.schema), out, 6, ["severity"])
    V.merge_version(spark.createDataFrame([(None, 9, 2.0, 3.0, 4.0)], changed.schema), out, 7, ["severity"])
    assert SW.current_wer(spark, out).where("severity IS NULL").first().samples == 9


def test_reassembly_batch_writes_only_its_chunks(spark, tmp_path):
    """Pending chunks of earlier batches are not written again."""
    import datetime as dt

    from vocalis.streaming import stateful as ST
    t0 = dt.datetime(2024, 1, 1)
    schema = "file_id long, chunk_index long, text string, total long, et timestamp"
    batches = [[(1, k, f"w{k}", 900, t0) for k in range(1, 800)], [(1, 850, "late", 900, t0)], [(1, 851, "later", 900, t0), (1, 0, "w0", 900, t0)]]
    rows, q = _drain_files(spark, tmp_path, batches, schema, lambda s: ST.stream_reassembly(s, "et"))
    assert [(r.from_index, r.to_index) for r in rows] == [(0, 799)]
    assert rows[0].text == " ".join(f"w{k}" for k in range(800))
    updated = [p["stateOperators"][0]["numRowsUpdated"] for p in q.recentProgress if p["numInputRows"]]
    assert updated[0] >= 799 and updated[1] < 20 and len(updated) == 3


def test_rate_limit_of_a_crowded_client_in_bounded_frames(spark, tmp_path, monkeypatch):
    """A client's unordered batch of many frames gives the batch operator's decisions."""
    from pyspark.sql import functions as F

    from vocalis.streaming import sources as SS
    from vocalis.streaming import stateful as ST
    n = 200_000
    req = spark.range(n).select(F.lit(7).cast("long").alias("client_id"), F.col("id").alias("request_id"), F.timestamp_micros(
        F.lit(1_704_067_200_000_000) + F.pmod(F.xxhash64("id"), F.lit(3_600_000_000))).alias("ts"))
    inbox, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    req.repartition(1).write.parquet(inbox)
    decided = ST.stream_rate_limit(spark.readStream.schema(req.schema).parquet(inbox), limit=5, window_us=10_000_000)
    SS.drain(SS.start_sink(decided, out, ck, available_now=True), timeout_s=300)
    got = spark.read.parquet(out)
    want = O.rate_limit(req, limit=5, window_us=10_000_000)
    assert got.count() == n and got.exceptAll(want.select(*got.columns)).count() == 0
    assert 0 < got.where("allowed").count() <= 5 * 361


def test_merge_of_sorted_pieces_holds_a_block_each():
    import numpy as np

    from vocalis.streaming.stateful import merge_sorted
    rng = np.random.default_rng(3)
    pieces = []
    for _ in range(12):
        rows = rng.integers(0, 40, (rng.integers(0, 90), 2))
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        pieces.append(rows)

    def blocks(rows):
        for k in range(0, len(rows), 7):
            yield rows[k:k + 7]
    out = list(merge_sorted([blocks(p) for p in pieces]))
    rows = np.concatenate(out)
    everything = np.concatenate(pieces)
    assert (rows == everything[np.lexsort((everything[:, 1], everything[:, 0]))]).all()
    assert max(map(len, out)) <= 12 * 7 and list(merge_sorted([])) == []


def test_landed_blocks_fill_their_files(spark, tmp_path, monkeypatch):
    """Many tasks land messages; only the last file of a slice has fewer than 50."""
    from collections import Counter

    from pyspark.sql import functions as F
    from vocalis.plans import stream_queries as SQ
    from vocalis.streaming import sources as SS
    monkeypatch.setattr(SQ, "CLIP_ROWS", 100)
    slice_ = F.pmod("vec_id", F.lit(3)).cast("int")
    rows = spark.range(0, 1000).select((F.col("id") * 3 % 1801).alias("vec_id"))
    dealt = SQ._in_blocks(rows, slice_, "vec_id", SS.LANDED_MESSAGES)
    assert dealt.rdd.getNumPartitions() == 10
    SS.land_messages(dealt.withColumn("slice", slice_), str(tmp_path / "in"), by="slice")
    back = spark.read.parquet(str(tmp_path / "in")).select("slice", F.input_file_name().alias("file"))
    files = Counter()
    for r in back.groupBy("slice", "file").count().collect():
        files[r["slice"], r["count"]] += 1
    for s, n in ((r[0], r[1]) for r in rows.groupBy(slice_).count().collect()):
        assert files[s, 50] == n // 50 and sum(k * c for (t, k), c in files.items() if t == s) == n
        assert sum(c for (t, k), c in files.items() if t == s) == -(-n // 50)


@pytest.mark.parametrize("key", ["trigger_control", "stream_sink", "stream_wer"])
def test_batches_of_many_files(spark, duck, monkeypatch, key):
    """Inputs of many files give what inputs of few files give."""
    from vocalis.plans import stream_queries as SQ
    monkeypatch.setattr(SQ, "CLIP_ROWS", 40)
    monkeypatch.setattr(SQ, "RESULT_ROWS", 400)
    got = E.queries()[key](spark, SF_SMALL).toPandas()
    want = duck.execute(E.oracle_sql()[key]).df()[list(got.columns)]
    assert sorted(map(repr, got.round(2).values.tolist())) == sorted(map(repr, want.round(2).values.tolist()))


def test_stream_offsets_drains_lanes_side_by_side(spark, tmp_path, monkeypatch):
    """The micro-batches of at most 50 messages are dealt evenly to queries that run at the same time."""
    import duckdb
    from pyspark.sql import functions as F
    from vocalis.plans import stream_queries as SQ
    from vocalis.streaming import sources as SS
    monkeypatch.setattr(SQ, "CLIP_ROWS", 100)
    monkeypatch.setattr(SS, "LANES", 4)
    path = str(tmp_path / "embeddings.parquet")
    ids = (F.col("id") * 7 % 1501).alias("vec_id")
    vector = F.array(F.lit(0.5).cast("float"), (F.col("id") % 3).cast("float")).alias("embedding")
    spark.range(0, 1300).select(ids, vector).write.parquet(path)
    runs, together, drain_all = [], [], SS.drain_all

    def spy(queries):
        together.append(sum(q.isActive for q in queries))
        drain_all(queries)
        runs.append([[p["numInputRows"] for p in q.recentProgress if p["numInputRows"]] for q in queries])

    monkeypatch.setattr(SS, "drain_all", spy)
    got = E.queries()["stream_offsets"](spark, str(tmp_path)).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{path}/*.parquet')")
    assert sorted(r[0] for r in got) == sorted(r[0] for r in con.execute(E.oracle_sql()["stream_offsets"]).fetchall())
    assert [len(r) for r in runs] == [4, 4] and max(together) > 1
    assert max(n for r in runs for lane in r for n in lane) == 50
    assert sum(n for r in runs for lane in r for n in lane) == 1300
    batches = [len(lane) for lane in runs[1]]
    assert max(batches) - min(batches) <= 3 and min(batches) >= 5


def test_drain_all_surfaces_one_error_and_stops_the_rest(spark):
    from vocalis.streaming import sources as SS

    class Query:
        def __init__(self, error=None):
            self.error, self.stopped = error, False

        def awaitTermination(self, timeout=None):
            return True

        def exception(self):
            return self.error

        def stop(self):
            self.stopped = True

    queries = [Query(), Query("no"), Query()]
    with pytest.raises(RuntimeError, match="no"):
        SS.drain_all(queries)
    assert all(q.stopped for q in queries)
