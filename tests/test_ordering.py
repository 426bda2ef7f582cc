"""Order-dependent operators against straightforward references."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from vocalis.operators import ordering as O


def test_bounded_sample_hot_key(spark):
    df = spark.range(0, 5000).select(F.when(F.col("id") < 4000, F.lit("hot")).otherwise(
        (F.col("id") % 7).cast("string")).alias("user"), F.col("id").alias("seq"))
    s = O.bounded_sample(df, "user", 100, ["seq"], seed=1)
    counts = {r.user: r["count"] for r in s.groupBy("user").count().collect()}
    assert counts["hot"] == 100 and all(v <= 100 for v in counts.values())
    o = O.sample_order(["seq"], 1)
    ref = df.withColumn("_o", o).withColumn("rn", F.row_number().over(Window.partitionBy("user").orderBy("_o", "seq"))) \
        .filter("rn <= 100").select("user", "seq")
    assert sorted(s.collect()) == sorted(ref.collect())


def test_global_row_number(spark):
    df = spark.range(0, 3000).select((F.col("id") % 3).alias("k"), ((F.col("id") * 7919) % 10007).alias("o"))
    got = O.global_row_number(df, "k", "o", buckets=9)
    ref = df.withColumn("rn2", F.row_number().over(Window.partitionBy("k").orderBy("o")))
    j = got.join(ref, ["k", "o"])
    assert j.filter(F.col("rn") != F.col("rn2")).count() == 0 and j.count() == 3000


def test_reassemble_two_levels(spark):
    rows = [(1, i, f" w{i} " if i % 4 else "") for i in range(50)] + [(2, 0, "")]
    df = spark.createDataFrame(rows, "file_id long, chunk_index long, text string")
    got = {r.file_id: r for r in O.reassemble(df, bucket=3).collect()}
    assert got[1].transcript == " ".join(f"w{i}" for i in range(50) if i % 4)
    assert got[1].n_chunks == 50 and got[2].transcript == ""


def brute_rate(events, limit, window):
    out, kept = {}, {}
    for c, t, rid in sorted(events, key=lambda e: (e[0], e[1], e[2])):
        k = [x for x in kept.get(c, []) if t - x < window]
        if len(k) >= limit:
            out[rid] = (False, max(0, window - (t - k[0])))
        else:
            k.append(t)
            out[rid] = (True, 0)
        kept[c] = k
    return out


def test_rate_limit_matches_brute_force(spark):
    import random
    rng = random.Random(5)
    ev = [(rng.randrange(4), rng.randrange(0, 600) * 1_000_000, i) for i in range(400)]
    df = spark.createDataFrame(ev, "client_id long, t long, request_id long") \
        .withColumn("ts", F.timestamp_micros("t"))
    got = {r.request_id: (r.allowed, r.wait_us) for r in O.rate_limit(df, limit=3, window_us=60_000_000).collect()}
    assert got == brute_rate(ev, 3, 60_000_000)


def test_chunk_plan(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 15.0), (3, 15.5), (4, 44.99)], "id long, duration_s double")
    rows = O.chunk_plan(df).orderBy("id", "chunk_index").collect()
    assert [(r.id, r.chunk_index) for r in rows] == [(1, 0), (2, 0), (3, 0), (3, 1), (4, 0), (4, 1), (4, 2)]
    last = rows[-1]
    assert last.start_sample == 480000 and last.end_sample == int(44.99 * 16000)


def test_rate_limit_hot_client_segments(spark):
    """One client holds most requests; buckets smaller than the window force
    the segment start to be carried across buckets.  Still exact."""
    import random
    rng = random.Random(9)
    ev, t = [], 0
    for i in range(3000):
        t += rng.choice([1, 2, 5, 20, 70, 200]) * 1_000_000
        ev.append((0 if i % 10 else 1 + i % 3, t, i))
    df = spark.createDataFrame(ev, "client_id long, t long, request_id long").withColumn("ts", F.timestamp_micros("t"))
    want = brute_rate(ev, 3, 60_000_000)
    for bucket, rows in ((30_000_000, 4), (3_600_000_000, 50_000), (3_600_000_000, 7), (1 << 50, 100)):
        got = {r.request_id: (r.allowed, r.wait_us)
               for r in O.rate_limit(df, limit=3, window_us=60_000_000, bucket_us=bucket, bucket_rows=rows).collect()}
        assert got == want


def test_rate_limit_of_one_long_burst(spark):
    """A million requests of one client without an idle gap, equal to the plain fold; no bucket is much over its bound."""
    from vocalis.operators import bursts as B
    n, limit, window = 1_000_000, 7, 5_000_000
    df = spark.range(n).select(F.lit(1).cast("long").alias("client_id"), F.col("id").alias("request_id"), (
        F.lit(1_704_067_200_000_000) + F.col("id") * 9_000 + F.pmod(F.xxhash64("id"), F.lit(50_000))).alias("ts_us"))
    sizes = B.with_buckets(df, 3_600_000_000, 20_000).groupBy("_slot", "_part").count().agg(F.max("count"), F.count(F.lit(1))).first()
    assert sizes[0] < 22_000 and sizes[1] >= 50
    out = O.rate_limit(df.withColumn("ts", F.timestamp_micros("ts_us")), limit=limit, window_us=window, bucket_rows=20_000)
    got = sorted((r.ts_us, r.request_id) for r in out.where("allowed").collect())
    rows = sorted((r.ts_us, r.request_id) for r in df.select("ts_us", "request_id").toLocalIterator())
    want, kept = [], []
    for t, i in rows:
        kept = [k for k in kept if t - k < window]
        if len(kept) < limit:
            kept.append(t)
            want.append((t, i))
    assert got == want and out.count() == n


def test_rate_limit_ties_and_empty(spark):
    same = spark.range(5000).select(F.lit(1).alias("client_id"), F.col("id").alias("request_id"), F.timestamp_seconds(F.lit(0)).alias("ts"))
    out = O.rate_limit(same, limit=3, window_us=60_000_000, bucket_rows=10).where("allowed").collect()
    assert sorted(r.request_id for r in out) == [0, 1, 2]
    assert O.rate_limit(same.limit(0)).count() == 0


def test_global_row_number_on_timestamps(spark):
    df = spark.range(0, 2000).select((F.col("id") % 2).alias("k"),
                                     F.timestamp_seconds(F.col("id") * 7919 % 10007 * 86_400).alias("o"))
    got = O.global_row_number(df, "k", "o", buckets=7)
    ref = df.withColumn("rn2", F.row_number().over(Window.partitionBy("k").orderBy("o")))
    assert got.join(ref, ["k", "o"]).filter("rn = rn2").count() == 2000


def test_admit_matches_the_plain_rule():
    import random

    import numpy as np

    from vocalis.operators.admission import admit
    rng = random.Random(2)
    for _ in range(300):
        limit, window = rng.randint(1, 4), rng.randint(1, 30)
        ts = sorted(rng.randrange(80) for _ in range(rng.randint(0, 40)))
        want = brute_rate([(0, t, i) for i, t in enumerate(ts)], limit, window)
        cut, recent, got = rng.randint(0, len(ts)), [], []
        for part in (ts[:cut], ts[cut:]):
            a, w = admit(np.array(part, dtype=np.int64), limit, window, recent)
            got += list(zip(a.tolist(), w.tolist()))
        assert got == [want[i] for i in range(len(ts))]
