"""Order-dependent operators (W1-W4) and chunk planning.

None of these sorts a whole key group inside one task when the work can be
split: reassembly concatenates buckets of chunks in parallel first,
sampling keeps each task's top-k before the shuffle, and batch numbering adds per-bucket offsets to per-bucket row numbers.  The
rate limiter's sequential part walks over request times alone, in buckets, and
leaves the decisions to parallel tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vocalis.functions.text import strip_ws
from vocalis.operators.bursts import decide_buckets
from vocalis.operators.relational import epoch_micros


def _keys(key: Sequence[str] | str) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


# ------------------------------------------------------------------ W1
def reassemble(chunks: DataFrame, key: str = "file_id", index: str = "chunk_index", text: str = "text",
               bucket: int = 512) -> DataFrame:
    """Per file, chunk texts sorted by index, trimmed, empties (failed
    chunks) dropped, joined with one space.

    Two levels: runs of ``bucket`` consecutive chunks are joined in
    parallel, then the (few) run strings per file are joined in order, so a
    file with millions of chunks is not sorted inside one task.
    """
    c = chunks.select(key, F.col(index).alias("_i"), strip_ws(text).alias("_t"))
    runs = c.groupBy(key, F.floor(F.col("_i") / bucket).alias("_b")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.array_join(F.filter(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_t"))), lambda s: s["_t"]),
                              lambda t: t != ""), " ").alias("_part"))
    return runs.groupBy(key).agg(
        F.array_join(F.filter(F.transform(F.array_sort(F.collect_list(F.struct("_b", "_part"))), lambda s: s["_part"]),
                              lambda t: t != ""), " ").alias("transcript"),
        F.sum("_n").alias("n_chunks"))


# ------------------------------------------------------------------ W2
def sample_order(cols: Sequence[str], seed: int) -> Column:
    """Seeded pseudo-random order: md5 of seed and the row's id columns
    (the same string hash is available in SQL engines, so it is checkable)."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def bounded_sample(df: DataFrame, key: Sequence[str] | str, k: int, id_cols: Sequence[str],
                   seed: int = 42) -> DataFrame:
    """At most ``k`` rows per key, uniform without replacement (all rows
    when the key has ``k`` or fewer), reproducible for a seed.

    Spark keeps only each task's first ``k`` rows per key before the shuffle
    (``WindowGroupLimit``), so a hot key moves ``k`` rows per map task.
    """
    w = Window.partitionBy(*_keys(key)).orderBy("_o", *id_cols)
    return df.withColumn("_o", sample_order(id_cols, seed)).withColumn("_rn", F.row_number().over(w)) \
        .filter(F.col("_rn") <= k).drop("_o", "_rn")


# ------------------------------------------------------------------ W3
def _order_bounds(df: DataFrame, order: str, buckets: int) -> list:
    """Approximate quantiles that cut the order column into ``buckets`` parts (a few values, read on the driver)."""
    shares = [i / buckets for i in range(1, buckets)]
    found = df.agg(F.percentile_approx(order, shares, 10_000)).first()[0] if shares else None
    return sorted(set(found or []))


def global_row_number(df: DataFrame, key: Sequence[str] | str, order: str, buckets: int | None = None,
                      out: str = "rn") -> DataFrame:
    """1-based row number per key by a number, date or time column, without
    one task sorting a whole key: rows are numbered inside (key, order
    bucket) and shifted by the row counts of the earlier buckets of the key.
    The buckets are cut at quantiles of the column, so there are few of them
    however sparse its values are (default: one per shuffle partition)."""
    ks = _keys(key)
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = [F.lit(v).cast(df.schema[order].dataType) for v in _order_bounds(df, order, n)]
    below = F.size(F.filter(F.array(*bounds), lambda v: v <= F.col(order))) if bounds else F.lit(0)
    b = df.withColumn("_b", below)
    counts = b.groupBy(*ks, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    w_off = Window.partitionBy(*ks).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(w_off), F.lit(0))) \
        .withColumn("_total", F.sum("_cnt").over(Window.partitionBy(*ks)))
    w_in = Window.partitionBy(*ks, "_b").orderBy(order)
    numbered = b.withColumn("_rn_in", F.row_number().over(w_in))
    return numbered.join(offsets, [*ks, "_b"]) \
        .withColumn(out, F.col("_rn_in") + F.col("_off")) \
        .withColumnRenamed("_total", f"{out}_total") \
        .drop("_b", "_rn_in", "_off", "_cnt")


def batch_number(df: DataFrame, key: Sequence[str] | str, order: str, size: int = 50,
                 buckets: int | None = None) -> DataFrame:
    """Consecutive batches of ``size`` per key: 1-based batch number,
    1-based position inside the batch, and the key's batch count."""
    n = global_row_number(df, key, order, buckets)
    return (n.withColumn("batch_no", F.floor((F.col("rn") - 1) / size) + 1)
             .withColumn("pair_no", (F.col("rn") - 1) % size + 1)
             .withColumn("n_batches", F.ceil(F.col("rn_total") / size))
             .drop("rn", "rn_total"))


# ------------------------------------------------------------------ W4
RATE_SCHEMA = "client_id long, request_id long, ts_us long, allowed boolean, wait_us long"


def rate_limit(events: DataFrame, key: str = "client_id", ts: str = "ts", tie: str = "request_id",
               limit: int = 3, window_us: int = 60_000_000, partitions: int | None = None,
               bucket_us: int | None = None, bucket_rows: int | None = None) -> DataFrame:
    """Sliding-window limiter per client, in time order.

    Keep the admitted timestamps younger than the window; at ``limit`` of
    them the request is rejected with wait = window - (now - oldest kept),
    otherwise admitted and recorded.  Rejections are not recorded, so each
    decision depends on the earlier ones.  A client's time line is cut into
    buckets (slices of ``bucket_us``, finer where they hold more than
    ``bucket_rows``); a chain over the request times alone finds the state in
    which each bucket begins, and the buckets are decided in parallel
    (``bursts.py``), also those of one burst without idle gaps.
    """
    e = events.select(F.col(key).cast("long").alias("client_id"), F.col(tie).cast("long").alias("request_id"),
                      epoch_micros(events, ts).alias("ts_us"))
    return decide_buckets(e, limit, window_us, bucket_us or max(window_us, 3_600_000_000), RATE_SCHEMA, partitions, bucket_rows)


# ------------------------------------------------------------------ D12
def chunk_plan(df: DataFrame, duration: str = "duration_s", size: float = 15.0, sample_rate: int = 16000) -> DataFrame:
    """ceil(d / size) chunks (one when d <= size); chunk i covers
    [size*i, min(size*(i+1), d)); sample bounds floor(t * sr), the end
    clipped to the clip's sample count floor(d * sr)."""
    d = F.col(duration).cast("double")
    n = F.greatest(F.ceil(d / size), F.lit(1))
    out = df.withColumn("chunk_index", F.explode(F.sequence(F.lit(0), (n - 1).cast("int"))))
    start = F.col("chunk_index") * F.lit(size)
    end = F.least(start + F.lit(size), d)
    total = F.floor(d * sample_rate).cast("bigint")
    return (out.withColumn("start_s", start.cast("double")).withColumn("end_s", end)
               .withColumn("start_sample", F.floor(F.col("start_s") * sample_rate).cast("bigint"))
               .withColumn("end_sample", F.least(F.floor(F.col("end_s") * sample_rate).cast("bigint"), total)))
