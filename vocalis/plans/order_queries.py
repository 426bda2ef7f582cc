"""Catalogue: order-dependent operators (W1-W4) and chunk planning."""

from __future__ import annotations

from pyspark.sql import functions as F

from vocalis.operators import ordering as O
from vocalis.plans import fixtures as X
from vocalis.plans.catalog import register, with_cte
from vocalis.plans.text_queries import duck_strip

# Rate-limit parameters of the registered check (the reference's 60 s
# default rejects nothing on this data, so the check uses 2 days).
RATE_LIMIT, RATE_WINDOW_US = 3, 2 * 86_400 * 1_000_000
SAMPLE_K, SAMPLE_SEED = 100, 42


# ------------------------------------------------------------------ W1
@register("reassemble_chunks", with_cte(
    "SELECT file_id, coalesce(string_agg(t, ' ' ORDER BY chunk_index) FILTER (WHERE t <> ''), '') AS transcript, "
    "count(*) AS n_chunks FROM (SELECT file_id, chunk_index, " + duck_strip("text") + " AS t FROM chunks) GROUP BY file_id",
    chunks=X.CHUNKS_SQL))
def q_reassemble_chunks(spark, sf_dir):
    return O.reassemble(X.chunks(spark, sf_dir))


# ------------------------------------------------------------------ W2
@register("bounded_sample", with_cte(
    f"SELECT username, seq FROM (SELECT username, seq, row_number() OVER (PARTITION BY username ORDER BY "
    f"md5(concat_ws(':', '{SAMPLE_SEED}', cast(seq AS varchar))), seq) AS rn FROM rules_raw) WHERE rn <= {SAMPLE_K}",
    rules_raw=X.RULES_RAW_SQL))
def q_bounded_sample(spark, sf_dir):
    s = O.bounded_sample(X.rules_raw(spark, sf_dir), "username", SAMPLE_K, ["seq"], seed=SAMPLE_SEED)
    return s.select("username", "seq")


# ------------------------------------------------------------------ W3
@register("batch_number", with_cte(
    "SELECT username, seq, cast(floor((rn - 1) / 50) + 1 AS BIGINT) AS batch_no, cast((rn - 1) % 50 + 1 AS BIGINT) AS pair_no, "
    "cast(ceil(cnt / 50) AS BIGINT) AS n_batches FROM (SELECT username, seq, row_number() OVER (PARTITION BY username ORDER BY seq) AS rn, "
    "count(*) OVER (PARTITION BY username) AS cnt FROM rules_raw)", rules_raw=X.RULES_RAW_SQL))
def q_batch_number(spark, sf_dir):
    b = O.batch_number(X.rules_raw(spark, sf_dir).select("username", "seq"), "username", "seq", size=50)
    return b.select("username", "seq", F.col("batch_no").cast("bigint").alias("batch_no"),
                    F.col("pair_no").cast("bigint").alias("pair_no"), F.col("n_batches").cast("bigint").alias("n_batches"))


# ------------------------------------------------------------------ W4
def rate_limit_sql(limit: int = RATE_LIMIT, window_us: int = RATE_WINDOW_US) -> str:
    kept = f"list_filter(r.kept, lambda x: e.t - x < {window_us})"
    return with_cte(f"""SELECT client_id, request_id, t AS ts_us, allowed, wait_us FROM r""",
                    requests=X.REQUESTS_SQL,
                    ev="SELECT client_id, request_id, epoch_us(ts) AS t, row_number() OVER "
                       "(PARTITION BY client_id ORDER BY ts, request_id) AS rn FROM requests",
                    r=f"""SELECT client_id, rn, request_id, t, [t] AS kept, true AS allowed, 0::BIGINT AS wait_us FROM ev WHERE rn = 1
  UNION ALL
  SELECT e.client_id, e.rn, e.request_id, e.t,
    CASE WHEN len({kept}) >= {limit} THEN {kept} ELSE list_append({kept}, e.t) END,
    len({kept}) < {limit},
    CASE WHEN len({kept}) >= {limit} THEN greatest(0, {window_us} - (e.t - {kept}[1]))::BIGINT ELSE 0::BIGINT END
  FROM r JOIN ev e ON e.client_id = r.client_id AND e.rn = r.rn + 1""").replace("WITH ", "WITH RECURSIVE ", 1)


@register("rate_limit", rate_limit_sql())
def q_rate_limit(spark, sf_dir):
    return O.rate_limit(X.requests(spark, sf_dir), limit=RATE_LIMIT, window_us=RATE_WINDOW_US)


# ------------------------------------------------------------------ D12
@register("chunk_plan", with_cte(
    "SELECT file_id, duration_s, chunk_index, start_s, end_s, cast(floor(start_s * 16000) AS BIGINT) AS start_sample, "
    "least(cast(floor(end_s * 16000) AS BIGINT), cast(floor(duration_s * 16000) AS BIGINT)) AS end_sample FROM "
    "(SELECT file_id, duration_s, chunk_index, chunk_index * 15.0::double AS start_s, "
    "least(chunk_index * 15.0::double + 15.0::double, duration_s) AS end_s FROM "
    "(SELECT file_id, duration_s, unnest(range(0, greatest(cast(ceil(duration_s / 15.0::double) AS BIGINT), 1))) AS chunk_index "
    "FROM durations))", durations=X.DURATIONS_SQL))
def q_chunk_plan(spark, sf_dir):
    p = O.chunk_plan(X.durations(spark, sf_dir))
    return p.select("file_id", "duration_s", F.col("chunk_index").cast("bigint").alias("chunk_index"),
                    "start_s", "end_s", "start_sample", "end_sample")
