"""Fixture views derived from the driver tables (see FIXTURES.md).

Each fixture exists twice: a Spark DataFrame builder taking ``(spark,
sf_dir)`` and a DuckDB CTE body over the pre-registered base views, so an
oracle query can inline it as ``WITH name AS (...)``.  Both read the whole
base table; nothing is capped or sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalis.functions.text import WS_RUN
from vocalis.operators.relational import spread
from vocalis.session import cap_batches, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    cap_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- results
_SEV = "CASE l_returnflag WHEN 'A' THEN 'mild' WHEN 'N' THEN 'moderate' ELSE 'severe' END"
_NOISE = "CASE l_linenumber % 4 WHEN 0 THEN 'clean' WHEN 1 THEN 'gaussian' WHEN 2 THEN 'babble' ELSE 'reverb' END"
_AUG5 = ("CASE l_orderkey % 5 WHEN 0 THEN 'none' WHEN 1 THEN 'gaussian_noise' WHEN 2 THEN 'pitch_shift' "
         "WHEN 3 THEN 'time_stretch' ELSE 'time_shift' END")
_SPK = "concat('speaker_', lpad(cast(l_suppkey % 15 + 1 AS string), 2, '0'))"
_GENDER = "CASE WHEN l_partkey % 2 = 0 THEN 'M' ELSE 'F' END"


def _results_cols(dbl) -> list[str]:
    pen = (f"(CASE l_linenumber % 4 WHEN 0 THEN {dbl('0.00')} WHEN 1 THEN {dbl('0.03')} "
           f"WHEN 2 THEN {dbl('0.09')} ELSE {dbl('0.06')} END)")
    return [
        f"concat({_SPK}, '_', cast(l_orderkey AS string), '_', cast(l_linenumber AS string), '.wav') AS filename",
        f"{_SPK} AS speaker",
        f"{_GENDER} AS gender",
        f"{_SEV} AS severity",
        f"{_NOISE} AS noise_type",
        f"{_AUG5} AS augmentation",
        f"(CASE l_returnflag WHEN 'A' THEN {dbl('0.26')} WHEN 'N' THEN {dbl('0.41')} ELSE {dbl('0.63')} END)"
        f" + {pen} + l_discount AS baseline_wer",
        f"(CASE l_returnflag WHEN 'A' THEN {dbl('0.13')} WHEN 'N' THEN {dbl('0.21')} ELSE {dbl('0.32')} END)"
        f" + {pen} + l_tax AS finetuned_wer",
    ]


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inference results table (one row per lineitem)."""
    return table(spark, sf_dir, "lineitem").selectExpr(*_results_cols(lambda v: f"{v}D"))


RESULTS_SQL = "SELECT " + ",\n  ".join(_results_cols(lambda v: f"{v}::double")) + " FROM lineitem"


# ---------------------------------------------------------------- pairs
def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcript pairs from whole conversation turns: the reference is the
    lower-cased token list, the hypothesis replaces every 5th token with
    ``um`` and drops every 11th (1-based)."""
    conv = table(spark, sf_dir, "conversations")
    toks = conv.select(
        "conv_id", "turn",
        F.filter(F.split(F.lower("text"), WS_RUN), lambda x: x != "").alias("r"),
    )
    hyp = F.filter(
        F.transform("r", lambda x, i: F.when((i + 1) % 5 == 0, F.lit("um"))
                    .when((i + 1) % 11 == 0, F.lit("")).otherwise(x)),
        lambda x: x != "",
    )
    return toks.select(
        F.concat(F.lit("user_"), (F.col("conv_id") % 20).cast("string")).alias("username"),
        (F.col("conv_id") * 100 + F.col("turn")).alias("pair_id"),
        F.array_join(hyp, " ").alias("model_output"),
        F.array_join("r", " ").alias("correct_transcription"),
    )


DUCK_WS_RUN = WS_RUN  # RE2 accepts the same class

PAIRS_SQL = f"""SELECT concat('user_', cast(conv_id % 20 AS string)) AS username, conv_id * 100 + turn AS pair_id,
    array_to_string(list_filter(list_transform(r, lambda x, i: CASE WHEN i % 5 = 0 THEN 'um' WHEN i % 11 = 0 THEN '' ELSE x END),
                                lambda x: x <> ''), ' ') AS model_output,
    array_to_string(r, ' ') AS correct_transcription
  FROM (SELECT conv_id, turn, list_filter(regexp_split_to_array(lower(text), '{DUCK_WS_RUN}'), lambda x: x <> '') AS r
        FROM conversations)"""


# ---------------------------------------------------------------- manifest
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audio paths: Unix paths, Windows paths and bare names (no parent)."""
    return table(spark, sf_dir, "orders").selectExpr(
        "CASE WHEN o_orderkey % 50 = 0 THEN concat(cast(o_orderkey AS string), '.wav') "
        "WHEN o_orderkey % 3 = 0 THEN concat('D:\\\\audio\\\\Synthetic_Female\\\\speaker_', cast(o_custkey % 15 AS string), "
        "'\\\\', cast(o_orderkey AS string), '.wav') "
        "ELSE concat('/data/audio/synthetic_male/speaker_', cast(o_custkey % 15 AS string), '/', "
        "cast(o_orderkey AS string), '.wav') END AS path",
        "cast(floor(o_totalprice) AS bigint) AS length",
    )


MANIFEST_SQL = """SELECT CASE WHEN o_orderkey % 50 = 0 THEN concat(cast(o_orderkey AS string), '.wav')
    WHEN o_orderkey % 3 = 0 THEN concat('D:\\audio\\Synthetic_Female\\speaker_', cast(o_custkey % 15 AS string), '\\', cast(o_orderkey AS string), '.wav')
    ELSE concat('/data/audio/synthetic_male/speaker_', cast(o_custkey % 15 AS string), '/', cast(o_orderkey AS string), '.wav') END AS path,
  cast(floor(o_totalprice) AS bigint) AS length
FROM orders"""


# ---------------------------------------------------------------- tasks
_TASK_COLS = [
    "concat(cast(l_orderkey AS string), '_', cast(l_linenumber AS string), '.wav') AS filename",
    f"{_SPK} AS speaker",
    f"{_GENDER} AS gender",
    "CASE l_orderkey % 4 WHEN 0 THEN 'gaussian_noise' WHEN 1 THEN 'pitch_shift' WHEN 2 THEN 'time_stretch' "
    "ELSE 'time_shift' END AS augmentation",
    "cast(CASE WHEN l_linenumber = 7 THEN -1 ELSE l_quantity / 4 END AS float) AS duration_s",
    "cast(CASE WHEN l_linenumber = 7 THEN -1 ELSE 1 + floor(l_quantity * 25) END AS int) AS n_frames",
    "CASE WHEN l_linenumber = 7 THEN 'error: truncated' ELSE 'ok' END AS status",
]


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature-job output rows without the Mel array."""
    return table(spark, sf_dir, "lineitem").selectExpr(*_TASK_COLS)


TASKS_SQL = "SELECT " + ",\n  ".join(_TASK_COLS) + " FROM lineitem"


# ---------------------------------------------------------------- rules_raw
_RULE_COLS = [
    "concat('user_', cast(user_id % 20 AS string)) AS username",
    "event_id AS seq",
    "CASE WHEN event_id % 97 = 0 THEN '  ' WHEN event_id % 2 = 0 THEN upper(event_type) ELSE event_type END AS stt_output",
    "concat('term', cast(user_id % 7 AS string)) AS intended",
    "CASE event_id % 5 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' WHEN 3 THEN 'often' END AS frequency",
    "concat('heard ', event_type, ' for term', cast(user_id % 7 AS string)) AS explanation",
    "ts",
]


def rules_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Un-deduplicated correction rules, as the extraction step returns them."""
    return table(spark, sf_dir, "events").selectExpr(*_RULE_COLS)


RULES_RAW_SQL = "SELECT " + ",\n  ".join(_RULE_COLS) + " FROM events"


# ---------------------------------------------------------------- vocab_raw
_VOCAB_COLS = [
    "concat('user_', cast(user_id % 20 AS string)) AS username",
    "event_id AS seq",
    "CASE WHEN event_id % 89 = 0 THEN ' ' WHEN event_id % 3 = 0 THEN upper(event_type) ELSE event_type END AS term",
    "CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'domain_term' END AS category",
    "concat('definition of ', event_type) AS definition",
    "[concat('al', cast(user_id % 5 AS string)), concat('AL', cast(user_id % 3 AS string)), "
    "concat('al', cast(event_id % 4 AS string))] AS misheard_as",
]


def vocab_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Un-deduplicated vocabulary entries."""
    cols = [c.replace("[concat(", "array(concat(").replace("string))] AS", "string))) AS") for c in _VOCAB_COLS]
    return table(spark, sf_dir, "events").selectExpr(*cols)


VOCAB_RAW_SQL = "SELECT " + ",\n  ".join(_VOCAB_COLS) + " FROM events"


# ---------------------------------------------------------------- chunks
_CHUNK_COLS = [
    "conv_id AS file_id",
    "turn AS chunk_index",
    "CASE WHEN (conv_id + turn) % 7 = 3 THEN '' ELSE text END AS text",
]


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcript chunks keyed (file, index); every 7th one failed (empty)."""
    return table(spark, sf_dir, "conversations").selectExpr(*_CHUNK_COLS)


CHUNKS_SQL = "SELECT " + ", ".join(_CHUNK_COLS) + " FROM conversations"


# ---------------------------------------------------------------- requests
def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log: client, time, tie-break id."""
    return table(spark, sf_dir, "events").selectExpr(
        "user_id AS client_id", "ts", "event_id AS request_id")


REQUESTS_SQL = "SELECT user_id AS client_id, ts, event_id AS request_id FROM events"


# ---------------------------------------------------------------- words
def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-transcript word lists with deterministic confidences."""
    conv = table(spark, sf_dir, "conversations")
    w = F.split(F.col("text"), " ", -1)
    return conv.select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("transcript_id"),
        F.transform(
            F.filter(w, lambda x: x != ""),
            lambda x, i: F.struct(
                x.alias("word"),
                (F.lit(0.75) + F.lit(0.25) * ((F.char_length(x) * 37 + (i + 1) * 11) % 100) / F.lit(100.0))
                .alias("confidence"),
            ),
        ).alias("words"),
    )


WORDS_SQL = """SELECT conv_id * 100 + turn AS transcript_id,
  list_transform(list_filter(string_split(text, ' '), lambda x: x <> ''),
     lambda x, i: {'word': x, 'confidence': 0.75::double + 0.25::double * ((length(x) * 37 + i * 11) % 100) / 100.0::double}) AS words
FROM conversations"""


# ---------------------------------------------------------------- durations
def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat(cast(l_orderkey AS string), '_', cast(l_linenumber AS string), '_', cast(l_partkey AS string)) AS file_id",
        "l_quantity AS duration_s")


DURATIONS_SQL = ("SELECT concat(cast(l_orderkey AS string), '_', cast(l_linenumber AS string), '_', "
                 "cast(l_partkey AS string)) AS file_id, l_quantity AS duration_s FROM lineitem")


# ---------------------------------------------------------------- signals
def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding")


SIGNALS_SQL = "SELECT vec_id, embedding FROM embeddings"


# ---------------------------------------------------------------- timings
_TIMING_COLS = [
    "cast((user_id % 6 + 1) * 500 AS int) AS size",
    "CASE WHEN event_id % 2 = 0 THEN 'sequential' ELSE 'spark' END AS mode",
    "CASE WHEN user_id % 6 = 5 AND event_id % 2 = 1 THEN 0.0D ELSE value END AS seconds",
]


def timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(size, mode, seconds) timing log; one size has zero Spark seconds."""
    return table(spark, sf_dir, "events").selectExpr(*_TIMING_COLS)


TIMINGS_SQL = "SELECT " + ", ".join(c.replace("0.0D", "0.0::double") for c in _TIMING_COLS) + " FROM events"


# ---------------------------------------------------------------- user mapping log
_MAP_COLS = [
    "concat('user_', cast(user_id % 20 AS string)) AS username",
    "concat('spk', lpad(cast(user_id % 20 AS string), 2, '0'), '_', cast(event_id % 3 AS string)) AS speaker_id",
    "ts AS updated_at",
    "event_id AS seq",
]


def mapping_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """username -> speaker id writes of all users."""
    return table(spark, sf_dir, "events").selectExpr(*_MAP_COLS)


MAPPING_LOG_SQL = "SELECT " + ", ".join(_MAP_COLS) + " FROM events"

# Gaps of the two lookup queries: users never mapped, users mapped without a
# profile, users with empty lists.
UNMAPPED_USERS = [f"user_{n}" for n in range(15, 20)]
MISSING_PROFILE_USER = "user_14"
EMPTY_PROFILE_USER = "user_13"


def _info_cols(n: str, arr) -> list[str]:
    return [
        f"CASE {n} % 4 WHEN 0 THEN 'tech' WHEN 1 THEN 'medical' WHEN 2 THEN NULL ELSE 'legal' END AS domain",
        f"CASE {n} % 5 WHEN 0 THEN 'Casual' WHEN 1 THEN 'academic' WHEN 2 THEN 'weird' WHEN 3 THEN NULL ELSE 'mixed' END AS formality",
        f"{arr}concat('topic_', cast({n} % 3 AS string)), concat('topic_', cast({n} % 4 + 3 AS string)){arr_end(arr)} AS topics",
        f"CASE WHEN {n} % 2 = 0 THEN NULL ELSE {arr}'en', 'de'{arr_end(arr)} END AS languages",
        f"CASE WHEN {n} % 3 = 0 THEN 'en-GB' END AS preferred_spelling",
        f"concat('speaks about topic_', cast({n} % 3 AS string)) AS notes",
    ]


def arr_end(arr: str) -> str:
    return ")" if arr == "array(" else "]"


def speaker_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted speaker info per mapped user (a function of the user number)."""
    m = mapping_log(spark, sf_dir).select("username").distinct() \
        .withColumn("n", F.expr("cast(substring(username, 6) AS int)"))
    return m.selectExpr("username", *_info_cols("n", "array("))


SPEAKER_INFO_SQL = ("SELECT username, " + ", ".join(_info_cols("n", "[")) +
                    " FROM (SELECT DISTINCT username, cast(substring(username, 6) AS int) AS n FROM mapping_log)")


# ---------------------------------------------------------------- substitution-only pairs
def sub_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with substitutions only (equal token counts): every 5th token
    becomes ``um``, every 7th gets an ``s`` appended."""
    conv = table(spark, sf_dir, "conversations")
    toks = conv.select("conv_id", "turn", F.filter(F.split(F.lower("text"), WS_RUN), lambda x: x != "").alias("r"))
    hyp = F.transform("r", lambda x, i: F.when((i + 1) % 5 == 0, F.lit("um"))
                      .when((i + 1) % 7 == 0, F.concat(x, F.lit("s"))).otherwise(x))
    return toks.select(
        F.concat(F.lit("user_"), (F.col("conv_id") % 20).cast("string")).alias("username"),
        (F.col("conv_id") * 100 + F.col("turn")).alias("pair_id"),
        F.array_join(hyp, " ").alias("model_output"),
        F.array_join("r", " ").alias("correct_transcription"),
    )


SUB_PAIRS_SQL = f"""SELECT concat('user_', cast(conv_id % 20 AS string)) AS username, conv_id * 100 + turn AS pair_id,
    array_to_string(list_transform(r, lambda x, i: CASE WHEN i % 5 = 0 THEN 'um' WHEN i % 7 = 0 THEN concat(x, 's') ELSE x END), ' ') AS model_output,
    array_to_string(r, ' ') AS correct_transcription
  FROM (SELECT conv_id, turn, list_filter(regexp_split_to_array(lower(text), '{DUCK_WS_RUN}'), lambda x: x <> '') AS r
        FROM conversations)"""


# ---------------------------------------------------------------- texts to correct
_RTEXT_COLS = [
    "event_id AS text_id",
    "concat('user_', cast(user_id % 20 AS string)) AS username",
    "concat('the ', event_type, ' then ', upper(event_type), ' and ', event_type, 'ing ', lower(event_type)) AS model_output",
]


def rule_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*_RTEXT_COLS)


RULE_TEXTS_SQL = "SELECT " + ", ".join(_RTEXT_COLS) + " FROM events"


# ---------------------------------------------------------------- phrase rules
#: Rules over several words, before and after the mined one-word rules: each user's event types and terms, as
#: (columns to take distinct, phrase, replacement, confidence).  Later ones meet what earlier ones wrote.
_PHRASE_RULES = [
    ("event_type", "concat('then ', event_type, ' and')", "concat('so ', event_type)", 1.5),
    ("event_type", "concat('SO ', event_type)", "concat('ÉT ', event_type)", 1.2),
    ("user_id % 7", "concat('the term', cast(user_id % 7 AS string))", "concat('THE T', cast(user_id % 7 AS string), ' the')", 0.01),
    ("user_id % 7", "'the ét'", "'fin'", 0.005),
]


def _phrase_rules_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT concat('user_', cast(user_id % 20 AS string)) AS username, {phrase} AS stt_output, {new} AS intended, "
        f"cast({conf} AS double) AS confidence, min(event_id) AS first_seq FROM events GROUP BY user_id % 20, {group}, {phrase}, {new}"
        for group, phrase, new, conf in _PHRASE_RULES)


PHRASE_RULES_SQL = _phrase_rules_sql()


def phrase_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of two and three words that chain with the one-word rules."""
    return spark.sql(PHRASE_RULES_SQL.replace("FROM events", "FROM {events}"), events=table(spark, sf_dir, "events"))


# ---------------------------------------------------------------- pairs with split and joined words
def split_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of unequal lengths.  The reference's i-th token is the first letter of a turn's i-th word, x and i; of 24
    tokens the hypothesis splits the 5th in two, joins the 11th and 12th and appends an ``s`` to the 18th."""
    conv = table(spark, sf_dir, "conversations")
    r = F.transform(F.filter(F.split(F.lower("text"), WS_RUN), lambda x: x != ""),
                    lambda w, i: F.concat(F.substring(w, 1, 1), F.lit("x"), (i + 1).cast("string")))
    hyp = F.expr("""filter(transform(r, (t, i) -> CASE (i + 1) % 24 WHEN 5 THEN concat(substr(t, 1, 2), ' ', substr(t, 3))
        WHEN 11 THEN concat(t, coalesce(get(r, i + 1), '')) WHEN 12 THEN NULL WHEN 18 THEN concat(t, 's') ELSE t END), t -> t IS NOT NULL)""")
    return conv.select("conv_id", "turn", r.alias("r")).select(
        F.concat(F.lit("user_"), (F.col("conv_id") % 20).cast("string")).alias("username"),
        F.array_join(hyp, " ").alias("model_output"), F.array_join("r", " ").alias("correct_transcription"))


#: One row per changed place of ``split_pairs``: username, wrong, right, words before and after.
SPLIT_CHANGES_SQL = f"""SELECT username, wrong, right_, array_to_string(h[greatest(p - 3, 1):p - 1], ' ') AS before_,
    array_to_string(h[p + n:p + n + 2], ' ') AS after_
  FROM (SELECT *, string_split(string_agg(piece, ' ') OVER (PARTITION BY conv_id, turn ORDER BY i
                    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), ' ') AS h,
          1 + coalesce(sum(n) OVER (PARTITION BY conv_id, turn ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS p
        FROM (SELECT conv_id, turn, i, concat('user_', cast(conv_id % 20 AS string)) AS username,
                CASE i % 24 WHEN 5 THEN concat(substr(t, 1, 2), ' ', substr(t, 3)) WHEN 11 THEN concat(t, coalesce(nxt, ''))
                  WHEN 12 THEN NULL WHEN 18 THEN concat(t, 's') ELSE t END AS piece,
                CASE i % 24 WHEN 5 THEN 2 WHEN 12 THEN 0 ELSE 1 END AS n,
                CASE i % 24 WHEN 5 THEN concat(substr(t, 1, 2), ' ', substr(t, 3)) WHEN 11 THEN concat(t, nxt) WHEN 18 THEN concat(t, 's') END AS wrong,
                CASE i % 24 WHEN 11 THEN concat(t, ' ', nxt) ELSE t END AS right_, nxt
              FROM (SELECT *, lead(t) OVER (PARTITION BY conv_id, turn ORDER BY i) AS nxt
                    FROM (SELECT conv_id, turn, unnest(range(1, len(w) + 1)) AS i,
                            unnest(list_transform(w, lambda x, k: concat(substr(x, 1, 1), 'x', k))) AS t
                          FROM (SELECT conv_id, turn, list_filter(regexp_split_to_array(lower(text), '{DUCK_WS_RUN}'), lambda x: x <> '') AS w
                                FROM conversations))))) x
  WHERE i % 24 IN (5, 18) OR (i % 24 = 11 AND nxt IS NOT NULL)"""


# ---------------------------------------------------------------- long-document pairs
def document_pairs(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Whole documents (up to ~20,000 words) as reference; the hypothesis
    replaces every 7th token with ``uh`` and drops every 13th."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), partitions)
    toks = docs.select("doc_id", F.array_remove(F.split(F.lower("text"), WS_RUN), "").alias("r"))
    hyp = F.array_remove(F.transform("r", lambda x, i: F.when((i + 1) % 7 == 0, F.lit("uh"))
                               .when((i + 1) % 13 == 0, F.lit("")).otherwise(x)), "")
    return toks.select(F.col("doc_id").alias("pair_id"), F.array_join(hyp, " ").alias("model_output"),
                       F.array_join("r", " ").alias("correct_transcription"))


DOCUMENT_PAIRS_SQL = f"""SELECT pair_id, r, list_filter(list_transform(r, lambda x, i: CASE WHEN i % 7 = 0 THEN 'uh'
    WHEN i % 13 = 0 THEN '' ELSE x END), lambda x: x <> '') AS h
  FROM (SELECT doc_id AS pair_id, list_filter(regexp_split_to_array(lower(text), '{DUCK_WS_RUN}'), lambda x: x <> '') AS r FROM documents)"""
