"""Catalogue: text, scalar, path and parsing operators (F*, P*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vocalis.functions import formatting as FM
from vocalis.functions import text as T
from vocalis.operators import wer_reports as R
from vocalis.operators.alignment import document_alignment, document_errors, edit_ops
from vocalis.operators.wer import pair_wer, wer_by_user
from vocalis.plans import clips as C
from vocalis.plans import fixtures as X
from vocalis.plans.catalog import register, with_cte

WS = T.WS_RUN


def duck_tokens(expr: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({expr}), '{WS}'), lambda x: x <> '')"


def duck_token_distance(r: str, h: str) -> str:
    """Exact token Levenshtein in DuckDB: anti-diagonal DP folded with
    list_reduce (``r``, ``h`` must be plain list column names)."""
    big = 1000000000
    return (
        f"list_reduce(range(1, len({r}) + len({h}) + 1), lambda acc, k: [acc[2], "
        f"list_transform(range(0, len({r}) + 1), lambda i: CASE WHEN k - i < 0 OR k - i > len({h}) THEN {big} "
        f"WHEN i = 0 THEN k WHEN k - i = 0 THEN i "
        f"ELSE least(acc[2][i] + 1, acc[2][i + 1] + 1, acc[1][i] + CASE WHEN {r}[i] = {h}[k - i] THEN 0 ELSE 1 END) END)], "
        f"[list_transform(range(0, len({r}) + 1), lambda i: {big}), "
        f"list_transform(range(0, len({r}) + 1), lambda i: CASE WHEN i = 0 THEN 0 ELSE {big} END)])[2][len({r}) + 1]"
    )


def duck_wer(r: str, h: str) -> str:
    return f"CASE WHEN len({r}) = 0 THEN 0.0::double ELSE round({duck_token_distance(r, h)} / len({r}), 4) END"


def duck_strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{WS}|{WS}$', '', 'g')"


_PAIR_TOKENS = (f"SELECT username, pair_id, {duck_tokens('correct_transcription')} AS r, "
                f"{duck_tokens('model_output')} AS h FROM pairs")


# ------------------------------------------------------------------ F1
@register("wer", with_cte(f"SELECT pair_id, username, {duck_wer('r', 'h')} AS wer FROM toks",
                          pairs=X.PAIRS_SQL, toks=_PAIR_TOKENS))
def q_wer(spark, sf_dir):
    return pair_wer(X.pairs(spark, sf_dir), partitions=C.partitions(spark)).select("pair_id", "username", "wer")


@register("pair_wer_report", with_cte(
    "SELECT username, count(*) AS samples, round(avg(wer) * 100, 2) AS avg_WER_pct, "
    "cast(sum(d) AS BIGINT) AS errors, cast(sum(len(r)) AS BIGINT) AS ref_words, round(sum(d) / nullif(sum(len(r)), 0) * 100, 2) AS corpus_WER_pct "
    f"FROM (SELECT username, r, {duck_token_distance('r', 'h')} AS d, {duck_wer('r', 'h')} AS wer FROM toks) "
    "GROUP BY username", pairs=X.PAIRS_SQL, toks=_PAIR_TOKENS))
def q_pair_wer_report(spark, sf_dir):
    """Bridge the reference lacks: text pairs -> per-utterance WER -> report."""
    return wer_by_user(pair_wer(X.pairs(spark, sf_dir), partitions=C.partitions(spark)))


@register("wer_documents")
def q_wer_documents(spark, sf_dir):
    """F1 on whole documents (up to ~20,000 words).  No SQL twin: a SQL DP
    over such texts is too slow; tests compare with a numpy DP."""
    return document_errors(X.document_pairs(spark, sf_dir, C.partitions(spark)))


# ------------------------------------------------------------------ F2
def duck_char_codes(expr: str, alphabet: str) -> str:
    """Re-encode a string with one byte per distinct character of the pair
    (DuckDB's levenshtein counts bytes; exact up to 127 distinct characters)."""
    return f"array_to_string(list_transform(string_split({expr}, ''), lambda c: chr(list_position({alphabet}, c)::int)), '')"


@register("cer", with_cte(
    "SELECT pair_id, CASE WHEN length(correct_transcription) = 0 THEN 0.0::double "
    f"ELSE round(levenshtein({duck_char_codes('correct_transcription', 'v')}, {duck_char_codes('model_output', 'v')}) "
    "/ length(correct_transcription), 4) END AS cer "
    "FROM (SELECT *, list_distinct(string_split(concat(correct_transcription, model_output), '')) AS v FROM pairs)",
    pairs=X.PAIRS_SQL))
def q_cer(spark, sf_dir):
    from vocalis.operators.wer import pair_cer
    return pair_cer(X.pairs(spark, sf_dir), partitions=C.partitions(spark)).select("pair_id", "cer")


# ------------------------------------------------------------------ F3 (property-tested)
@register("edit_ops", with_cte(
    f"SELECT pair_id, {duck_token_distance('r', 'h')}::BIGINT AS errors, len(r)::BIGINT AS n_ref, len(h)::BIGINT AS n_hyp "
    "FROM toks WHERE len(r) + len(h) > 0", pairs=X.PAIRS_SQL, toks=_PAIR_TOKENS))
def q_edit_ops(spark, sf_dir):
    """Which optimal path is taken is a free choice; its counts are not: S + D + I is the distance, S + D + H the
    reference length, S + I + H the hypothesis length."""
    ops = edit_ops(X.pairs(spark, sf_dir), "pair_id", "correct_transcription", "model_output", C.partitions(spark))
    return ops.groupBy("pair_id").agg(
        F.count_if(F.col("op") != "hit").alias("errors"), F.count_if(F.col("op") != "ins").alias("n_ref"),
        F.count_if(F.col("op") != "del").alias("n_hyp"))


@register("document_alignment", with_cte(
    "SELECT pair_id, len(r)::BIGINT AS n_ref, len(h)::BIGINT AS n_hyp, sha256(array_to_string(h, ' ')) AS rebuilt_sha256, true AS least "
    "FROM docs", docs=X.DOCUMENT_PAIRS_SQL))
def q_document_alignment(spark, sf_dir):
    """F1 / F3 on whole documents: S + D + H and S + I + H are the lengths, the path rebuilds the hypothesis, and its
    S + D + I is the distance that ``document_errors`` counts by other means."""
    pairs = X.document_pairs(spark, sf_dir, C.partitions(spark))
    path = document_alignment(pairs).withColumn("rebuilt_sha256", F.sha2("rebuilt", 256)).drop("rebuilt")
    counted = document_errors(pairs).select(F.col("pair_id").alias("_pair"), "errors")
    return path.join(counted, F.col("pair_id") == F.col("_pair")).select(
        "pair_id", (F.col("subs") + F.col("dels") + F.col("hits")).alias("n_ref"),
        (F.col("subs") + F.col("ins") + F.col("hits")).alias("n_hyp"), "rebuilt_sha256",
        (F.col("subs") + F.col("dels") + F.col("ins") == F.col("errors")).alias("least"))


# ------------------------------------------------------------------ F5 / F6
@register("tokenize", f"SELECT conv_id, turn, {duck_tokens('text')} AS tokens FROM conversations")
def q_tokenize(spark, sf_dir):
    return X.table(spark, sf_dir, "conversations").select("conv_id", "turn", T.tokenize("text").alias("tokens"))


@register("word_list", "SELECT conv_id, turn, string_split(text, ' ') AS words FROM conversations")
def q_word_list(spark, sf_dir):
    return X.table(spark, sf_dir, "conversations").select("conv_id", "turn", T.word_list("text").alias("words"))


# ------------------------------------------------------------------ F7
_FENCED = ("CASE event_id % 4 WHEN 0 THEN concat('```json', chr(10), props, chr(10), '```') "
           "WHEN 1 THEN concat('```', chr(10), props, chr(10), '```  ', chr(10)) "
           "WHEN 2 THEN concat('  ', props) ELSE concat(chr(10), ' ```', props) END")


@register("strip_fences", with_cte(
    "SELECT event_id, CASE WHEN starts_with(t, '```') THEN "
    + duck_strip(f"regexp_replace(regexp_replace(t, '^[^\\n]*(\\n|$)', ''), '```{T.PY_WHITESPACE}*$', '')")
    + " ELSE t END AS text FROM f", f=f"SELECT event_id, {duck_strip(_FENCED)} AS t FROM events"))
def q_strip_fences(spark, sf_dir):
    ev = X.table(spark, sf_dir, "events").selectExpr("event_id", _FENCED.replace("chr(10)", "char(10)") + " AS t")
    return ev.select("event_id", T.strip_fences("t").alias("text"))


# ------------------------------------------------------------------ F9 / F10
_QUOTED = ("CASE turn % 5 WHEN 0 THEN concat('\"', text, '\"') WHEN 1 THEN concat('''  ', text, ' ''') "
           "WHEN 2 THEN concat('\"', text) WHEN 3 THEN '\"' ELSE text END")


@register("strip_quotes", with_cte(
    "SELECT conv_id, turn, CASE WHEN (starts_with(t, '\"') AND ends_with(t, '\"')) OR (starts_with(t, '''') AND ends_with(t, '''')) "
    f"THEN {duck_strip('substring(t, 2, greatest(length(t) - 2, 0))')} ELSE t END AS text FROM q",
    q=f"SELECT conv_id, turn, {_QUOTED} AS t FROM conversations"))
def q_strip_quotes(spark, sf_dir):
    c = X.table(spark, sf_dir, "conversations").selectExpr("conv_id", "turn", f"{_QUOTED} AS t")
    return c.select("conv_id", "turn", T.strip_quotes("t").alias("text"))


_ESCAPED = "concat('say \\\"', event_type, '\\\" then \\\"', cast(user_id AS string), '\\\"')"


@register("unescape_quotes",
          "SELECT event_id, replace(concat('say \\\"', event_type, '\\\" then \\\"', cast(user_id AS string), '\\\"'), "
          "'\\\"', '\"') AS text FROM events")
def q_unescape_quotes(spark, sf_dir):
    ev = X.table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit('say \\"'), "event_type", F.lit('\\" then \\"'),
                             F.col("user_id").cast("string"), F.lit('\\"')).alias("t"))
    return ev.select("event_id", T.unescape_quotes("t").alias("text"))


# ------------------------------------------------------------------ F17
@register("remove_fillers", with_cte(
    "SELECT pair_id, " + duck_strip(
        f"regexp_replace(regexp_replace(regexp_replace(model_output, '{WS}', '  ', 'g'), "
        "'(?i)(^|\\s)(you\\s+know|like|uh|um)(\\s|$)', ' ', 'g'), " f"'{WS}', ' ', 'g')") + " AS text FROM pairs",
    pairs=X.PAIRS_SQL))
def q_remove_fillers(spark, sf_dir):
    return X.pairs(spark, sf_dir).select("pair_id", T.remove_fillers("model_output").alias("text"))


# ------------------------------------------------------------------ F4
@register("improvement_pct", with_cte(
    "SELECT speaker, round((avg(baseline_wer) - avg(finetuned_wer)) / nullif(avg(baseline_wer), 0) * 100, 2) "
    "AS improvement_pct FROM results GROUP BY speaker", results=X.RESULTS_SQL))
def q_improvement_pct(spark, sf_dir):
    res = X.results(spark, sf_dir)
    return res.groupBy("speaker").agg(
        R.improvement_pct(F.avg("baseline_wer"), F.avg("finetuned_wer")).alias("improvement_pct"))


# ------------------------------------------------------------------ P1
@register("path_metadata", with_cte(
    "SELECT path, string_split(np, '/')[-1] AS filename, "
    "CASE WHEN len(string_split(np, '/')) >= 2 THEN string_split(np, '/')[-2] ELSE 'unknown' END AS speaker, "
    "CASE WHEN contains(lower(path), 'male') AND NOT contains(lower(path), 'female') THEN 'M' ELSE 'F' END AS gender, "
    "length FROM (SELECT path, replace(path, '\\', '/') AS np, length FROM manifest)", manifest=X.MANIFEST_SQL))
def q_path_metadata(spark, sf_dir):
    m = X.manifest(spark, sf_dir)
    return m.select("path", FM.basename("path").alias("filename"), FM.parent_dir("path").alias("speaker"),
                    FM.gender_from_path("path").alias("gender"), "length")


# ------------------------------------------------------------------ P2
_KEY = ("CASE WHEN event_id % 17 = 0 THEN 'not json' WHEN event_id % 13 = 0 THEN props "
        "ELSE concat('{\"speaker\":\"speaker_', lpad(cast(user_id % 15 + 1 AS string), 2, '0'), "
        "'\",\"gender\":\"', CASE WHEN user_id % 2 = 0 THEN 'M' ELSE 'F' END, "
        "'\",\"filename\":\"', cast(event_id AS string), '.wav\"}') END")


def _json(field: str) -> str:
    return f"CASE WHEN json_valid(k) THEN json_extract_string(k, '$.{field}') END AS {field}"


@register("parse_stream_key", with_cte(
    f"SELECT event_id, {_json('speaker')}, {_json('gender')}, {_json('filename')}, ts AS kafka_ts FROM m",
    m=f"SELECT event_id, {_KEY} AS k, ts FROM events"))
def q_parse_stream_key(spark, sf_dir):
    ev = X.table(spark, sf_dir, "events").selectExpr("event_id", f"cast({_KEY} AS binary) AS key", "ts")
    cols = FM.parse_audio_key("key")
    return ev.select("event_id", cols["speaker"].alias("speaker"), cols["gender"].alias("gender"),
                     cols["filename"].alias("filename"), F.col("ts").alias("kafka_ts"))


# ------------------------------------------------------------------ P6
_EDGE = ("SELECT pair_id, CASE WHEN pair_id % 9 = 0 THEN '   ' WHEN pair_id % 10 = 0 THEN '' ELSE model_output END "
         "AS model_output, CASE WHEN pair_id % 7 = 0 THEN concat(' ', chr(9), ' ') ELSE correct_transcription END "
         "AS correct_transcription FROM pairs")


@register("valid_pairs", with_cte(
    f"SELECT pair_id, model_output, correct_transcription FROM edge WHERE {duck_strip('model_output')} <> '' "
    f"AND {duck_strip('correct_transcription')} <> ''", pairs=X.PAIRS_SQL, edge=_EDGE))
def q_valid_pairs(spark, sf_dir):
    from vocalis.operators.kb import valid_pairs
    p = X.pairs(spark, sf_dir)
    pid = F.col("pair_id")
    edge = p.select("pair_id",
                    F.when(pid % 9 == 0, F.lit("   ")).when(pid % 10 == 0, F.lit("")).otherwise(F.col("model_output"))
                    .alias("model_output"),
                    F.when(pid % 7 == 0, F.lit(" \t ")).otherwise(F.col("correct_transcription"))
                    .alias("correct_transcription"))
    return valid_pairs(edge)


# ------------------------------------------------------------------ P7 / P8 / F11 / F12
_FILES = [
    "o_orderkey AS file_id",
    "CASE o_orderkey % 11 WHEN 0 THEN concat('clip_', cast(o_orderkey AS string), '.WAV') "
    "WHEN 1 THEN concat('movie_', cast(o_orderkey AS string), '.mp4') WHEN 2 THEN concat('talk_', cast(o_orderkey AS string), '.webm') "
    "WHEN 3 THEN concat('notes_', cast(o_orderkey AS string)) WHEN 4 THEN concat('trail_', cast(o_orderkey AS string), '.') "
    "WHEN 5 THEN concat('a.b.', cast(o_orderkey AS string), '.flac') WHEN 6 THEN concat('x_', cast(o_orderkey AS string), '.mkv') "
    "WHEN 7 THEN concat('y_', cast(o_orderkey AS string), '.txt') WHEN 8 THEN '' "
    "WHEN 9 THEN concat('z_', cast(o_orderkey AS string), '.M4A') ELSE concat('w_', cast(o_orderkey AS string), '.avi') END AS filename",
    "CASE o_custkey % 5 WHEN 0 THEN 'audio/wav' WHEN 1 THEN 'video/mp4' WHEN 2 THEN 'application/octet-stream' "
    "WHEN 3 THEN NULL ELSE '' END AS mime",
    "CASE WHEN o_orderkey % 13 = 0 THEN 0 ELSE cast(floor(o_totalprice * CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 37 "
    "WHEN 2 THEN 9973 ELSE 1234567 END) AS bigint) END AS size_bytes",
    "o_totalprice / 100 AS duration_s",
]
_FILES_SQL = "SELECT " + ", ".join(_FILES) + " FROM orders"


def _files(spark, sf_dir):
    return X.table(spark, sf_dir, "orders").selectExpr(*_FILES)


_DUCK_EXT = "string_split(filename, '.')[-1]"


@register("media_type", with_cte(
    "SELECT file_id, CASE WHEN starts_with(coalesce(mime, ''), 'audio/') THEN 'audio' "
    "WHEN starts_with(coalesce(mime, ''), 'video/') THEN 'video' "
    f"WHEN lower({_DUCK_EXT}) IN ({', '.join(repr(e) for e in FM.AUDIO_EXTS)}) THEN 'audio' "
    f"WHEN lower({_DUCK_EXT}) IN ({', '.join(repr(e) for e in FM.VIDEO_EXTS)}) THEN 'video' "
    "ELSE 'unknown' END AS media_type FROM files", files=_FILES_SQL))
def q_media_type(spark, sf_dir):
    return _files(spark, sf_dir).select("file_id", FM.media_type("mime", "filename").alias("media_type"))


@register("file_extension", with_cte(
    f"SELECT file_id, CASE WHEN upper({_DUCK_EXT}) = '' THEN 'UNKNOWN' ELSE upper({_DUCK_EXT}) END AS extension FROM files",
    files=_FILES_SQL))
def q_file_extension(spark, sf_dir):
    return _files(spark, sf_dir).select("file_id", FM.file_extension("filename").alias("extension"))


@register("format_file_size", with_cte(
    "SELECT file_id, size_bytes, CASE WHEN size_bytes = 0 THEN '0 B' ELSE concat(regexp_replace(cast(round(size_bytes / "
    "pow(1024.0, u), 1) AS varchar), '\\.0$', ''), ' ', ['B', 'KB', 'MB', 'GB'][u + 1]) END AS size_text FROM "
    "(SELECT file_id, size_bytes, CASE WHEN size_bytes < 1024 THEN 0 WHEN size_bytes < 1048576 THEN 1 "
    "WHEN size_bytes < 1073741824 THEN 2 ELSE 3 END AS u FROM files)", files=_FILES_SQL))
def q_format_file_size(spark, sf_dir):
    return _files(spark, sf_dir).select("file_id", "size_bytes", FM.format_file_size("size_bytes").alias("size_text"))


@register("format_duration", with_cte(
    "SELECT file_id, concat(cast(cast(floor(duration_s / 60) AS bigint) AS varchar), ':', "
    "lpad(cast(cast(floor(duration_s % 60) AS bigint) AS varchar), 2, '0')) AS duration_text FROM files",
    files=_FILES_SQL))
def q_format_duration(spark, sf_dir):
    return _files(spark, sf_dir).select("file_id", FM.format_duration("duration_s").alias("duration_text"))


# ------------------------------------------------------------------ F13 / F16 / F18
@register("freq_to_confidence", with_cte(
    "SELECT seq, frequency, CASE frequency WHEN 'high' THEN 0.9::double WHEN 'medium' THEN 0.7::double "
    "WHEN 'low' THEN 0.5::double ELSE 0.7::double END AS confidence FROM rules_raw", rules_raw=X.RULES_RAW_SQL))
def q_freq_to_confidence(spark, sf_dir):
    r = X.rules_raw(spark, sf_dir)
    return r.select("seq", "frequency", FM.freq_to_confidence("frequency").alias("confidence"))


@register("confidence_band", with_cte(
    "SELECT transcript_id, pos, w.word AS word, w.confidence AS confidence, CASE WHEN w.confidence >= 0.95 THEN 'high' "
    "WHEN w.confidence >= 0.85 THEN 'mid' ELSE 'low' END AS band FROM "
    "(SELECT transcript_id, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS pos FROM words)",
    words=X.WORDS_SQL))
def q_confidence_band(spark, sf_dir):
    w = X.words(spark, sf_dir).select("transcript_id", F.posexplode("words").alias("p", "w"))
    return w.select("transcript_id", (F.col("p") + 1).cast("bigint").alias("pos"), F.col("w.word").alias("word"),
                    F.col("w.confidence").alias("confidence"), FM.confidence_band("w.confidence").alias("band"))


@register("round_half_up",
          "SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity / 8, 2) AS q2, round(l_extendedprice / 7, 4) AS p4, "
          "round(l_extendedprice / 3, 0) AS p0 FROM lineitem")
def q_round_half_up(spark, sf_dir):
    li = X.table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     FM.round_half_up(F.col("l_quantity") / 8, 2).alias("q2"),
                     FM.round_half_up(F.col("l_extendedprice") / 7, 4).alias("p4"),
                     FM.round_half_up(F.col("l_extendedprice") / 3, 0).alias("p0"))
