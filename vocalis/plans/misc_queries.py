"""Catalogue: feature reports, sources and sinks, array forms of signal ops
(A9-A12, A17, A18, J1, P3, P5, S2, S5, S9, S12, D5, D7, D13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vocalis.functions import formatting as FM
from vocalis.operators import features as FE
from vocalis.operators import relational as RL
from vocalis.operators import wer_reports as R
from vocalis.operators import signal_sql as SQ
from vocalis.plans import fixtures as X
from vocalis.plans.catalog import register, with_cte
from vocalis.session import scratch_path
from vocalis.sources import pairs as SP
from vocalis.sources import results as SR

_TASKS = dict(tasks=X.TASKS_SQL)


# ------------------------------------------------------------------ A9 / A10 / A11
@register("task_outcomes", with_cte(
    "SELECT count(*) AS total, count(*) FILTER (WHERE status = 'ok') AS success, "
    "count(*) FILTER (WHERE status <> 'ok') AS failed FROM tasks", **_TASKS))
def q_task_outcomes(spark, sf_dir):
    return FE.task_outcomes(X.tasks(spark, sf_dir))


@register("feature_summary", with_cte(
    "SELECT gender, speaker, count(filename) AS file_count, round(avg(duration_s), 2) AS avg_duration_s, "
    "round(avg(n_frames), 0) AS avg_frames FROM tasks GROUP BY gender, speaker ORDER BY speaker, gender", **_TASKS))
def q_feature_summary(spark, sf_dir):
    return FE.feature_summary(X.tasks(spark, sf_dir))


@register("augmentation_summary", with_cte(
    "SELECT augmentation, gender, count(filename) AS files, round(avg(duration_s), 2) AS avg_dur_s FROM tasks "
    "WHERE status = 'ok' GROUP BY augmentation, gender ORDER BY augmentation, gender", **_TASKS))
def q_augmentation_summary(spark, sf_dir):
    return FE.augmentation_summary(X.tasks(spark, sf_dir))


@register("success_filter", with_cte(
    "SELECT filename, speaker, augmentation, duration_s FROM tasks WHERE status = 'ok'", **_TASKS))
def q_success_filter(spark, sf_dir):
    return RL.successes(X.tasks(spark, sf_dir)).select("filename", "speaker", "augmentation", "duration_s")


@register("drop_columns", with_cte(
    "SELECT filename, speaker, gender, augmentation, duration_s, n_frames FROM tasks", **_TASKS))
def q_drop_columns(spark, sf_dir):
    return RL.drop_columns(X.tasks(spark, sf_dir), "status")


# ------------------------------------------------------------------ J1 / A12
@register("file_x_technique", with_cte(
    "SELECT path, t.augmentation FROM manifest CROSS JOIN (VALUES " +
    ", ".join(f"('{t}')" for t in FE.TECHNIQUES) + ") AS t(augmentation)", manifest=X.MANIFEST_SQL))
def q_file_x_technique(spark, sf_dir):
    return FE.explode_techniques(X.manifest(spark, sf_dir).select("path"))


@register("dataset_profile", with_cte(
    "SELECT CASE WHEN grouping_id(speaker, gender) = 0 THEN 'speaker' ELSE 'total' END AS level, speaker, gender, "
    "count(*) AS files, round(sum(length) / 1000000, 1) AS size_mb FROM files "
    "GROUP BY GROUPING SETS ((speaker, gender), ())",
    manifest=X.MANIFEST_SQL,
    files="SELECT CASE WHEN len(string_split(replace(path, '\\', '/'), '/')) >= 2 THEN string_split(replace(path, '\\', '/'), '/')[-2] "
          "ELSE 'unknown' END AS speaker, CASE WHEN contains(lower(path), 'male') AND NOT contains(lower(path), 'female') "
          "THEN 'M' ELSE 'F' END AS gender, length FROM manifest"))
def q_dataset_profile(spark, sf_dir):
    m = X.manifest(spark, sf_dir)
    files = m.select(FM.parent_dir("path").alias("speaker"), FM.gender_from_path("path").alias("gender"), "length")
    return FE.dataset_profile(files)


# ------------------------------------------------------------------ A17 / A18
@register("avg_confidence", with_cte(
    "SELECT transcript_id, len(words)::BIGINT AS n_words, "
    "round(CASE WHEN len(words) > 0 THEN list_reduce(list_transform(words, lambda w: w.confidence), lambda a, b: a + b) / len(words) "
    "ELSE 0.0 END, 6) AS mean_confidence, "
    "cast(round(CASE WHEN len(words) > 0 THEN list_reduce(list_transform(words, lambda w: w.confidence), lambda a, b: a + b) / len(words) "
    "ELSE 0.0 END * 100, 0) AS BIGINT) AS confidence_pct, "
    "len(list_filter(words, lambda w: w.confidence >= 0.95))::BIGINT AS n_high, "
    "len(list_filter(words, lambda w: w.confidence < 0.95 AND w.confidence >= 0.85))::BIGINT AS n_mid, "
    "len(list_filter(words, lambda w: w.confidence < 0.85))::BIGINT AS n_low FROM words", words=X.WORDS_SQL))
def q_avg_confidence(spark, sf_dir):
    return FE.avg_confidence(X.words(spark, sf_dir))


@register("speedup_report", with_cte(
    "SELECT size, round(sequential, 4) AS sequential_s, round(spark, 4) AS spark_s, "
    "CASE WHEN spark <= 0 THEN 1.0::double ELSE round(sequential / spark, 2) END AS speedup FROM "
    "(SELECT size, sum(seconds) FILTER (WHERE mode = 'sequential') AS sequential, "
    "sum(seconds) FILTER (WHERE mode = 'spark') AS spark FROM timings GROUP BY size)", timings=X.TIMINGS_SQL))
def q_speedup_report(spark, sf_dir):
    return FE.speedup_report(X.timings(spark, sf_dir))


# ------------------------------------------------------------------ S2 / S5 / S12 / S9
@register("read_results", with_cte("SELECT * FROM results", results=X.RESULTS_SQL))
def q_read_results(spark, sf_dir):
    path = scratch_path(spark, "results-csv")
    SR.write_results_csv(X.results(spark, sf_dir), path)
    return SR.read_results(spark, path)


@register("write_summary", with_cte(
    "SELECT severity, noise_type, gender, augmentation, round(avg(baseline_wer), 12) AS avg_baseline_wer, "
    "round(avg(finetuned_wer), 12) AS avg_finetuned_wer, count(*) AS sample_count "
    "FROM results GROUP BY severity, noise_type, gender, augmentation", results=X.RESULTS_SQL))
def q_write_summary(spark, sf_dir):
    path = scratch_path(spark, "summary")
    SR.write_summary(R.wer_summary(X.results(spark, sf_dir)), path)
    back = spark.read.parquet(path)
    return back.select("severity", "noise_type", "gender", "augmentation",
                       F.round("avg_baseline_wer", 12).alias("avg_baseline_wer"),
                       F.round("avg_finetuned_wer", 12).alias("avg_finetuned_wer"), "sample_count")


@register("partitioned_wer_write", with_cte(
    "SELECT noise_type, count(*) AS samples, round(avg(finetuned_wer) * 100, 2) AS finetuned_WER_pct "
    "FROM results WHERE severity = 'severe' GROUP BY noise_type", results=X.RESULTS_SQL))
def q_partitioned_wer_write(spark, sf_dir):
    path = scratch_path(spark, "wer-by-severity")
    SR.write_wer_by_severity(X.results(spark, sf_dir), path)
    sev = SR.read_severity(spark, path, "severe")
    return sev.groupBy("noise_type").agg(F.count(F.lit(1)).alias("samples"),
                                         R.pct("finetuned_wer").alias("finetuned_WER_pct"))


@register("parse_pairs", with_cte("SELECT model_output, correct_transcription FROM pairs", pairs=X.PAIRS_SQL))
def q_parse_pairs(spark, sf_dir):
    path = scratch_path(spark, "pair-files")
    text = SP.pairs_to_text(X.pairs(spark, sf_dir))  # every third tuple over two lines
    broken = F.when(F.crc32(F.col("value").cast("binary")) % 3 == 0,
                    F.replace("value", F.lit('", "'), F.lit('",\n  "'))).otherwise(F.col("value"))
    text.select(broken.alias("value")).write.mode("overwrite").text(path)
    return SP.read_pair_files(spark, path)


# ------------------------------------------------------------------ D5 / D7 / D13 (array forms)
@register("aug_time_shift", with_cte(
    f"SELECT vec_id, list_concat(embedding[len(embedding) - {SQ.SHIFT - 1}:len(embedding)], "
    f"embedding[1:len(embedding) - {SQ.SHIFT}]) AS shifted FROM signals", signals=X.SIGNALS_SQL))
def q_aug_time_shift(spark, sf_dir):
    s = X.signals(spark, sf_dir)
    return s.select("vec_id", SQ.roll("embedding", SQ.SHIFT).alias("shifted"))


@register("power_to_db", with_cte(
    "SELECT vec_id, list_transform(db, lambda x: round(greatest(x, list_max(db) - 80.0), 4)) AS db FROM "
    "(SELECT vec_id, list_transform(embedding, lambda x: 10.0 * log10(greatest(1e-10, x * x)) - "
    "10.0 * log10(greatest(1e-10, list_max(list_transform(embedding, lambda y: y * y))))) AS db FROM signals)",
    signals=X.SIGNALS_SQL))
def q_power_to_db(spark, sf_dir):
    s = X.signals(spark, sf_dir)
    return s.select("vec_id", SQ.power_to_db(F.transform("embedding", lambda x: x * x), digits=4).alias("db"))


@register("encode_pcm16", with_cte(
    "SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN greatest(-1.0::double, least(1.0::double, x::double)) < 0 "
    "THEN cast(trunc(greatest(-1.0::double, least(1.0::double, x::double)) * 32768.0::double) AS INTEGER) "
    "ELSE cast(trunc(greatest(-1.0::double, least(1.0::double, x::double)) * 32767.0::double) AS INTEGER) END) AS pcm FROM signals",
    signals=X.SIGNALS_SQL))
def q_encode_pcm16(spark, sf_dir):
    s = X.signals(spark, sf_dir)
    return s.select("vec_id", SQ.pcm16_samples("embedding").alias("pcm"))


# ------------------------------------------------------------------ S3 / O5
@register("results_view", with_cte(
    "SELECT noise_type, severity, sum(CASE WHEN finetuned_wer < baseline_wer THEN 1 ELSE 0 END)::BIGINT AS improved, "
    "round(max(baseline_wer - finetuned_wer), 6) AS best_gain FROM results GROUP BY noise_type, severity",
    results=X.RESULTS_SQL))
def q_results_view(spark, sf_dir):
    """S3: the results table registered under a SQL name and queried with SQL text."""
    import uuid
    name = f"results_{uuid.uuid4().hex[:8]}"
    SR.register(X.results(spark, sf_dir), name)
    return spark.sql(f"SELECT noise_type, severity, count_if(finetuned_wer < baseline_wer) AS improved, "
                     f"round(max(baseline_wer - finetuned_wer), 6) AS best_gain FROM {name} GROUP BY noise_type, severity")


@register("show_limit", with_cte(
    "SELECT severity, noise_type, gender, augmentation, sample_count FROM results_summary "
    "ORDER BY severity, noise_type, gender, augmentation LIMIT 20",
    results=X.RESULTS_SQL,
    results_summary="SELECT severity, noise_type, gender, augmentation, count(*) AS sample_count FROM results "
                     "GROUP BY severity, noise_type, gender, augmentation"))
def q_show_limit(spark, sf_dir):
    """The rows a console preview shows (first 20 in key order)."""
    from vocalis.streaming.sources import preview_rows
    s = R.wer_summary(X.results(spark, sf_dir)).select("severity", "noise_type", "gender", "augmentation",
                                                       "sample_count")
    return preview_rows(s.orderBy("severity", "noise_type", "gender", "augmentation"), 20)
