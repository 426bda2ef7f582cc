"""Catalogue: audio sources, signal operators and feature jobs (S1, S4, P4,
D1-D4, D6, D8-D11).

Clips are synthesised from the ``embeddings`` rows (rate, channels and
length are functions of ``vec_id``, the tones of the row's values), so
lengths, frame counts and failure rows have exact SQL twins; spectra and
random augmentations are property-tested.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from vocalis.operators import audio as A
from vocalis.operators import signal as S
from vocalis.operators.batches import frames
from vocalis.plans import clips as C
from vocalis.plans import fixtures as X
from vocalis.plans.catalog import register, with_cte
from vocalis.session import scratch_path
from vocalis.sources import audio as SA

CLIPS_SQL = """SELECT vec_id, sr, ch, broken, n_in,
    CASE WHEN sr = 16000 THEN n_in ELSE cast(ceil(n_in * 16000 / sr) AS BIGINT) END AS n_out
  FROM (SELECT vec_id, CASE vec_id % 3 WHEN 0 THEN 16000 WHEN 1 THEN 8000 ELSE 22050 END AS sr,
               CASE WHEN vec_id % 4 = 1 THEN 2 ELSE 1 END AS ch, vec_id % 50 = 7 AS broken,
               (CASE vec_id % 3 WHEN 0 THEN 16000 WHEN 1 THEN 8000 ELSE 22050 END) * (250 + (vec_id % 7) * 125) // 1000 AS n_in
        FROM embeddings)"""

_META = ("concat('clip_', cast(vec_id AS varchar), '.wav') AS filename, "
         "concat('speaker_', cast(vec_id % 5 AS varchar)) AS speaker, "
         "CASE WHEN vec_id % 3 = 0 THEN 'M' ELSE 'F' END AS gender")
_ERR = "'error: not a RIFF/WAVE stream'"


def _files(spark, sf_dir):
    clips = C.synth_clips(X.signals(spark, sf_dir))
    return A.with_path_metadata(C.clips_as_files(clips))


def _features(spark, sf_dir):
    return A.extract_features(_files(spark, sf_dir), C.partitions(spark))


# ------------------------------------------------------------------ S1
@register("scan_audio", with_cte(
    f"SELECT {_META}, 44 + n_in * 2 * ch AS length FROM clips", clips=CLIPS_SQL))
def q_scan_audio(spark, sf_dir):
    root = scratch_path(spark, "audio")
    SA.write_binary_files(C.synth_clips(X.signals(spark, sf_dir)), root).write.format("noop").mode("overwrite").save()
    listing = A.with_path_metadata(SA.scan_audio(spark, root))
    return listing.select("filename", "speaker", "gender", "length")


# ------------------------------------------------------------------ D10 / P4 / S4
_FEATURE_TWIN = (f"SELECT {_META}, CASE WHEN broken THEN -1.0 ELSE cast(n_out / 16000 AS FLOAT) END::FLOAT AS duration_s, "
                 "CASE WHEN broken THEN -1 ELSE cast(1 + n_out // 160 AS INTEGER) END::INTEGER AS n_frames, "
                 "CASE WHEN broken THEN 0 ELSE 80 * (1 + n_out // 160) END::INTEGER AS n_mel, "
                 f"CASE WHEN broken THEN {_ERR} ELSE 'ok' END AS status FROM clips")


@register("extract_features", with_cte(_FEATURE_TWIN, clips=CLIPS_SQL))
def q_extract_features(spark, sf_dir):
    f = _features(spark, sf_dir)
    return f.select("filename", "speaker", "gender", "duration_s", "n_frames",
                    F.size("mel_features").alias("n_mel"), "status")


@register("failure_capture", with_cte(
    f"SELECT {_META}, -1.0::FLOAT AS duration_s, -1 AS n_frames, 0 AS n_mel, {_ERR} AS status FROM clips WHERE broken",
    clips=CLIPS_SQL))
def q_failure_capture(spark, sf_dir):
    f = _features(spark, sf_dir).filter(F.col("status") != "ok")
    return f.select("filename", "speaker", "gender", "duration_s", "n_frames",
                    F.size("mel_features").alias("n_mel"), "status")


@register("write_features", with_cte(
    "SELECT filename, speaker, gender, duration_s, n_frames, n_mel FROM (" + _FEATURE_TWIN + ") WHERE status = 'ok'",
    clips=CLIPS_SQL))
def q_write_features(spark, sf_dir):
    path = scratch_path(spark, "features")
    SA.write_features(_features(spark, sf_dir), path)
    back = spark.read.parquet(path)
    return back.select("filename", "speaker", "gender", "duration_s", "n_frames",
                       F.size("mel_features").alias("n_mel"))


# ------------------------------------------------------------------ per-clip signal operators
def _per_clip(spark, sf_dir, fn: Callable[[int, np.ndarray, int], dict], schema: str):
    """Decode every fixture clip once and apply ``fn`` in an Arrow batch; -1 in every column of a clip that fails."""
    cols = [c.split()[0] for c in schema.split(", ")]

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield from frames(map(measured, pdf["vec_id"], pdf["content"]), cols)

    def measured(vid, blob) -> tuple:
        try:
            y, sr = S.decode_wav(bytes(blob))
            values = fn(int(vid), y, sr)
        except S.AudioDecodeError:
            values = dict.fromkeys(cols[1:], -1)
        return (int(vid), *[values[c] for c in cols[1:]])

    clips = C.synth_clips(X.signals(spark, sf_dir))
    return clips.select("vec_id", "content").mapInPandas(run, schema)


def _per_clip_sql(**cols: str) -> str:
    """Twin of ``_per_clip``: column = (expression, type), -1 for broken clips."""
    return "SELECT vec_id, " + ", ".join(
        f"CAST(CASE WHEN broken THEN -1 ELSE {e} END AS {t}) AS {c}" for c, (e, t) in cols.items()) + " FROM clips"


_FRAMES = "1 + n_out // 160"


@register("decode_wav", with_cte(_per_clip_sql(sample_rate=("16000", "INTEGER"), n_samples=("n_out", "BIGINT")),
                                 clips=CLIPS_SQL))
def q_decode_wav(spark, sf_dir):
    return _per_clip(spark, sf_dir, lambda v, y, sr: {"sample_rate": sr, "n_samples": len(y)},
                     "vec_id long, sample_rate int, n_samples long")


@register("mel_spectrogram", with_cte(_per_clip_sql(n_mels=("80", "INTEGER"), n_frames=(_FRAMES, "INTEGER")),
                                      clips=CLIPS_SQL))
def q_mel_spectrogram(spark, sf_dir):
    def fn(v, y, sr):
        m = S.mel_spectrogram(y, sr)
        return {"n_mels": m.shape[0], "n_frames": m.shape[1]}
    return _per_clip(spark, sf_dir, fn, "vec_id long, n_mels int, n_frames int")


@register("flatten_features", with_cte(_per_clip_sql(n_values=(f"80 * ({_FRAMES})", "BIGINT")), clips=CLIPS_SQL))
def q_flatten_features(spark, sf_dir):
    return _per_clip(spark, sf_dir, lambda v, y, sr: {"n_values": int(S.log_mel_features(y, sr)[0].size)},
                     "vec_id long, n_values long")


@register("frame_stats", with_cte(_per_clip_sql(duration_s=("n_out / 16000", "FLOAT"), n_frames=(_FRAMES, "INTEGER")),
                                  clips=CLIPS_SQL))
def q_frame_stats(spark, sf_dir):
    def fn(v, y, sr):
        _, dur, frames = S.log_mel_features(y, sr)
        return {"duration_s": np.float32(dur), "n_frames": frames}
    return _per_clip(spark, sf_dir, fn, "vec_id long, duration_s float, n_frames int")


_AUG_SEED = 7


@register("aug_gaussian_noise", with_cte(_per_clip_sql(n_samples=("n_out", "BIGINT")), clips=CLIPS_SQL))
def q_aug_gaussian_noise(spark, sf_dir):
    def fn(v, y, sr):
        rng = np.random.default_rng(S.clip_seed(str(v), "gaussian_noise", _AUG_SEED))
        return {"n_samples": len(S.gaussian_noise(y, rng, S.NOISE_SD))}
    return _per_clip(spark, sf_dir, fn, "vec_id long, n_samples long")


@register("aug_pitch_shift", with_cte(_per_clip_sql(n_samples=("n_out", "BIGINT")), clips=CLIPS_SQL))
def q_aug_pitch_shift(spark, sf_dir):
    def fn(v, y, sr):
        rng = np.random.default_rng(S.clip_seed(str(v), "pitch_shift", _AUG_SEED))
        return {"n_samples": len(S.pitch_shift(y, sr, rng.uniform(*S.PITCH_RANGE)))}
    return _per_clip(spark, sf_dir, fn, "vec_id long, n_samples long")


@register("aug_time_stretch", with_cte(
    _per_clip_sql(rate_pct=("85 + vec_id * 37 % 31", "INTEGER"), n_in=("n_out", "BIGINT"),
                  n_samples=("round(n_out / ((85 + vec_id * 37 % 31) / 100.0::double))", "BIGINT")), clips=CLIPS_SQL))
def q_aug_time_stretch(spark, sf_dir):
    """Every clip stretched at a rate between 0.85 and 1.15 that depends on its number."""
    def fn(v, y, sr):
        pct = 85 + v * 37 % 31
        return {"rate_pct": pct, "n_in": len(y), "n_samples": len(S.time_stretch(y, pct / 100.0))}
    return _per_clip(spark, sf_dir, fn, "vec_id long, rate_pct int, n_in long, n_samples long")


# ------------------------------------------------------------------ D11
@register("augment_extract")
def q_augment_extract(spark, sf_dir):
    f = A.augment_extract(_files(spark, sf_dir), seed=_AUG_SEED, partitions=C.partitions(spark))
    return f.select("filename", "speaker", "gender", "augmentation", "duration_s", "n_frames",
                    F.size("mel_features").alias("n_mel"), "status")


# ------------------------------------------------------------------ the whole job and its reports
@register("audio_job_report", with_cte(
    "SELECT augmentation, CASE WHEN vec_id % 3 = 0 THEN 'M' ELSE 'F' END AS gender, count(*) AS total, "
    "count(*) FILTER (WHERE NOT broken) AS success, count(*) FILTER (WHERE broken) AS failed "
    "FROM clips, (SELECT unnest(['gaussian_noise', 'pitch_shift', 'time_stretch', 'time_shift']) AS augmentation) t "
    "GROUP BY ALL", clips=CLIPS_SQL))
def q_audio_job_report(spark, sf_dir):
    """Scan, decode, augment, extract, write once; outcomes (A9) per technique and gender and the summary (A11) are read
    from what was written."""
    from vocalis.operators import features as FE
    path = scratch_path(spark, "augmented")
    A.augment_extract(_files(spark, sf_dir), seed=_AUG_SEED, partitions=C.partitions(spark)) \
        .write.mode("overwrite").parquet(path)
    written = spark.read.parquet(path)
    outcome = written.groupBy("augmentation", "gender").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "ok").alias("success"),
        F.count_if(F.col("status") != "ok").alias("failed"))
    summary = FE.augmentation_summary(written).select("augmentation", "gender", F.col("files").alias("success"))
    return outcome.join(summary, ["augmentation", "gender", "success"])
