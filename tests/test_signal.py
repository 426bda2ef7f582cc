"""Audio kernels and jobs: property tests on generated WAVs."""

import struct

import numpy as np
import pandas as pd
import pytest

from vocalis.operators import audio as A
from vocalis.operators import signal as S
from vocalis.sources import audio as SA


def sine(freq=440.0, sr=16000, secs=1.0, amp=0.5):
    t = np.arange(int(sr * secs)) / sr
    return amp * np.sin(2 * np.pi * freq * t)


def test_wav_round_trip_mono_16k():
    y = sine()
    out, sr = S.decode_wav(S.encode_pcm16(y, 16000))
    assert sr == 16000 and len(out) == len(y)
    assert np.max(np.abs(out - y)) < 1e-4


def test_stereo_and_resampling():
    y44 = sine(440, 44100, 0.5)
    out, sr = S.decode_wav(S.encode_pcm16(y44, 44100, channels=2))
    assert len(out) == int(np.ceil(len(y44) * 16000 / 44100))
    spec = np.abs(np.fft.rfft(out))
    assert abs(np.argmax(spec) * 16000 / len(out) - 440) < 3
    y8, _ = S.decode_wav(S.encode_pcm16(sine(300, 8000, 1.0), 8000))
    assert len(y8) == 16000


def test_pcm16_mapping_and_header():
    blob = S.encode_pcm16(np.array([-2.0, -1.0, -0.5, 0.0, 0.5, 1.0, 3.0]), 16000)
    assert blob[:4] == b"RIFF" and blob[8:16] == b"WAVEfmt " and len(blob) == 44 + 14
    samples = struct.unpack("<7h", blob[44:])
    assert samples == (-32768, -32768, -16384, 0, 16383, 32767, 32767)


@pytest.mark.parametrize("blob", [b"", b"RIFF\x00\x00", b"NOTAWAVEfile", S.encode_pcm16(sine(), 16000)[:30]])
def test_broken_inputs_raise(blob):
    with pytest.raises(S.AudioDecodeError):
        S.decode_wav(blob)


def test_mel_shapes_and_db_floor():
    y = sine(secs=1.0)
    m = S.mel_spectrogram(y)
    assert m.shape == (80, 1 + len(y) // 160)
    db = S.power_to_db(m)
    assert db.max() == 0.0 and db.min() >= -80.0
    flat, dur, frames = S.log_mel_features(y)
    assert flat.dtype == np.float32 and flat.size == 80 * frames and dur == 1.0
    silence, _, fr = S.log_mel_features(np.zeros(1600))
    assert fr == 11 and np.all(silence == 0.0)


def test_filterbank_peaks_follow_frequency():
    fb = S.mel_filterbank()
    low = S.mel_spectrogram(sine(200)).sum(axis=1).argmax()
    high = S.mel_spectrogram(sine(4000)).sum(axis=1).argmax()
    assert fb.shape == (80, 201) and low < high


def test_augmentations():
    rng = np.random.default_rng(0)
    y = sine(440, 16000, 1.0)
    noisy = S.gaussian_noise(y, rng, 0.005)
    assert len(noisy) == len(y) and 0.003 < np.std(noisy - y) < 0.007
    assert np.array_equal(S.time_shift(y, 100)[100:], y[:-100])
    stretched = S.time_stretch(y, 1.1)
    assert len(stretched) == round(len(y) / 1.1)
    shifted = S.pitch_shift(y, 16000, 2.0)
    assert len(shifted) == len(y)
    f = np.argmax(np.abs(np.fft.rfft(shifted))) * 16000 / len(shifted)
    assert abs(f - 440 * 2 ** (2 / 12)) < 15


def test_augment_is_seeded():
    y = sine()
    a = S.augment(y, 16000, "pitch_shift", np.random.default_rng(S.clip_seed("f.wav", "pitch_shift", 1)))
    b = S.augment(y, 16000, "pitch_shift", np.random.default_rng(S.clip_seed("f.wav", "pitch_shift", 1)))
    assert np.array_equal(a, b)


def test_scan_extract_and_write(spark, tmp_path):
    root = tmp_path / "audio"
    files = {"Synthetic_Male/spk1/a.wav": S.encode_pcm16(sine(), 16000),
             "Synthetic_Female/spk2/b.wav": S.encode_pcm16(sine(300, 8000, 0.5), 8000, 2),
             "spk3/broken.wav": b"garbage",
             "spk3/notes.txt": b"not audio"}
    for rel, blob in files.items():
        p = root / rel
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(blob)
    listing = SA.scan_audio(spark, str(root))
    assert listing.count() == 3
    feats = A.extract_features(A.with_path_metadata(listing)).collect()
    by = {r.filename: r for r in feats}
    assert by["a.wav"].gender == "M" and by["a.wav"].speaker == "spk1" and by["a.wav"].n_frames == 101
    assert by["b.wav"].gender == "F" and abs(by["b.wav"].duration_s - 0.5) < 1e-6
    assert by["broken.wav"].status.startswith("error:") and by["broken.wav"].n_frames == -1
    assert len(by["a.wav"].mel_features) == 80 * 101
    aug = A.augment_extract(A.with_path_metadata(listing), seed=3).collect()
    assert len(aug) == 12 and sum(r.status == "ok" for r in aug) == 8
    out = str(tmp_path / "features")
    SA.write_features(A.extract_features(A.with_path_metadata(listing)), out)
    back = spark.read.parquet(out)
    assert back.count() == 2 and "status" not in back.columns


# ------------------------------------------------------------------ frames of bounded size
def test_feature_stages_hand_on_small_frames():
    from vocalis.operators import audio as A
    from vocalis.operators.batches import FRAME_BYTES
    from vocalis.streaming import features as SF
    blob = S.encode_pcm16(0.1 * np.sin(np.arange(16000) / 5.0))
    n = 300
    files = pd.DataFrame({"filename": [f"c{i}.wav" for i in range(n)], "speaker": ["s"] * n, "gender": ["M"] * n,
                          "content": [b"bad" if i == 7 else None if i == 8 else blob for i in range(n)]})
    messages = files.assign(kafka_ts=pd.Timestamp("2024-01-01"), audio_bytes=files["content"])
    for run, pdf, rows in ((A._extract_batches, files, n), (A._augment_batches(["gaussian_noise", "time_shift"], 7), files, 2 * n),
                           (SF._batches, messages, n)):
        out = list(run(iter([pdf, pdf.iloc[:0]])))
        assert sum(len(f) for f in out) == rows
        assert len(out) > 1 and all(sum(m.nbytes for m in f["mel_features"]) < FRAME_BYTES + (1 << 16) for f in out)
        whole = pd.concat(out)
        assert list(dict.fromkeys(whole["filename"])) == list(files["filename"])
        assert (whole["duration_s"] == -1).sum() == 2 * rows // n and whole["duration_s"].dtype == np.float32


def test_clips_come_in_small_frames(spark):
    from pyspark.sql import functions as F
    from vocalis.plans import clips as C
    ids = spark.range(0, 600, 1, 1).select(F.col("id").alias("vec_id"), F.array(F.lit(0.5)).alias("embedding"))
    clips = C.synth_clips(ids, seconds=1.0)

    def sizes(it):
        for batch in it:
            yield batch.select(["vec_id"]).slice(0, 1)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(16 * 1024 * 1024)
    assert clips.select("vec_id", "content").mapInArrow(sizes, "vec_id long").count() > 1
    assert clips.select("vec_id").distinct().count() == 600


def test_tables_cap_the_batches_of_any_session(spark):
    from conftest import SF_SMALL
    from vocalis.plans import fixtures as X
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        X.signals(spark, SF_SMALL)
        assert spark.conf.get(key) == str(16 * 1024 * 1024)
        spark.conf.set(key, "8m")
        X.signals(spark, SF_SMALL)
        assert spark.conf.get(key) == "8m"
    finally:
        spark.conf.set(key, before)
