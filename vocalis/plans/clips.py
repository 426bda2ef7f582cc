"""Fixture clips: WAV files derived from the ``embeddings`` rows.

Rate (16 / 8 / 22.05 kHz), channels (mono or stereo) and length (0.25-1.0 s)
are functions of ``vec_id``; every value of the row gives one tone; every 50th
row starting at 7 is corrupted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalis.operators import signal as S
from vocalis.operators.batches import frames
from vocalis.operators.relational import spread

CLIP_SCHEMA = "vec_id long, rel_path string, content binary"


def partitions(spark: SparkSession) -> int | None:
    """Tasks for CPU-heavy fixture stages over one-split tables (``spark.vocalis.partitions``; unset: as scanned)."""
    n = spark.conf.get("spark.vocalis.partitions", None)
    return int(n) if n else None


def clip_rate(vec_id: int) -> int:
    return (16000, 8000, 22050)[vec_id % 3]


def clip_channels(vec_id: int) -> int:
    return 2 if vec_id % 4 == 1 else 1


def clip_samples(vec_id: int, seconds: float | None = None) -> int:
    if seconds is not None:
        return int(clip_rate(vec_id) * seconds)
    return clip_rate(vec_id) * (250 + (vec_id % 7) * 125) // 1000


def clip_rel_path(vec_id: int) -> str:
    group = ("Male_group", "Female_group", "other_group")[vec_id % 3]
    return f"{group}/speaker_{vec_id % 5}/clip_{vec_id}.wav"


def clip_signal(vec_id: int, embedding, seconds: float | None = None) -> np.ndarray:
    """A base tone and one tone per value, 40 Hz apart from 300 Hz, summed by Horner's rule."""
    sr, n = clip_rate(vec_id), clip_samples(vec_id, seconds)
    t = np.arange(n) / sr
    values = np.tanh(np.asarray(embedding if embedding is not None else [], dtype=np.float64))
    step = np.exp(2j * np.pi * 40.0 * t)
    tones = np.zeros(n, dtype=complex)
    for a in values[::-1]:
        tones = tones * step + a
    tones *= np.exp(2j * np.pi * 300.0 * t)
    return 0.3 * np.sin(2 * np.pi * (220.0 + 10.0 * (vec_id % 20)) * t) + 0.16 / max(1, len(values)) * tones.imag


def synth_clips(signals: DataFrame, seconds: float | None = None) -> DataFrame:
    """(vec_id, rel_path, content): one clip per row of ``signals`` (vec_id, embedding)."""
    def clip(vid, emb) -> tuple[int, str, bytes]:
        vid = int(vid)
        blob = S.encode_pcm16(clip_signal(vid, emb, seconds), clip_rate(vid), clip_channels(vid))
        return vid, clip_rel_path(vid), b"NOTAWAVE" + blob[8:] if vid % 50 == 7 else blob

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield from frames(map(clip, pdf["vec_id"], pdf["embedding"]), ("vec_id", "rel_path", "content"), 2)

    return spread(signals.select("vec_id", "embedding"), partitions(signals.sparkSession)).mapInPandas(run, CLIP_SCHEMA)


def clips_as_files(clips: DataFrame, root: str = "/audio") -> DataFrame:
    """Shape clips like a ``binaryFile`` listing (path, length, content)."""
    return clips.select(F.concat(F.lit(root.rstrip("/") + "/"), "rel_path").alias("path"),
                        F.length("content").cast("long").alias("length"), "content")
