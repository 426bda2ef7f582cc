"""Audio jobs as Arrow-batched Spark operators.

Path-derived metadata (filename, speaker, gender) is computed with
built-in expressions *before* the Python stage, so filters on it are
pushed into the scan; the Python stage only sees (metadata, bytes).
Every file is decoded once; the augmentation job emits all technique rows
from that single decode.  A file that fails to decode is kept as a
sentinel row (-1 duration, -1 frames, empty features, ``error: ...``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vocalis.functions.formatting import basename, gender_from_path, parent_dir
from vocalis.operators import signal as S
from vocalis.operators.batches import frames
from vocalis.operators.features import TECHNIQUES
from vocalis.operators.relational import spread

FEATURE_SCHEMA = T.StructType([
    T.StructField("filename", T.StringType(), False),
    T.StructField("speaker", T.StringType(), True),
    T.StructField("gender", T.StringType(), True),
    T.StructField("duration_s", T.FloatType(), True),
    T.StructField("n_frames", T.IntegerType(), True),
    T.StructField("mel_features", T.ArrayType(T.FloatType()), True),
    T.StructField("status", T.StringType(), True),
])

AUGMENTED_SCHEMA = T.StructType(
    FEATURE_SCHEMA.fields[:3] + [T.StructField("augmentation", T.StringType(), True)] + FEATURE_SCHEMA.fields[3:])

_EMPTY = np.zeros(0, dtype=np.float32)


def with_path_metadata(df: DataFrame, path: str = "path") -> DataFrame:
    """P1 on a file listing: filename, speaker (parent folder), gender."""
    return df.withColumn("filename", basename(path)) \
             .withColumn("speaker", parent_dir(path)) \
             .withColumn("gender", gender_from_path(path))


def _feature_row(content) -> tuple[float, int, np.ndarray, str]:
    try:
        y, sr = S.decode_wav(bytes(content) if content is not None else None)
        mel, dur, frames = S.log_mel_features(y, sr)
        return dur, frames, mel, "ok"
    except Exception as e:  # noqa: BLE001 - every failure becomes a sentinel row
        return -1.0, -1, _EMPTY, f"error: {e}"


_NUMBERS = {"duration_s": np.float32, "n_frames": np.int32}


def _extract_batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in it:
        rows = ((fn, spk, gen, *_feature_row(content))
                for fn, spk, gen, content in zip(pdf["filename"], pdf["speaker"], pdf["gender"], pdf["content"]))
        yield from frames(rows, FEATURE_SCHEMA.names, FEATURE_SCHEMA.names.index("mel_features"), _NUMBERS)


def extract_features(files: DataFrame, partitions: int | None = None) -> DataFrame:
    """(filename, speaker, gender, content) -> log-Mel feature rows, on ``partitions`` tasks (default: as read)."""
    cols = files.select("filename", "speaker", "gender", "content")
    return spread(cols, partitions).mapInPandas(_extract_batches, FEATURE_SCHEMA)


def _augment_batches(techniques: Sequence[str], seed: int):
    def augmented(pdf: pd.DataFrame) -> Iterator[tuple]:
        for fn, spk, gen, content in zip(pdf["filename"], pdf["speaker"], pdf["gender"], pdf["content"]):
            try:
                y, sr = S.decode_wav(bytes(content) if content is not None else None)
                err = None
            except Exception as e:  # noqa: BLE001
                y, sr, err = None, S.SAMPLE_RATE, f"error: {e}"
            for tech in techniques:
                if err is None:
                    try:
                        rng = np.random.default_rng(S.clip_seed(fn, tech, seed))
                        mel, dur, n_frames = S.log_mel_features(S.augment(y, sr, tech, rng), sr)
                        row = (dur, n_frames, mel, "ok")
                    except Exception as e:  # noqa: BLE001
                        row = (-1.0, -1, _EMPTY, f"error: {e}")
                else:
                    row = (-1.0, -1, _EMPTY, err)
                yield (fn, spk, gen, tech, *row)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield from frames(augmented(pdf), AUGMENTED_SCHEMA.names, AUGMENTED_SCHEMA.names.index("mel_features"), _NUMBERS)
    return run


def augment_extract(files: DataFrame, techniques: Sequence[str] = TECHNIQUES, seed: int = 0,
                    partitions: int | None = None) -> DataFrame:
    """D11 (J1 + D1-D9): every file x every technique, decoded once per file,
    augmentation seeded by (filename, technique, seed) so re-runs and task
    retries give identical rows."""
    return spread(files.select("filename", "speaker", "gender", "content"), partitions).mapInPandas(
        _augment_batches(list(techniques), seed), AUGMENTED_SCHEMA)
