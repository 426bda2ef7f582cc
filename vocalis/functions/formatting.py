"""Scalar Column functions: paths, media types, sizes, durations, bands.

All are CASE / string built-ins, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------------ P1
def normalize_path(path: Column | str) -> Column:
    return F.replace(_c(path), F.lit("\\"), F.lit("/"))


def basename(path: Column | str) -> Column:
    return F.substring_index(normalize_path(path), "/", -1)


def parent_dir(path: Column | str, default: str = "unknown") -> Column:
    """Name of the directory holding the file; ``default`` for a bare name."""
    parts = F.split(normalize_path(path), "/", -1)
    return F.when(F.size(parts) >= 2, F.element_at(parts, -2)).otherwise(F.lit(default))


def gender_from_path(path: Column | str, default: str = "F") -> Column:
    """``M`` when the lower-cased path mentions ``male`` but not ``female``;
    otherwise ``default`` (the reference's default is ``F``)."""
    low = F.lower(_c(path))
    return F.when(low.contains("male") & ~low.contains("female"), F.lit("M")).otherwise(F.lit(default))


# ------------------------------------------------------------------ P7 / P8
# Extension lists of the media-type fallback.
AUDIO_EXTS = ["mp3", "wav", "ogg", "flac", "aac", "m4a", "wma", "webm"]
VIDEO_EXTS = ["mp4", "avi", "mkv", "mov", "wmv", "flv", "webm", "m4v"]


def last_dot_part(filename: Column | str) -> Column:
    """Text after the last dot (the whole name when there is no dot)."""
    return F.substring_index(_c(filename), ".", -1)


def media_type(mime: Column | str, filename: Column | str) -> Column:
    """MIME prefix first, else extension list (audio checked first)."""
    m = F.coalesce(_c(mime), F.lit(""))
    ext = F.lower(F.coalesce(last_dot_part(filename), F.lit("")))
    return (F.when(m.startswith("audio/"), F.lit("audio"))
            .when(m.startswith("video/"), F.lit("video"))
            .when(ext.isin(AUDIO_EXTS), F.lit("audio"))
            .when(ext.isin(VIDEO_EXTS), F.lit("video"))
            .otherwise(F.lit("unknown")))


def file_extension(filename: Column | str) -> Column:
    """Upper-cased text after the last dot, ``UNKNOWN`` when empty."""
    e = F.upper(last_dot_part(filename))
    return F.when(F.coalesce(e, F.lit("")) == "", F.lit("UNKNOWN")).otherwise(e)


# ------------------------------------------------------------------ F11
# Size units.
SIZE_UNITS = ["B", "KB", "MB", "GB"]


def format_file_size(nbytes: Column | str) -> Column:
    """``0 B``; unit = floor(log1024(bytes)) clamped to GB; one
    decimal, a trailing ``.0`` dropped."""
    b = _c(nbytes).cast("double")
    k = F.lit(1024.0)
    unit = (F.when(b < k, 0).when(b < k * k, 1).when(b < k * k * k, 2).otherwise(3))
    scaled = F.round(b / F.pow(k, unit), 1)
    txt = F.regexp_replace(scaled.cast("string"), r"\.0$", "")
    label = F.element_at(F.array(*[F.lit(u) for u in SIZE_UNITS]), unit + 1)
    return F.when(b == 0, F.lit("0 B")).otherwise(F.concat(txt, F.lit(" "), label))


# ------------------------------------------------------------------ F12
def format_duration(seconds: Column | str) -> Column:
    """``m:ss``."""
    s = _c(seconds).cast("double")
    mins = F.floor(s / 60).cast("bigint")
    secs = F.floor(s % 60).cast("bigint")
    return F.concat(mins.cast("string"), F.lit(":"), F.lpad(secs.cast("string"), 2, "0"))


# ------------------------------------------------------------------ F13 / F16 / F18
# Frequency grade -> base confidence (anything else 0.7).
FREQ_CONFIDENCE = {"high": 0.9, "medium": 0.7, "low": 0.5}
DEFAULT_CONFIDENCE = 0.7


def freq_to_confidence(freq: Column | str) -> Column:
    f = _c(freq)
    out = F.lit(DEFAULT_CONFIDENCE)
    for name, v in reversed(list(FREQ_CONFIDENCE.items())):
        out = F.when(f == name, F.lit(v)).otherwise(out)
    return out


def confidence_band(conf: Column | str) -> Column:
    """F16: >= .95 high, >= .85 mid, else low."""
    c = _c(conf)
    return F.when(c >= 0.95, F.lit("high")).when(c >= 0.85, F.lit("mid")).otherwise(F.lit("low"))


def round_half_up(c: Column | str, digits: int) -> Column:
    """SQL ROUND (half away from zero, unlike Python's half-even)."""
    return F.round(_c(c), digits)


# ------------------------------------------------------------------ P2
def parse_audio_key(key: Column | str) -> dict[str, Column]:
    """Kafka key bytes -> JSON text -> speaker / gender / filename."""
    meta = _c(key).cast("string")
    return {
        "meta_json": meta,
        "speaker": F.get_json_object(meta, "$.speaker"),
        "gender": F.get_json_object(meta, "$.gender"),
        "filename": F.get_json_object(meta, "$.filename"),
    }
