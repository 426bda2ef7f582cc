"""Numpy signal kernels used inside the Arrow audio jobs.

Pure functions over one clip; the Spark jobs in ``vocalis.operators.audio``
call them per row of an Arrow batch.  The filterbank and window are built
once per Python worker and cached.
"""

from __future__ import annotations

import functools
import struct
import zlib
from collections.abc import Iterator

import numpy as np

# Audio constants of the feature tables.
SAMPLE_RATE = 16000
N_MELS = 80
HOP_LENGTH = 160
N_FFT = 400
AMIN, TOP_DB = 1e-10, 80.0


class AudioDecodeError(ValueError):
    pass


# ------------------------------------------------------------------ D1
def parse_wav(data: bytes) -> tuple[np.ndarray, int]:
    """RIFF/WAVE bytes -> (float64 samples, shape (n, channels), rate).

    PCM 8/16/24/32-bit integers and 32/64-bit IEEE floats."""
    if data is None or len(data) < 12 or data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        raise AudioDecodeError("not a RIFF/WAVE stream")
    pos, fmt, payload = 12, None, None
    while pos + 8 <= len(data):
        cid, size = data[pos:pos + 4], struct.unpack("<I", data[pos + 4:pos + 8])[0]
        body = data[pos + 8:pos + 8 + size]
        if cid == b"fmt ":
            if len(body) < 16:
                raise AudioDecodeError("short fmt chunk")
            tag, ch, rate, _, _, bits = struct.unpack("<HHIIHH", body[:16])
            if tag == 0xFFFE and len(body) >= 26:  # WAVE_FORMAT_EXTENSIBLE: real tag in the GUID
                tag = struct.unpack("<H", body[24:26])[0]
            fmt = (tag, ch, rate, bits)
        elif cid == b"data":
            payload = body
            if len(body) < size:
                raise AudioDecodeError("truncated data chunk")
            break
        pos += 8 + size + (size & 1)
    if fmt is None or payload is None:
        raise AudioDecodeError("missing fmt or data chunk")
    tag, ch, rate, bits = fmt
    if ch < 1 or rate < 1:
        raise AudioDecodeError("bad channel count or rate")
    width = bits // 8
    usable = len(payload) - len(payload) % (width * ch)
    raw = payload[:usable]
    if tag == 1 and bits == 8:
        x = (np.frombuffer(raw, dtype=np.uint8).astype(np.float64) - 128.0) / 128.0
    elif tag == 1 and bits == 16:
        x = np.frombuffer(raw, dtype="<i2").astype(np.float64) / 32768.0
    elif tag == 1 and bits == 24:
        b = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 3).astype(np.int32)
        v = b[:, 0] | (b[:, 1] << 8) | (b[:, 2] << 16)
        x = np.where(v >= 1 << 23, v - (1 << 24), v).astype(np.float64) / float(1 << 23)
    elif tag == 1 and bits == 32:
        x = np.frombuffer(raw, dtype="<i4").astype(np.float64) / float(1 << 31)
    elif tag == 3 and bits in (32, 64):
        x = np.frombuffer(raw, dtype="<f4" if bits == 32 else "<f8").astype(np.float64)
    else:
        raise AudioDecodeError(f"unsupported format tag {tag} / {bits} bits")
    return x.reshape(-1, ch), rate


def resample(y: np.ndarray, sr_in: int, sr_out: int) -> np.ndarray:
    """Band-limited resampling by spectrum truncation / zero padding;
    output length ceil(n * sr_out / sr_in)."""
    if sr_in == sr_out or len(y) == 0:
        return y.astype(np.float64)
    n_out = int(np.ceil(len(y) * sr_out / sr_in))
    spec = np.fft.rfft(y)
    keep = min(len(spec), n_out // 2 + 1)
    out = np.zeros(n_out // 2 + 1, dtype=complex)
    out[:keep] = spec[:keep]
    return np.fft.irfft(out, n=n_out) * (n_out / len(y))


def decode_wav(data: bytes, sr: int = SAMPLE_RATE) -> tuple[np.ndarray, int]:
    """WAV bytes -> mono float signal at ``sr``."""
    x, rate = parse_wav(data)
    mono = x.mean(axis=1) if x.shape[1] > 1 else x[:, 0]
    return resample(mono, rate, sr), sr


# ------------------------------------------------------------------ D13
def encode_pcm16(y: np.ndarray, sr: int = SAMPLE_RATE, channels: int = 1) -> bytes:
    """Clamp to [-1, 1]; negative x 32768, else x 32767 (truncated);
    44-byte RIFF header, 16-bit PCM."""
    c = np.clip(np.asarray(y, dtype=np.float64), -1.0, 1.0)
    s = np.where(c < 0, c * 32768.0, c * 32767.0).astype(np.int16)
    if channels > 1:
        s = np.repeat(s[:, None], channels, axis=1).reshape(-1)
    body = s.astype("<i2").tobytes()
    header = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(body), b"WAVE", b"fmt ", 16, 1, channels, sr,
                         sr * 2 * channels, 2 * channels, 16, b"data", len(body))
    return header + body


# ------------------------------------------------------------------ D6 / D7 / D8 / D9
@functools.lru_cache(maxsize=8)
def hann(n: int) -> np.ndarray:
    """Periodic Hann window (the spectral-analysis form)."""
    return 0.5 - 0.5 * np.cos(2.0 * np.pi * np.arange(n) / n)


def _hz_to_mel(f):
    f = np.asarray(f, dtype=np.float64)
    f_sp, min_log_hz = 200.0 / 3, 1000.0
    min_log_mel, logstep = min_log_hz / f_sp, np.log(6.4) / 27.0
    return np.where(f >= min_log_hz, min_log_mel + np.log(np.maximum(f, 1e-12) / min_log_hz) / logstep, f / f_sp)


def _mel_to_hz(m):
    m = np.asarray(m, dtype=np.float64)
    f_sp, min_log_hz = 200.0 / 3, 1000.0
    min_log_mel, logstep = min_log_hz / f_sp, np.log(6.4) / 27.0
    return np.where(m >= min_log_mel, min_log_hz * np.exp(logstep * (m - min_log_mel)), f_sp * m)


@functools.lru_cache(maxsize=8)
def mel_filterbank(sr: int = SAMPLE_RATE, n_fft: int = N_FFT, n_mels: int = N_MELS) -> np.ndarray:
    """Slaney-style mel filterbank (triangles on the Slaney mel scale,
    area-normalised), shape (n_mels, 1 + n_fft // 2)."""
    freqs = np.linspace(0.0, sr / 2.0, 1 + n_fft // 2)
    mel_f = _mel_to_hz(np.linspace(_hz_to_mel(0.0), _hz_to_mel(sr / 2.0), n_mels + 2))
    fdiff = np.diff(mel_f)
    ramps = mel_f[:, None] - freqs[None, :]
    lower = -ramps[:-2] / fdiff[:-1, None]
    upper = ramps[2:] / fdiff[1:, None]
    w = np.maximum(0.0, np.minimum(lower, upper))
    return w * (2.0 / (mel_f[2:n_mels + 2] - mel_f[:n_mels]))[:, None]


def stft_power(y: np.ndarray, n_fft: int = N_FFT, hop: int = HOP_LENGTH) -> np.ndarray:
    """|STFT|^2 of a centred (zero-padded) signal, shape (1 + n_fft//2, 1 + len // hop)."""
    return np.concatenate(list(_power_blocks(y, n_fft, hop)), axis=1)


def _power_blocks(y: np.ndarray, n_fft: int, hop: int, block: int = 2048) -> Iterator[np.ndarray]:
    """``stft_power`` in runs of ``block`` frames."""
    pad = n_fft // 2
    frames = np.lib.stride_tricks.sliding_window_view(np.pad(np.asarray(y, dtype=np.float64), (pad, pad)), n_fft)[::hop]
    for i in range(0, len(frames), block):
        yield (np.abs(np.fft.rfft(frames[i:i + block] * hann(n_fft), axis=1)) ** 2).T


def mel_spectrogram(y: np.ndarray, sr: int = SAMPLE_RATE, n_mels: int = N_MELS, hop: int = HOP_LENGTH,
                    n_fft: int = N_FFT) -> np.ndarray:
    """Mel power spectrogram, shape (n_mels, n_frames), block by block."""
    bank = mel_filterbank(sr, n_fft, n_mels)
    return np.concatenate([bank @ p for p in _power_blocks(y, n_fft, hop)], axis=1)


def power_to_db(m: np.ndarray, amin: float = AMIN, top_db: float = TOP_DB) -> np.ndarray:
    """dB relative to the maximum, floored ``top_db`` below the peak."""
    ref = np.max(m) if m.size else 1.0
    db = 10.0 * np.log10(np.maximum(amin, m)) - 10.0 * np.log10(max(amin, ref))
    return np.maximum(db, db.max() - top_db) if db.size else db


def log_mel_features(y: np.ndarray, sr: int = SAMPLE_RATE) -> tuple[np.ndarray, float, int]:
    """Flattened (band by band) log-Mel array, duration, frame count."""
    m = mel_spectrogram(y, sr)
    return power_to_db(m).astype(np.float32).reshape(-1), float(len(y) / sr), int(m.shape[1])


# ------------------------------------------------------------------ D2-D5
def clip_seed(filename: str, technique: str, seed: int) -> int:
    """Deterministic per (file, technique, job seed)."""
    return zlib.crc32(f"{seed}:{technique}:{filename}".encode("utf-8"))


def gaussian_noise(y: np.ndarray, rng: np.random.Generator, sd: float = 0.005) -> np.ndarray:
    """Additive white noise N(0, sd)."""
    return y + rng.normal(0.0, sd, size=y.shape)


def time_shift(y: np.ndarray, n: int) -> np.ndarray:
    """Circular roll by ``n`` samples."""
    return np.roll(y, n)


def _stft(y: np.ndarray, n_fft: int, hop: int) -> np.ndarray:
    pad = n_fft // 2
    yp = np.pad(y, (pad, pad))
    n_frames = 1 + max(0, (len(yp) - n_fft)) // hop
    idx = np.arange(n_fft)[None, :] + hop * np.arange(n_frames)[:, None]
    return np.fft.rfft(yp[idx] * hann(n_fft)[None, :], axis=1).T


def _istft(spec: np.ndarray, n_fft: int, hop: int, length: int) -> np.ndarray:
    frames = np.fft.irfft(spec.T, n=n_fft, axis=1) * hann(n_fft)[None, :]
    n = n_fft + hop * (frames.shape[0] - 1)
    out, norm = np.zeros(n), np.zeros(n)
    w2 = hann(n_fft) ** 2
    for i, f in enumerate(frames):
        out[i * hop:i * hop + n_fft] += f
        norm[i * hop:i * hop + n_fft] += w2
    out = np.where(norm > 1e-10, out / np.maximum(norm, 1e-10), 0.0)[n_fft // 2:]
    return np.pad(out, (0, max(0, length - len(out))))[:length]


def time_stretch(y: np.ndarray, rate: float, n_fft: int = 2048, hop: int = 512) -> np.ndarray:
    """Phase-vocoder time stretch; new length round(len / rate), pitch kept."""
    if len(y) == 0:
        return y
    n_fft = min(n_fft, 1 << int(np.floor(np.log2(max(len(y), 16)))))
    hop = max(1, n_fft // 4)
    spec = _stft(np.asarray(y, dtype=np.float64), n_fft, hop)
    steps = np.arange(0, spec.shape[1], rate)
    spec = np.pad(spec, ((0, 0), (0, 2)))
    expected = np.linspace(0, np.pi * hop, spec.shape[0])
    phase = np.angle(spec[:, 0])
    out = np.empty((spec.shape[0], len(steps)), dtype=complex)
    for t, s in enumerate(steps):
        i = int(s)
        a, b = spec[:, i], spec[:, i + 1]
        frac = s - i
        out[:, t] = ((1 - frac) * np.abs(a) + frac * np.abs(b)) * np.exp(1j * phase)
        dphi = np.angle(b) - np.angle(a) - expected
        dphi -= 2.0 * np.pi * np.round(dphi / (2.0 * np.pi))
        phase += expected + dphi
    return _istft(out, n_fft, hop, int(round(len(y) / rate)))


def pitch_shift(y: np.ndarray, sr: int, n_steps: float) -> np.ndarray:
    """D3: shift pitch by ``n_steps`` semitones keeping the length: stretch
    by 2^(-n/12), then resample back to the original length."""
    if len(y) == 0:
        return y
    rate = 2.0 ** (-n_steps / 12.0)
    stretched = time_stretch(y, rate)
    shifted = resample(stretched, int(round(sr / rate)), sr)
    return np.pad(shifted, (0, max(0, len(y) - len(shifted))))[:len(y)]


# Augmentation parameter ranges.
NOISE_SD = 0.005
PITCH_RANGE = (-2.0, 2.0)
STRETCH_RANGE = (0.85, 1.15)
SHIFT_RANGE_S = (0.05, 0.15)


def augment(y: np.ndarray, sr: int, technique: str, rng: np.random.Generator) -> np.ndarray:
    if technique == "gaussian_noise":
        return gaussian_noise(y, rng, NOISE_SD)
    if technique == "pitch_shift":
        return pitch_shift(y, sr, rng.uniform(*PITCH_RANGE))
    if technique == "time_stretch":
        return time_stretch(y, rng.uniform(*STRETCH_RANGE))
    if technique == "time_shift":
        return time_shift(y, int(sr * rng.uniform(*SHIFT_RANGE_S)))
    if technique in ("none", None):
        return y
    raise ValueError(f"unknown augmentation {technique}")


