"""Audio features: decode PCM/WAV, resample to 16 kHz, log-Mel spectrogram over a fixed 30 s frame.

Runs inside ``mapInPandas``: Spark partitions the rows, numpy does the per-clip signal work.
Output per row: ``input_features`` (n_mels x 3000), ``input_length`` (seconds of audio after
resampling, before padding), or a ``reject_reason``. Model codecs (MP3 through ffmpeg) are out of
scope; an injected ``decoder(bytes) -> (samples, rate, channels)`` can replace the WAV reader.
"""

from __future__ import annotations

import io
import wave

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Fixed values of the log-Mel front end: 16 kHz, 25 ms window (400), 10 ms hop (160), 30 s frame.
SAMPLE_RATE = 16000
N_FFT = 400
HOP = 160
CHUNK_SECONDS = 30
N_SAMPLES = SAMPLE_RATE * CHUNK_SECONDS


def audio_seconds(samples_col) -> "F.Column":
    """Length in seconds of a 16 kHz sample array."""
    c = F.col(samples_col) if isinstance(samples_col, str) else samples_col
    return (F.size(c) / F.lit(float(SAMPLE_RATE))).cast("double")


def _hz_to_mel(f):
    f = np.asarray(f, dtype=np.float64)
    f_sp = 200.0 / 3
    mels = f / f_sp
    min_log_hz = 1000.0
    min_log_mel = min_log_hz / f_sp
    logstep = np.log(6.4) / 27.0
    return np.where(f >= min_log_hz, min_log_mel + np.log(np.maximum(f, 1e-10) / min_log_hz) / logstep, mels)


def _mel_to_hz(m):
    m = np.asarray(m, dtype=np.float64)
    f_sp = 200.0 / 3
    freqs = f_sp * m
    min_log_hz = 1000.0
    min_log_mel = min_log_hz / f_sp
    logstep = np.log(6.4) / 27.0
    return np.where(m >= min_log_mel, min_log_hz * np.exp(logstep * (m - min_log_mel)), freqs)


def mel_filters(n_mels: int = 80, n_fft: int = N_FFT, sr: int = SAMPLE_RATE) -> np.ndarray:
    """Slaney-scale, area-normalised triangular filters, shape (n_mels, 1 + n_fft // 2)."""
    fft_freqs = np.linspace(0, sr / 2, 1 + n_fft // 2)
    mel_pts = np.linspace(_hz_to_mel(0.0), _hz_to_mel(sr / 2), n_mels + 2)
    hz_pts = _mel_to_hz(mel_pts)
    fdiff = np.diff(hz_pts)
    ramps = hz_pts[:, None] - fft_freqs[None, :]
    lower = -ramps[:-2] / fdiff[:-1, None]
    upper = ramps[2:] / fdiff[1:, None]
    weights = np.maximum(0, np.minimum(lower, upper))
    enorm = 2.0 / (hz_pts[2:n_mels + 2] - hz_pts[:n_mels])
    return (weights * enorm[:, None]).astype(np.float64)


def log_mel(samples: np.ndarray, n_mels: int = 80, filters: np.ndarray | None = None) -> np.ndarray:
    """(n_mels, 3000) float32 log-Mel of the first 30 s, zero-padded.

    Frames lying wholly in the zero padding after the signal have zero power, hence the floor value
    log10(1e-10) = -10 before the dynamic-range clamp; only frames that touch the signal are
    transformed (the same result as transforming all of them, at a fraction of the cost for short
    clips).
    """
    s = np.asarray(samples, dtype=np.float64)[:N_SAMPLES]
    x = np.zeros(N_SAMPLES, dtype=np.float64)
    x[:len(s)] = s
    pad = N_FFT // 2
    xp = np.pad(x, (pad, pad), mode="reflect")
    n_frames = 1 + (len(xp) - N_FFT) // HOP - 1  # the last frame is dropped
    # frame t covers xp[t*HOP : t*HOP + N_FFT] = x[t*HOP - pad : ...]; zero once t*HOP - pad >= len(s)
    active = min(n_frames, (len(s) + pad) // HOP + 1)
    idx = np.arange(N_FFT)[None, :] + HOP * np.arange(active)[:, None]
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(N_FFT) / N_FFT)  # periodic Hann
    spec = np.fft.rfft(xp[idx] * window, axis=1)
    power = (np.abs(spec) ** 2).T
    fb = filters if filters is not None else mel_filters(n_mels)
    logm = np.full((fb.shape[0], n_frames), -10.0)
    logm[:, :active] = np.log10(np.maximum(fb @ power, 1e-10))
    logm = np.maximum(logm, logm.max() - 8.0)
    return ((logm + 4.0) / 4.0).astype(np.float32)


def log_mel_reference(samples: np.ndarray, n_mels: int = 80) -> np.ndarray:
    """Every frame transformed (no shortcut); used to check :func:`log_mel`."""
    x = np.zeros(N_SAMPLES, dtype=np.float64)
    s = np.asarray(samples, dtype=np.float64)[:N_SAMPLES]
    x[:len(s)] = s
    xp = np.pad(x, (N_FFT // 2, N_FFT // 2), mode="reflect")
    n = 1 + (len(xp) - N_FFT) // HOP
    idx = np.arange(N_FFT)[None, :] + HOP * np.arange(n)[:, None]
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(N_FFT) / N_FFT)
    power = (np.abs(np.fft.rfft(xp[idx] * window, axis=1)) ** 2).T[:, :-1]
    logm = np.log10(np.maximum(mel_filters(n_mels) @ power, 1e-10))
    logm = np.maximum(logm, logm.max() - 8.0)
    return ((logm + 4.0) / 4.0).astype(np.float32)


def resample(samples: np.ndarray, orig_sr: int, new_sr: int = SAMPLE_RATE, width: int = 6,
             rolloff: float = 0.99) -> np.ndarray:
    """Band-limited resampling with a Hann-windowed sinc kernel."""
    if orig_sr == new_sr:
        return np.asarray(samples, dtype=np.float64)
    from math import gcd
    g = gcd(orig_sr, new_sr)
    up, down = new_sr // g, orig_sr // g
    x = np.asarray(samples, dtype=np.float64)
    n_out = int(np.ceil(len(x) * up / down))
    base = min(up, down) * rolloff
    half = int(np.ceil(width * down / base))
    t_out = np.arange(n_out) * down / up  # positions in input samples
    k = np.arange(-half, half + 1)
    pos = np.floor(t_out).astype(np.int64)[:, None] + k[None, :]
    frac = t_out[:, None] - pos
    arg = frac * base / down
    w = np.where(np.abs(arg) <= width / 1.0, 0.5 + 0.5 * np.cos(np.pi * arg / width), 0.0)
    kern = np.sinc(arg) * w * base / down
    valid = (pos >= 0) & (pos < len(x))
    vals = np.where(valid, x[np.clip(pos, 0, max(len(x) - 1, 0))], 0.0) if len(x) else np.zeros_like(kern)
    return (vals * kern).sum(axis=1)


def read_wav(data: bytes):
    """(samples float64 in [-1, 1] shaped (frames, channels), rate, channels) from PCM WAV bytes."""
    with wave.open(io.BytesIO(data)) as w:
        ch, width, rate, n = w.getnchannels(), w.getsampwidth(), w.getframerate(), w.getnframes()
        raw = w.readframes(n)
    if width == 2:
        a = np.frombuffer(raw, dtype="<i2").astype(np.float64) / 32768.0
    elif width == 1:
        a = (np.frombuffer(raw, dtype=np.uint8).astype(np.float64) - 128.0) / 128.0
    elif width == 4:
        a = np.frombuffer(raw, dtype="<i4").astype(np.float64) / 2147483648.0
    else:
        raise ValueError(f"unsupported sample width {width}")
    return a.reshape(-1, ch), rate, ch


def _features_schema(id_type: str, summary: bool) -> str:
    if summary:
        return (f"id {id_type}, input_length double, n_mels int, n_frames int, feat_mean double, "
                "feat_max double, reject_reason string")
    return f"id {id_type}, input_features array<array<float>>, input_length double, reject_reason string"


def _emit(ids, feats, lengths, reasons, summary):
    if summary:
        return pd.DataFrame({
            "id": ids, "input_length": lengths,
            "n_mels": pd.array([None if f is None else f.shape[0] for f in feats], dtype="Int32"),
            "n_frames": pd.array([None if f is None else f.shape[1] for f in feats], dtype="Int32"),
            "feat_mean": [None if f is None else float(f.mean()) for f in feats],
            "feat_max": [None if f is None else float(f.max()) for f in feats],
            "reject_reason": reasons})
    return pd.DataFrame({"id": ids, "input_features": [None if f is None else list(f) for f in feats],
                         "input_length": lengths, "reject_reason": reasons})


def log_mel_features(df: DataFrame, id_col: str, audio_col: str, n_mels: int = 80, downmix: bool = False,
                     decoder=None, summary: bool = False, rows_per_output: int = 32,
                     max_seconds: float | None = None) -> DataFrame:
    """Features from encoded audio bytes (WAV by default). Rejects: ``audio_missing``,
    ``audio_undecodable``, ``multi_channel`` (unless ``downmix``), ``too_long`` (only when
    ``max_seconds`` is given; off by default), ``feature_error``."""
    id_type = df.schema[id_col].dataType.simpleString()
    read = decoder or read_wav

    def run(batches):
        fb = mel_filters(n_mels)
        for pdf in batches:
            for start in range(0, len(pdf), rows_per_output):
                part = pdf.iloc[start:start + rows_per_output]
                ids, feats, lens, reasons = [], [], [], []
                for rid, data in zip(part[id_col], part[audio_col]):
                    ids.append(rid)
                    f, ln, why = None, None, None
                    if data is None or len(data) == 0:
                        why = "audio_missing"
                    else:
                        try:
                            samples, rate, ch = read(bytes(data))
                        except Exception:  # noqa: BLE001 - any decode failure is a reject
                            samples, why = None, "audio_undecodable"
                        if samples is not None:
                            if ch > 1 and not downmix:
                                why = "multi_channel"
                            else:
                                try:
                                    mono = samples.mean(axis=1) if samples.ndim == 2 else samples
                                    mono = resample(mono, rate)
                                    ln = len(mono) / SAMPLE_RATE
                                    if max_seconds is not None and ln > max_seconds:
                                        why = "too_long"
                                    else:
                                        f = log_mel(mono, n_mels, fb)
                                except Exception:  # noqa: BLE001
                                    f, ln, why = None, None, "feature_error"
                    feats.append(f)
                    lens.append(ln)
                    reasons.append(why)
                yield _emit(ids, feats, lens, reasons, summary)

    src = df.select(F.col(id_col), F.col(audio_col))
    out = src.mapInPandas(run, _features_schema(id_type, summary))
    return out.withColumnRenamed("id", id_col)


def log_mel_from_samples(df: DataFrame, id_col: str, samples_col: str, sample_rate: int = SAMPLE_RATE,
                         n_mels: int = 80, summary: bool = False, rows_per_output: int = 32) -> DataFrame:
    """Features from arrays of PCM samples (float, nominally in [-1, 1])."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches):
        fb = mel_filters(n_mels)
        for pdf in batches:
            for start in range(0, len(pdf), rows_per_output):
                part = pdf.iloc[start:start + rows_per_output]
                ids, feats, lens, reasons = [], [], [], []
                for rid, s in zip(part[id_col], part[samples_col]):
                    ids.append(rid)
                    if s is None or len(s) == 0:
                        feats.append(None)
                        lens.append(None)
                        reasons.append("audio_missing")
                        continue
                    mono = resample(np.asarray(s, dtype=np.float64), sample_rate)
                    feats.append(log_mel(mono, n_mels, fb))
                    lens.append(len(mono) / SAMPLE_RATE)
                    reasons.append(None)
                yield _emit(ids, feats, lens, reasons, summary)

    src = df.select(F.col(id_col), F.col(samples_col))
    out = src.mapInPandas(run, _features_schema(id_type, summary))
    return out.withColumnRenamed("id", id_col)


def fetch_audio(df: DataFrame, id_col: str, location_col: str, loader, tries: int = 3, delay: float = 5.0) -> DataFrame:
    """Load each row's audio bytes with an injected ``loader(location) -> bytes``: up to ``tries``
    attempts ``delay`` seconds apart; after the last failure the row carries ``error`` instead of
    bytes (and later becomes an ``audio_missing`` reject). One loader per task."""
    import time as _time

    id_type = df.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {id_type}, {location_col} string, audio binary, attempts int, error string"

    def run(batches):
        for pdf in batches:
            audio, att, err = [], [], []
            for loc in pdf[location_col]:
                data, last, n = None, None, 0
                for n in range(1, tries + 1):
                    try:
                        data = loader(loc)
                        last = None
                        break
                    except Exception as e:  # noqa: BLE001 - retried, then recorded
                        last = f"{type(e).__name__}: {e}"
                        if n < tries and delay:
                            _time.sleep(delay)
                audio.append(data)
                att.append(n)
                err.append(last)
            yield pd.DataFrame({id_col: pdf[id_col], location_col: pdf[location_col], "audio": audio,
                                "attempts": pd.array(att, dtype="Int32"), "error": err})

    return df.select(id_col, F.col(location_col).cast("string").alias(location_col)).mapInPandas(run, schema)


def wav_bytes(samples, rate: int = SAMPLE_RATE):
    """Column: 16-bit mono PCM WAV bytes of an array of float samples in [-1, 1]."""
    from pyspark.sql.types import BinaryType

    @F.pandas_udf(BinaryType())
    def _encode(col: pd.Series) -> pd.Series:
        out = []
        for s in col:
            if s is None:
                out.append(None)
                continue
            pcm = (np.clip(np.asarray(s, dtype=np.float64), -1.0, 1.0) * 32767).astype("<i2")
            buf = io.BytesIO()
            with wave.open(buf, "wb") as w:
                w.setnchannels(1)
                w.setsampwidth(2)
                w.setframerate(rate)
                w.writeframes(pcm.tobytes())
            out.append(buf.getvalue())
        return pd.Series(out, dtype="object")

    return _encode(F.col(samples) if isinstance(samples, str) else samples)


class WavFeatures:
    """The feature function of the preparation job: WAV bytes -> (log-Mel, seconds) of its 16 kHz mono signal."""

    def __init__(self, n_mels: int = 80, downmix: bool = False, read=read_wav):
        self.n_mels, self.downmix, self.read = n_mels, downmix, read

    def __call__(self, data: bytes):
        from asrprep.operators.preparation import Reject
        try:
            samples, rate, channels = self.read(data)
        except Exception as e:  # noqa: BLE001 - not audio
            raise Reject("audio_undecodable") from e
        if channels > 1 and not self.downmix:
            raise Reject("multi_channel")
        mono = resample(samples.mean(axis=1), rate)
        return log_mel(mono, self.n_mels), len(mono) / SAMPLE_RATE
