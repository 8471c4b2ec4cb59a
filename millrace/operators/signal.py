"""Measures of sampled signals, held as arrays: framing, frame statistics, spectra, quality.

Framing, root mean squares, crossings and deltas are array expressions; spectra run in Arrow batches with NumPy, one
matrix product per frame size. A signal of any length is one row; empty and null ones have null measures.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FRAME, HOP = 2048, 512


def frames(x: Column, size: int = FRAME, hop: int = HOP) -> Column:
    """Windows of ``size`` samples, ``hop`` apart; a signal shorter than one window is one frame, what is left at the end none."""
    n = F.greatest(F.lit(1), F.floor((F.size(x) - size) / F.lit(hop)) + 1).cast("int")
    cut = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(x, i * hop + 1, F.lit(size)))
    return F.when(F.size(x) > 0, cut)


def rms(frame: Column) -> Column:
    return F.sqrt(F.aggregate(frame, F.lit(0.0), lambda s, v: s + v * v) / F.size(frame))


def crossings(frame: Column) -> Column:
    """The share of samples at which the sign (0 counts as above) differs from the one before."""
    signs = F.transform(frame, lambda v: (v < 0).cast("int"))
    turns = F.aggregate(F.zip_with(F.slice(signs, 1, F.greatest(F.lit(1), F.size(frame) - 1)), F.slice(signs, 2, F.greatest(F.lit(1), F.size(frame) - 1)), lambda a, b: F.abs(a - F.coalesce(b, a))), F.lit(0), lambda s, v: s + v)
    return turns / F.size(frame)


def delta(x: Column, width: int = 9) -> Column:
    """The slope at each place of a series over ``width`` (odd) neighbours, the ends being repeated beyond themselves."""
    half = width // 2
    norm = 2 * sum(k * k for k in range(1, half + 1))
    at = lambda i: F.get(x, F.greatest(F.lit(0), F.least(F.size(x) - 1, i)))

    def slope(i: Column) -> Column:
        out = F.lit(0.0)
        for k in range(1, half + 1):
            out = out + F.lit(float(k)) * (at(i + k) - at(i - k))
        return out / F.lit(float(norm))

    return F.when(F.size(x) > 0, F.transform(F.sequence(F.lit(0), F.size(x) - 1), slope))


def series_summary(x: Column, name: str) -> dict[str, Column]:
    """Mean, population deviation, greatest and least of an array, as columns by name."""
    n = F.size(x)
    mean = F.aggregate(x, F.lit(0.0), lambda s, v: s + v) / n
    spread = F.sqrt(F.aggregate(x, F.lit(0.0), lambda s, v: s + v * v) / n - mean * mean)
    return {f"{name}_mean": mean, f"{name}_std": F.coalesce(F.nanvl(spread, F.lit(0.0)), F.when(n > 0, F.lit(0.0))), f"{name}_max": F.array_max(x), f"{name}_min": F.array_min(x)}


SPECTRAL = (
    "spectral_centroid_mean", "spectral_centroid_std", "spectral_bandwidth_mean", "spectral_bandwidth_std", "spectral_rolloff_mean", "spectral_rolloff_std",
    "spectral_flatness_mean", "spectral_flatness_std", "spectral_flux", "vocal_band_ratio",
)
NOTES = ("C", "C#", "D", "D#", "E", "F", "F#", "G", "G#", "A", "A#", "B")


def _power(y: np.ndarray, size: int, hop: int) -> np.ndarray:
    """Power spectra of the Hann-windowed frames of a signal, one row per frame; the end is filled with noughts."""
    n = max(1, 1 + -(-max(0, len(y) - size) // hop))
    y = np.pad(y, (0, max(0, (n - 1) * hop + size - len(y))))
    f = np.lib.stride_tricks.sliding_window_view(y, size)[::hop][:n]
    return np.abs(np.fft.rfft(f * np.hanning(size + 1)[:-1], axis=1)) ** 2


def spectrum(y: np.ndarray, rate: float, size: int, hop: int) -> tuple[list[float], np.ndarray]:
    """The measures ``SPECTRAL`` of a signal, and its mean share of energy per note of the scale."""
    p = _power(y, size, hop)
    a = np.sqrt(p)
    hz = np.fft.rfftfreq(size, 1 / rate)
    whole = np.maximum(a.sum(1), 1e-10)
    centroid = a @ hz / whole
    width = np.sqrt((a * (hz[None] - centroid[:, None]) ** 2).sum(1) / whole)
    rolloff = hz[np.argmax(np.cumsum(a, 1) >= 0.85 * a.sum(1, keepdims=True), 1)]
    flat = np.exp(np.log(np.maximum(p, 1e-10)).mean(1)) / np.maximum(p, 1e-10).mean(1)
    flux = float((np.diff(a, axis=0) ** 2).mean()) if len(a) > 1 else 0.0
    voice = (hz >= 100) & (hz <= 3000)
    out = [f(v) for v in (centroid, width, rolloff, flat) for f in (np.mean, np.std)] + [flux, p[:, voice].sum() / (p.sum() + 1e-10)]
    chroma = np.zeros(12)
    heard = hz > 20
    np.add.at(chroma, np.round(12 * np.log2(hz[heard] / 440) + 9).astype(int) % 12, p[:, heard].mean(0))
    return [float(v) for v in out], chroma / max(chroma.sum(), 1e-10)


def spectral_features(df: DataFrame, key: str, signal: str, rate: str, size: int = FRAME, hop: int = HOP) -> DataFrame:
    """``(key, SPECTRAL..., chroma)`` per row; null for null and empty signals and a rate that isn't above 0."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, y, r in zip(b[key], b[signal], b[rate]):
                ok = y is not None and len(y) and r is not None and r > 0
                m, c = spectrum(np.asarray(y, float), float(r), size, hop) if ok else ([None] * len(SPECTRAL), None)
                rows.append((k, *m, c))
            yield pd.DataFrame(rows, columns=[key, *SPECTRAL, "chroma"])

    return df.select(key, signal, rate).mapInPandas(run, f"`{key}` {kind}, " + ", ".join(f"{c} double" for c in SPECTRAL) + ", chroma array<double>")


def quality(x: Column, size: int = FRAME, hop: int = HOP, quiet: float = 0.01, clip: float = 0.99) -> dict[str, Column]:
    """Silence and clipping ratio, ratio of signal to noise and dynamic range of a signal in [-1, 1], as columns by name.

    Frames below ``quiet`` are silent, and their power is the noise's. Without a silent frame, or where noise has no
    power, the ratio is infinite. The dynamic range is the loudest frame above the 5th percentile of frames with any power.
    """
    n = F.nullif(F.size(x), F.lit(0))
    level = F.transform(frames(x, size, hop), rms)
    still = F.filter(level, lambda v: v < quiet)
    loud = F.filter(level, lambda v: v >= quiet)
    power = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v * v) / F.greatest(F.lit(1), F.size(a))
    heard = F.array_sort(F.filter(level, lambda v: v > 1e-6))
    at = (F.size(heard) - 1) * F.lit(0.05)
    lower = F.get(heard, F.floor(at).cast("int"))
    floor_ = lower + (F.get(heard, F.ceil(at).cast("int")) - lower) * (at - F.floor(at))
    return {
        "silence_ratio": F.size(still) / F.size(level),
        "clipping_ratio": F.size(F.filter(x, lambda v: F.abs(v) >= clip)) / n,
        "snr_db": F.when(F.size(loud) == 0, F.lit(0.0)).when(power(still) > 0, 10 * F.log10(power(loud) / power(still))).otherwise(F.lit(float("inf"))),
        "dynamic_range_db": F.when(F.size(heard) == 0, F.lit(0.0)).otherwise(20 * F.log10(F.array_max(heard) / floor_)),
    }


def stem_share(voice: Column, other: Column) -> Column:
    """The energy of the separated voice over that of both; 0 where neither has any."""
    e = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v * v)
    return F.when(e(voice) + e(other) > 0, e(voice) / (e(voice) + e(other))).otherwise(F.lit(0.0))
