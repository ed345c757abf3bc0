"""Framewise spectral features of fixed-rate signals."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def _mel(f: np.ndarray | float) -> np.ndarray | float:
    return 2595.0 * np.log10(1.0 + np.asarray(f) / 700.0)


def mel_bank(bands: int, lo: float, hi: float, rate: float, block: int) -> np.ndarray:
    """Triangular filters, equally spaced on the mel scale, over the rfft bins."""
    edges = 700.0 * (10.0 ** (np.linspace(_mel(lo), _mel(hi), bands + 2) / 2595.0) - 1.0)
    freq = np.fft.rfftfreq(block, 1.0 / rate)
    left, mid, right = edges[:-2, None], edges[1:-1, None], edges[2:, None]
    return np.clip(np.minimum((freq - left) / (mid - left), (right - freq) / (right - mid)), 0.0, None)


def cosine_basis(n: int, k: int) -> np.ndarray:
    """Orthonormal DCT-II rows 1..k (the constant one is left out)."""
    i = np.arange(n)
    return np.sqrt(2.0 / n) * np.cos(np.pi * (i + 0.5)[None, :] * np.arange(1, k + 1)[:, None] / n)


def _lpc(frame: np.ndarray, order: int) -> np.ndarray:
    """Linear prediction coefficients of windowed frames (last axis) by their autocorrelation."""
    n = frame.shape[-1]
    r = np.stack([(frame[..., : n - k] * frame[..., k:]).sum(-1) for k in range(order + 1)], -1)
    lag = np.abs(np.arange(order)[:, None] - np.arange(order)[None, :])
    m = r[..., lag] + 1e-9 * (1.0 + r[..., :1, None]) * np.eye(order)
    return np.linalg.solve(m, r[..., 1:, None])[..., 0]


def _shape(mag: np.ndarray, freq: np.ndarray) -> np.ndarray:
    """Centroid, spread, skewness and kurtosis of each spectrum."""
    p = mag / (mag.sum(-1, keepdims=True) + 1e-12)
    c = (p * freq).sum(-1, keepdims=True)
    d = freq - c
    s = np.sqrt((p * d**2).sum(-1, keepdims=True)) + 1e-12
    third, fourth = (p * d**3).sum(-1, keepdims=True), (p * d**4).sum(-1, keepdims=True)
    return np.concatenate([c, s, third / s**3, fourth / s**4], -1)


def framewise(x: np.ndarray, rate: float, bank: np.ndarray, basis: np.ndarray, lpc: int) -> tuple[np.ndarray, np.ndarray]:
    """Mel bands and the other features of signals x[signal, frame, sample]."""
    win = x * np.hanning(x.shape[-1])
    mag = np.abs(np.fft.rfft(win, axis=-1))
    freq = np.fft.rfftfreq(x.shape[-1], 1.0 / rate)
    mel = mag @ bank.T
    cep = np.log(mel + 1e-10) @ basis.T
    prev = np.concatenate([np.zeros_like(mag[:, :1]), mag[:, :-1]], 1)
    flux = np.sqrt(((mag - prev) ** 2).sum(-1, keepdims=True))
    f0 = freq - freq.mean()
    slope = ((mag - mag.mean(-1, keepdims=True)) @ f0 / (f0**2).sum())[..., None]
    norm = np.sqrt((mag**2).sum(-1) * (prev**2).sum(-1)) + 1e-12
    variation = (1.0 - (mag * prev).sum(-1) / norm)[..., None]
    onset = np.clip(np.log1p(mag) - np.log1p(prev), 0.0, None).sum(-1, keepdims=True)
    feats = np.concatenate([cep, _lpc(win, lpc), flux, _shape(mag, freq), slope, variation, onset], -1)
    return mel, feats


def spectral_features(
    df: DataFrame, key: str, signal: str, block: int, step: int, rate: float = 2000.0, bands: int = 40,
    lo: float = 30.0, hi: float = 600.0, mfcc: int = 12, lpc: int = 4,
) -> DataFrame:
    """Per frame of ``block`` samples every ``step``: mel bands, and cepstrum,
    prediction, flux, shape, slope, variation and onset.

    Signals of one table have one length; the last frames are padded with
    zeros. One row per (key, frame) comes out.
    """
    bank, basis = mel_bank(bands, lo, hi, rate, block), cosine_basis(bands, mfcc)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            x = np.stack(pdf[signal].to_numpy()).astype("float64")
            count = -(-x.shape[1] // step)
            x = np.pad(x, ((0, 0), (0, max(0, (count - 1) * step + block - x.shape[1]))))
            at = np.arange(count)[:, None] * step + np.arange(block)[None, :]
            mel, feats = framewise(x[:, at], rate, bank, basis, lpc)
            yield pd.DataFrame(
                {
                    key: np.repeat(pdf[key].to_numpy(), count),
                    "frame": np.tile(np.arange(count, dtype="int32"), len(pdf)),
                    "mel": list(mel.reshape(-1, bands)),
                    "feats": list(feats.reshape(-1, feats.shape[-1])),
                }
            )

    return df.select(key, signal).mapInPandas(run, f"{key} bigint, frame int, mel array<double>, feats array<double>")
