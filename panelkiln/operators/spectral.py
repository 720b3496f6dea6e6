"""Spectral and wavelet features of each group's series (per group in a Python task: a transform needs the whole series)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..spec import PanelSpec

# fixed values: low-pass filters of the Daubechies 1, Symlet 2 and Coiflet 1 wavelets
FILTERS = {
    "db1": (0.7071067811865476, 0.7071067811865476),
    "sym2": (-0.12940952255126037, 0.2241438680420134, 0.8365163037378079, 0.48296291314453416),
    "coif1": (-0.01565572813546454, -0.0727326195128539, 0.38486484686420286, 0.8525720202122554, 0.3378976624578092, -0.0727326195128539),
}


def _fill(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, float)
    good = np.isfinite(x)
    return np.where(good, x, x[good].mean() if good.any() else 0.0)


def spectrum(x: np.ndarray, top: int = 10) -> dict[str, float]:
    """The largest magnitudes of the real FFT without the mean, and the shares of the lowest fifth, next two and last two."""
    x = _fill(x)
    m = np.abs(np.fft.rfft(x - x.mean())) if len(x) else np.zeros(1)
    ordered = np.sort(m)[::-1][:top]
    total, cuts = m.sum(), (len(m) // 5, 3 * len(m) // 5)
    share = [float(p.sum() / total) if total > 0 else 0.0 for p in np.split(m, cuts)]
    return {f"fft_top_{i}": float(ordered[i]) if i < len(ordered) else 0.0 for i in range(top)} | dict(zip(("fft_low", "fft_mid", "fft_high"), share, strict=True))


def wavelet(x: np.ndarray, name: str, levels: int = 3) -> dict[str, float]:
    """Mean and deviation of the detail coefficients of each level, and of the last approximation (periodic border)."""
    low = np.array(FILTERS[name])
    high = low[::-1] * (-1.0) ** np.arange(len(low))
    a, out = _fill(x), {}
    for level in range(1, levels + 1):
        if len(a) < 2:
            d, a = np.zeros(1), a if len(a) else np.zeros(1)
        else:
            a = np.append(a, a[-1]) if len(a) % 2 else a
            at = (np.arange(0, len(a), 2)[:, None] + np.arange(len(low))[None, :]) % len(a)
            d, a = (a[at] * high).sum(1), (a[at] * low).sum(1)
        out |= {f"{name}_d{level}_mean": float(d.mean()), f"{name}_d{level}_std": float(d.std())}
    return out | {f"{name}_a_mean": float(a.mean()), f"{name}_a_std": float(a.std())}


def spectral_features(df: DataFrame, spec: PanelSpec, column: str, top: int = 10, wavelets: tuple[str, ...] = ("db1", "sym2", "coif1"), levels: int = 3) -> DataFrame:
    """One row per group. Only the group, the order and one value column travel."""
    names = [*spectrum(np.zeros(4), top), *(k for w in wavelets for k in wavelet(np.zeros(4), w, levels))]
    order = [spec.order, *spec.tiebreak]
    kind = df.schema[spec.group].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values(order)[column].to_numpy()
        row = spectrum(x, top)
        for w in wavelets:
            row |= wavelet(x, w, levels)
        return pd.DataFrame([{spec.group: pdf[spec.group].iloc[0], "n": len(x)} | row])

    schema = f"`{spec.group}` {kind}, n long, " + ", ".join(f"`{n}` double" for n in names)
    return df.select(spec.group, *order, F.col(column).cast("double").alias(column)).groupBy(spec.group).applyInPandas(run, schema)
