"""Separable convolution (F8-F10): Gaussian smoothing and difference of Gaussians.

Voxel form: one pass per axis.  Each tap ``s(x+k)`` is an offset window
function (``lead``/``lag`` on the axis, dense at that point) over one window
spec, so a pass is one hash exchange on the other two axes and no row
multiplication; several kernels on the same input (DoG) share the taps.  Mirror borders materialise the padded
axis first (``coords.extend``); zero borders read absent taps as 0.

The block form (numpy 1-D convolution inside a halo plan) is in
``kernels.gauss_block``.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..volume import AXES, Volume, VolumeMeta


def gauss_half_kernel(sigma: float) -> np.ndarray:
    """Half-kernel ``w[i] = exp(-i^2 / 2 sigma^2)`` for ``i < max(2, floor(3 sigma + 0.5) + 1)``,
    normalised so that the full symmetric kernel sums to 1 (no tail correction)."""
    n = max(2, int(math.floor(3.0 * sigma + 0.5)) + 1)
    i = np.arange(n, dtype=np.float64)
    w = np.exp(-(i * i) / (2.0 * sigma * sigma))
    return w / (w[0] + 2.0 * w[1:].sum())


def _taps(df: DataFrame, col: str, axis: str, reach: int) -> dict[int, Column]:
    """``s(x+k)`` for ``|k| <= reach`` as offset window functions.

    The axis is dense here (sparse input is densified, mirror borders are
    materialised), so ``lead``/``lag`` by k rows is the sample at distance k;
    past the ends they are NULL, which is the zero border.  Offset frames cost
    O(1) per row, unlike one-row RANGE frames.
    """
    others = [a for a in AXES if a != axis]
    w = Window.partitionBy(*others).orderBy(axis)
    taps = {0: F.col(col)}
    for k in range(1, reach + 1):
        taps[k] = F.coalesce(F.lead(col, k).over(w), F.lit(0.0))
        taps[-k] = F.coalesce(F.lag(col, k).over(w), F.lit(0.0))
    return taps


def _conv(taps: dict[int, Column], half: np.ndarray) -> Column:
    out = F.lit(float(half[0])) * taps[0]
    for i in range(1, len(half)):
        out = out + F.lit(float(half[i])) * (taps[-i] + taps[i])
    return out


def separable(vol: Volume, halves: dict[str, list], extension: str = "zero", dense: bool = False) -> DataFrame:
    """Apply per output column ``name`` the separable kernels ``halves[name]`` (one
    half-kernel per axis; ``None`` skips an axis).  Returns ``x, y, z, <names>``.

    Sparse input is densified first: after the first pass, absent voxels next
    to present ones carry values the next pass must read.
    """
    if not (dense or vol.meta.dense):
        from .coords import densify
        vol = densify(vol)
    names = list(halves)
    nd = len(next(iter(halves.values())))
    df = vol.df.select(*AXES, *[F.col("v").cast("double").alias(n) for n in names])
    cur = Volume(df, vol.meta)  # columns carried through passes
    lo, hi = vol.meta.min, vol.meta.max
    identical = True  # before the first pass every column is a copy of v: share the taps
    for d in range(nd):
        kernels = {n: halves[n][d] for n in names if halves[n][d] is not None}
        if not kernels:
            continue
        reach = max(len(k) for k in kernels.values()) - 1
        a = AXES[d]
        src = cur.df
        if extension != "zero":
            # materialise the padded axis: each column is re-read at mirrored positions
            src = _extend_cols(cur, d, reach, extension, names)
        outs = []
        shared = _taps(src, names[0], a, reach) if identical else None
        for n in names:
            if n in kernels:
                taps = shared if shared is not None else _taps(src, n, a, len(kernels[n]) - 1)
                outs.append(_conv(taps, kernels[n]).alias(n))
            else:
                outs.append(F.col(n))
        identical = False
        src = src.select(*AXES, *outs)
        if extension != "zero":
            src = src.filter(F.col(a).between(lo[d], hi[d]))
        cur = Volume(src, vol.meta)
    return cur.df


def _extend_cols(vol: Volume, d: int, pad: int, mode: str, names: list[str]) -> DataFrame:
    from .coords import extend_axis
    return extend_axis(vol.df.select(*AXES, *names), AXES[d], vol.dims[d], pad, vol.meta.min[d], mode)


def gauss(vol: Volume, sigma, extension: str = "zero", out_dtype: str | None = None, dense: bool = False) -> Volume:
    """F8: separable Gaussian with per-axis sigma (P4 kernels); axes of size 1 are skipped."""
    nd = vol.meta.ndim
    halves = [gauss_half_kernel(s) if d < nd else None for d, s in enumerate(sigma)]
    df = separable(vol, {"v": halves}, extension, dense)
    meta = VolumeMeta(vol.dims, "float64", vol.meta.min)
    out = Volume(df, meta)
    if out_dtype:
        from ..functions.pointwise import to_type
        out = Volume(df.select(*AXES, to_type("v", out_dtype).alias("v")), VolumeMeta(vol.dims, out_dtype, vol.meta.min))
    return out


def dog(vol: Volume, sigma1, sigma2, extension: str = "mirror_single", dense: bool = False) -> Volume:
    """Gaussian(sigma1) - Gaussian(sigma2), both kernels sharing each pass's taps."""
    nd = vol.meta.ndim
    h1 = [gauss_half_kernel(s) if d < nd else None for d, s in enumerate(sigma1)]
    h2 = [gauss_half_kernel(s) if d < nd else None for d, s in enumerate(sigma2)]
    df = separable(vol, {"g1": h1, "g2": h2}, extension, dense)
    return Volume(df.select(*AXES, (F.col("g1") - F.col("g2")).alias("v")), VolumeMeta(vol.dims, "float64", vol.meta.min))


def convolve_separable(vol: Volume, half_kernels, extension: str = "zero", dense: bool = False) -> Volume:
    """separable convolution with user-given symmetric half-kernels (one per axis)."""
    df = separable(vol, {"v": [np.asarray(h, dtype=np.float64) if h is not None else None for h in half_kernels]},
                   extension, dense)
    return Volume(df, VolumeMeta(vol.dims, "float64", vol.meta.min))
