"""Numpy kernels run inside Spark tasks on one padded block or slice.

They follow the voxel-form Column expressions operation for operation, so
the block form and the voxel form give the same numbers (tests check it).
"""

from __future__ import annotations

import numpy as np

from ..volume import dtype_of
from . import exact as X


# ------------------------------------------------------------------ P1-P3

def round_half_away(a: np.ndarray) -> np.ndarray:
    return np.where(a >= 0, np.floor(a + 0.5), np.ceil(a - 0.5))


def to_dtype(a: np.ndarray, dtype: str) -> np.ndarray:
    """Integers round half away from zero and saturate at the ends of the type; NaN -> 0.

    A sample that is in the type already, or an integer inside its range, is not touched.
    """
    t = dtype_of(dtype)
    a, want = np.asarray(a), np.dtype(t.numpy)
    if a.dtype == want or not t.integer:
        return a.astype(want, copy=False)
    ends = np.iinfo(want)
    if a.dtype.kind in "iu":
        have = np.iinfo(a.dtype)
        return np.clip(a, max(have.min, ends.min), min(have.max, ends.max)).astype(want)
    d = a.astype(np.float64)
    d = round_half_away(np.where(np.isnan(d), 0.0, d))
    low, high = d <= float(ends.min), d >= float(ends.max)  # 2^63 - 1 and 2^64 - 1 are 2^63 and 2^64 as doubles
    out = np.where(low | high, 0.0, d).astype(want)
    return np.where(high, want.type(ends.max), np.where(low, want.type(ends.min), out))


def clamp(a: np.ndarray, lo: float, hi: float) -> np.ndarray:
    """D4 with Java semantics (NaN passes through)."""
    return np.where(np.isnan(a), a, np.minimum(hi, np.maximum(lo, a)))


# ------------------------------------------------------------------ G (CLLCN)

def exact_sums(dtype: str, r: int) -> bool:
    """Whether window sums and sums of squares of ``dtype`` fit an int64: decided by the type, never by the samples."""
    t = dtype_of(dtype)
    # samples pass through float32 first, which holds integers up to 2^24 exactly
    return t.integer and max(-t.lo, t.hi) <= 2 ** 24 and (2 * r + 1) ** 2 * max(-t.lo, t.hi) ** 2 < 2 ** 63


def window_sums(a: np.ndarray, k: int, axis: int) -> np.ndarray:
    """Sums of every ``k`` neighbours along an axis.

    Each window is the tail of one run of ``k`` samples plus the head of the
    next, so a sum holds samples of its window only: a huge or NaN sample does
    not reach the windows beside it, and there is nothing to cancel.
    """
    a = np.moveaxis(a, axis, -1)
    n = a.shape[-1] - k + 1
    pad = np.zeros(a.shape[:-1] + (-a.shape[-1] % k + k,), a.dtype)
    runs = np.concatenate([a, pad], -1).reshape(a.shape[:-1] + (-1, k))
    head = runs.cumsum(-1).reshape(a.shape[:-1] + (-1,))
    tail = runs[..., ::-1].cumsum(-1)[..., ::-1].reshape(a.shape[:-1] + (-1,))
    i = np.arange(n)
    # a window that starts a run is that run; otherwise a tail and a head
    out = np.where(i % k == 0, tail[..., :n], tail[..., :n] + head[..., k - 1:k - 1 + n])
    return np.moveaxis(out, -1, axis)


def box_sums(a: np.ndarray, r: int, exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Window sums of a and a^2 over (2r+1)^2 for the centre of a 2-D padded
    slice (``a.shape = (h + 2r, w + 2r)``), exact and rounded once; ``exact``: int64 holds them (see ``exact_sums``)."""
    k = 2 * r + 1
    f = X.window_fields(X.window_fields(X.fields(a, exact), k, 1), k, 0)
    return X.sums(f, exact, (a.shape[0] - 2 * r, a.shape[1] - 2 * r))


def soft_limit(x: np.ndarray, limit: float, gamma: float) -> np.ndarray:
    g = 1.0 / np.power(gamma, 1.0 / (gamma - 1.0))
    a, b = g - limit, limit - np.power(g, gamma)
    with np.errstate(invalid="ignore"):
        return np.where(x < limit, x, np.power(x + a, gamma) + b)


def cllcn_slice(fp: np.ndarray, r: int, k: float = 3.0, limit: float = 10.0, gamma: float = 0.5,
                center: bool = True, stretch: bool = True, keep_min_max: bool = True,
                fp_min: float = 0.0, fp_max: float = 65535.0, exact: bool = False) -> np.ndarray:
    """G8 on one float32 slice padded by r on both axes; returns the centre (float64,
    before the float store).  Statistics come from the unmodified slice (P5)."""
    S, Q = box_sums(fp, r, exact)
    v = fp[r:fp.shape[0] - r, r:fp.shape[1] - r].astype(np.float64)
    return cllcn_from_sums(v, S, Q, r, k, limit, gamma, center, stretch, keep_min_max, fp_min, fp_max)


def cllcn_from_sums(v: np.ndarray, S: np.ndarray, Q: np.ndarray, r: int, k: float = 3.0, limit: float = 10.0,
                    gamma: float = 0.5, center: bool = True, stretch: bool = True, keep_min_max: bool = True,
                    fp_min: float = 0.0, fp_max: float = 65535.0) -> np.ndarray:
    """G8 from the (float32-valued) samples and their full-window sums S, Q."""
    bs = (2 * r + 1) * (2 * r + 1)
    scale, scale1, scale2 = 1.0 / bs, 1.0 / (bs - 1), 1.0 / (bs * bs - bs)
    mean = S * scale
    var = scale1 * Q - scale2 * S * S
    with np.errstate(invalid="ignore", divide="ignore"):
        std = np.where(var < 0, 0.0, np.sqrt(np.where(var < 0, 0.0, var)))
        L = fp_max - fp_min
        fp_mean = L / 2.0 + fp_min
        d = float(k) * std
        if gamma == 1:
            if center and stretch:
                return (v - (mean - d)) / 2.0 / d * L + fp_min
            if center:
                return (v - mean) + fp_mean
            if stretch:
                return (v - fp_mean) / 2.0 / d * L + fp_mean
            return v
        s = np.where(d == 0, 0.0, 0.5 * soft_limit((1.0 / d) * L, limit, gamma))
        if center and stretch:
            vmin = mean - (L / s) * 0.5
            out = (v - vmin) * s + fp_min
            if keep_min_max:
                out = np.where((v == fp_min) | (v == fp_max), v, out)
            return out
        if center:
            return (v - mean) + fp_mean
        if stretch:
            return (v - fp_mean) * s * L + fp_mean
        return v


# ------------------------------------------------------------------ F8-F10

def convolve_axis(a: np.ndarray, half: np.ndarray, axis: int) -> np.ndarray:
    """Symmetric 1-D convolution along ``axis`` of an array padded by
    ``len(half)-1`` on that axis; returns the unpadded centre.  Same
    accumulation order as the voxel form: ``w0*t0 + w1*(t-1 + t1) + ...``."""
    reach = len(half) - 1
    n = a.shape[axis] - 2 * reach

    def tap(k):
        sl = [slice(None)] * a.ndim
        sl[axis] = slice(reach + k, reach + k + n)
        return a[tuple(sl)]

    out = float(half[0]) * tap(0)
    for i in range(1, len(half)):
        out = out + float(half[i]) * (tap(-i) + tap(i))
    return out


def gauss_block(a: np.ndarray, halves: list) -> np.ndarray:
    """Separable convolution of a padded 3-D array (numpy axes z, y, x), x first."""
    out = a.astype(np.float64)
    for d, half in enumerate(halves):  # d = 0 -> x (numpy axis 2)
        if half is None:
            continue
        out = convolve_axis(out, half, 2 - d)
    return out
