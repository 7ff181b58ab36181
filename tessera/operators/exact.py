"""Exact window sums of any voxel type: samples as integer fields that add up without rounding.

A *field set* is a dict of int64 arrays.  Types whose sums and sums of squares fit an int64 have two fields, the samples
and their squares.  Others go through float32, as the slice operator does; a float32 is a multiple of 2^-149 and
its square of 2^-298, so both are cut into limbs of 32 bits counted from there.  Only limbs that occur are kept
(a few, as samples of one image have similar exponents).  Sums of limbs never round, so differences of running sums are exact too:
a huge sample leaves no trace outside its windows, and results do not depend on the plan or the block size.  NaN and
infinities are counted in fields of their own.  ``sums`` rounds once, at the end.
"""

from __future__ import annotations

import numpy as np

S, Q, NANS, PLUS, MINUS = 0, 100, 200, 201, 202  # first limbs of samples and squares, and the counts
S_BASE, Q_BASE = -149, -298  # exponents of the lowest float32 bit and of its square
MASK = 0xFFFFFFFF

Fields = dict[int, np.ndarray]


def _limbs(x: np.ndarray, base: int, first: int) -> Fields:
    """Finite doubles of at most 48 significant bits, multiples of 2^base, as signed 32-bit limbs."""
    m, e = np.frexp(np.abs(x))
    whole = np.ldexp(m, 48).astype(np.int64)
    at = np.where(whole > 0, e.astype(np.int64) - 48 - base, 0)
    whole >>= np.maximum(-at, 0)  # below the lowest bit there are zeros only
    limb, shift = np.divmod(np.maximum(at, 0), 32)
    low, high = (whole & MASK) << shift, (whole >> 32) << shift
    sign = np.where(x < 0, -1, 1)
    parts = [(low & MASK) * sign, ((low >> 32) + (high & MASK)) * sign, (high >> 32) * sign]
    out = {}
    for k in range(int(limb.min()), int(limb.max()) + 3) if x.size else ():
        field = sum(np.where(limb == k - j, p, 0) for j, p in enumerate(parts))
        if field.any():
            out[first + k] = field
    return out


def fields(a: np.ndarray, exact: bool) -> Fields:
    """The field set of samples and their squares."""
    if exact:
        v = a.astype(np.int64)
        return {S: v, Q: v * v}
    with np.errstate(over="ignore"):
        v = a.astype(np.float32).astype(np.float64)
    out = {k: f.astype(np.int64) for k, f in ((NANS, np.isnan(v)), (PLUS, v == np.inf), (MINUS, v == -np.inf)) if f.any()}
    if out:
        v = np.where(np.isfinite(v), v, 0.0)
    return _limbs(v, S_BASE, S) | _limbs(v * v, Q_BASE, Q) | out


def _value(f: Fields, base: int, shape) -> np.ndarray:
    """Limbs as doubles: carried to a canonical form, then rounded from the top."""
    if not f:
        return np.zeros(shape)
    low, high = min(f), max(f)
    carry, digits = np.zeros(shape, np.int64), []
    for k in range(low, high + 1):
        t = f.get(k, 0) + carry
        digits.append(t & MASK)
        carry = t >> 32
    out = carry.astype(np.float64)
    for d in reversed(digits):
        out = out * 2.0 ** 32 + d
    return np.ldexp(out, base + 32 * low)


def sums(f: Fields, exact: bool, shape) -> tuple[np.ndarray, np.ndarray]:
    """(sum of samples, sum of squares) in float64."""
    if exact:
        return tuple(f[k].astype(np.float64) if k in f else np.zeros(shape) for k in (S, Q))
    s = _value({k - S: x for k, x in f.items() if k < Q}, S_BASE, shape)
    q = _value({k - Q: x for k, x in f.items() if Q <= k < NANS}, Q_BASE, shape)
    none = np.zeros(shape, np.int64)
    nans, plus, minus = (f.get(k, none) > 0 for k in (NANS, PLUS, MINUS))
    s = np.where(nans | plus & minus, np.nan, np.where(plus, np.inf, np.where(minus, -np.inf, s)))
    return s, np.where(nans, np.nan, np.where(plus | minus, np.inf, q))


def pack(f: Fields) -> bytes:
    """A field set as bytes; fields that fit take 32 bits a sample, zero ones nothing."""
    head, data = [], []
    for k, x in f.items():
        top = max(-int(x.min()), int(x.max())) if x.size else 0
        if top:
            wide = 8 if top >= 2 ** 31 else 4
            head += [k, wide]
            data.append(np.ascontiguousarray(x, f"<i{wide}").tobytes())
    return np.array([len(head) // 2, *head], "<i4").tobytes() + b"".join(data)


def unpack(b: bytes, shape) -> Fields:
    n = int(np.frombuffer(b, "<i4", 1)[0])
    head = np.frombuffer(b, "<i4", 2 * n, 4).reshape(n, 2).tolist()
    at, size, out = 4 + 8 * n, int(np.prod(shape)), {}
    for k, wide in head:
        out[k] = np.frombuffer(b, f"<i{wide}", size, at).reshape(shape).astype(np.int64)
        at += wide * size
    return out


def window(x: np.ndarray, k: int, axis: int) -> np.ndarray:
    """Sums of every k neighbours along an axis, as differences of running sums (int64: exact)."""
    run = np.concatenate([np.zeros_like(np.take(x, [0], axis)), x.cumsum(axis)], axis)
    n = x.shape[axis] - k + 1
    return np.take(run, np.arange(k, k + n), axis) - np.take(run, np.arange(n), axis)


def window_fields(f: Fields, k: int, axis: int) -> Fields:
    return {i: window(x, k, axis) for i, x in f.items()}
