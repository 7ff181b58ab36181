"""Block form of the pairwise operators (E1-E7), stencils (F3, F6, F7), user kernels (F10) and views.

Pairwise operators join equally blocked volumes on the grid position, so a
shuffle moves payloads, not voxels; volumes on different grids (translated, cropped, other blocks) are cut on the result's
grid and meet in one exchange (``combine``).  Stencils are one halo exchange each.
Views filter grid keys (pushed into the chunk source) and cut payloads; a crop
that is not aligned with the blocks is one exchange.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..volume import dtype_of, spanning
from . import kernels as K
from .halo import (BLOCK_COLUMNS, BLOCK_SCHEMA, BlockVolume, G, O, Outbox, S, decode, encode, gathered, grouped_rows, map_blocks,
                   on_interval, operand)


# ------------------------------------------------------------------ E1-E7

def saturating(op, a: np.ndarray, b: np.ndarray, dtype: str) -> np.ndarray:
    """``op(a, b)`` in the voxel type of A: integers saturate at its ends (P2), floats are rounded to it."""
    t = dtype_of(dtype)
    if not t.integer:
        return op(a.astype(np.float64), b.astype(np.float64)).astype(np.dtype(t.numpy))
    x, y = K.to_dtype(a, "int64") if a.dtype.kind == "f" else a.astype(np.int64), \
        K.to_dtype(b, "int64") if b.dtype.kind == "f" else b.astype(np.int64)
    with np.errstate(over="ignore"):
        exact, near = op(x, y), op(x.astype(np.float64), y.astype(np.float64))
    ends, out = np.iinfo(np.dtype(t.numpy)), exact
    large = np.abs(near) >= 2.0 ** 62  # int64 arithmetic may have wrapped: these few again in Python's integers
    if large.any():
        out[large] = np.clip(op(x[large].astype(object), y[large].astype(object)), int(np.iinfo(np.int64).min),
                             int(np.iinfo(np.int64).max)).astype(np.int64)
    return np.clip(out, ends.min, ends.max).astype(np.dtype(t.numpy))


def aligned(*volumes: BlockVolume) -> bool:
    """Whether the volumes share interval and blocks, so that equal grid positions hold equal coordinates."""
    first = volumes[0]
    return all(v.source is None and tuple(v.block) == tuple(first.block) and tuple(v.dims) == tuple(first.dims)
               and tuple(v.meta.min) == tuple(first.meta.min) for v in volumes)


def combine(volumes: list[BlockVolume], fn, out_dtype: str, on: BlockVolume | None = None, extension="zero",
            how: str = "full_outer", channels: int = 1) -> BlockVolume:
    """``fn(block of each volume)`` on the interval and the blocks of ``on`` (the first volume), voxel by voxel at equal coordinates.

    Beyond its own interval a volume is extended (one rule, or one for each).  Their origins, sizes and blocks may differ: every
    source block is cut on the grid of the result and its pieces regrouped, all volumes in one exchange; the
    stages of a chain run there too.  ``how``: "full_outer" gives blocks that some volume reaches, "inner" those that
    all reach, "grid" all.
    """
    on = volumes[0] if on is None else on
    rules = [extension] * len(volumes) if isinstance(extension, str) else list(extension)
    meta = replace(on.meta, dtype=out_dtype, dense=False)
    every = how == "grid" or how == "full_outer" and any(not s.zero_preserving for v in volumes for s in v.stages)
    df = gathered([operand(v, e) for v, e in zip(volumes, rules)], fn, meta, on.block, out_dtype, channels, every, how == "inner")
    return BlockVolume(df, meta, tuple(on.block), channels)


def pairwise(a: BlockVolume, b: BlockVolume, fn, out_dtype: str, how: str = "full_outer", channels: int = 1,
             on: BlockVolume | None = None, extension="zero") -> BlockVolume:
    """``fn(block of A, block of B)`` at equal coordinates; the result has the interval and blocks of ``on`` (A).

    Volumes on one grid are joined on the grid position, an absent block is zero; others go through ``combine``.
    ``how="grid"`` computes every block of the grid, also where neither side has one.
    """
    if not aligned(a, b, *([on] if on is not None else [])):
        if how == "inner" and any(not s.zero_preserving for v in (a, b) for s in v.stages):
            how = "grid"  # a stage may make samples where no block is stored
        return combine([a, b], fn, out_dtype, on, extension, how, channels)
    da, db = np.dtype(dtype_of(a.dtype).numpy), np.dtype(dtype_of(b.dtype).numpy)
    left = a.df.select(*G, *O, *S, F.col("payload").alias("pa"))
    right = b.df.select(*G, *[F.col(c).alias(f"{c}_b") for c in (*O, *S)], F.col("payload").alias("pb"))
    if how == "grid":
        j = a.grid().select(*G, *O, *S).join(left.select(*G, "pa"), list(G), "left").join(right.select(*G, "pb"), list(G), "left")
    else:
        j = left.join(right, list(G), how)
        if how == "full_outer":
            j = j.select(*G, *[F.coalesce(c, f"{c}_b").alias(c) for c in (*O, *S)], "pa", "pb")

    def run(it):
        out = Outbox(BLOCK_COLUMNS, S)
        for pdf in it:
            for row in pdf.itertuples(index=False):
                shape = (row.sz, row.sy, row.sx)
                x = np.frombuffer(row.pa, da).reshape(shape) if row.pa is not None else np.zeros(shape, da)
                y = np.frombuffer(row.pb, db).reshape(shape) if row.pb is not None else np.zeros(shape, db)
                if out.add((*row[:9], encode(fn(x, y), out_dtype))):
                    yield out.frame()
        if out.rows:
            yield out.frame()

    df = j.select(*G, *O, *S, "pa", "pb").mapInPandas(run, BLOCK_SCHEMA)
    return BlockVolume(df, replace(a.meta, dtype=out_dtype, dense=False), a.block, channels)


def add(a: BlockVolume, b: BlockVolume, on: BlockVolume | None = None, extension="zero") -> BlockVolume:
    """A + B in A's type, on the interval of ``on`` (A)."""
    return pairwise(a, b, lambda x, y, d=a.dtype: saturating(np.add, x, y, d), a.dtype, on=on, extension=extension)


def sub(a: BlockVolume, b: BlockVolume, on: BlockVolume | None = None, extension="zero") -> BlockVolume:
    """A - B in A's type."""
    return pairwise(a, b, lambda x, y, d=a.dtype: saturating(np.subtract, x, y, d), a.dtype, on=on, extension=extension)


def mul(a: BlockVolume, b: BlockVolume, on: BlockVolume | None = None, extension="zero") -> BlockVolume:
    """A * B in A's type; a block absent on either side is zero."""
    return pairwise(a, b, lambda x, y, d=a.dtype: saturating(np.multiply, x, y, d), a.dtype, "inner", on=on, extension=extension)


def div(a: BlockVolume, b: BlockVolume, on: BlockVolume | None = None, extension="zero") -> BlockVolume:
    """A / B over the whole interval in double with IEEE rules (0/0 is NaN)."""
    def fn(x, y):
        with np.errstate(divide="ignore", invalid="ignore"):
            return x.astype(np.float64) / y.astype(np.float64)
    return pairwise(a, b, fn, "float64", "grid", on=on, extension=extension)


def multiply_cell(a: BlockVolume, b: BlockVolume, lo, size) -> BlockVolume:
    """E5: A * B restricted to one cell's interval, which both must hold; cut and multiplied in one exchange."""
    cell = cropped(a, lo, size)
    return mul(a, b, on=replace(a, meta=cell))


def vmax(sources: list[BlockVolume], floor: float | None = 0, on: BlockVolume | None = None) -> BlockVolume:
    """Per-voxel maximum of n volumes of one type, and of ``floor`` (the output's former zeros), on the interval of ``on`` (that which spans them)."""
    dtype, n = sources[0].dtype, len(sources)
    if any(s.dtype != dtype for s in sources):
        raise TypeError("E6 takes volumes of one voxel type")

    def highest(*blocks):
        out = np.maximum.reduce(blocks)
        return out if floor is None else np.maximum(out, np.asarray(floor, out.dtype))
    if not aligned(*sources, *([on] if on is not None else [])):
        on = on or replace(sources[0], meta=spanning([s.meta for s in sources]))
        return combine(sources, highest, dtype, on)
    u = sources[0].df.select(*BLOCK_COLUMNS)
    for s in sources[1:]:
        u = u.unionAll(s.df.select(*BLOCK_COLUMNS))

    def one(pdf: pd.DataFrame):
        r = pdf.iloc[0]
        blocks = [decode(p, dtype, int(r.sx), int(r.sy), int(r.sz)) for p in pdf["payload"]]
        if len(blocks) < n:  # an absent block is zero
            blocks.append(np.zeros_like(blocks[0]))
        return (*(int(r[c]) for c in BLOCK_COLUMNS[:-1]), encode(highest(*blocks), dtype))

    return BlockVolume(grouped_rows(u, list(G), one, BLOCK_SCHEMA, BLOCK_COLUMNS), sources[0].meta, sources[0].block)


def pair(a: BlockVolume, b: BlockVolume, on: BlockVolume | None = None, extension="zero") -> BlockVolume:
    """Two float64 channels (A, B) per voxel."""
    return pairwise(a, b, lambda x, y: np.stack([x, y], -1).astype(np.float64), "float64", channels=2, on=on, extension=extension)


def center_gradient_by_views(bv: BlockVolume, axis: int, extension: str = "mirror_single") -> BlockVolume:
    """F1 as the difference of two shifted views of the extended volume, halved, cropped to the volume (F2).

    Both views are operands on the volume's own grid: one exchange.
    """
    step = [0, 0, 0]
    step[axis] = -1
    behind, ahead = translate_inverse(bv, step), translate(bv, step)  # s(x-1) and s(x+1)
    wide = "float64" if dtype_of(bv.dtype).integer else bv.dtype
    return combine([ahead, behind], lambda b, a: (b.astype(np.float64) - a.astype(np.float64)) * 0.5, wide, bv, extension)


# ------------------------------------------------------------------ F3, F6, F7, F10

def gradient_forward(bv: BlockVolume, axis: int, extension: str = "zero", out_dtype: str = "float64") -> BlockVolume:
    """``s(x+1) - s(x)`` with a halo of one sample along ``axis``."""
    radius = tuple(1 if d == axis else 0 for d in range(3))

    def fn(a):
        a = np.moveaxis(a.astype(np.float64), 2 - axis, 0)
        return np.moveaxis(a[2:] - a[1:-1], 0, 2 - axis)
    return map_blocks(bv, fn, radius, extension, out_dtype, zero_preserving=True)


def _difference(a: np.ndarray, d: int, nd: int) -> np.ndarray:
    """``s(x+1) - s(x-1)`` along axis d (x first) for the array's centre: one sample less at both ends of the nd axes."""
    inner = [slice(None)] * 3
    for e in range(nd):
        inner[2 - e] = slice(1, -1)
    hi, lo = list(inner), list(inner)
    hi[2 - d], lo[2 - d] = slice(2, None), slice(0, -2)
    return a[tuple(hi)] - a[tuple(lo)]


def hessian_entries(a: np.ndarray, sigma, nd: int) -> list[np.ndarray]:
    """``H_de`` for e >= d from an array padded by two samples on the nd axes, in the order of the voxel form."""
    g = [_difference(a, e, nd) * (2.0 / sigma[e]) for e in range(nd)]
    return [_difference(g[e], d, nd) * (2.0 / sigma[e]) for d in range(nd) for e in range(d, nd)]


def hessian_names(nd: int) -> list[str]:
    return [f"h{d}{e}" for d in range(nd) for e in range(d, nd)]


def hessian(bv: BlockVolume, sigma, extension: str = "zero") -> BlockVolume:
    """F6 in one halo exchange of radius 2; a channel per entry (``hessian_names``)."""
    nd = bv.meta.ndim
    radius = tuple(2 if d < nd else 0 for d in range(3))
    return map_blocks(bv, lambda a: np.stack(hessian_entries(a.astype(np.float64), sigma, nd), -1), radius, extension,
                      "float64", zero_preserving=True, out_channels=nd * (nd + 1) // 2)


def tubeness(bv: BlockVolume, sigma, extension: str = "zero") -> BlockVolume:
    """F7 in one halo exchange of radius 2."""
    from .stencil import tubeness_2d_values, tubeness_values
    nd = bv.meta.ndim
    radius = tuple(2 if d < nd else 0 for d in range(3))

    def fn(a):
        h = hessian_entries(a.astype(np.float64), sigma, nd)
        if nd == 2:
            return tubeness_2d_values(*h)
        m = np.empty(h[0].shape + (3, 3))
        for v, (d, e) in zip(h, [(d, e) for d in range(3) for e in range(d, 3)]):
            m[..., d, e] = m[..., e, d] = v
        return tubeness_values(np.linalg.eigvalsh(m).reshape(-1, 3)).reshape(h[0].shape)
    return map_blocks(bv, fn, radius, extension, "float64", zero_preserving=True)


def convolve_separable(bv: BlockVolume, half_kernels, extension: str = "zero", out_dtype: str = "float64") -> BlockVolume:
    """symmetric half-kernels, one per axis (None skips an axis), in one halo exchange."""
    halves = [np.asarray(h, np.float64) if h is not None else None for h in half_kernels]
    halves += [None] * (3 - len(halves))
    radius = tuple(len(h) - 1 if h is not None else 0 for h in halves)
    return map_blocks(bv, lambda a: K.gauss_block(a, halves), radius, extension, out_dtype, zero_preserving=True)


# ------------------------------------------------------------------ C1-C6

def cropped(bv: BlockVolume, lo, size):
    """Metadata of the interval ``[lo, lo+size)`` (in the volume's coordinates), which the volume must hold."""
    at, size = [int(o) - int(m) for o, m in zip(lo, bv.meta.min)], tuple(int(s) for s in size)
    if any(o < 0 or o + s > n for o, s, n in zip(at, size, bv.dims)):
        raise ValueError(f"crop {at}+{size} reaches outside the volume {bv.dims}")
    return replace(bv.meta, dims=size, min=tuple(int(o) for o in lo), dense=False)


def crop(bv: BlockVolume, lo, size) -> BlockVolume:
    """The interval ``[lo, lo+size)`` (in the volume's coordinates); its blocks start at ``lo``.

    Only blocks that meet the interval are read.  If ``lo`` lies on block borders, blocks are cut in place; otherwise
    their pieces are regrouped in one exchange.
    """
    meta, bv = cropped(bv, lo, size), bv.end()
    at, b, dtype, ch = [o - m for o, m in zip(meta.min, bv.meta.min)], bv.block, bv.dtype, bv.channels
    df = bv.df
    for g, o, s, k in zip(G, at, meta.dims, b):
        df = df.filter(F.col(g).between(o // k, (o + s - 1) // k))
    inside = replace(bv, stored=df)
    if any(o % k for o, k in zip(at, b)):
        return on_interval(inside, meta.min, meta.dims, b)

    def cut(it):
        out = Outbox(BLOCK_COLUMNS, S)
        for pdf in it:
            for row in pdf.itertuples(index=False):
                o = [x - p for x, p in zip((row.ox, row.oy, row.oz), at)]
                s = [min(n, e - x) for n, e, x in zip((row.sx, row.sy, row.sz), meta.dims, o)]
                a = decode(row.payload, dtype, row.sx, row.sy, row.sz, ch)[:s[2], :s[1], :s[0]]
                if out.add((*[x // k for x, k in zip(o, b)], *o, *s, encode(a, dtype))):
                    yield out.frame()
        if out.rows:
            yield out.frame()

    return BlockVolume(df.select(*BLOCK_COLUMNS).mapInPandas(cut, BLOCK_SCHEMA), meta, b, ch)


def crop_like(bv: BlockVolume, other: BlockVolume) -> BlockVolume:
    """Crop to another volume's interval."""
    return crop(bv, other.meta.min, other.dims)


def zero_min(bv: BlockVolume) -> BlockVolume:
    """The interval starts at 0 (metadata only)."""
    return replace(bv, meta=replace(bv.meta, min=(0, 0, 0)))


def translate(bv: BlockVolume, t) -> BlockVolume:
    """C4: the value at p moves to p+t (metadata only)."""
    return replace(bv, meta=replace(bv.meta, min=tuple(m + int(d) for m, d in zip(bv.meta.min, t))))


def translate_inverse(bv: BlockVolume, t) -> BlockVolume:
    """result(q) = src(q+t) (metadata only)."""
    return translate(bv, [-int(d) for d in t])


def hyperslice(bv: BlockVolume, axis: int, pos: int) -> BlockVolume:
    """Fix one axis at ``pos`` and drop it; only the blocks that hold the position are read."""
    at, dtype, bv = int(pos) - int(bv.meta.min[axis]), bv.dtype, bv.end()
    keep = [d for d in range(3) if d != axis]
    df = bv.df.filter(F.col(G[axis]) == at // bv.block[axis])

    def cut(it):
        for pdf in it:
            rows = []
            for row in pdf.itertuples(index=False):
                a = decode(row.payload, dtype, row.sx, row.sy, row.sz)
                g, o, s = (row.gx, row.gy, row.gz), (row.ox, row.oy, row.oz), (row.sx, row.sy, row.sz)
                plane = np.take(a, at - o[axis], axis=2 - axis)
                rows.append((g[keep[0]], g[keep[1]], 0, o[keep[0]], o[keep[1]], 0, s[keep[0]], s[keep[1]], 1, encode(plane, dtype)))
            if rows:
                yield pd.DataFrame(rows, columns=BLOCK_COLUMNS)

    pick = lambda v, last: (v[keep[0]], v[keep[1]], last)
    meta = replace(bv.meta, dims=pick(bv.dims, 1), min=pick(bv.meta.min, 0), rank=2, dense=False)
    return BlockVolume(df.select(*BLOCK_COLUMNS).mapInPandas(cut, BLOCK_SCHEMA), meta, pick(bv.block, 1))


def tiled(bv: BlockVolume, op, tile) -> BlockVolume:
    """The operator on tiles of another size, the result in the volume's blocks again."""
    from .blocks import retile
    out = op(retile(bv, tile))
    return retile(out, bv.block)


__all__ = ["aligned", "combine", "cropped", "center_gradient_by_views", "on_interval", "add", "sub", "mul", "div", "multiply_cell", "vmax", "pair", "gradient_forward", "hessian", "hessian_names",
           "tubeness", "convolve_separable", "crop", "crop_like", "zero_min", "translate", "translate_inverse", "hyperslice",
           "tiled"]
