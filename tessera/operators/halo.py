"""The halo plan: block volumes, chains of kernels on them, and the one exchange that brings blocks what they read.

Schema of a block volume (one row per stored block; an absent block is all zero)::

    gx, gy, gz BIGINT   grid position      ox, oy, oz BIGINT  offset from the interval's min
    sx, sy, sz INT      cropped size       payload BINARY     little-endian, x fastest

A target block of the result is computed from *operands*.  An operand is a block volume with any
number of stages (kernels with a halo, x2 downsampling) on top, seen on the target's interval:

1. per axis, ``levels`` follows a target cell backwards: its interval in the operand's coordinates, mapped through
   the extension, then through every stage (padded by its radius and mapped through its own extension; doubled by a
   downsampling).  The image of a contiguous range is contiguous, so each level is one range; all of it is
   a function of the metadata, computed per worker and cached;
2. every source block enters Python once and emits one trimmed piece for each target whose source range it meets,
   so only samples that a target reads are shuffled, whatever the origins and block sizes of the two grids;
3. one exchange on the target's grid position groups the pieces of all operands (``grouped_rows``); the kernels run
   one after the other on a block that shrinks from level to level.

A border rule holds for every intermediate volume by itself: where a stage reads outside the volume it finds zeros
or the mirrored samples of the stage before, which its level covers.  So a chain gives what its operators give one by one,
with one shuffle.  A group holds the source range of one target, never more.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass, replace
from typing import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..plans.grid import block_grid
from ..volume import VolumeMeta, dtype_of
from . import kernels as K

G, O, S = ("gx", "gy", "gz"), ("ox", "oy", "oz"), ("sx", "sy", "sz")
BLOCK_SCHEMA = ("gx bigint, gy bigint, gz bigint, ox bigint, oy bigint, oz bigint, "
                "sx int, sy int, sz int, payload binary")
BLOCK_COLUMNS = ["gx", "gy", "gz", "ox", "oy", "oz", "sx", "sy", "sz", "payload"]
OUT_BYTES = 8 << 20  # payload that a task holds before it hands rows on
# A padded group of a halo plan stays below this where another plan exists.
MAX_GROUP_BYTES = 256 << 20


@dataclass(frozen=True)
class Stage:
    """A kernel of a chain: ``fn(padded) -> centre``, its halo and border, and the type it gives.

    ``fn`` gets numpy axes z, y, x (and, with ``with_origin``, offset and size of the centre, x first) and returns the centre or an array
    of the padded shape.  ``halved`` marks the axes that a x2 downsampling halves.
    """

    fn: Callable
    dims: tuple[int, int, int]  # of its input
    dtype: str  # of its result
    radius: tuple[int, int, int] = (0, 0, 0)
    extension: str = "zero"
    channels: int = 1
    zero_preserving: bool = False
    with_origin: bool = False
    halved: tuple[bool, bool, bool] = (False, False, False)


@dataclass(frozen=True)
class BlockVolume:
    """Blocks with their metadata.  In a chain (see ``chain``) ``source`` is what the ``stages`` start from."""

    stored: DataFrame | None
    meta: VolumeMeta
    block: tuple[int, int, int]
    channels: int = 1  # samples per voxel in the payload (trailing numpy axis when > 1)
    source: "BlockVolume | None" = None
    stages: tuple[Stage, ...] = ()

    @property
    def df(self) -> DataFrame:
        """Rows of the volume; those of a chain are planned as one exchange."""
        if self.source is None:
            return self.stored
        if not self.stages and tuple(self.block) == tuple(self.source.block):
            return self.source.df
        return gathered([operand(self)], lambda a: a, self.meta, self.block, self.dtype, self.channels,
                        every_block=not all(s.zero_preserving for s in self.stages))

    @property
    def dims(self):
        return self.meta.dims

    @property
    def dtype(self):
        return self.meta.dtype

    def grid(self) -> DataFrame:
        return block_grid((self.stored if self.source is None else self.source.df).sparkSession, self.dims, self.block)

    def chain(self) -> "BlockVolume":
        """The same volume, on which operators collect: they run in one exchange when rows are asked for.

        Stencils, convolutions, slice operators, pointwise converters, retile and x2 downsampling collect;
        operators with a plan of their own read the rows of the chain so far.
        """
        return self if self.source is not None else replace(self, stored=None, source=self)

    def end(self) -> "BlockVolume":
        """The chain as an ordinary volume: what follows is planned by itself."""
        return self if self.source is None else BlockVolume(self.df, self.meta, self.block, self.channels)

    def then(self, op: Callable[["BlockVolume"], "BlockVolume"], *, expect_dtype: str | None = None,
             expect_ndim: int | None = None, expect_block=None) -> "BlockVolume":
        """Chain an operator (H9), checking type, dimensionality and block size first."""
        if expect_dtype is not None and self.dtype != expect_dtype:
            raise TypeError(f"operator expects {expect_dtype}, volume is {self.dtype}")
        if expect_ndim is not None and self.meta.ndim != expect_ndim:
            raise ValueError(f"operator expects {expect_ndim}-D input, volume is {self.meta.ndim}-D")
        if expect_block is not None and tuple(self.block) != tuple(expect_block):
            raise ValueError(f"operator expects blocks of {tuple(expect_block)}, volume has {tuple(self.block)}")
        return op(self)


def decode(payload: bytes, dtype: str, sx: int, sy: int, sz: int, channels: int = 1) -> np.ndarray:
    shape = (sz, sy, sx) if channels == 1 else (sz, sy, sx, channels)
    return np.frombuffer(payload, dtype=np.dtype(dtype_of(dtype).numpy)).reshape(shape)


def encode(a: np.ndarray, dtype: str) -> bytes:
    return np.ascontiguousarray(a, dtype=np.dtype(dtype_of(dtype).numpy)).tobytes()


class Outbox:
    """Rows on their way out of a task, handed on in frames of about ``OUT_BYTES`` of payload."""

    def __init__(self, columns: list[str], int_columns: tuple[str, ...] = ()):
        self.columns, self.int_columns, self.rows, self.held = columns, int_columns, [], 0

    def add(self, row: tuple) -> bool:
        """Whether the frame is full."""
        self.rows.append(row)
        self.held += sum(len(x) for x in row if isinstance(x, (bytes, bytearray))) + 64
        return self.held > OUT_BYTES

    def frame(self) -> pd.DataFrame:
        out = pd.DataFrame(self.rows, columns=self.columns)
        self.rows, self.held = [], 0
        return out.astype({c: "int32" for c in self.int_columns})


def grouped_many(df: DataFrame, keys: list[str], per_group: Callable, schema: str, columns: list[str],
                 int_columns: tuple[str, ...] = ()) -> DataFrame:
    """Grouped map with one Python call per Arrow batch instead of per group; ``per_group`` gives any number of rows.

    Same physical shape as ``groupBy(keys).applyInPandas``: one hash exchange
    on ``keys``, a sort inside each partition, then ``mapInPandas`` walks the
    contiguous groups of each batch; a group that continues into the next
    batch is carried over, so a group is never split and never larger in
    memory than itself.  Rows leave in bounded frames.
    """
    def run(it):
        carry, out = None, Outbox(columns, int_columns)
        for pdf in it:
            if carry is not None and len(carry):
                pdf = pd.concat([carry, pdf], ignore_index=True)
            if not len(pdf):
                continue
            k = pdf[keys].to_numpy()
            tail = (k == k[-1]).all(axis=1)
            cut = int(np.argmax(tail))
            body, carry = pdf.iloc[:cut], pdf.iloc[cut:]
            if len(body):
                kb = k[:cut]
                starts = np.concatenate([[0], np.flatnonzero((kb[1:] != kb[:-1]).any(axis=1)) + 1, [cut]])
                for a, b in zip(starts[:-1], starts[1:]):
                    for row in per_group(body.iloc[a:b]):
                        if out.add(row):
                            yield out.frame()
        if carry is not None and len(carry):
            for row in per_group(carry):
                if out.add(row):
                    yield out.frame()
        if out.rows:
            yield out.frame()

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


def grouped_rows(df: DataFrame, keys: list[str], per_group: Callable[[pd.DataFrame], tuple | None], schema: str,
                 columns: list[str]) -> DataFrame:
    """``grouped_many`` with one row a group, or none (None)."""
    def rows(pdf):
        row = per_group(pdf)
        return () if row is None else (row,)
    return grouped_many(df, keys, rows, schema, columns)


# ------------------------------------------------------------------ ranges along one axis

def _index_map(lo: int, hi: int, n: int, mode: str) -> np.ndarray:
    i = np.arange(lo, hi + 1)
    if mode == "zero":
        return np.where((i >= 0) & (i < n), i, -1)
    if mode == "mirror_single":
        if n == 1:
            return np.zeros_like(i)
        p = 2 * n - 2
        m = np.mod(i, p)
        return np.where(m < n, m, p - m)
    p = 2 * n
    m = np.mod(i, p)
    return np.where(m < n, m, p - 1 - m)


def image(lo: int, hi: int, n: int, mode: str) -> tuple[int, int]:
    """The range of samples of ``[0, n)`` that ``[lo, hi]`` reads through the extension (empty: first > last)."""
    if mode == "zero" or (lo >= 0 and hi < n) or lo > hi:
        return max(lo, 0), min(hi, n - 1)
    if hi - lo >= 2 * n:
        return 0, n - 1
    m = _index_map(lo, hi, n, mode)
    return int(m.min()), int(m.max())


@dataclass(frozen=True)
class AxisPlan:
    """How targets along one axis read an operand: ``steps`` are (samples of the input, radius, extension, halved) of its stages."""

    steps: tuple[tuple[int, int, str, bool], ...]
    n: int           # samples of the operand, its stages done
    extension: str   # of the operand, beyond its interval
    shift: int       # operand coordinate of the target's first sample
    target: int      # samples of the target
    block: int       # of the target

    def cell(self, t: int) -> tuple[int, int]:
        """A target cell in the operand's coordinates."""
        return t * self.block + self.shift, min(self.target, (t + 1) * self.block) - 1 + self.shift


@functools.lru_cache(maxsize=4096)
def levels(plan: AxisPlan, t: int) -> tuple[tuple[int, int], ...]:
    """Ranges of the operand's levels that target cell t reads: the source first, the last stage's result last."""
    lo, hi = image(*plan.cell(t), plan.n, plan.extension)
    out = [(lo, hi)]
    for n, r, mode, halved in reversed(plan.steps):
        if lo > hi:
            lo, hi = 0, -1
        elif halved:
            lo, hi = 2 * lo, min(2 * hi + 1, n - 1)
        else:
            lo, hi = image(lo - r, hi + r, n, mode)
        out.append((lo, hi))
    return tuple(reversed(out))


@functools.lru_cache(maxsize=64)
def source_ranges(plan: AxisPlan) -> tuple[np.ndarray, np.ndarray]:
    """First and last source sample of every target cell (empty: first > last)."""
    found = [levels(plan, t)[0] for t in range(-(-plan.target // plan.block))]
    return np.array([x[0] for x in found], np.int64), np.array([x[1] for x in found], np.int64)


def target_ranges(n: int, r: int, mode: str, tb: int) -> tuple[np.ndarray, np.ndarray]:
    """``source_ranges`` of one stage of radius r on the volume's own interval."""
    return source_ranges(AxisPlan(((n, r, mode, False),), n, "zero", 0, n, tb))


# ------------------------------------------------------------------ operands

@dataclass(frozen=True)
class Operand:
    """A block volume with stages on top, extended beyond its interval by ``extension``."""

    volume: BlockVolume
    stages: tuple[Stage, ...] = ()
    extension: str = "zero"
    min: tuple[int, int, int] | None = None  # of the interval after the stages; None: the volume's

    @property
    def dims(self) -> tuple[int, int, int]:
        d = tuple(self.volume.dims)
        for s in self.stages:
            d = tuple((n + 1) // 2 if h else n for n, h in zip(d, s.halved))
        return d

    def plans(self, target_min, target_dims, block) -> tuple[AxisPlan, ...]:
        at = self.min if self.min is not None else self.volume.meta.min
        return tuple(AxisPlan(tuple((s.dims[d], s.radius[d], s.extension, s.halved[d]) for s in self.stages), self.dims[d],
                              self.extension, int(target_min[d]) - int(at[d]), int(target_dims[d]), int(block[d])) for d in range(3))


PIECE = ["tx", "ty", "tz", "side", "px", "py", "pz", "nx", "ny", "nz", "payload"]
PIECE_SCHEMA = ("tx bigint, ty bigint, tz bigint, side int, px bigint, py bigint, pz bigint, nx int, ny int, nz int, payload binary")


def pieces(bv: BlockVolume, plans: tuple[AxisPlan, ...], side: int = 0) -> DataFrame:
    """Every source block cut into the pieces that targets read (step 2 of the plan)."""
    dtype, ch = bv.dtype, bv.channels

    def cut(it):
        ranges, out = [source_ranges(p) for p in plans], Outbox(PIECE, ("side", "nx", "ny", "nz"))
        for pdf in it:
            for row in pdf.itertuples(index=False):
                a = decode(row.payload, dtype, row.sx, row.sy, row.sz, ch)
                o, s = (row.ox, row.oy, row.oz), (row.sx, row.sy, row.sz)
                per_axis = []
                for d in range(3):
                    lo, hi = np.maximum(ranges[d][0], o[d]), np.minimum(ranges[d][1], o[d] + s[d] - 1)
                    per_axis.append([(int(t), int(lo[t]), int(hi[t])) for t in np.flatnonzero(lo <= hi)])
                for tz, lz, hz in per_axis[2]:
                    for ty, ly, hy in per_axis[1]:
                        for tx, lx, hx in per_axis[0]:
                            part = a[lz - o[2]:hz - o[2] + 1, ly - o[1]:hy - o[1] + 1, lx - o[0]:hx - o[0] + 1]
                            if out.add((tx, ty, tz, side, lx, ly, lz, hx - lx + 1, hy - ly + 1, hz - lz + 1,
                                        np.ascontiguousarray(part).tobytes())):
                                yield out.frame()
        if out.rows:
            yield out.frame()

    df = bv.df
    for g, p, n, b in zip(G, plans, bv.dims, bv.block):  # blocks that no target reads stay unread
        lo, hi = source_ranges(p)
        there = lo <= hi
        first, last = (int(lo[there].min()), int(hi[there].max())) if there.any() else (0, -1)
        if first > 0 or last < n - 1:
            df = df.filter(F.col(g).between(first // b, last // b) if first <= last else F.lit(False))
    return df.select(*O, *S, "payload").mapInPandas(cut, PIECE_SCHEMA)


def _paste(pdf: pd.DataFrame, ranges, dtype: str, channels: int) -> np.ndarray:
    """The samples of the source ranges (x first) from their pieces; what no piece covers is zero."""
    np_dt = np.dtype(dtype_of(dtype).numpy)
    tail = () if channels == 1 else (channels,)
    lo = [r[0] for r in ranges]
    out = np.zeros(tuple(max(0, h - l + 1) for l, h in reversed(ranges)) + tail, np_dt)
    for row in pdf.itertuples(index=False):
        if row.payload is not None:
            x, y, z = row.px - lo[0], row.py - lo[1], row.pz - lo[2]
            out[z:z + row.nz, y:y + row.ny, x:x + row.nx] = np.frombuffer(row.payload, np_dt).reshape((row.nz, row.ny, row.nx) + tail)
    return out


def _read(a: np.ndarray, have, want, dims, mode) -> np.ndarray:
    """The array of the ranges ``want`` through the extension (one rule, or one for each axis), from one that covers the ranges ``have``."""
    if all(w == h for w, h in zip(want, have)):
        return a
    modes = [mode] * 3 if isinstance(mode, str) else mode
    index = [_index_map(w[0], w[1], n, m) for w, n, m in zip(want, dims, modes)]
    out = np.zeros(tuple(len(i) for i in reversed(index)) + a.shape[3:], a.dtype)
    there = [i >= 0 for i in index]
    if all(t.any() for t in there):
        at = [i[t] - h[0] for i, t, h in zip(index, there, have)]
        out[np.ix_(*reversed(there))] = a[np.ix_(*reversed(at))]
    return out


def _halved(a: np.ndarray, stage: Stage) -> np.ndarray:
    """x2 downsampling of a region that starts on even samples: means over what lies inside the volume."""
    total, count = a.astype(np.float64), np.ones(a.shape)
    for d in range(3):
        if stage.halved[d]:
            ax = 2 - d
            if total.shape[ax] % 2:
                pad = [(0, 0)] * 3
                pad[ax] = (0, 1)
                total, count = np.pad(total, pad), np.pad(count, pad)
            shape = list(total.shape)
            shape[ax:ax + 1] = [shape[ax] // 2, 2]
            total, count = total.reshape(shape).sum(ax + 1), count.reshape(shape).sum(ax + 1)
    return K.to_dtype(total / count, stage.dtype)


def _run(a: np.ndarray, stages, per_axis) -> np.ndarray:
    """The stages on a source region; ``per_axis`` has the levels of each axis."""
    for k, stage in enumerate(stages):
        have, goal = [p[k] for p in per_axis], [p[k + 1] for p in per_axis]
        tail = () if stage.channels == 1 else (stage.channels,)
        shape = tuple(max(0, h - l + 1) for l, h in reversed(goal))
        if 0 in shape:
            a = np.zeros(shape + tail, np.dtype(dtype_of(stage.dtype).numpy))
        elif any(stage.halved):
            a = _halved(a, stage)
        else:
            r = stage.radius
            a = _read(a, have, [(l - x, h + x) for (l, h), x in zip(goal, r)], stage.dims, stage.extension)
            out = np.asarray(stage.fn(a, [l for l, _ in goal], list(shape[::-1])) if stage.with_origin else stage.fn(a))
            if out.shape != shape + tail:
                out = out[r[2]:r[2] + shape[0], r[1]:r[1] + shape[1], r[0]:r[0] + shape[2]]
            a = out if out.dtype == np.dtype(dtype_of(stage.dtype).numpy) else K.to_dtype(out, stage.dtype)  # P1/P2, not a truncating cast
    return a


def gathered(operands: list[Operand], fn: Callable, meta: VolumeMeta, block, out_dtype: str, out_channels: int = 1,
             every_block: bool = False, need_all: bool = False) -> DataFrame:
    """Blocks of ``fn(array of each operand)`` on the interval of ``meta``, in one exchange.

    A block that no operand reaches is left out unless ``every_block``; with ``need_all`` also one that
    some operand does not reach.  An operand without samples there is an array of zeros.
    """
    block, dims = tuple(int(b) for b in block), tuple(int(n) for n in meta.dims)
    plans = [op.plans(meta.min, dims, block) for op in operands]
    rows = functools.reduce(DataFrame.unionAll, [pieces(op.volume, p, i) for i, (op, p) in enumerate(zip(operands, plans))])
    spark = rows.sparkSession
    if every_block:
        zero, none = F.lit(0).cast("long"), F.lit(0).cast("int")
        rows = rows.unionAll(block_grid(spark, dims, block).select(
            *G, F.lit(-1).cast("int").alias("side"), *[zero.alias(c) for c in ("px", "py", "pz")],
            *[none.alias(c) for c in ("nx", "ny", "nz")], F.lit(None).cast("binary").alias("payload")))
    shapes = [(op.stages, op.volume.dtype, op.volume.channels, op.dims, op.extension) for op in operands]
    tail = () if out_channels == 1 else (out_channels,)

    def target(pdf: pd.DataFrame):
        t = [int(pdf[c].iloc[0]) for c in ("tx", "ty", "tz")]
        o = [x * b for x, b in zip(t, block)]
        s = [min(b, n - x) for x, b, n in zip(o, block, dims)]
        side = pdf["side"].to_numpy()
        if need_all and any(not (side == i).any() for i in range(len(shapes))):
            return None
        arrays = []
        for i, ((stages, dtype, ch, op_dims, mode), plan) in enumerate(zip(shapes, plans)):
            per_axis = [levels(p, x) for p, x in zip(plan, t)]
            a = _run(_paste(pdf if len(shapes) == 1 else pdf[side == i], [p[0] for p in per_axis], dtype, ch), stages, per_axis)
            arrays.append(_read(a, [p[-1] for p in per_axis], [p.cell(x) for p, x in zip(plan, t)], op_dims, mode))
        out = np.asarray(fn(*arrays))
        if out.shape != (s[2], s[1], s[0]) + tail:
            raise ValueError(f"kernel gave {out.shape} for a block of {(s[2], s[1], s[0]) + tail}")
        if out.dtype != np.dtype(dtype_of(out_dtype).numpy):
            out = K.to_dtype(out, out_dtype)
        return (*t, *o, *s, encode(out, out_dtype))

    return grouped_rows(rows, ["tx", "ty", "tz"], target, BLOCK_SCHEMA, BLOCK_COLUMNS)


def added(bv: BlockVolume, stage: Stage, dims=None, vmin=None, block=None) -> BlockVolume:
    """The volume with one more stage: collected in a chain, planned at once otherwise.

    A chain whose padded group would outgrow ``MAX_GROUP_BYTES`` ends before the stage.
    """
    meta = replace(bv.meta, dtype=stage.dtype, dims=tuple(dims or bv.dims), min=tuple(vmin or bv.meta.min), dense=False)
    block = tuple(int(b) for b in (block or bv.block))
    if bv.source is None:
        op = Operand(bv, (stage,), min=meta.min)
        df = gathered([op], lambda a: a, meta, block, stage.dtype, stage.channels, every_block=not stage.zero_preserving)
        return BlockVolume(df, meta, block, stage.channels)
    longer = replace(bv, meta=meta, block=block, channels=stage.channels, stages=bv.stages + (stage,))
    if bv.stages and group_bytes(longer) > MAX_GROUP_BYTES:
        return added(replace(bv.end(), stored=None, source=bv.end()), stage, dims, vmin, block)
    return longer


def group_bytes(bv: BlockVolume) -> int:
    """Bytes of the widest level of a chain's group, in float64."""
    size, most = [float(b) for b in bv.block], 0.0
    channels = bv.channels
    for s in reversed(bv.stages):
        size = [min(n, 2 * x if h else x + 2 * r) for x, r, h, n in zip(size, s.radius, s.halved, s.dims)]
        most = max(most, math.prod(size) * 8 * channels)
        channels = 1
    return int(most)


def map_blocks(bv: BlockVolume, fn: Callable[[np.ndarray], np.ndarray], radius=(0, 0, 0), extension: str = "zero",
               out_dtype: str | None = None, zero_preserving: bool = False, target_block=None,
               out_channels: int = 1, with_origin: bool = False) -> BlockVolume:
    """``fn(padded) -> centre`` per block, halo ``radius`` per axis.

    ``fn`` receives the padded block (numpy axes z, y, x; with ``with_origin`` also
    the centre's offset and size, x first) and returns either
    the centre or an array of the padded shape (cropped here).  With
    ``zero_preserving=False`` every block of the grid is computed, also where
    no source block exists (a kernel may map zeros to non-zero values).  A ``radius`` of fewer axes is filled with zeros.
    """
    stage = Stage(fn, tuple(bv.dims), out_dtype or bv.dtype, (*(int(r) for r in radius), 0, 0, 0)[:3], extension, out_channels, zero_preserving,
                  with_origin)
    return added(bv, stage, block=target_block)


def on_interval(bv: BlockVolume, vmin, dims, block=None, extension: str = "zero") -> BlockVolume:
    """The volume on another interval, in blocks that start at its ``vmin``; beyond its own interval it is extended.

    Crop, border extension and re-blocking in one exchange (C1, C7-C9, H1).
    """
    meta = replace(bv.meta, min=tuple(int(m) for m in vmin), dims=tuple(int(n) for n in dims), dense=False)
    block = tuple(int(b) for b in (block or bv.block))
    df = gathered([operand(bv, extension)], lambda a: a, meta, block, bv.dtype, bv.channels)
    return BlockVolume(df, meta, block, bv.channels)


def operand(bv: BlockVolume, extension: str = "zero") -> Operand:
    """A volume as an operand: the stages of a chain run inside its consumer's exchange."""
    if bv.source is None:
        return Operand(bv, (), extension)
    return Operand(bv.source, bv.stages, extension, tuple(bv.meta.min))
