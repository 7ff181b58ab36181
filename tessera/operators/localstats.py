"""Local window statistics and local contrast normalisation.

Voxel form.  A box sum over ``[x-r, x+r] x [y-r, y+r]`` per slice is computed
in two separable passes; each pass is a prefix sum along one axis
(``rowsBetween(unboundedPreceding, 0)``, incremental, O(1) per row whatever
the radius) and a difference of two shifted prefix values (``lead``/``lag`` on
an axis that is dense after extension).  Integer inputs are summed as BIGINT,
exactly.  Each pass is one hash exchange on the slice key.

The slice operator pads axes 0 and 1 by the radius with the extension before
taking statistics, so every kept voxel sees a full window: the count is the
constant ``(2rx+1)(2ry+1)``, extension samples included.

A window partition is a segment of an axis line with the radius around it (``SEGMENT``), so it is
bounded whatever the volume.  The block form (:mod:`tessera.operators.blocks`, halo plan with
bounded groups) moves far fewer bytes and is the one to run at scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.pointwise import clamp, ieee_div, soft_limit_constants, to_type
from ..volume import Volume, VolumeMeta, idiv
from .coords import ensure_dense, extend
from .kernels import exact_sums


SEGMENT = 4096  # samples of a line in a window partition, or four radii if that is more


def _segments(df: DataFrame, axis: str, r: int, lo: int, n: int):
    """Rows dealt to segments of the axis, each with the r samples on both sides of it (at most 1.5 rows for one).

    Gives (rows, further partition columns, what keeps a segment's own rows)."""
    size = max(SEGMENT, 4 * r)
    if n <= size:
        return df, [], lambda d: d
    at = F.col(axis) - F.lit(int(lo))
    first = idiv(F.greatest(at - r, F.lit(0)), size)
    last = F.least(idiv(at + r, size), F.lit((n - 1) // size))
    return (df.withColumn("_seg", F.explode(F.sequence(first, last))), ["_seg"],
            lambda d: d.where(idiv(at, size) == F.col("_seg")).drop("_seg"))


def _axis_window_sum(df: DataFrame, cols: list[str], axis: str, others: list[str], r: int, lo: int, n: int) -> DataFrame:
    """Add ``<c>_w`` = sum of ``c`` over ``[axis-r, axis+r]`` for each c in cols.

    Rows must be dense along ``axis`` inside each ``others`` group, from ``lo`` on ``n`` of them; positions
    beyond the group's ends count as 0.  Running sums start with the segment's first row, which is r before its own first.
    """
    df, more, own = _segments(df, axis, r, lo, n)
    w_order = Window.partitionBy(*others, *more).orderBy(axis)
    w_cum = w_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_all = Window.partitionBy(*others, *more)
    if any(df.schema[c].dataType.typeName() == "double" for c in cols):
        # doubles: frames over the window's own rows, so that no other sample can reach a sum
        frame = w_order.rowsBetween(-r, r)
        return own(df.select("*", *[F.sum(c).over(frame).alias(f"{c}_w") for c in cols]))
    for c in cols:
        df = df.withColumn(f"_p_{c}", F.sum(c).over(w_cum))
    sel = []
    for c in cols:
        p = F.col(f"_p_{c}")
        hi = F.coalesce(F.lead(p, r).over(w_order), F.sum(c).over(w_all))
        lo = F.coalesce(F.lag(p, r + 1).over(w_order), F.lit(0).cast(df.schema[c].dataType))
        sel.append((hi - lo).alias(f"{c}_w"))
    keep = [c for c in df.columns if not c.startswith("_p_")]
    return own(df.select(*keep, *sel))


def box_sums(vol: Volume, rx: int, ry: int, extension: str = "zero", as_float: bool = False) -> DataFrame:
    """Per voxel: ``S`` = window sum of v, ``Q`` = window sum of v^2 (exact for small integer types).

    ``as_float``: samples go through float32 first, as the slice operator does.

    Output columns ``x, y, z, v, S, Q`` for every voxel of the input's interval
    (a sparse input is densified first).
    """
    vol = ensure_dense(vol)  # prefix differences need every row along the axis
    vt = "bigint" if exact_sums(vol.dtype, max(rx, ry)) else "double"
    src = vol if extension == "zero" else extend(vol, (rx, ry, 0), extension)
    v = (F.col("v").cast("float") if as_float else F.col("v")).cast(vt)
    df = src.df.select("x", "y", "z", v.alias("a"), (v * v).alias("b"))
    (x0, y0, _), (x1, y1, _) = vol.meta.min, vol.meta.max
    (lx, ly, _), (nx, ny, _) = src.meta.min, src.dims
    df = _axis_window_sum(df, ["a", "b"], "x", ["z", "y"], rx, lx, nx)
    if extension != "zero":
        # the pass over y needs the padded rows, but only the kept columns
        df = df.filter(F.col("x").between(x0, x1))
    df = df.select("x", "y", "z", "a", F.col("a_w").alias("s1"), F.col("b_w").alias("q1"))
    df = _axis_window_sum(df, ["s1", "q1"], "y", ["z", "x"], ry, ly, ny)
    if extension != "zero":
        df = df.filter(F.col("y").between(y0, y1))
    return df.select("x", "y", "z", F.col("a").alias("v"), F.col("s1_w").alias("S"), F.col("q1_w").alias("Q"))


def _stats(rx: int, ry: int):
    """Column expressions for mean / sample variance / std, in the reference's operation order."""
    bs = (2 * rx + 1) * (2 * ry + 1)
    S = F.col("S").cast("double")
    Q = F.col("Q").cast("double")
    scale = 1.0 / bs
    scale1 = 1.0 / (bs - 1) if bs > 1 else float("inf")
    scale2 = 1.0 / (bs * bs - bs) if bs > 1 else float("inf")
    mean = S * F.lit(scale)
    var = F.lit(scale1) * Q - F.lit(scale2) * S * S
    std = F.when(var < 0, F.lit(0.0)).otherwise(F.sqrt(var))
    return mean, var, std


def box_stats(vol: Volume, r: int, extension: str = "zero") -> DataFrame:
    """Window sum, mean, sample variance and std per voxel (full windows)."""
    mean, var, std = _stats(r, r)
    return box_sums(vol, r, r, extension).select(
        "x", "y", "z", "v", "S", "Q", mean.alias("mean"), var.alias("var"), std.alias("std"))


def _fv() -> Column:
    # the slice is converted to float before filtering
    return F.col("v").cast("float").cast("double")


# The expressions below read staged columns ``_mean``, ``_std`` (and ``_s``)
# so that Catalyst analyses small trees; ``cllcn`` adds them by projections.
def _mean() -> Column:
    return F.col("_mean")


def _std() -> Column:
    return F.col("_std")


def _scol() -> Column:
    return F.col("_s")


def center_expr(fp_min, fp_max) -> Column:
    """G3 ``runCenter``: ``v - mean + fpMean``."""
    fp_mean = (fp_max - fp_min) / 2.0 + fp_min
    return (_fv() - _mean()) + F.lit(fp_mean)


def stretch_expr(k, fp_min, fp_max) -> Column:
    """G4 ``runStretch`` (gamma = 1): ``(v - fpMean)/2/d * L + fpMean``, d = k*std."""
    L = fp_max - fp_min
    fp_mean = L / 2.0 + fp_min
    d = F.lit(float(k)) * _std()
    return ieee_div((_fv() - F.lit(fp_mean)) / 2.0, d) * F.lit(L) + F.lit(fp_mean)


def _limit(x: Column, limit: float, gamma: float) -> Column:
    a, b = soft_limit_constants(limit, gamma)
    return F.when(x < F.lit(float(limit)), x).otherwise(F.pow(x + F.lit(a), F.lit(float(gamma))) + F.lit(b))


def s_expr(k, limit, gamma, fp_min, fp_max) -> Column:
    """``s = d == 0 ? 0 : 0.5 * limit(1/d * L)`` with d = k*std."""
    L = fp_max - fp_min
    d = F.lit(float(k)) * _std()
    return F.when(d == 0, F.lit(0.0)).otherwise(F.lit(0.5) * _limit(ieee_div(F.lit(1.0), d) * F.lit(L), limit, gamma))


def stretch_limited_expr(fp_min, fp_max) -> Column:
    """G5 ``runStretch`` (limited): ``(v - fpMean) * s * L + fpMean`` (the extra L is reproduced)."""
    L = fp_max - fp_min
    fp_mean = L / 2.0 + fp_min
    return (_fv() - F.lit(fp_mean)) * _scol() * F.lit(L) + F.lit(fp_mean)


def center_stretch_expr(k, fp_min, fp_max) -> Column:
    """G6 ``runCenterStretch`` (gamma = 1): ``(v - (mean - d))/2/d * L + fpMin``."""
    L = fp_max - fp_min
    d = F.lit(float(k)) * _std()
    return ieee_div((_fv() - (_mean() - d)) / 2.0, d) * F.lit(L) + F.lit(fp_min)


def center_stretch_limited_expr(keep_min_max, fp_min, fp_max) -> Column:
    """``(v - (mean - L/s*0.5)) * s + fpMin``; ``keepMinMax`` leaves v == min or max unchanged.

    Constant regions give s = 0 -> L/s = Inf -> Inf*0 = NaN (P11), reproduced.
    """
    L = fp_max - fp_min
    vmin = _mean() - ieee_div(F.lit(L), _scol()) * F.lit(0.5)
    out = (_fv() - vmin) * _scol() + F.lit(fp_min)
    if keep_min_max:
        out = F.when((_fv() == F.lit(float(fp_min))) | (_fv() == F.lit(float(fp_max))), _fv()).otherwise(out)
    return out


def cllcn_expr(k=3.0, limit=10.0, gamma=0.5, center=True, stretch=True, keep_min_max=True,
               fp_min=0.0, fp_max=65535.0) -> tuple[bool, Column]:
    """G8 dispatch, chosen at plan time: (needs ``_s``, float result before clamping)."""
    if gamma == 1:
        if center:
            return False, center_stretch_expr(k, fp_min, fp_max) if stretch else center_expr(fp_min, fp_max)
        return False, stretch_expr(k, fp_min, fp_max) if stretch else _fv()
    if center:
        if stretch:
            return True, center_stretch_limited_expr(keep_min_max, fp_min, fp_max)
        return False, center_expr(fp_min, fp_max)
    return (True, stretch_limited_expr(fp_min, fp_max)) if stretch else (False, _fv())


def cllcn(vol: Volume, r: int, k: float = 3.0, limit: float = 10.0, gamma: float = 0.5,
          center: bool = True, stretch: bool = True, keep_min_max: bool = True,
          extension: str = "zero", min_intensity: float = 0.0, max_intensity: float = 65535.0,
          out_dtype: str | None = None) -> Volume:
    """G8/G11/G12 as the slice operator runs it: float slice, filter, float store, clamp, convert (P10).

    ``min_intensity``/``max_intensity`` are both the processor's display range
    (``fpMin``/``fpMax``) and the clamp range, as in the reference job.
    """
    out_dtype = out_dtype or vol.dtype
    mean, _, std = _stats(r, r)
    staged = box_sums(vol, r, r, extension, as_float=True).select("x", "y", "z", "v", mean.alias("_mean"), std.alias("_std"))
    need_s, f = cllcn_expr(k, limit, gamma, center, stretch, keep_min_max, min_intensity, max_intensity)
    if need_s:
        staged = staged.withColumn("_s", s_expr(k, limit, gamma, min_intensity, max_intensity))
    sums = staged
    stored = f.cast("float").cast("double")
    clamped = clamp(stored, min_intensity, max_intensity)
    return Volume(sums.select("x", "y", "z", to_type(clamped, out_dtype).alias("v")),
                  VolumeMeta(vol.dims, out_dtype, vol.meta.min))


def normalize_local_contrast(vol: Volume, r: int, k: float = 3.0, center: bool = True, stretch: bool = True,
                             extension: str = "mirror_single", **kw) -> Volume:
    """G9 (pinned as G8 with gamma = 1): the notebook's local contrast normalisation."""
    return cllcn(vol, r, k=k, limit=10.0, gamma=1.0, center=center, stretch=stretch, keep_min_max=False,
                 extension=extension, **kw)
