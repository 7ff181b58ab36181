"""Coordinate views (C*): crop, translate, slices, extension, copy.

All are projections, filters or equi-joins on coordinates; Catalyst pushes
crops into the scan.  An extension explodes, per axis, the padded positions
that read a voxel: a closed form of its coordinate, without a join.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from ..volume import AXES, Volume, VolumeMeta, idiv

# --------------------------------------------------------------------- C1-C6

def crop(vol: Volume, lo, size) -> Volume:
    """Keep the interval ``[lo, lo+size)``; coordinates unchanged."""
    cond = F.lit(True)
    for a, o, s in zip(AXES, lo, size):
        cond = cond & F.col(a).between(int(o), int(o) + int(s) - 1)
    new_min = tuple(int(o) for o in lo)
    return Volume(vol.df.filter(cond), VolumeMeta(tuple(int(s) for s in size), vol.dtype, new_min))


def zero_min(vol: Volume) -> Volume:
    """Shift so that the interval starts at 0."""
    m = vol.meta.min
    df = vol.df.select(*[(F.col(a) - F.lit(int(o))).alias(a) for a, o in zip(AXES, m)], "v")
    return Volume(df, VolumeMeta(vol.dims, vol.dtype))


def translate(vol: Volume, t) -> Volume:
    """C4: the value at p moves to p+t."""
    df = vol.df.select(*[(F.col(a) + F.lit(int(d))).alias(a) for a, d in zip(AXES, t)], "v")
    return Volume(df, VolumeMeta(vol.dims, vol.dtype, tuple(m + int(d) for m, d in zip(vol.meta.min, t))))


def translate_inverse(vol: Volume, t) -> Volume:
    """result(q) = src(q+t)."""
    return translate(vol, [-int(d) for d in t])


def hyperslice(vol: Volume, axis: int, pos: int) -> Volume:
    """Fix one axis at ``pos`` and drop it (remaining axes shift down)."""
    keep = [a for i, a in enumerate(AXES) if i != axis]
    df = vol.df.filter(F.col(AXES[axis]) == int(pos)).select(
        F.col(keep[0]).alias("x"), F.col(keep[1]).alias("y"), F.lit(0).cast("bigint").alias("z"), "v")
    dims = tuple(d for i, d in enumerate(vol.dims) if i != axis) + (1,)
    mn = tuple(d for i, d in enumerate(vol.meta.min) if i != axis) + (0,)
    return Volume(df, VolumeMeta(dims, vol.dtype, mn))


def slice_positions(n: int) -> list[int]:
    """The three display slices used for a stack: n/10*4, n/2, n/10*6 (integer division first)."""
    return [n // 10 * 4, n // 2, n // 10 * 6]


def interval_of(vol: Volume) -> DataFrame:
    """C11/B11 measured from data: min, max and element count of the occupied box."""
    aggs = []
    for a in AXES:
        aggs += [F.min(a).alias(f"min_{a}"), F.max(a).alias(f"max_{a}")]
    box = vol.df.agg(*aggs)
    return box.withColumn("num_elements", F.lit(1).cast("bigint") * (F.col("max_x") - F.col("min_x") + 1)
                          * (F.col("max_y") - F.col("min_y") + 1) * (F.col("max_z") - F.col("min_z") + 1))


# --------------------------------------------------------------------- C7-C9

def mirror_single_index(i: Column, n: int) -> Column:
    """C8 (edge sample not repeated): ``m = pmod(i, 2n-2); m < n ? m : 2n-2-m``; n = 1 -> 0."""
    if n == 1:
        return F.lit(0).cast("bigint")
    p = 2 * n - 2
    m = F.pmod(i, F.lit(p))
    return F.when(m < n, m).otherwise(F.lit(p) - m)


def mirror_double_index(i: Column, n: int) -> Column:
    """C9 (edge sample repeated): ``m = pmod(i, 2n); m < n ? m : 2n-1-m``."""
    p = 2 * n
    m = F.pmod(i, F.lit(p))
    return F.when(m < n, m).otherwise(F.lit(p - 1) - m)


def mirror_index(i: Column, n: int, mode: str) -> Column:
    if mode == "mirror_single":
        return mirror_single_index(i, n)
    if mode == "mirror_double":
        return mirror_double_index(i, n)
    raise ValueError(f"unknown mirror mode {mode!r}")


def mirrored_positions(m: Column, n: int, lo: int, hi: int, mode: str) -> Column:
    """All ``i`` in ``[lo, hi]`` with ``mirror_index(i, n, mode) == m``, as an array.

    They are ``m`` and its reflection (``-m`` or ``-m-1``) plus multiples of the period.
    """
    if n == 1:
        return F.sequence(F.lit(lo).cast("bigint"), F.lit(hi).cast("bigint"))
    if mode not in ("mirror_single", "mirror_double"):
        raise ValueError(f"unknown mirror mode {mode!r}")
    p, other = (2 * n - 2, -m) if mode == "mirror_single" else (2 * n, -m - 1)

    def steps(c: Column) -> Column:
        start = c + F.ceil((F.lit(lo) - c) / p) * p
        return F.when(start <= hi, F.sequence(start, F.greatest(start, F.lit(hi)), F.lit(p).cast("bigint"))) \
            .otherwise(F.array().cast("array<bigint>"))
    return F.array_union(steps(m.cast("bigint")), steps(other.cast("bigint")))


def extend_axis(df: DataFrame, axis: str, n: int, pad: int, m0: int, mode: str) -> DataFrame:
    """Rows re-read at every padded position of one axis (at most ``1 + ceil(pad/n)`` times each)."""
    at = mirrored_positions(F.col(axis) - F.lit(int(m0)), n, -pad, n - 1 + pad, mode)
    cols = [c for c in df.columns if c != axis]
    return df.select(F.explode(at).alias("_i"), *cols).select(
        *[(F.col("_i") + F.lit(int(m0))).alias(axis) if c == axis else F.col(c) for c in df.columns])


def extend(vol: Volume, pad, mode: str = "zero") -> Volume:
    """Materialise the volume on its interval grown by ``pad`` per axis.

    ``zero`` adds no rows (absent reads as 0); mirror modes explode each axis in turn.
    """
    meta = VolumeMeta(tuple(d + 2 * int(p) for d, p in zip(vol.dims, pad)), vol.dtype,
                      tuple(m - int(p) for m, p in zip(vol.meta.min, pad)))
    df = vol.df
    if mode != "zero":
        for a, n, p, m0 in zip(AXES, vol.dims, pad, vol.meta.min):
            if int(p):
                df = extend_axis(df, a, n, int(p), m0, mode)
    return Volume(df, meta)


def densify(vol: Volume) -> Volume:
    """Fill absent voxels inside ``dims`` with 0 (needed before row-shaped windows).

    The coordinate grid comes from ``spark.range`` (one row per voxel, split
    into many partitions), then one left equi-join on coordinates.  A voxel
    outside ``dims`` is an error, not a row that disappears.
    """
    spark = vol.df.sparkSession
    nx, ny, nz = vol.dims
    mx, my, mz = vol.meta.min
    n = nx * ny * nz
    ids = F.col("id")
    grid = spark.range(0, n).select(
        (ids % nx + mx).alias("x"), (idiv(ids, nx) % ny + my).alias("y"), (idiv(ids, nx * ny) + mz).alias("z"))
    vt = vol.df.schema["v"].dataType
    inside = F.lit(True)
    for a, m0, n in zip(AXES, vol.meta.min, vol.dims):
        inside = inside & F.col(a).between(int(m0), int(m0) + int(n) - 1)
    where = F.concat_ws(",", *AXES)
    outside = F.raise_error(F.concat(F.lit("voxel outside the volume's dims: "), where)).cast("boolean")
    # a filter above the join's input: it sees every row, also those the join would drop
    src = vol.df.where(F.when(F.coalesce(inside, F.lit(False)), F.lit(True)).otherwise(outside))
    df = grid.join(src, list(AXES), "left").select(*AXES, F.coalesce("v", F.lit(0).cast(vt)).alias("v"))
    return Volume(df, replace(vol.meta, dense=True))


def ensure_dense(vol: Volume) -> Volume:
    """The volume itself if its metadata says every voxel has a row, else ``densify``."""
    return vol if vol.meta.dense else densify(vol)


# --------------------------------------------------------------------- C12-C14

def copy_into(source: Volume, target: Volume) -> Volume:
    """Write source values over the target's interval (others keep target)."""
    s = source.df.select(*AXES, F.col("v").alias("_s"))
    df = target.df.join(s, list(AXES), "left").select(*AXES, F.coalesce("_s", "v").alias("v"))
    return Volume(df, target.meta)


def copy_real(source: Volume, target: Volume, dtype: str) -> Volume:
    """C12 with conversion of the source through double to ``dtype``."""
    from ..functions.pointwise import to_type
    s = source.with_df(source.df.select(*AXES, to_type("v", dtype).alias("v")), dtype=dtype)
    t = target.with_df(target.df.select(*AXES, to_type("v", dtype).alias("v")), dtype=dtype)
    return copy_into(s, t)


def first_slice_float(vol: Volume) -> Volume:
    """C14: the first 2-D slice (z = min z) as float32."""
    z0 = vol.meta.min[2]
    df = vol.df.filter(F.col("z") == z0).select("x", "y", F.lit(0).cast("bigint").alias("z"),
                                                 F.col("v").cast("float").alias("v"))
    return Volume(df, VolumeMeta((vol.dims[0], vol.dims[1], 1), "float32", (vol.meta.min[0], vol.meta.min[1], 0)))


def crop_like(vol: Volume, other: Volume) -> Volume:
    """Crop to another volume's interval (taken from its metadata)."""
    return crop(vol, other.meta.min, other.dims)


def raster_order(vol: Volume) -> DataFrame:
    """Voxels in flat-iteration order (x fastest).  Only where order is
    observable (a sorted export); operators never depend on row order."""
    return vol.df.orderBy("z", "y", "x")
