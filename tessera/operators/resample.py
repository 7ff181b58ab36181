"""Resampling (H4-H7): x2 downsampling, pyramids, affine n-linear resampling.

Downsampling is one aggregation keyed by the target voxel (partial sums
before the shuffle).  Affine resampling maps each target voxel through T^-1,
emits its 2^n interpolation corners with weights (``explode``), maps corners
through the extension, equi-joins the source and sums per target.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..functions.pointwise import to_type
from ..volume import AXES, Volume, VolumeMeta, idiv
from .coords import mirror_index


def downsampled_dims(dims) -> tuple[int, int, int]:
    """H5: ``(n + 1) div 2`` per axis (size-1 axes stay 1)."""
    return tuple((int(n) + 1) // 2 for n in dims)


def downsample2(vol: Volume, out_dtype: str | None = None) -> Volume:
    """H4: half-pixel x2 downsampling in all axes, float computation.

    target(i) = mean of source(2i), source(2i+1); an odd end mirrors its last
    sample, which equals the mean over the samples inside the dims (absent
    sparse voxels count as 0), so the divisor is the number of source
    positions inside the dims, not ``count(*)``.
    """
    out_dtype = out_dtype or vol.dtype
    m = vol.meta.min
    keys = [idiv(F.col(a) - F.lit(int(m0)), 2).alias(a) for a, m0 in zip(AXES, m)]
    agg = vol.df.groupBy(*keys).agg(F.sum(F.col("v").cast("double")).alias("s"))
    cnt = F.lit(1.0)
    for a, n in zip(AXES, vol.dims):
        cnt = cnt * F.least(F.lit(2), F.lit(int(n)) - F.col(a) * 2).cast("double")
    mean = F.col("s") / cnt
    dims = downsampled_dims(vol.dims)
    val = to_type(mean, out_dtype) if out_dtype else mean
    return Volume(agg.select(*AXES, val.alias("v")), VolumeMeta(dims, out_dtype))


def pyramid(vol: Volume, levels: int, out_dtype: str | None = None) -> list[Volume]:
    """H6: repeated H4; level k is rounded to the type before level k+1 reads it."""
    from ..session import cut_lineage
    out, cur = [], vol
    for _ in range(levels):
        cur = downsample2(cur, out_dtype)
        cur = cur.with_df(cut_lineage(cur.df))  # read by the next level and by the caller: computed once
        out.append(cur)
    return out


# ------------------------------------------------------------------ H7

def affine_identity() -> np.ndarray:
    return np.hstack([np.eye(3), np.zeros((3, 1))])


def _h(t: np.ndarray) -> np.ndarray:
    return np.vstack([t, [0, 0, 0, 1]])


def rotate(t: np.ndarray, axis: int, angle: float) -> np.ndarray:
    """Pre-multiply a rotation about ``axis`` (right-handed), as successive calls compose."""
    c, s = math.cos(angle), math.sin(angle)
    r = np.eye(4)
    i, j = [(1, 2), (0, 2), (0, 1)][axis]
    if axis == 1:
        r[0, 0], r[0, 2], r[2, 0], r[2, 2] = c, s, -s, c
    else:
        r[i, i], r[i, j], r[j, i], r[j, j] = c, -s, s, c
    return (r @ _h(t))[:3]


def scale(t: np.ndarray, s: float) -> np.ndarray:
    """Pre-multiply a uniform scaling."""
    return (np.diag([s, s, s, 1.0]) @ _h(t))[:3]


def inverse(t: np.ndarray) -> np.ndarray:
    return np.linalg.inv(_h(t))[:3]


def target_coords(spark, lo, size) -> DataFrame:
    nx, ny, nz = (int(s) for s in size)
    i = F.col("id")
    return spark.range(0, nx * ny * nz).select(
        (i % nx + int(lo[0])).alias("x"), (idiv(i, nx) % ny + int(lo[1])).alias("y"), (idiv(i, nx * ny) + int(lo[2])).alias("z"))


def affine(vol: Volume, t: np.ndarray, target_min, target_size, extension: str = "mirror_double",
           out_dtype: str | None = None) -> Volume:
    """H7 (P9): target(q) = n-linear interpolation of the extended source at T^-1 q.

    2-D volumes interpolate in x, y only (4 corners), 3-D in all axes (8).
    """
    spark = vol.df.sparkSession
    nd = vol.meta.ndim
    ti = inverse(np.asarray(t, dtype=np.float64))
    tg = target_coords(spark, target_min, target_size)
    p = []
    for r in range(nd):
        e = F.lit(float(ti[r, 0])) * F.col("x").cast("double") + F.lit(float(ti[r, 1])) * F.col("y").cast("double") \
            + F.lit(float(ti[r, 2])) * F.col("z").cast("double") + F.lit(float(ti[r, 3]))
        p.append(e)
    tg = tg.select(*AXES, *[pe.alias(f"p{r}") for r, pe in enumerate(p)])
    tg = tg.select(*AXES, *[F.floor(f"p{r}").alias(f"f{r}") for r in range(nd)],
                   *[(F.col(f"p{r}") - F.floor(f"p{r}")).alias(f"t{r}") for r in range(nd)])
    corners = []
    for c in range(2 ** nd):
        bits = [(c >> r) & 1 for r in range(nd)]
        w = F.lit(1.0)
        for r, b in enumerate(bits):
            w = w * (F.col(f"t{r}") if b else (F.lit(1.0) - F.col(f"t{r}")))
        coords = [F.col(f"f{r}") + F.lit(b) for r, b in enumerate(bits)]
        if nd == 2:
            coords.append(F.col("z"))
        corners.append(F.struct(*[cc.cast("bigint").alias(f"c{r}") for r, cc in enumerate(coords)], w.alias("w")))
    ex = tg.select(*AXES, F.explode(F.array(*corners)).alias("k")).select(*AXES, "k.*")
    inside = F.lit(True)
    mapped = []
    for r, (n, m0) in enumerate(zip(vol.dims, vol.meta.min)):
        rel = F.col(f"c{r}") - F.lit(int(m0))
        if extension == "zero":
            inside = inside & rel.between(0, n - 1)
            mapped.append(F.col(f"c{r}").alias(f"s{r}"))
        else:
            mapped.append((mirror_index(rel, n, extension) + F.lit(int(m0))).alias(f"s{r}"))
    ex = ex.select(*AXES, "w", *mapped, inside.alias("inside"))
    src = vol.df.select(*[F.col(a).alias(f"s{r}") for r, a in enumerate(AXES)], F.col("v").cast("double").alias("v"))
    j = ex.join(src, ["s0", "s1", "s2"], "left")
    val = F.when(F.col("inside"), F.coalesce(F.col("v"), F.lit(0.0))).otherwise(F.lit(0.0))
    out = j.groupBy(*AXES).agg(F.sum(F.col("w") * val).alias("v"))
    dims = tuple(int(s) for s in target_size)
    if out_dtype:
        out = out.select(*AXES, to_type("v", out_dtype).alias("v"))
    return Volume(out, VolumeMeta(dims, out_dtype or "float64", tuple(int(m) for m in target_min)))
