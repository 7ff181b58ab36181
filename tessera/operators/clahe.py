"""CLAHE (G10), pinned definition P8, voxel form.

Per 2-D slice: tiles of side ``T = 2r+1`` aligned to the slice origin;
``bins`` histogram bins over ``[lo, hi]``; clip limit ``slope * count / bins``
with the excess spread evenly over all bins once; tile map = clipped CDF
scaled to the range; each voxel blends the maps of the four tiles whose
centres surround it (bilinear, clamped at the borders).

Plan: histogram = one aggregation keyed by (slice, tile, bin) with partial
counts before the shuffle; the CDF is a running window sum per tile over the
tile's full bin range (bounded: ``bins`` rows per tile); the blend explodes
four (tile, bin, weight) lookups per voxel, equi-joins the map table and sums
per voxel.  Nothing is broadcast (the map table grows with the image).
"""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..functions.pointwise import to_type
from ..volume import AXES, Volume, VolumeMeta, idiv
from .coords import ensure_dense


def clahe(vol: Volume, r: int, bins: int = 256, slope: float = 3.0, lo: float = 0.0, hi: float = 65535.0,
          out_dtype: str | None = None) -> Volume:
    out_dtype = out_dtype or vol.dtype
    vol = ensure_dense(vol)  # tile counts and outputs cover every voxel
    T = 2 * r + 1
    nx, ny, _ = vol.dims
    mx, my, _ = vol.meta.min
    ntx, nty = (nx + T - 1) // T, (ny + T - 1) // T
    span = float(hi - lo + 1)
    x = F.col("x") - F.lit(mx)
    y = F.col("y") - F.lit(my)
    b = F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor((F.col("v").cast("double") - F.lit(float(lo)))
                                                                   * F.lit(float(bins)) / F.lit(span)))).cast("int")
    vox = vol.df.select(*AXES, "v", idiv(x, T).alias("tx"), idiv(y, T).alias("ty"), b.alias("b"))

    hist = vox.groupBy("z", "tx", "ty", "b").agg(F.count(F.lit(1)).alias("h"))
    maps = tile_maps(hist, bins, slope, lo, hi)

    gx = (x.cast("double") - F.lit(float(r))) / F.lit(float(T))
    gy = (y.cast("double") - F.lit(float(r))) / F.lit(float(T))
    pos = vox.select(*AXES, "b", F.floor(gx).alias("fx"), (gx - F.floor(gx)).alias("wx"),
                     F.floor(gy).alias("fy"), (gy - F.floor(gy)).alias("wy"))

    def clampt(c, n):
        return F.least(F.lit(n - 1), F.greatest(F.lit(0), c)).cast("bigint")

    corners = []
    for bx in (0, 1):
        for by in (0, 1):
            w = ((F.col("wx") if bx else (F.lit(1.0) - F.col("wx")))
                 * (F.col("wy") if by else (F.lit(1.0) - F.col("wy"))))
            corners.append(F.struct(clampt(F.col("fx") + bx, ntx).alias("tx"), clampt(F.col("fy") + by, nty).alias("ty"),
                                    w.alias("w")))
    look = pos.select(*AXES, "b", F.explode(F.array(*corners)).alias("k")).select(*AXES, "b", "k.*")
    out = (look.join(maps, ["z", "tx", "ty", "b"]).groupBy(*AXES).agg(F.sum(F.col("w") * F.col("m")).alias("v")))
    return Volume(out.select(*AXES, to_type("v", out_dtype).alias("v")), VolumeMeta(vol.dims, out_dtype, vol.meta.min))


def tile_maps(hist, bins: int = 256, slope: float = 3.0, lo: float = 0.0, hi: float = 65535.0):
    """Clipped-CDF map per tile from counts ``(z, tx, ty, b, h)``: rows ``(z, tx, ty, b, m)``
    for every bin (``bins`` rows per tile, a bound independent of the data size)."""
    tiles = hist.groupBy("z", "tx", "ty").agg(F.sum("h").alias("n"))
    full = (tiles.select("z", "tx", "ty", "n", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("b"))
            .join(hist, ["z", "tx", "ty", "b"], "left")
            .select("z", "tx", "ty", "b", "n", F.coalesce("h", F.lit(0)).cast("double").alias("h")))
    limit = F.lit(float(slope)) * F.col("n").cast("double") / F.lit(float(bins))
    full = full.withColumn("c", F.least(F.col("h"), limit))
    wt = Window.partitionBy("z", "tx", "ty")
    wc = wt.orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    full = full.withColumn("excess", F.sum(F.col("h") - F.col("c")).over(wt))
    cdf = F.sum("c").over(wc) + (F.col("b") + 1).cast("double") * F.col("excess") / F.lit(float(bins))
    return full.select("z", "tx", "ty", "b",
                       (F.lit(float(lo)) + F.lit(float(hi - lo)) * cdf / F.col("n").cast("double")).alias("m"))
