"""H1-H3, H10-H12, A10 and the block-form (scale path) versions of G/F operators.

Each query runs the block plan (halo exchange + numpy kernel per padded block)
and unravels the result to voxels, so it is checked by the same oracle SQL as
its voxel-form twin.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from .. import sqlcheck as q
from ..catalog import ORACLES, register
from ..functions.pointwise import invert
from ..operators import blocks as B
from ..sources import fixtures as fx
from ..volume import Volume, VolumeMeta
from . import q_filters, q_localstats, q_pointwise, q_stencil  # noqa: F401  (oracles reused below)


@register("cllcn_blocks", ORACLES["cllcn"])
def cllcn_blocks(spark, sf_dir):
    """G11 through the halo plan: (16,16,1) blocks, one shuffle, integral images per slice."""
    bv = B.from_voxels(fx.embedding_u16(spark, sf_dir), (16, 16, 1))
    return B.to_voxels(B.cllcn(bv, 5)).df


@register("cllcn_mirror_blocks", ORACLES["cllcn_mirror"])
def cllcn_mirror_blocks(spark, sf_dir):
    """G12 through the halo plan with blocks (7,5,1) that divide no axis."""
    bv = B.from_voxels(fx.embedding_u16(spark, sf_dir), (7, 5, 1))
    return B.to_voxels(B.cllcn(bv, 7, extension="mirror_single")).df


@register("gauss_blocks", ORACLES["gauss"])
def gauss_blocks(spark, sf_dir):
    """F8 through the halo plan (radius 6), result as uint16."""
    bv = B.from_voxels(fx.embedding_u16(spark, sf_dir), (16, 16, 1))
    return B.to_voxels(B.gauss(bv, (2.0, 2.0, 0.0), "zero", out_dtype="uint16")).df


@register("dog_blocks", ORACLES["dog"])
def dog_blocks(spark, sf_dir):
    """F9 through one halo exchange of radius 12 for both kernels."""
    v = fx.embedding_u16(spark, sf_dir)
    inv = Volume(v.df.select("x", "y", "z", invert("v").alias("v")), VolumeMeta(v.dims, "float32"))
    out = B.to_voxels(B.dog(B.from_voxels(inv, (16, 16, 1)), (4.0, 4.0, 0.0), (3.0, 3.0, 0.0), "mirror_single"))
    return out.df.select("x", "y", "z", F.round("v", 3).alias("v"))


@register("retile_roundtrip", q.with_(q.V4) + "SELECT x, y, z, v FROM v4")
def retile_roundtrip(spark, sf_dir):
    """H3 -> H1 -> H2: V4 into (7,5,3) blocks, re-blocked to (16,16,4), back to voxels (zeros dropped)."""
    bv = B.retile(B.from_voxels(fx.lineitem_counts(spark, sf_dir), (7, 5, 3)), (16, 16, 4))
    return B.to_voxels(bv, drop_zeros=True).df


@register("downsample_blocks", ORACLES["downsample"].replace("SELECT x, y, z, v FROM d1", "SELECT x, y, z, v FROM d1 WHERE v <> 0"))
def downsample_blocks(spark, sf_dir):
    """H4 in block form: even (8,8,2) blocks map 1:1 to (4,4,1) output blocks, no shuffle."""
    bv = B.downsample2(B.from_voxels(fx.lineitem_counts(spark, sf_dir), (8, 8, 2)))
    return B.to_voxels(bv, drop_zeros=True).df


@register("nonempty_blocks", q.with_(q.V3) + """SELECT x // 4 AS gx, y // 4 AS gy, z // 2 AS gz, COUNT(*) AS n, CAST(SUM(v) AS BIGINT) AS total
FROM v3 WHERE v <> 0 GROUP BY 1, 2, 3""")
def nonempty_blocks(spark, sf_dir):
    """A10: blocks of V3 (4,4,2) with a non-zero sample (JVM-side test), with their voxel count and sum."""
    bv = B.nonempty(B.from_voxels(fx.event_counts(spark, sf_dir), (4, 4, 2)))
    vox = B.to_voxels(bv, drop_zeros=True).df
    return (vox.groupBy((F.col("x") / 4).cast("bigint").alias("gx"), (F.col("y") / 4).cast("bigint").alias("gy"),
                        (F.col("z") / 2).cast("bigint").alias("gz"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total")))


@register("map_slices_udf", q.with_(q.V2) + "SELECT x, y, z, CAST(least(65535, v * 2) AS INTEGER) AS v FROM v2")
def map_slices_udf(spark, sf_dir):
    """A user slice filter (double the values) with padding 3, clamp to 0..65535, uint16."""
    bv = B.from_voxels(fx.embedding_u16(spark, sf_dir), (32, 32, 1))
    out = B.map_slices(bv, lambda fp: fp * np.float32(2.0), 3, "mirror_single", 0.0, 65535.0, "uint16")
    return B.to_voxels(out).df


@register("map_blocks_udf", q.with_(q.V4, q.V4DIMS) + """SELECT c.x, c.y, c.z, CAST(c.v + COALESCE(n.v, 0) AS BIGINT) AS v
FROM (SELECT tx.i AS x, ty.i AS y, tz.i AS z, COALESCE(v4.v, 0) AS v
      FROM range(0, (SELECT nx FROM v4dims)) tx(i) CROSS JOIN range(0, (SELECT ny FROM v4dims)) ty(i) CROSS JOIN range(0, (SELECT nz FROM v4dims)) tz(i)
      LEFT JOIN v4 ON v4.x = tx.i AND v4.y = ty.i AND v4.z = tz.i) c
LEFT JOIN v4 n ON n.x = c.x + 1 AND n.y = c.y AND n.z = c.z
WHERE c.v + COALESCE(n.v, 0) <> 0""")
def map_blocks_udf(spark, sf_dir):
    """A user block function with halo (1,0,0): s(x) + s(x+1), zero border, 3-D blocks (7,5,3)."""
    bv = B.from_voxels(fx.lineitem_counts(spark, sf_dir), (7, 5, 3))
    out = B.map_blocks(bv, lambda a: a[:, :, 1:-1] + a[:, :, 2:],
                       (1, 0, 0), "zero", "int64", zero_preserving=True)
    return B.to_voxels(out, drop_zeros=True).df


@register("cllcn_strips", ORACLES["cllcn"])
def cllcn_strips(spark, sf_dir):
    """G11 through two strip passes (x sums with halo (5,0,0), then y sums + formula with halo (0,5,0)),
    the plan for large radii where running sums do not apply."""
    bv = B.from_voxels(fx.embedding_u16(spark, sf_dir), (16, 16, 1))
    return B.to_voxels(B.cllcn_strips(bv, 5, prefix=False)).df


@register("cllcn_running_sums", ORACLES["cllcn"])
def cllcn_running_sums(spark, sf_dir):
    """G11 through running sums along x, then y, the plan used automatically for large radii."""
    bv = B.from_voxels(fx.embedding_u16(spark, sf_dir), (16, 16, 1))
    return B.to_voxels(B.cllcn(bv, 5, strips=True)).df


@register("gradient_center_rai_blocks", ORACLES["gradient_center_rai"])
def gradient_center_rai_blocks(spark, sf_dir):
    """F2 in block form: halo of one sample along y, mirror-single border, blocks (7,5,1)."""
    bv = B.from_voxels(fx.embedding_u16(spark, sf_dir), (7, 5, 1))
    return B.to_voxels(B.center_gradient(bv, 1, "mirror_single")).df


@register("gradient_magnitude_3d_blocks", ORACLES["gradient_magnitude_3d"])
def gradient_magnitude_3d_blocks(spark, sf_dir):
    """F5 in 3-D block form on V4 (sparse: absent blocks read as zero), sigma = (1, 2, 4)."""
    bv = B.from_voxels(fx.lineitem_counts(spark, sf_dir), (16, 16, 4))
    out = B.gradient_magnitude(bv, (1.0, 2.0, 4.0), "zero")
    return B.to_voxels(out).df


@register("clahe_blocks", ORACLES["clahe"])
def clahe_blocks(spark, sf_dir):
    """G10 in block form: partial tile histograms per block, tile maps, blend per block with
    the maps of its neighbour tiles; no voxel leaves its block."""
    bv = B.from_voxels(fx.embedding_u16(spark, sf_dir), (16, 16, 1))
    return B.to_voxels(B.clahe(bv, 5)).df


@register("affine_2d_blocks", ORACLES["affine_2d"])
def affine_2d_blocks(spark, sf_dir):
    """H7 in block form: rotate(z, 0.3) then scale(0.9), n-linear, mirror-double, onto V2's interval."""
    from .q_filters import _affine_matrix
    v = fx.embedding_u16(spark, sf_dir)
    out = B.affine(B.from_voxels(v, (16, 16, 1)), _affine_matrix(), (0, 0, 0), v.dims, (16, 16, 1),
                   "mirror_double", "uint16")
    return B.to_voxels(out).df


@register("contrast_window_blocks", ORACLES["contrast_window"])
def contrast_window_blocks(spark, sf_dir):
    """D2 in block form: pointwise on payloads (one mapInPandas, no shuffle), uint8."""
    bv = B.from_voxels(fx.embedding_u16(spark, sf_dir), (16, 16, 1))
    f = lambda a: np.maximum(0.0, np.minimum(255.0, 255.0 - 255.0 * (a.astype(np.float64) - 26000.0) / 6000.0))
    return B.to_voxels(B.map_pointwise(bv, f, "uint8")).df
