"""Block-form operators and 3-D volumes: pairwise, stencils, views, flagship operators and jobs on V4 and V5, and the chunk store's rules.

``V5U`` is V5 as u16 (cents // 200), so that values spread over the type's range.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
from pyspark.sql import functions as F

from .. import jobs as J
from .. import sqlcheck as q
from ..catalog import ORACLES, register
from ..functions.pointwise import to_type
from ..operators import blockops as BO
from ..operators import blocks as B
from ..operators import compare as CMP
from ..operators import coords as C
from ..operators import resample as RS
from ..session import scratch_dir
from ..sources import attributes as AT
from ..sources import chunked as CH
from ..sources import fixtures as fx
from ..volume import Volume, VolumeMeta
from .q_filters import BOX, BOX_Y, _down_sql, _sep_sql
from .q_jobs import _v4_u16
from .q_localstats import _clahe_sql

BLK = (16, 16, 4)
V5U = "v5u AS (SELECT x, y, z, CAST(least(65535, v // 200) AS BIGINT) AS v FROM v5)"
D5 = [q.V4DIMS, q.V5, V5U, q.dense_sql("d5", "v5u")]
D4 = [q.V4DIMS, q.V4, q.dense_sql("d4", "v4")]


def _nonzero(sql: str) -> str:
    return f"SELECT * FROM ({sql}) WHERE v <> 0"


def _v4(spark, sf_dir) -> B.BlockVolume:
    return B.from_voxels(fx.lineitem_counts(spark, sf_dir), BLK)


def _v5(spark, sf_dir) -> B.BlockVolume:
    return B.from_voxels(fx.lineitem_revenue(spark, sf_dir), BLK)


def _v5u(spark, sf_dir) -> B.BlockVolume:
    v = fx.lineitem_revenue(spark, sf_dir)
    df = v.df.select("x", "y", "z", to_type(F.floor(F.col("v") / 200), "uint16").alias("v"))
    return B.from_voxels(Volume(df, VolumeMeta(v.dims, "uint16", rank=3)), BLK)


def _v2(spark, sf_dir) -> B.BlockVolume:
    return B.from_voxels(fx.embedding_u16(spark, sf_dir), (16, 16, 1))


# ------------------------------------------------------------------ E1-E7

@register("vol_add_blocks", ORACLES["vol_add"])
def vol_add_blocks(spark, sf_dir):
    """E1 in block form: one join on grid keys."""
    return B.to_voxels(BO.add(_v4(spark, sf_dir), _v5(spark, sf_dir)), drop_zeros=True).df


@register("vol_sub_blocks", _nonzero(ORACLES["vol_sub"]))
def vol_sub_blocks(spark, sf_dir):
    """E2 in block form."""
    return B.to_voxels(BO.sub(_v5(spark, sf_dir), _v4(spark, sf_dir)), drop_zeros=True).df


@register("vol_mul_blocks", _nonzero(ORACLES["vol_mul"]))
def vol_mul_blocks(spark, sf_dir):
    """E3 in block form."""
    return B.to_voxels(BO.mul(_v4(spark, sf_dir), _v5(spark, sf_dir)), drop_zeros=True).df


@register("vol_mul_saturated", q.with_(*D5) + "SELECT x, y, z, CAST(least(65535, v * 7) AS INTEGER) AS v FROM d5 WHERE v <> 0")
def vol_mul_saturated(spark, sf_dir):
    """E3 in uint16: products past 65535 saturate (V5U times a constant volume of 7)."""
    a = _v5u(spark, sf_dir)
    seven = B.map_pointwise(a, lambda x: np.where(x > 0, 7, 0), "uint16")
    return B.to_voxels(BO.mul(a, seven), drop_zeros=True).df


@register("vol_div_blocks", ORACLES["vol_div"])
def vol_div_blocks(spark, sf_dir):
    """E4 in block form over the whole interval, IEEE rules."""
    return B.to_voxels(BO.div(_v5(spark, sf_dir), _v4(spark, sf_dir))).df


@register("multiply_cell_blocks", _nonzero(ORACLES["multiply_cell"]))
def multiply_cell_blocks(spark, sf_dir):
    """E5 in block form: both sides cropped by grid keys first."""
    return B.to_voxels(BO.multiply_cell(_v4(spark, sf_dir), _v5(spark, sf_dir), (8, 16, 0), (2, 16, 4)), drop_zeros=True).df


ORACLES["multiply_cell_blocks"] = ORACLES["multiply_cell_blocks"].replace("BETWEEN 8 AND 15", "BETWEEN 8 AND 9")


@register("vol_max_blocks", q.with_(q.V4, q.V5) + """SELECT x, y, z, greatest(max(v), 0) AS v FROM (
  SELECT x, y, z, v FROM v4 UNION ALL SELECT x, y, z, v // 100000 FROM v5 UNION ALL SELECT x, y, z, 3 - v FROM v4)
GROUP BY x, y, z HAVING greatest(max(v), 0) <> 0""")
def vol_max_blocks(spark, sf_dir):
    """E6 in block form over three volumes and the output's zero content."""
    v4, v5 = _v4(spark, sf_dir), _v5(spark, sf_dir)
    small = B.map_pointwise(v5, lambda a: a // 100000)
    flipped = B.map_pointwise(v4, lambda a: np.where(a > 0, 3 - a, 0))
    return B.to_voxels(BO.vmax([v4, small, flipped]), drop_zeros=True).df


@register("pair_blocks", q.with_(q.V4, q.V5) + """SELECT v4.x, v4.y, v4.z, CAST(v4.v AS DOUBLE) AS a, CAST(v5.v AS DOUBLE) AS b
FROM v4 JOIN v5 ON v4.x = v5.x AND v4.y = v5.y AND v4.z = v5.z""")
def pair_blocks(spark, sf_dir):
    """E7 in block form: two channels; occupied voxels only."""
    df = B.channels_to_voxels(BO.pair(_v4(spark, sf_dir), _v5(spark, sf_dir)), ["a", "b"])
    return df.where("a <> 0 AND b <> 0")


# ------------------------------------------------------------------ F3, F6, F7, F10, G1, G2

@register("gradient_forward_blocks", _nonzero(ORACLES["gradient_forward"]))
def gradient_forward_blocks(spark, sf_dir):
    """F3 in block form: halo of one sample along y."""
    return B.to_voxels(BO.gradient_forward(_v4(spark, sf_dir), 1), drop_zeros=True).df


@register("hessian_2d_blocks", ORACLES["hessian_2d"])
def hessian_2d_blocks(spark, sf_dir):
    """F6 in block form: one halo exchange of radius 2, a channel per entry."""
    h = BO.hessian(_v2(spark, sf_dir), (2.0, 2.0))
    return B.channels_to_voxels(h, BO.hessian_names(2))


@register("tubeness_2d_blocks", ORACLES["tubeness_2d"])
def tubeness_2d_blocks(spark, sf_dir):
    """F7 (n = 2) in block form."""
    t = B.to_voxels(BO.tubeness(_v2(spark, sf_dir), (2.0, 2.0)))
    return t.df.select("x", "y", "z", (F.round("v", 6) + F.lit(0.0)).alias("v"))


@register("tubeness_3d_blocks", _nonzero(ORACLES["tubeness_3d"]))
def tubeness_3d_blocks(spark, sf_dir):
    """F7 (n = 3) in block form: one halo exchange of radius 2 and a vectorised eigenvalue kernel."""
    t = B.to_voxels(BO.tubeness(_v4(spark, sf_dir), (1.0, 1.0, 1.0)))
    return t.df.select("x", "y", "z", (F.round("v", 6) + F.lit(0.0)).alias("v")).where("v <> 0")


@register("convolve_separable_blocks", ORACLES["convolve_separable"])
def convolve_separable_blocks(spark, sf_dir):
    """F10 in block form: user half-kernels along x and y."""
    out = B.to_voxels(BO.convolve_separable(_v2(spark, sf_dir), [BOX, BOX_Y, None]))
    return out.df.select("x", "y", "z", F.round("v", 4).alias("v"))


def _box_sql(r):
    mean, var, std = q.stats_sql(r)
    return (q.with_(*D5, q.box_window_sql("d5", r)) + f"""SELECT x, y, z, CAST(S AS DOUBLE) AS S, CAST(Q AS DOUBLE) AS Q, {mean} AS mean,
  {var} AS var, {std} AS std FROM boxed WHERE Q <> 0""")


@register("box_stats_blocks", _box_sql(2))
def box_stats_blocks(spark, sf_dir):
    """G1/G2 in block form on V5U, slice by slice; windows with a sample."""
    return B.channels_to_voxels(B.box_stats(_v5u(spark, sf_dir), 2), ["S", "Q", "mean", "var", "std"]).where("Q <> 0")


# ------------------------------------------------------------------ flagship operators in 3-D

def _cllcn_3d_sql(r, **kw):
    out = q.to_int(q.clamp(q.f32(q.cllcn_sql(r, **kw)), 0.0, 65535.0), 0, 65535, "INTEGER")
    return _nonzero(q.with_(*D5, q.box_window_sql("d5", r)) + f"SELECT x, y, z, {out} AS v FROM boxed")


@register("cllcn_3d_blocks", _cllcn_3d_sql(3))
def cllcn_3d_blocks(spark, sf_dir):
    """G11 on all slices of V5U."""
    return B.to_voxels(B.cllcn(_v5u(spark, sf_dir), 3), drop_zeros=True).df


@register("cllcn_3d_strips", _cllcn_3d_sql(3))
def cllcn_3d_strips(spark, sf_dir):
    """G11 on all slices of V5U in two strip passes."""
    return B.to_voxels(B.cllcn(_v5u(spark, sf_dir), 3, strips=True), drop_zeros=True).df


@register("cllcn_large_blocks", _cllcn_3d_sql(5))
def cllcn_large_blocks(spark, sf_dir):
    """G11 on V5U in blocks of 64 cubed."""
    v = _v5u(spark, sf_dir)
    return B.to_voxels(B.cllcn(B.retile(v, (64, 64, 64)), 5), drop_zeros=True).df


@register("cllcn_center_blocks", _cllcn_3d_sql(2, center=True, stretch=False))
def cllcn_center_blocks(spark, sf_dir):
    """G3 in block form."""
    return B.to_voxels(B.cllcn(_v5u(spark, sf_dir), 2, center=True, stretch=False), drop_zeros=True).df


@register("cllcn_stretch_blocks", _cllcn_3d_sql(2, gamma=1.0, center=False, stretch=True))
def cllcn_stretch_blocks(spark, sf_dir):
    """G4 in block form."""
    return B.to_voxels(B.cllcn(_v5u(spark, sf_dir), 2, gamma=1.0, center=False, stretch=True), drop_zeros=True).df


@register("cllcn_stretch_limited_blocks", _cllcn_3d_sql(2, center=False, stretch=True))
def cllcn_stretch_limited_blocks(spark, sf_dir):
    """G5 in block form."""
    return B.to_voxels(B.cllcn(_v5u(spark, sf_dir), 2, center=False, stretch=True), drop_zeros=True).df


@register("cllcn_center_stretch_blocks", _cllcn_3d_sql(2, gamma=1.0))
def cllcn_center_stretch_blocks(spark, sf_dir):
    """G6 in block form."""
    return B.to_voxels(B.cllcn(_v5u(spark, sf_dir), 2, gamma=1.0), drop_zeros=True).df


@register("lcn_blocks", ORACLES["lcn"])
def lcn_blocks(spark, sf_dir):
    """G9 in block form: mirror-single border, gamma = 1, V2."""
    return B.to_voxels(B.cllcn(_v2(spark, sf_dir), 4, gamma=1.0, keep_min_max=False, extension="mirror_single")).df


def _gauss_3d_sql():
    ctes, last = _sep_sql("d5", [1.5, 1.5, 1.0], "g", "zero", "v4dims")
    return _nonzero(q.with_(*D5, *ctes) + f"SELECT x, y, z, {q.to_int('v', 0, 65535, 'INTEGER')} AS v FROM {last}")


@register("gauss_3d_blocks", _gauss_3d_sql())
def gauss_3d_blocks(spark, sf_dir):
    """F8 in 3-D: one halo exchange, uint16."""
    return B.to_voxels(B.gauss(_v5u(spark, sf_dir), (1.5, 1.5, 1.0), "zero", "uint16"), drop_zeros=True).df


@register("gauss_tiles", _gauss_3d_sql())
def gauss_tiles(spark, sf_dir):
    """The same on tiles of (32,8,2), put back into the volume's blocks."""
    out = BO.tiled(_v5u(spark, sf_dir), lambda b: B.gauss(b, (1.5, 1.5, 1.0), "zero", "uint16"), (32, 8, 2))
    return B.to_voxels(out, drop_zeros=True).df


@register("clahe_3d_blocks", _clahe_sql(4, src=[*D5, "v2 AS (SELECT * FROM d5)"], dims="v2dims AS (SELECT nx, ny FROM v4dims)"))
def clahe_3d_blocks(spark, sf_dir):
    """G10 on all slices of V5U: packed tile histograms (the halo plan is for tiles smaller than these)."""
    return B.to_voxels(B.clahe(_v5u(spark, sf_dir), 4)).df


@register("clahe_3d_halo", ORACLES["clahe_3d_blocks"])
def clahe_3d_halo(spark, sf_dir):
    """G10 on all slices of V5U in one halo exchange."""
    return B.to_voxels(B.clahe(_v5u(spark, sf_dir), 4, halo=True)).df


@register("map_slices_3d", q.with_(*D5) + "SELECT x, y, z, CAST(least(65535, v * 2) AS INTEGER) AS v FROM d5 WHERE v <> 0")
def map_slices_3d(spark, sf_dir):
    """U1/H11 on all slices of V5U: double the values, clamp to 0..65535."""
    out = B.map_slices(_v5u(spark, sf_dir), lambda fp: fp * np.float32(2.0), 3, "mirror_single", 0.0, 65535.0, "uint16",
                       zero_preserving=True)
    return B.to_voxels(out, drop_zeros=True).df


def _affine_3d_ctes(src, dims, target):
    """CTEs ex (target voxel, mapped corner, weight) for the view-plane transform of a 3-D source."""
    p = q.unrotated("x", "y", "z")
    corner = ", ".join(f"CAST(f{d} + b{d} AS BIGINT) AS c{d}" for d in range(3))
    w = " * ".join(f"(CASE WHEN b{d} = 1 THEN t{d} ELSE 1.0 - t{d} END)" for d in range(3))
    bits = ", ".join(f"({c & 1}, {c >> 1 & 1}, {c >> 2 & 1})" for c in range(8))
    mapped = " AND ".join(f"s.{a} = {q.mirror_double(f'ex.c{d}', dims[d])}" for d, a in enumerate("xyz"))
    return [f"tg AS ({target})", f"pp AS (SELECT x, y, z, {', '.join(f'{e} AS p{d}' for d, e in enumerate(p))} FROM tg)",
            f"fl AS (SELECT x, y, z, {', '.join(f'floor(p{d}) AS f{d}, p{d} - floor(p{d}) AS t{d}' for d in range(3))} FROM pp)",
            f"ex AS (SELECT x, y, z, {corner}, {w} AS w FROM fl, (VALUES {bits}) cn(b0, b1, b2))",
            f"""res AS (SELECT ex.x, ex.y, ex.z, SUM(ex.w * CAST(COALESCE(s.v, 0) AS DOUBLE)) AS v FROM ex LEFT JOIN {src} s ON {mapped}
  GROUP BY ex.x, ex.y, ex.z)"""]


def _view_matrix():
    t = RS.affine_identity()
    for axis, ang in ((2, 0.3), (1, 0.1), (0, 0.6)):
        t = RS.rotate(t, axis, ang)
    return RS.scale(t, 0.9)


@register("affine_3d_blocks", q.with_(*D4, *_affine_3d_ctes("v4", (q.NX4, q.NY4, q.NZ4), "SELECT x, y, z FROM d4"))
          + "SELECT x, y, z, round(v, 4) AS v FROM res")
def affine_3d_blocks(spark, sf_dir):
    """H7 in 3-D: rotate z 0.3, y 0.1, x 0.6, scale 0.9, n-linear, mirror-double, onto V4's interval."""
    bv = _v4(spark, sf_dir)
    out = B.to_voxels(B.affine(bv, _view_matrix(), (0, 0, 0), bv.dims, BLK, "mirror_double", "float64"))
    return out.df.select("x", "y", "z", F.round("v", 4).alias("v"))


# ------------------------------------------------------------------ views

@register("crop_blocks", ORACLES["crop"])
def crop_blocks(spark, sf_dir):
    """C1 in block form, not aligned with the blocks: pieces regrouped in one exchange."""
    bv = _v4(spark, sf_dir)
    return B.to_voxels(BO.crop(bv, (2, 10, 1), (bv.dims[0] // 2, 20, 3)), drop_zeros=True).df


@register("crop_aligned_blocks", q.with_(q.V4) + "SELECT x, y, z, v FROM v4 WHERE x < 9 AND y BETWEEN 16 AND 44 AND z >= 4")
def crop_aligned_blocks(spark, sf_dir):
    """C1 in block form on block borders: filtered grid keys and cut payloads, no exchange."""
    bv = _v4(spark, sf_dir)
    return B.to_voxels(BO.crop(bv, (0, 16, 4), (9, 29, bv.dims[2] - 4)), drop_zeros=True).df


@register("crop_like_blocks", q.with_(q.V5) + "SELECT x, y, z, v FROM v5 WHERE x BETWEEN 3 AND 9 AND y BETWEEN 5 AND 24 AND z BETWEEN 1 AND 4")
def crop_like_blocks(spark, sf_dir):
    """C2 in block form."""
    other = BO.crop(_v4(spark, sf_dir), (3, 5, 1), (7, 20, 4))
    return B.to_voxels(BO.crop_like(_v5(spark, sf_dir), other), drop_zeros=True).df


@register("zero_min_blocks", q.with_(q.V4) + """SELECT x - 4 AS x, y - 7 AS y, z - 2 AS z, v FROM v4
  WHERE x BETWEEN 4 AND 9 AND y BETWEEN 7 AND 36 AND z BETWEEN 2 AND 5""")
def zero_min_blocks(spark, sf_dir):
    """C1 + C3 in block form."""
    return B.to_voxels(BO.zero_min(BO.crop(_v4(spark, sf_dir), (4, 7, 2), (6, 30, 4))), drop_zeros=True).df


@register("translate_blocks", ORACLES["translate"])
def translate_blocks(spark, sf_dir):
    """C4 in block form (metadata only)."""
    return B.to_voxels(BO.translate(_v4(spark, sf_dir), (3, -2, 1)), drop_zeros=True).df


@register("translate_inverse_blocks", ORACLES["translate_inverse"])
def translate_inverse_blocks(spark, sf_dir):
    """C5 in block form (metadata only)."""
    return B.to_voxels(BO.translate_inverse(_v4(spark, sf_dir), (3, -2, 1)), drop_zeros=True).df


@register("hyperslice_blocks", ORACLES["hyperslice"])
def hyperslice_blocks(spark, sf_dir):
    """C6 in block form: only blocks that hold the slice are read."""
    bv = _v4(spark, sf_dir)
    return B.to_voxels(BO.hyperslice(bv, 2, bv.dims[2] // 2), drop_zeros=True).df


@register("raster_order", q.with_(q.V4, q.V4DIMS) + "SELECT x, y, z, v, row_number() OVER (ORDER BY z, y, x) AS n, x + nx * (y + ny * z) AS flat FROM v4, v4dims")
def raster_order(spark, sf_dir):
    """V4 in flat-iteration order; ``n`` counts the rows of the sorted export, ``flat`` is the position in the array.

    The number of rows before each slice comes from one small aggregate per z, so only a slice's rows are numbered together.
    """
    from pyspark.sql import Window
    v = fx.lineitem_counts(spark, sf_dir)
    nx, ny, nz = v.dims
    df = C.raster_order(v)
    per = v.df.groupBy("z").agg(F.count(F.lit(1)).alias("k"))
    later = per.select((F.explode(F.sequence(F.col("z") + 1, F.lit(nz)))).alias("z"), "k").groupBy("z").agg(F.sum("k").alias("before"))
    inside = F.row_number().over(Window.partitionBy("z").orderBy("y", "x"))
    return df.withColumn("i", inside).join(later, "z", "left").select(
        "x", "y", "z", "v", (F.coalesce("before", F.lit(0)) + F.col("i")).alias("n"),
        (F.col("x") + nx * (F.col("y") + ny * F.col("z"))).alias("flat")).orderBy("z", "y", "x")


@register("chain_blocks", q.with_(q.V4DIMS, "v4 AS (SELECT x, y, z, v * 2 + 1 AS v FROM (" + q.with_(q.V4) + "SELECT * FROM v4))",
                                  _down_sql("v4", (q.NX4, q.NY4, q.NZ4), "d1")) + "SELECT x, y, z, v FROM d1 WHERE v <> 0")
def chain_blocks(spark, sf_dir):
    """H9/U7 in block form: convert, then downsample, with type, rank and block size checked at each step."""
    bv = B.from_voxels(fx.lineitem_counts(spark, sf_dir), (8, 8, 2))
    out = (bv.then(lambda b: B.map_pointwise(b, lambda a: np.where(a > 0, a * 2 + 1, 0)), expect_dtype="int64", expect_ndim=3)
           .then(B.downsample2, expect_dtype="int64", expect_block=(8, 8, 2)))
    return B.to_voxels(out.then(lambda b: b, expect_block=(4, 4, 1)), drop_zeros=True).df


# ------------------------------------------------------------------ A: stores and comparison

@register("compare_volumes", q.with_(q.V4, q.V5) + """SELECT count_if(b IS NULL) AS only_a, count_if(a IS NULL) AS only_b,
  count_if(a IS NOT NULL AND b IS NOT NULL) AS both, count_if(COALESCE(a, 0) <> COALESCE(b, 0)) AS n_diff,
  CAST(max(abs(COALESCE(a, 0) - COALESCE(b, 0))) AS DOUBLE) AS max_abs_diff
FROM (SELECT v4.v AS a, s.v AS b FROM v4 FULL OUTER JOIN (SELECT x, y, z, v // 100000 AS v FROM v5 WHERE v >= 100000) s
      ON s.x = v4.x AND s.y = v4.y AND s.z = v4.z)""")
def compare_volumes(spark, sf_dir):
    """A12 in voxel form: V4 against V5 // 100000 where that is positive."""
    v5 = fx.lineitem_revenue(spark, sf_dir)
    small = v5.with_df(v5.df.where("v >= 100000").select("x", "y", "z", F.floor(F.col("v") / 100000).cast("bigint").alias("v")))
    return CMP.compare_volumes(fx.lineitem_counts(spark, sf_dir), small)


@register("n5_typed_attribute", q.with_(q.V4DIMS) + "SELECT nx, ny, nz, CAST('uint16' AS VARCHAR) AS dtype FROM v4dims")
def n5_typed_attribute(spark, sf_dir):
    """A4: typed reads of ``dimensions`` and ``dataType``."""
    root = scratch_dir(spark, "typed")
    CH.save_blocks(B.from_voxels(_v4_u16(spark, sf_dir), BLK), root, "v4/s0", "n5", "gzip")
    a = AT.list_attributes(spark, root)
    d, t = AT.get_attribute(a, "dimensions", "array<bigint>"), AT.get_attribute(a, "dataType", "string")
    return d.join(t, "path").select(*[F.col("dimensions")[i].alias(n) for i, n in enumerate(("nx", "ny", "nz"))],
                                    F.col("dataType").alias("dtype"))


@register("chunk_rewrite", q.with_(q.V4) + "SELECT x, y, z, CAST(v AS INTEGER) AS v FROM v4 WHERE y < 20")
def chunk_rewrite(spark, sf_dir):
    """A dataset written twice; of the first, larger content no chunk is left."""
    root = scratch_dir(spark, "rewrite")
    v = _v4_u16(spark, sf_dir)
    CH.save_blocks(B.from_voxels(v, BLK), root, "v4/s0", "n5", "raw")
    CH.save_blocks(B.from_voxels(v.with_df(v.df.where("y < 20")), BLK), root, "v4/s0", "n5", "gzip")
    return B.to_voxels(CH.open_blocks(spark, root, "v4/s0"), drop_zeros=True).df


@register("zarr_fill_value", q.with_(q.V4DIMS, q.V4, "low AS (SELECT * FROM v4 WHERE y < 20 AND z < 4)", q.dense_sql("d", "low"),
                                     "stored AS (SELECT DISTINCT x // 16 AS gx, y // 16 AS gy, z // 4 AS gz FROM low)")
          + """SELECT x, y, z, CAST(CASE WHEN s.gx IS NULL THEN 7 ELSE v END AS INTEGER) AS v
FROM d LEFT JOIN stored s ON s.gx = d.x // 16 AND s.gy = d.y // 16 AND s.gz = d.z // 4""")
def zarr_fill_value(spark, sf_dir):
    """A3: chunks that are not stored read as the dataset's fill value."""
    import json
    root = scratch_dir(spark, "fill")
    v = _v4_u16(spark, sf_dir)
    CH.save_blocks(B.from_voxels(v.with_df(v.df.where("y < 20 AND z < 4")), BLK), root, "v4", "zarr", "gzip")
    st = CH.Store(root)
    st.write(st.at("v4", ".zarray"), json.dumps(st.json(st.at("v4", ".zarray")) | {"fill_value": 7}).encode())
    return B.to_voxels(CH.open_blocks(spark, root, "v4")).df


@register("output_attributes", q.with_(q.V2DIMS) + """SELECT key, value FROM (
  SELECT 'blockSize' AS key, '[16,16,1]' AS value UNION ALL SELECT 'compression', '{"type":"raw"}' UNION ALL SELECT 'dataType', '"uint16"'
  UNION ALL SELECT 'dimensions', '[' || CAST(nx AS VARCHAR) || ',' || CAST(ny AS VARCHAR) || ',1]' FROM v2dims
  UNION ALL SELECT 'offset', '[1,2,3]' UNION ALL SELECT 'unit', '"nm"')""")
def output_attributes(spark, sf_dir):
    """The output of J1 keeps the source's attributes and its three axes, also where the third has one sample."""
    root = scratch_dir(spark, "out")
    bv = _v2(spark, sf_dir)
    CH.save_blocks(replace(bv, meta=replace(bv.meta, rank=3)), root, "em/s8", "n5", "raw", attrs={"unit": "nm", "offset": [1, 2, 3]})
    J.contrast_enhance(spark, root, "em/s8", root, "out/s8", 8)
    a = AT.list_attributes(spark, root)
    return a.filter(F.col("path").endswith("/out/s8")).select("key", "value")


# ------------------------------------------------------------------ jobs in 3-D

@register("job_contrast_enhance_3d", _cllcn_3d_sql(4))
def job_contrast_enhance_3d(spark, sf_dir):
    """J1 on a 3-D container (V5U, scale index 8)."""
    root = scratch_dir(spark, "j1-3d")
    CH.save_blocks(_v5u(spark, sf_dir), root, "v5/s8", "n5", "gzip")
    J.contrast_enhance(spark, root, "v5/s8", root, "out/s8", 8)
    return B.to_voxels(CH.open_blocks(spark, root, "out/s8"), drop_zeros=True).df


def _clahe_gradients_3d_sql():
    parts = []
    for d, a in enumerate("xyz"):
        n = (q.NX4, q.NY4, q.NZ4)[d]
        rest = " AND ".join(f"{{0}}.{o} = c.{o}" for o in "xyz" if o != a)
        parts.append(f"""SELECT '{a}' AS axis, c.x, c.y, c.z, (CAST(n.v AS DOUBLE) - CAST(p.v AS DOUBLE)) * 0.5 AS v FROM cl c
  JOIN cl n ON {rest.format('n')} AND n.{a} = {q.mirror_single(f'c.{a} + 1', n)}
  JOIN cl p ON {rest.format('p')} AND p.{a} = {q.mirror_single(f'c.{a} - 1', n)}""")
    return _nonzero(f"WITH {q.V4DIMS}, cl AS MATERIALIZED ({ORACLES['clahe_3d_blocks']})\n" + "\nUNION ALL\n".join(parts))


@register("job_clahe_gradients_3d", _clahe_gradients_3d_sql())
def job_clahe_gradients_3d(spark, sf_dir):
    """J2 on a 3-D container: CLAHE of all slices, then centre gradients along x, y and z."""
    root = scratch_dir(spark, "j2-3d")
    CH.save_blocks(_v5u(spark, sf_dir), root, "v5", "n5", "gzip")
    out = None
    for axis, name in J.clahe_gradients(spark, root, "v5", root, 8, block=BLK).items():
        d = B.to_voxels(CH.open_blocks(spark, root, name), drop_zeros=True).df.select(F.lit(axis).alias("axis"), "x", "y", "z", "v")
        out = d if out is None else out.unionByName(d)
    return out


def _smooth_3d_sql():
    ctes, last = _sep_sql("d4", [1.0, 1.0, 1.0], "g", "mirror_double", "v4dims")
    return _nonzero(q.with_(*D4, *ctes) + f"SELECT x, y, z, round(CAST(CAST(v AS FLOAT) AS DOUBLE), 3) AS v FROM {last}")


@register("job_smooth_cells_3d", _smooth_3d_sql())
def job_smooth_cells_3d(spark, sf_dir):
    """J4 on a 3-D container: mirror-double border, Gaussian sigma 1, cells of 8."""
    root = scratch_dir(spark, "j4-3d")
    CH.save_blocks(B.from_voxels(_v4_u16(spark, sf_dir), BLK), root, "v4", "n5", "raw")
    vox = B.to_voxels(J.smooth_cells(spark, root, "v4", 1.0, 8)).df.select("x", "y", "z", F.round(F.col("v").cast("double"), 3).alias("v"))
    return vox.where("v <> 0")


def _view_3d_sql(size=(48, 48)):
    dims = [f"(({n} + 1) // 2)" for n in (q.NX4, q.NY4, q.NZ4)]
    cnt = " * ".join(f"least(2, {n} - 2 * t{a})" for a, n in zip("xyz", (q.NX4, q.NY4, q.NZ4)))
    ds = f"""ds AS (SELECT tx AS x, ty AS y, tz AS z, SUM(CAST(v AS DOUBLE)) / CAST({cnt} AS DOUBLE) AS v
  FROM (SELECT x // 2 AS tx, y // 2 AS ty, z // 2 AS tz, v // 50000 AS v FROM v5) GROUP BY tx, ty, tz)"""
    target = f"SELECT CAST(i AS BIGINT) AS x, CAST(j AS BIGINT) AS y, CAST(0 AS BIGINT) AS z FROM range(0, {size[0]}) a(i), range(0, {size[1]}) b(j)"
    return q.with_(q.V5, q.V4DIMS, ds, *_affine_3d_ctes("ds", dims, target)) \
        + f"SELECT x, y, z, {q.to_int('v', 0, 255, 'SMALLINT')} AS v FROM res"


@register("job_view_plane_3d", _view_3d_sql())
def job_view_plane_3d(spark, sf_dir):
    """J5 on a 3-D container (V5 // 50000): x2 downsampling, 3-D rotation, a plane of 48 x 48."""
    root = scratch_dir(spark, "j5-3d")
    v5 = fx.lineitem_revenue(spark, sf_dir)
    small = v5.df.select("x", "y", "z", to_type(F.floor(F.col("v") / 50000), "uint16").alias("v"))
    CH.save_blocks(B.from_voxels(Volume(small, VolumeMeta(v5.dims, "uint16", rank=3)), BLK), root, "v5", "n5", "raw")
    return J.view_plane(spark, root, "v5", (48, 48, 1)).df
