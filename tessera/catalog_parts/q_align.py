"""Blocks whose intervals differ, chains in one exchange, and window sums in any type and under any border."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sqlcheck as q
from ..catalog import ORACLES, register
from ..operators import blockops as BO
from ..operators import blocks as B
from ..sources import fixtures as fx
from .q_blockops import BLK, D4, D5, _nonzero, _v2, _v4, _v5, _v5u, _view_matrix

ODD = (7, 5, 3)
SHIFT = (3, -2, 1)
# V5 moved by SHIFT, as far as it lies in V4's interval
MOVED = f"""moved AS (SELECT x, y, z, v FROM (SELECT x + 3 AS x, y - 2 AS y, z + 1 AS z, v FROM v5), v4dims
  WHERE x BETWEEN 0 AND nx - 1 AND y BETWEEN 0 AND ny - 1 AND z BETWEEN 0 AND nz - 1)"""
BOTH = [q.V4, q.V5, q.V4DIMS, MOVED]


def _moved(spark, sf_dir) -> B.BlockVolume:
    """V5 in other blocks, moved."""
    return BO.translate(B.from_voxels(fx.lineitem_revenue(spark, sf_dir), ODD), SHIFT)


def _pairs(value: str, how: str = "FULL OUTER") -> str:
    return q.with_(*BOTH) + f"""SELECT x, y, z, {value} AS v FROM (
  SELECT COALESCE(a.x, b.x) AS x, COALESCE(a.y, b.y) AS y, COALESCE(a.z, b.z) AS z, COALESCE(a.v, 0) AS a, COALESCE(b.v, 0) AS b
  FROM v4 a {how} JOIN moved b ON a.x = b.x AND a.y = b.y AND a.z = b.z)"""


# ------------------------------------------------------------------ E1-E7 on volumes that do not line up

@register("vol_add_shifted_blocks", _nonzero(_pairs("CAST(a + b AS BIGINT)")))
def vol_add_shifted_blocks(spark, sf_dir):
    """V4 plus V5 translated by (3, -2, 1) and blocked otherwise, on V4's interval."""
    return B.to_voxels(BO.add(_v4(spark, sf_dir), _moved(spark, sf_dir)), drop_zeros=True).df


@register("vol_sub_shifted_blocks", _nonzero(_pairs("CAST(a - b AS BIGINT)")))
def vol_sub_shifted_blocks(spark, sf_dir):
    """E2 with a translated volume."""
    return B.to_voxels(BO.sub(_v4(spark, sf_dir), _moved(spark, sf_dir)), drop_zeros=True).df


@register("vol_mul_shifted_blocks", _nonzero(_pairs("CAST(a * b AS BIGINT)", "INNER")))
def vol_mul_shifted_blocks(spark, sf_dir):
    """E3 with a translated volume; only blocks that both reach are computed."""
    return B.to_voxels(BO.mul(_v4(spark, sf_dir), _moved(spark, sf_dir)), drop_zeros=True).df


@register("vol_div_shifted_blocks", q.with_(*BOTH, q.dense_sql("d4", "v4")) + f"""SELECT a.x, a.y, a.z,
  {q.ieee_div('CAST(a.v AS DOUBLE)', 'CAST(COALESCE(b.v, 0) AS DOUBLE)')} AS v
FROM d4 a LEFT JOIN moved b ON a.x = b.x AND a.y = b.y AND a.z = b.z""")
def vol_div_shifted_blocks(spark, sf_dir):
    """E4 with a translated volume over V4's whole interval."""
    return B.to_voxels(BO.div(_v4(spark, sf_dir), _moved(spark, sf_dir))).df


@register("vol_max_shifted_blocks", _nonzero(_pairs("CAST(greatest(a * 400000, b, 0) AS BIGINT)")))
def vol_max_shifted_blocks(spark, sf_dir):
    """E6 over V4 * 400000 and a translated V5, on V4's interval."""
    a = B.map_pointwise(_v4(spark, sf_dir), lambda x: x * 400000)
    return B.to_voxels(BO.vmax([a, _moved(spark, sf_dir)], on=a), drop_zeros=True).df


@register("pair_shifted_blocks", q.with_(*BOTH) + """SELECT a.x, a.y, a.z, CAST(a.v AS DOUBLE) AS a, CAST(b.v AS DOUBLE) AS b
FROM v4 a JOIN moved b ON a.x = b.x AND a.y = b.y AND a.z = b.z""")
def pair_shifted_blocks(spark, sf_dir):
    """E7 with a translated volume; occupied voxels only."""
    df = B.channels_to_voxels(BO.pair(_v4(spark, sf_dir), _moved(spark, sf_dir)), ["a", "b"])
    return df.where("a <> 0 AND b <> 0")


@register("vol_sub_cropped_blocks", _nonzero(q.with_(q.V4, q.V5, q.V4DIMS) + """SELECT x, y, z, CAST(a - b AS BIGINT) AS v FROM (
  SELECT COALESCE(a.x, b.x) AS x, COALESCE(a.y, b.y) AS y, COALESCE(a.z, b.z) AS z, COALESCE(a.v, 0) AS a, COALESCE(b.v, 0) AS b
  FROM (SELECT * FROM v5 WHERE x BETWEEN 2 AND 8 AND y BETWEEN 3 AND 40 AND z >= 1) a
  FULL OUTER JOIN (SELECT * FROM v4 WHERE x BETWEEN 4 AND 8 AND y BETWEEN 11 AND 40 AND z BETWEEN 1 AND 3) b
    ON a.x = b.x AND a.y = b.y AND a.z = b.z)"""))
def vol_sub_cropped_blocks(spark, sf_dir):
    """E2 of two crops whose blocks start at different places, on the first one's interval."""
    v5 = _v5(spark, sf_dir)
    a = BO.crop(v5, (2, 3, 1), (7, 38, v5.dims[2] - 1))
    b = BO.crop(_v4(spark, sf_dir), (4, 11, 1), (5, 30, 3))
    return B.to_voxels(BO.sub(a, b), drop_zeros=True).df


@register("centre_gradient_by_views_blocks", ORACLES["gradient_center_rai"])
def centre_gradient_by_views_blocks(spark, sf_dir):
    """F1/F2 from views: translate and translateInverse of the mirrored volume, their difference, halved, on the source's interval."""
    bv = B.from_voxels(fx.embedding_u16(spark, sf_dir), (7, 5, 1))
    return B.to_voxels(BO.center_gradient_by_views(bv, 1)).df


@register("extend_mirror_single_blocks", ORACLES["extend_mirror_single"])
def extend_mirror_single_blocks(spark, sf_dir):
    """C8 in block form: V2 on an interval grown by (3, 4, 0), in blocks that start at its min."""
    bv = _v2(spark, sf_dir)
    return B.to_voxels(BO.on_interval(bv, (-3, -4, 0), (bv.dims[0] + 6, bv.dims[1] + 8, 1), (16, 16, 1), "mirror_single")).df


@register("extend_mirror_double_blocks", ORACLES["extend_mirror_double"])
def extend_mirror_double_blocks(spark, sf_dir):
    """C9 in block form."""
    bv = _v2(spark, sf_dir)
    return B.to_voxels(BO.on_interval(bv, (-3, -4, 0), (bv.dims[0] + 6, bv.dims[1] + 8, 1), (7, 9, 1), "mirror_double")).df


# ------------------------------------------------------------------ chains

def _shifted(src: str, a: str, **d) -> str:
    on = " AND ".join(f"{a}.{x} = c.{x}" + (f" + ({d[x]})" if x in d else "") for x in "xyz")
    return f"LEFT JOIN {src} {a} ON {on}"


CHAIN = q.with_(*D4, f"""c1 AS (SELECT c.x, c.y, c.z, CAST(COALESCE(n.v, 0) - c.v AS DOUBLE) AS v FROM d4 c {_shifted('d4', 'n', y=1)})""",
                f"""c2 AS (SELECT c.x, c.y, c.z, (COALESCE(n.v, 0) - COALESCE(p.v, 0)) * 0.5 AS v
  FROM c1 c {_shifted('c1', 'n', x=1)} {_shifted('c1', 'p', x=-1)})""",
                f"""c3 AS (SELECT c.x, c.y, c.z, COALESCE(n.v, 0) - c.v AS v FROM c2 c {_shifted('c2', 'n', z=1)})""") + \
    "SELECT x, y, z, v FROM c3 WHERE v <> 0"


@register("chain_fused_blocks", CHAIN)
def chain_fused_blocks(spark, sf_dir):
    """H8/H9: three stencils (forward along y, centre along x, forward along z) in one exchange; each has zeros beyond its own border."""
    c = BO.gradient_forward(_v4(spark, sf_dir).chain(), 1)
    c = BO.gradient_forward(B.center_gradient(c, 0, "zero"), 2)
    return B.to_voxels(c, drop_zeros=True).df


MIRRORED = (q.with_(q.V2, q.V2DIMS, f"""m1 AS (SELECT c.x, c.y, c.z, (CAST(n.v AS DOUBLE) - CAST(p.v AS DOUBLE)) * 0.5 AS v
  FROM v2dims, v2 c JOIN v2 n ON n.x = c.x AND n.y = {q.mirror_single('c.y + 1', 'ny')}
  JOIN v2 p ON p.x = c.x AND p.y = {q.mirror_single('c.y - 1', 'ny')})""") + f"""SELECT c.x, c.y, c.z, (n.v - p.v) * 0.5 AS v
  FROM v2dims, m1 c JOIN m1 n ON n.x = c.x AND n.y = {q.mirror_double('c.y + 1', 'ny')}
  JOIN m1 p ON p.x = c.x AND p.y = {q.mirror_double('c.y - 1', 'ny')}""")


@register("chain_fused_mirror_blocks", MIRRORED)
def chain_fused_mirror_blocks(spark, sf_dir):
    """H8/H9: the second derivative along y, the first stencil under a mirror-single, the second under a mirror-double border."""
    c = B.from_voxels(fx.embedding_u16(spark, sf_dir), (7, 5, 1)).chain()
    return B.to_voxels(B.center_gradient(B.center_gradient(c, 1, "mirror_single"), 1, "mirror_double")).df


@register("chain_fused_downsample_blocks", ORACLES["chain_blocks"])
def chain_fused_downsample_blocks(spark, sf_dir):
    """H4/H9: a converter and a x2 downsampling in one exchange, from blocks of an odd size."""
    import numpy as np
    c = B.map_pointwise(B.from_voxels(fx.lineitem_counts(spark, sf_dir), ODD).chain(), lambda a: np.where(a > 0, a * 2 + 1, 0))
    return B.to_voxels(B.downsample2(c), drop_zeros=True).df


# ------------------------------------------------------------------ running sums

@register("cllcn_mirror_running_sums", ORACLES["cllcn_mirror"])
def cllcn_mirror_running_sums(spark, sf_dir):
    """G12 through running sums: the mirrored window is folded into the line's total and two reads."""
    bv = B.from_voxels(fx.embedding_u16(spark, sf_dir), (16, 16, 1))
    return B.to_voxels(B.cllcn(bv, 7, extension="mirror_single", strips=True)).df


@register("box_stats_running_sums", ORACLES["box_stats_blocks"])
def box_stats_running_sums(spark, sf_dir):
    """G1/G2 on V5U through running sums."""
    return B.channels_to_voxels(B.box_stats(_v5u(spark, sf_dir), 2, running=True), ["S", "Q", "mean", "var", "std"]).where("Q <> 0")


WIDE = (q.with_(*[c for c in D5 if not c.startswith("v5u")][:2], "v5f AS (SELECT x, y, z, CAST(CAST(CAST(v AS FLOAT) AS DOUBLE) AS HUGEINT) AS v FROM v5)",
                q.dense_sql("d5f", "v5f"), q.box_window_sql("d5f", 3))
        + "SELECT x, y, z, CAST(S AS DOUBLE) AS S, CAST(Q // 1048576 AS DOUBLE) AS Q FROM boxed WHERE Q <> 0")


def _wide(spark, sf_dir, running):
    df = B.channels_to_voxels(B.box_stats(_v5(spark, sf_dir), 3, running=running), ["S", "Q", "mean", "var", "std"])
    return df.where("Q <> 0").select("x", "y", "z", "S", F.floor(F.col("Q") / 1048576).cast("double").alias("Q"))


@register("box_sums_int64", WIDE)
def box_sums_int64(spark, sf_dir):
    """G1/G2 on V5 (int64): sums of float32 samples and squares, exact, in one halo exchange."""
    return _wide(spark, sf_dir, False)


@register("box_sums_int64_running", WIDE)
def box_sums_int64_running(spark, sf_dir):
    """G1/G2 on V5 (int64) through running sums of 32-bit limbs."""
    return _wide(spark, sf_dir, True)


# ------------------------------------------------------------------ types and bounded resampling

@register("int64_identity_blocks", q.with_(q.V5) + "SELECT x, y, z, v + 1152921504606846977 AS v FROM v5")
def int64_identity_blocks(spark, sf_dir):
    """D5 on int64 values past 2^60: the converter sees them as they are, no sample goes through a double."""
    v5 = fx.lineitem_revenue(spark, sf_dir)
    big = v5.with_df(v5.df.select("x", "y", "z", (F.col("v") + F.lit(2 ** 60 + 1)).alias("v")))
    return B.to_voxels(B.map_pointwise(B.from_voxels(big, BLK), lambda a: a), drop_zeros=True).df


@register("affine_3d_bounded_blocks", ORACLES["affine_3d_blocks"])
def affine_3d_bounded_blocks(spark, sf_dir):
    """H7 with a bound of 20 kB for a target's source: smaller targets, put together again."""
    bv = _v4(spark, sf_dir)
    out = B.to_voxels(B.affine(bv, _view_matrix(), (0, 0, 0), bv.dims, BLK, "mirror_double", "float64", group_bytes=20_000))
    return out.df.select("x", "y", "z", F.round("v", 4).alias("v"))


@register("affine_translated_blocks", q.with_(q.V4) + "SELECT x + 9 AS x, y + 4 AS y, z - 2 AS z, CAST(v AS DOUBLE) AS v FROM v4")
def affine_translated_blocks(spark, sf_dir):
    """H7 on a volume whose interval does not start at 0: moved by (3, -2, 1), then by the affine (6, 6, -3)."""
    import numpy as np
    bv = BO.translate(_v4(spark, sf_dir), SHIFT)
    t = np.hstack([np.eye(3), np.array([[6.0], [6.0], [-3.0]])])
    out = B.affine(bv, t, tuple(m + int(d) for m, d in zip(bv.meta.min, t[:, 3])), bv.dims, BLK, "zero", "float64")
    return B.to_voxels(out, drop_zeros=True).df
