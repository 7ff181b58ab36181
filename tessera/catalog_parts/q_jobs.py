"""A1-A13 round trips and the jobs J1-J4, end to end through chunked containers.

Containers are written under the session's shared checkpoint folder
(``session.scratch_dir``), read back with the ``ndblocks`` source and
unravelled to voxels for the oracle comparison.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import jobs as J
from .. import sqlcheck as q
from ..catalog import ORACLES, register
from ..functions.pointwise import to_type
from ..operators import blocks as B
from ..session import scratch_dir
from ..sources import attributes as AT
from ..sources import chunked as CH
from ..sources import fixtures as fx
from ..volume import Volume, VolumeMeta
from .q_filters import _sep_sql
from .q_localstats import _cllcn_oracle


def _v4_u16(spark, sf_dir) -> Volume:
    v4 = fx.lineitem_counts(spark, sf_dir)
    return Volume(v4.df.select("x", "y", "z", to_type("v", "uint16").alias("v")), VolumeMeta(v4.dims, "uint16"))


V4U16 = q.with_(q.V4) + "SELECT x, y, z, CAST(v AS INTEGER) AS v FROM v4 WHERE v <> 0"


@register("chunk_roundtrip_n5", V4U16)
def chunk_roundtrip_n5(spark, sf_dir):
    """A8 + A2 + A10: V4 (uint16) saved as N5 gzip in (32,8,3) chunks, read back, unravelled."""
    root = scratch_dir(spark, "n5")
    CH.save_blocks(B.from_voxels(_v4_u16(spark, sf_dir), (16, 16, 4)), root, "v4/s0", "n5", "gzip", block=(32, 8, 3))
    return B.to_voxels(CH.open_blocks(spark, root, "v4/s0"), drop_zeros=True).df


@register("chunk_roundtrip_zarr", V4U16)
def chunk_roundtrip_zarr(spark, sf_dir):
    """A9 + A3: V4 saved as Zarr v2 with '/' separators, raw chunks (full-size edge chunks), read back."""
    root = scratch_dir(spark, "zarr")
    CH.save_blocks(B.from_voxels(_v4_u16(spark, sf_dir), (16, 16, 4)), root, "v4", "zarr", "raw", "/", block=(32, 8, 3))
    return B.to_voxels(CH.open_blocks(spark, root, "v4"), drop_zeros=True).df


@register("n5_attributes", q.with_(q.V4DIMS) + """SELECT key, value, type FROM (
  SELECT 'blockSize' AS key, '[32,8,3]' AS value, 'ARRAY<BIGINT>' AS type
  UNION ALL SELECT 'compression', '{"level":-1,"type":"gzip","useZlib":false}', 'OBJECT<level: BIGINT, type: STRING, useZlib: BOOLEAN>'
  UNION ALL SELECT 'dataType', '"uint16"', 'STRING'
  UNION ALL SELECT 'dimensions', '[' || CAST(nx AS VARCHAR) || ',' || CAST(ny AS VARCHAR) || ',' || CAST(nz AS VARCHAR) || ']', 'ARRAY<BIGINT>' FROM v4dims)""")
def n5_attributes(spark, sf_dir):
    """A4: attributes of the written V4 dataset as (key, JSON value, variant type)."""
    root = scratch_dir(spark, "attrs")
    CH.save_blocks(B.from_voxels(_v4_u16(spark, sf_dir), (16, 16, 4)), root, "v4/s0", "n5", "gzip", block=(32, 8, 3))
    a = AT.list_attributes(spark, root)
    return a.filter(F.col("path").endswith("/v4/s0")).select("key", "value", "type")


@register("job_contrast_enhance", f"SELECT * FROM ({_cllcn_oracle(4)}) WHERE v <> 0")
def job_contrast_enhance(spark, sf_dir):
    """V2 stored as N5 (16,16,1) -> contrast-limited local contrast normalisation with the radius of
    scale index 8 (round(1023/256) = 4) -> N5 output without empty blocks -> read back."""
    root = scratch_dir(spark, "j1")
    CH.save_blocks(B.from_voxels(fx.embedding_u16(spark, sf_dir), (16, 16, 1)), root, "emb/s0", "n5", "raw")
    J.contrast_enhance(spark, root, "emb/s0", root, "emb-cllcn/s0", 8)
    return B.to_voxels(CH.open_blocks(spark, root, "emb-cllcn/s0"), drop_zeros=True).df


@register("job_contrast_export", q.with_(q.V2DIMS) + """SELECT CAST(((nx + 63) // 64) * ((ny + 63) // 64) AS BIGINT) AS n_blocks,
  CAST(0 AS BIGINT) AS n_diff_voxels, CAST(0.0 AS DOUBLE) AS max_abs_diff FROM v2dims""")
def job_contrast_export(spark, sf_dir):
    """J3 + A12: contrast window to uint8, written as N5 and Zarr, compared block by block."""
    root = scratch_dir(spark, "j3")
    CH.save_blocks(B.from_voxels(fx.embedding_u16(spark, sf_dir), (64, 64, 1)), root, "emb", "n5", "raw")
    return J.contrast_export(spark, root, "emb", root, block=(64, 64, 64))


def _smooth_sql():
    h = 3.0
    ctes, last = _sep_sql("v2", [h, h], "g", "mirror_double", "v2dims")
    return q.with_(q.V2, q.V2DIMS, *ctes) + f"SELECT x, y, z, CAST(v AS FLOAT) AS v FROM {last}"


@register("job_smooth_cells", _smooth_sql())
def job_smooth_cells(spark, sf_dir):
    """Mirror-double border, Gaussian sigma 3 into 32-cells (float32)."""
    root = scratch_dir(spark, "j4")
    CH.save_blocks(B.from_voxels(fx.embedding_u16(spark, sf_dir), (16, 16, 1)), root, "emb", "n5", "raw")
    return B.to_voxels(J.smooth_cells(spark, root, "emb", 3.0, 32)).df


@register("parquet_blocks_crop", q.with_(q.V4) + "SELECT x, y, z, CAST(v AS INTEGER) AS v FROM v4 WHERE z BETWEEN 4 AND 6 AND v <> 0")
def parquet_blocks_crop(spark, sf_dir):
    """A13 + C1: V4 blocks (16,16,4) stored as parquet partitioned by dataset/gz; a crop z >= 4 prunes to
    the gz = 1 directory (PartitionFilters) before unravelling."""
    from ..sources import parquet as PQ
    from ..operators.coords import crop
    root = scratch_dir(spark, "parquet")
    v = _v4_u16(spark, sf_dir)
    PQ.write_blocks(B.from_voxels(v, (16, 16, 4)), root, "v4")
    bv = PQ.read_blocks(spark, root, "v4", v.meta, (16, 16, 4))
    bv = B.BlockVolume(bv.df.filter(F.col("gz") == 1), bv.meta, bv.block)
    vox = B.to_voxels(bv, drop_zeros=True)
    return crop(vox, (0, 0, 4), (v.dims[0], v.dims[1], 3)).df


@register("crop_like", q.with_(q.V4, q.V5) + "SELECT x, y, z, v FROM v5 WHERE x BETWEEN 3 AND 12 AND y BETWEEN 5 AND 24 AND z BETWEEN 1 AND 4")
def crop_like(spark, sf_dir):
    """Crop V5 by the interval of another volume (a crop of V4 at (3,5,1) size (10,20,4))."""
    from ..operators.coords import crop, crop_like as cl
    other = crop(fx.lineitem_counts(spark, sf_dir), (3, 5, 1), (10, 20, 4))
    return cl(fx.lineitem_revenue(spark, sf_dir), other).df


def _clahe_gradients_sql(r=4):
    from .q_localstats import _clahe_sql
    ms = q.mirror_single
    nx, ny = "(SELECT nx FROM v2dims)", "(SELECT ny FROM v2dims)"
    return (f"WITH cl AS ({_clahe_sql(r)}),\n" + q.V2DIMS + f"""
SELECT 'x' AS axis, c.x, c.y, c.z, (CAST(n.v AS DOUBLE) - CAST(p.v AS DOUBLE)) * 0.5 AS v FROM cl c
  JOIN cl n ON n.y = c.y AND n.z = c.z AND n.x = {ms('c.x + 1', nx)}
  JOIN cl p ON p.y = c.y AND p.z = c.z AND p.x = {ms('c.x - 1', nx)}
UNION ALL
SELECT 'y' AS axis, c.x, c.y, c.z, (CAST(n.v AS DOUBLE) - CAST(p.v AS DOUBLE)) * 0.5 AS v FROM cl c
  JOIN cl n ON n.x = c.x AND n.z = c.z AND n.y = {ms('c.y + 1', ny)}
  JOIN cl p ON p.x = c.x AND p.z = c.z AND p.y = {ms('c.y - 1', ny)}""")


@register("job_clahe_gradients", _clahe_gradients_sql())
def job_clahe_gradients(spark, sf_dir):
    """J2 + A11: CLAHE (radius of scale index 8 = 4), double, centre gradients along x and y with
    mirror-single borders, written as sibling N5 datasets and read back (axis column)."""
    root = scratch_dir(spark, "j2")
    CH.save_blocks(B.from_voxels(fx.embedding_u16(spark, sf_dir), (32, 32, 1)), root, "emb", "n5", "raw")
    names = J.clahe_gradients(spark, root, "emb", root, 8, block=(32, 32, 1))
    out = None
    for axis, name in names.items():
        d = B.to_voxels(CH.open_blocks(spark, root, name)).df.select(F.lit(axis).alias("axis"), "x", "y", "z", "v")
        out = d if out is None else out.unionByName(d)
    return out


def _view_plane_sql(size=(64, 64)):
    p = q.unrotated("x", "y", "z")[:2]
    md = q.mirror_double
    dnx, dny = "(((SELECT nx FROM v2dims) + 1) // 2)", "(((SELECT ny FROM v2dims) + 1) // 2)"
    return q.with_(q.V2, q.V2DIMS, f"""ds AS (SELECT tx AS x, ty AS y, CAST(0 AS BIGINT) AS z,
    SUM(CAST(v AS DOUBLE)) / (CAST(least(2, (SELECT nx FROM v2dims) - 2 * tx) AS DOUBLE) * least(2, (SELECT ny FROM v2dims) - 2 * ty)) AS v
  FROM (SELECT x // 2 AS tx, y // 2 AS ty, v FROM v2) GROUP BY tx, ty),
tg AS (SELECT CAST(i AS BIGINT) AS x, CAST(j AS BIGINT) AS y, CAST(0 AS BIGINT) AS z FROM range(0, {size[0]}) a(i), range(0, {size[1]}) b(j)),
pp AS (SELECT x, y, z, {p[0]} AS p0, {p[1]} AS p1 FROM tg),
fl AS (SELECT x, y, z, floor(p0) AS f0, floor(p1) AS f1, p0 - floor(p0) AS t0, p1 - floor(p1) AS t1 FROM pp),
ex AS (SELECT x, y, z, CAST(f0 + b0 AS BIGINT) AS c0, CAST(f1 + b1 AS BIGINT) AS c1,
         1.0 * (CASE WHEN b0 = 1 THEN t0 ELSE 1.0 - t0 END) * (CASE WHEN b1 = 1 THEN t1 ELSE 1.0 - t1 END) AS w
       FROM fl, (VALUES (0, 0), (1, 0), (0, 1), (1, 1)) cn(b0, b1))""") + f"""
SELECT ex.x, ex.y, ex.z, {q.to_int('SUM(ex.w * COALESCE(s.v, 0.0))', 0, 255, 'SMALLINT')} AS v
FROM ex LEFT JOIN ds s ON s.x = {md('ex.c0', dnx)} AND s.y = {md('ex.c1', dny)} AND s.z = ex.z
GROUP BY ex.x, ex.y, ex.z"""


@register("job_view_plane", _view_plane_sql())
def job_view_plane(spark, sf_dir):
    """J5 + H9: V2 as a container -> float -> x2 downsampling -> affine (rotate z 0.3, y 0.1, x 0.6;
    scale 0.9), n-linear, mirror-double -> uint8 plane of 64 x 64."""
    root = scratch_dir(spark, "j5")
    CH.save_blocks(B.from_voxels(fx.embedding_u16(spark, sf_dir), (32, 32, 1)), root, "emb", "n5", "raw")
    return J.view_plane(spark, root, "emb", (64, 64, 1)).df


@register("job_pyramid", "SELECT x, y, z, v FROM (" + ORACLES["pyramid"].replace("SELECT 1 AS level", "SELECT CAST(1 AS INTEGER) AS level")
          + ") WHERE level = 3 AND v <> 0")
def job_pyramid(spark, sf_dir):
    """H6 job: V4 stored in (8,8,2) blocks; three x2 levels written as s1..s3 datasets (block form,
    even blocks map 1:1, re-opened from storage per level); level 3 read back."""
    root = scratch_dir(spark, "pyramid")
    CH.save_blocks(B.from_voxels(fx.lineitem_counts(spark, sf_dir), (8, 8, 2)), root, "v4/s0", "n5", "raw")
    names = J.write_pyramid(spark, root, "v4/s0", 3)
    return B.to_voxels(CH.open_blocks(spark, root, names[-1]), drop_zeros=True).df
