"""Containers at scale: metadata of both layouts, planning from stored chunks, versions, pyramids in one scan, digests, parquet."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import jobs as J
from .. import sqlcheck as q
from ..catalog import ORACLES, register
from ..operators import blocks as B
from ..operators import compare as CMP
from ..session import scratch_dir
from ..sources import attributes as AT
from ..sources import chunked as CH
from ..sources import fixtures as fx
from ..sources import parquet as PQ
from .q_blockops import BLK, D4, _v4
from .q_jobs import V4U16, _v4_u16


@register("zarr_attributes", q.with_(q.V4DIMS) + """SELECT path, file, key, value FROM (
  SELECT 'em/v4' AS path, '.zarray' AS file, 'chunks' AS key, '[4,16,16]' AS value
  UNION ALL SELECT 'em/v4', '.zarray', 'compressor', '{"id":"gzip","level":5}' UNION ALL SELECT 'em/v4', '.zarray', 'dimension_separator', '"/"'
  UNION ALL SELECT 'em/v4', '.zarray', 'dtype', '"<u2"' UNION ALL SELECT 'em/v4', '.zarray', 'fill_value', '0'
  UNION ALL SELECT 'em/v4', '.zarray', 'filters', 'null' UNION ALL SELECT 'em/v4', '.zarray', 'order', '"C"'
  UNION ALL SELECT 'em/v4', '.zarray', 'shape', '[' || nz || ',' || ny || ',' || nx || ']' FROM v4dims
  UNION ALL SELECT 'em/v4', '.zarray', 'zarr_format', '2' UNION ALL SELECT 'em/v4', '.zattrs', 'unit', '"nm"')""")
def zarr_attributes(spark, sf_dir):
    """A4 for Zarr: array metadata and attributes as rows, the path pushed into the walk of the container."""
    root = scratch_dir(spark, "zattrs")
    v = B.from_voxels(_v4_u16(spark, sf_dir), BLK)
    CH.save_blocks(v, root, "em/v4", "zarr", "gzip", "/", attrs={"unit": "nm"})
    CH.save_blocks(v, root, "em/other", "zarr", "raw", ".")
    return AT.container_attributes(spark, root).where("path = 'em/v4'").select("path", "file", "key", "value")


@register("chunk_index_scan", V4U16)
def chunk_index_scan(spark, sf_dir):
    """A2: the scan planned from the chunks that a Spark job found stored, partitions of 64 kB."""
    root = scratch_dir(spark, "index")
    CH.save_blocks(B.from_voxels(_v4_u16(spark, sf_dir), BLK), root, "v4/s0", "n5", "gzip", block=(8, 8, 2))
    return B.to_voxels(CH.open_blocks(spark, root, "v4/s0", index=True, partition_bytes=1 << 16), drop_zeros=True).df


@register("chunk_index_crop", q.with_(q.V4) + "SELECT x, y, z, CAST(v AS INTEGER) AS v FROM v4 WHERE y BETWEEN 16 AND 23 AND z >= 2")
def chunk_index_crop(spark, sf_dir):
    """A3 + C1: a crop of a Zarr volume planned from stored chunks; only partitions whose box meets it are read."""
    from ..operators import blockops as BO
    root = scratch_dir(spark, "index-crop")
    v = B.from_voxels(_v4_u16(spark, sf_dir), BLK)
    CH.save_blocks(v, root, "v4", "zarr", "raw", ".", block=(8, 8, 2))
    bv = CH.open_blocks(spark, root, "v4", index=True, partition_bytes=1 << 14)
    return B.to_voxels(BO.crop(bv, (0, 16, 2), (bv.dims[0], 8, bv.dims[2] - 2)), drop_zeros=True).df


@register("chunk_versions", ORACLES["chunk_rewrite"])
def chunk_versions(spark, sf_dir):
    """A8 where folders cannot be renamed: two versions written under their final keys, the second one current, the first one dropped."""
    root = scratch_dir(spark, "versions")
    v = _v4_u16(spark, sf_dir)
    CH.save_blocks(B.from_voxels(v, BLK), root, "v4/s0", "n5", "raw", versions=True)
    CH.save_blocks(B.from_voxels(v.with_df(v.df.where("y < 20")), BLK), root, "v4/s0", "n5", "gzip", versions=True)
    CH.drop_old_versions(spark, root, "v4/s0")
    return B.to_voxels(CH.open_blocks(spark, root, "v4/s0"), drop_zeros=True).df


@register("pyramid_blocks", f"SELECT level, x, y, z, v FROM ({ORACLES['pyramid']}) WHERE v <> 0")
def pyramid_blocks(spark, sf_dir):
    """H6 in block form: all levels from one read of V4."""
    out, (rows, metas) = None, B.pyramid(_v4(spark, sf_dir), 3)
    for k, m in enumerate(metas, 1):
        d = B.to_voxels(B.BlockVolume(rows.where(F.col("level") == k).select(*B.BLOCK_COLUMNS), m, BLK), drop_zeros=True).df
        d = d.select(F.lit(k).alias("level"), "x", "y", "z", "v")
        out = d if out is None else out.unionByName(d)
    return out


@register("job_pyramid_levels", f"SELECT level, x, y, z, v FROM ({ORACLES['pyramid']}) WHERE v <> 0")
def job_pyramid_levels(spark, sf_dir):
    """H6 as a job from blocks whose sides are no multiples of 8: every level read back."""
    root = scratch_dir(spark, "pyramid-levels")
    CH.save_blocks(B.from_voxels(fx.lineitem_counts(spark, sf_dir), (10, 12, 3)), root, "v4/s0", "n5", "raw")
    out = None
    for k, name in enumerate(J.write_pyramid(spark, root, "v4/s0", 3), 1):
        d = B.to_voxels(CH.open_blocks(spark, root, name), drop_zeros=True).df.select(F.lit(k).alias("level"), "x", "y", "z", "v")
        out = d if out is None else out.unionByName(d)
    return out


@register("compare_blocks_digests", q.with_(*D4) + """SELECT CAST(count(DISTINCT (x // 16, y // 16, z // 4)) AS BIGINT) AS n_blocks,
  CAST(count_if(v <> 0 AND y < 9) AS BIGINT) AS n_diff_voxels, CAST(coalesce(max(CASE WHEN v <> 0 AND y < 9 THEN v END), 0) AS DOUBLE) AS max_abs_diff
FROM d4 WHERE (x // 16, y // 16, z // 4) IN (SELECT (x // 16, y // 16, z // 4) FROM v4)""")
def compare_blocks_digests(spark, sf_dir):
    """A12 in block form: V4 against V4 without its first nine rows; payloads of equal blocks stay where they are."""
    v = fx.lineitem_counts(spark, sf_dir)
    return CMP.compare_blocks(B.from_voxels(v, BLK), B.from_voxels(v.with_df(v.df.where("y >= 9")), BLK))


@register("parquet_voxels", q.with_(q.V4) + "SELECT x, y, z, CAST(v AS INTEGER) AS v FROM v4 WHERE x BETWEEN 2 AND 9 AND y BETWEEN 8 AND 23 AND z BETWEEN 1 AND 4")
def parquet_voxels(spark, sf_dir):
    """Voxels in Morton order of cells of 8, cropped along all three axes."""
    root = scratch_dir(spark, "voxels")
    v = _v4_u16(spark, sf_dir)
    PQ.write_voxels(v, root, "v4", cell=8)
    return PQ.read_voxels(spark, root, "v4", v.meta).df.where("x BETWEEN 2 AND 9 AND y BETWEEN 8 AND 23 AND z BETWEEN 1 AND 4")
