"""B / H5 / H8: grid planning over V4 (lineitem); every grid row counts the occupied voxels of its interval."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from .. import sqlcheck as q
from ..catalog import register
from ..plans import grid as g
from ..sources import fixtures as fx


def _counted(grid, v, cell, before=(0, 0, 0), after=(0, 0, 0), origin=(0, 0, 0), step=(1, 1, 1)):
    """``n_voxels`` per grid row: voxels in ``[o * step - before, o * step + cell - 1 + after]`` per axis, where offsets o are
    ``origin`` plus multiples of ``cell / step``.  Each voxel is sent to the few cells that hold it; one equi-join."""
    df = v.df.select("x", "y", "z")
    for a, c, lo, hi, o, k in zip("xyz", cell, before, after, origin, step):
        rel = F.col(a) - F.lit(o * k)
        cells = F.sequence(F.ceil((rel - F.lit(c - 1 + hi)) / c).cast("bigint"), F.floor((rel + F.lit(lo)) / c).cast("bigint"))
        df = df.withColumn("_g", F.explode(cells)).withColumn(f"o{a}", F.col("_g") * (c // k) + o).drop("_g")
    n = df.groupBy("ox", "oy", "oz").agg(F.count(F.lit(1)).alias("n_voxels"))
    return grid.join(n, ["ox", "oy", "oz"], "left").select(*grid.columns, F.coalesce("n_voxels", F.lit(0)).alias("n_voxels"))


def _counted_sql(base, cols, lo, hi):
    """The grid rows of ``base`` with the number of V4's voxels between ``lo`` and ``hi`` (one expression per axis)."""
    on = " AND ".join(f"v4.{a} BETWEEN {l} AND {h}" for a, l, h in zip("xyz", lo, hi))
    return f"WITH {q.V4}, b AS ({base}) SELECT {cols}, COUNT(v4.x) AS n_voxels FROM b LEFT JOIN v4 ON {on} GROUP BY {cols}"


GRID_COLS = "id, gx, gy, gz, ox, oy, oz, sx, sy, sz"
O3, E3 = ("ox", "oy", "oz"), ("ox + sx - 1", "oy + sy - 1", "oz + sz - 1")


def _grid_sql(block, out=None, dims_cte=q.V4DIMS, dims_name="v4dims"):
    out = out or block
    bx, by, bz = block
    return (q.with_(dims_cte, f"""c AS (SELECT nx, ny, nz, (nx + {bx - 1}) // {bx} AS cx, (ny + {by - 1}) // {by} AS cy,
          (nz + {bz - 1}) // {bz} AS cz FROM {dims_name}),
t AS (SELECT i, i % cx * {bx} AS ox, (i // cx) % cy * {by} AS oy, i // (cx * cy) * {bz} AS oz, nx, ny, nz
      FROM c, range(0, (SELECT cx * cy * cz FROM c)) r(i))""")
            + f"""SELECT CAST(i AS BIGINT) AS id, CAST(ox // {out[0]} AS BIGINT) AS gx, CAST(oy // {out[1]} AS BIGINT) AS gy,
       CAST(oz // {out[2]} AS BIGINT) AS gz, CAST(ox AS BIGINT) AS ox, CAST(oy AS BIGINT) AS oy, CAST(oz AS BIGINT) AS oz,
       CAST(least({bx}, nx - ox) AS INTEGER) AS sx, CAST(least({by}, ny - oy) AS INTEGER) AS sy,
       CAST(least({bz}, nz - oz) AS INTEGER) AS sz FROM t""")


@register("block_grid", _counted_sql(_grid_sql((7, 5, 3)), GRID_COLS, O3, E3))
def block_grid(spark, sf_dir):
    """Blocks of (7,5,3) over V4's dims; edge blocks cropped; x fastest."""
    v = fx.lineitem_counts(spark, sf_dir)
    return _counted(g.block_grid(spark, v.dims, (7, 5, 3)), v, (7, 5, 3))


@register("block_grid_out", _counted_sql(_grid_sql((8, 10, 4), (4, 5, 2)), GRID_COLS, O3, E3))
def block_grid_out(spark, sf_dir):
    """B1 with an output block that divides the grid block: grid position = offset / out."""
    v = fx.lineitem_counts(spark, sf_dir)
    return _counted(g.block_grid(spark, v.dims, (8, 10, 4), (4, 5, 2)), v, (8, 10, 4))


_OFFSETS = q.with_(q.V4DIMS, """c AS (SELECT (nx - 1 - 3) // 4 + 1 AS cx, (ny - 3 - (-2)) // 5 + 1 AS cy, (nz - 1 - 1) // 2 + 1 AS cz FROM v4dims)""") \
    + """SELECT CAST(i AS BIGINT) AS id, CAST(3 + i % cx * 4 AS BIGINT) AS ox, CAST(-2 + (i // cx) % cy * 5 AS BIGINT) AS oy,
       CAST(1 + i // (cx * cy) * 2 AS BIGINT) AS oz FROM c, range(0, (SELECT cx * cy * cz FROM c)) r(i)"""


@register("grid_offsets", _counted_sql(_OFFSETS, "id, ox, oy, oz", O3, ("ox + 3", "oy + 4", "oz + 1")))
def grid_offsets(spark, sf_dir):
    """Offsets from (3,-2,1) to (nx-1,ny-3,nz-1) inclusive, spacing (4,5,2), with the voxels up to the next offset."""
    v = fx.lineitem_counts(spark, sf_dir)
    nx, ny, nz = v.dims
    return _counted(g.grid_offsets(spark, (3, -2, 1), (nx - 1, ny - 3, nz - 1), (4, 5, 2)), v, (4, 5, 2), origin=(3, -2, 1))


@register("grid_cell", q.with_(q.V4) + """SELECT x, y, z, CAST((x - 5) // 3 AS BIGINT) AS cx, CAST((y - 20) // 7 AS BIGINT) AS cy,
       CAST((z - 3) // 2 AS BIGINT) AS cz FROM v4""")
def grid_cell(spark, sf_dir):
    """Grid cell of every V4 voxel, truncating division (negative offsets round toward 0)."""
    v = fx.lineitem_counts(spark, sf_dir).df
    return v.select("x", "y", "z", g.grid_cell(F.col("x"), 5, 3).alias("cx"), g.grid_cell(F.col("y"), 20, 7).alias("cy"),
                    g.grid_cell(F.col("z"), 3, 2).alias("cz"))


@register("scaled_interval", q.with_(q.V4) + """SELECT x, y, z, CAST(floor((x + 0.5) * 0.37) AS BIGINT) AS fx,
       CAST(ceil(y * 1.7) AS BIGINT) AS cy FROM v4""")
def scaled_interval(spark, sf_dir):
    """floorScaled and ceilScaled of voxel positions."""
    v = fx.lineitem_counts(spark, sf_dir).df
    return v.select("x", "y", "z", g.floor_scaled(F.col("x") + 0.5, 0.37).cast("bigint").alias("fx"),
                    g.ceil_scaled(F.col("y"), 1.7).cast("bigint").alias("cy"))


@register("radius_by_scale", q.with_(q.V4, q.V4DIMS, """lv AS (SELECT s FROM range(0, CAST(ceil(log2(greatest(
    (SELECT nx FROM v4dims), (SELECT ny FROM v4dims), (SELECT nz FROM v4dims)))) AS BIGINT) + 1) r(s))""") + """
SELECT CAST(s AS INTEGER) AS s, CAST(floor(1023.0 * pow(2.0, -s) + 0.5) AS INTEGER) AS radius,
       CAST(ceil(nx / pow(2.0, s)) AS BIGINT) AS nx, CAST(ceil(ny / pow(2.0, s)) AS BIGINT) AS ny,
       CAST(ceil(nz / pow(2.0, s)) AS BIGINT) AS nz,
       (SELECT COUNT(*) FROM (SELECT DISTINCT x >> CAST(s AS BIGINT), y >> CAST(s AS BIGINT), z >> CAST(s AS BIGINT) FROM v4)) AS n_voxels
FROM v4dims, lv""")
def radius_by_scale(spark, sf_dir):
    """B8 + H5: per pyramid level of V4, the radius round(1023*2^-s), the level's dims ((n+1) div 2 per step) and
    its occupied voxels."""
    v = fx.lineitem_counts(spark, sf_dir)
    levels = math.ceil(math.log2(max(v.dims))) + 1
    at = v.df.select(F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("s"), *"xyz")
    n = (at.select("s", *[F.expr(f"shiftright({a}, s)").alias(a) for a in "xyz"]).distinct()
         .groupBy("s").agg(F.count(F.lit(1)).alias("n_voxels")))
    cols = ["s", g.radius_for_scale(F.col("s")).alias("radius")]
    for a, d in zip("xyz", v.dims):
        cols.append(F.ceil(F.lit(float(d)) / F.pow(F.lit(2.0), F.col("s").cast("double"))).cast("bigint").alias(f"n{a}"))
    return n.select(*cols, "n_voxels")


def _interval_sql(r, clamp: bool):
    rx, ry, rz = r
    base = _grid_sql((16, 16, 4)).replace("SELECT CAST(i AS BIGINT) AS id", "SELECT nx, ny, nz, CAST(i AS BIGINT) AS id", 1)
    cols = []
    for a, rr in zip("xyz", r):
        lo = f"o{a} - {rr}"
        hi = f"o{a} + s{a} - 1 + {rr}"
        if clamp:
            lo, hi = f"greatest(0, {lo})", f"least(n{a} - 1, {hi})"
        cols += [f"CAST({lo} AS BIGINT) AS lo_{a}", f"CAST({hi} AS BIGINT) AS hi_{a}"]
    names = ", ".join(f"{e}_{a}" for a in "xyz" for e in ("lo", "hi"))
    return _counted_sql(f"SELECT {GRID_COLS}, {', '.join(cols)} FROM ({base}) b", f"{GRID_COLS}, {names}",
                        ("lo_x", "lo_y", "lo_z"), ("hi_x", "hi_y", "hi_z"))


@register("padded_interval", _interval_sql((5, 5, 0), True))
def padded_interval(spark, sf_dir):
    """Per (16,16,4) block of V4, the source interval padded by (5,5,0) and clamped to the image."""
    v = fx.lineitem_counts(spark, sf_dir)
    grid = g.padded_interval(g.block_grid(spark, v.dims, (16, 16, 4)), (5, 5, 0), v.dims)
    return _counted(grid, v, (16, 16, 4), (5, 5, 0), (5, 5, 0))


@register("expand_interval", _interval_sql((2, 3, 1), False))
def expand_interval(spark, sf_dir):
    """Per block, the interval expanded by (2,3,1) without clamping."""
    v = fx.lineitem_counts(spark, sf_dir)
    return _counted(g.expand_interval(g.block_grid(spark, v.dims, (16, 16, 4)), (2, 3, 1)), v, (16, 16, 4), (2, 3, 1), (2, 3, 1))


_ds_dims = q.V4DIMS + """,
d2 AS (SELECT (nx + 1) // 2 AS nx, (ny + 1) // 2 AS ny, (nz + 1) // 2 AS nz FROM v4dims)"""
_RANGES = f"""SELECT gx, gy, gz, ox, oy, oz, sx, sy, sz,
   CAST(2 * (ox - 1) AS BIGINT) AS src_lo_x, CAST(2 * (oy - 1) AS BIGINT) AS src_lo_y, CAST(2 * (oz - 1) AS BIGINT) AS src_lo_z,
   CAST(2 * (ox + sx - 1 + 1) + 1 AS BIGINT) AS src_hi_x, CAST(2 * (oy + sy - 1 + 1) + 1 AS BIGINT) AS src_hi_y,
   CAST(2 * (oz + sz - 1 + 1) + 1 AS BIGINT) AS src_hi_z
FROM ({_grid_sql((8, 8, 2), dims_cte=_ds_dims, dims_name='d2')}) b"""
_LO, _HI = ("src_lo_x", "src_lo_y", "src_lo_z"), ("src_hi_x", "src_hi_y", "src_hi_z")


@register("source_ranges", _counted_sql(_RANGES, ", ".join((GRID_COLS.replace("id, ", ""), *_LO, *_HI)), _LO, _HI))
def source_ranges(spark, sf_dir):
    """H8: for the (8,8,2) grid of V4 downsampled x2, the source interval read by
    'downsample x2, then a radius-1 stencil' (backward pass of the chain), and its occupied voxels."""
    v = fx.lineitem_counts(spark, sf_dir)
    grid = g.block_grid(spark, [(n + 1) // 2 for n in v.dims], (8, 8, 2))
    ranges = g.source_ranges(grid, [g.op_downsample2(), g.op_stencil((1, 1, 1))])
    return _counted(ranges, v, (16, 16, 4), (2, 2, 2), (2, 2, 2), step=(2, 2, 2))
