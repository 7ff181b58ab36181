"""C: crops, translations, slices, extension and copies on V2, V3, V4, V5."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sqlcheck as q
from ..catalog import register
from ..operators import coords as C
from ..sources import fixtures as fx

@register("crop", q.with_(q.V4, q.V4DIMS) + """SELECT x, y, z, v FROM v4, v4dims
  WHERE x BETWEEN 2 AND 2 + nx // 2 - 1 AND y BETWEEN 10 AND 29 AND z BETWEEN 1 AND 3""")
def crop(spark, sf_dir):
    """Crop V4 to min (2,10,1), size (nx/2, 20, 3)."""
    v = fx.lineitem_counts(spark, sf_dir)
    return C.crop(v, (2, 10, 1), (v.dims[0] // 2, 20, 3)).df


@register("translate", q.with_(q.V4) + "SELECT x + 3 AS x, y - 2 AS y, z + 1 AS z, v FROM v4")
def translate(spark, sf_dir):
    """C4: the value at p moves to p + (3,-2,1)."""
    return C.translate(fx.lineitem_counts(spark, sf_dir), (3, -2, 1)).df


@register("translate_inverse", q.with_(q.V4) + "SELECT x - 3 AS x, y + 2 AS y, z - 1 AS z, v FROM v4")
def translate_inverse(spark, sf_dir):
    """result(q) = src(q + (3,-2,1))."""
    return C.translate_inverse(fx.lineitem_counts(spark, sf_dir), (3, -2, 1)).df


@register("zero_min", q.with_(q.V4) + """SELECT x - 4 AS x, y - 7 AS y, z - 2 AS z, v FROM v4
  WHERE x BETWEEN 4 AND 13 AND y BETWEEN 7 AND 36 AND z BETWEEN 2 AND 5""")
def zero_min(spark, sf_dir):
    """C1 + C3: crop at (4,7,2) size (10,30,4), then shift the interval to start at 0."""
    return C.zero_min(C.crop(fx.lineitem_counts(spark, sf_dir), (4, 7, 2), (10, 30, 4))).df


@register("hyperslice", q.with_(q.V4) + "SELECT x, y, CAST(0 AS BIGINT) AS z, v FROM v4 WHERE z = 3")
def hyperslice(spark, sf_dir):
    """The centre slice z = dim(2)/2 of V4, axis dropped."""
    v = fx.lineitem_counts(spark, sf_dir)
    return C.hyperslice(v, 2, v.dims[2] // 2).df


@register("hyperslices", q.with_(q.V4) + "SELECT x, y, z, v FROM v4 WHERE y IN (20, 25, 30)")
def hyperslices(spark, sf_dir):
    """The three display slices n/10*4, n/2, n/10*6 along y, kept in place."""
    v = fx.lineitem_counts(spark, sf_dir)
    pos = C.slice_positions(v.dims[1])
    return v.df.filter(F.col("y").isin(pos))


@register("interval_of", q.with_(q.V3) + """SELECT min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y,
  min(z) AS min_z, max(z) AS max_z, CAST(1 AS BIGINT) * (max(x) - min(x) + 1) * (max(y) - min(y) + 1) * (max(z) - min(z) + 1) AS num_elements
FROM v3""")
def interval_of(spark, sf_dir):
    """Bounding interval and element count of the occupied voxels of V3 (sparse)."""
    return C.interval_of(fx.event_counts(spark, sf_dir))


@register("extend_zero", q.with_(q.V3, q.V3DIMS) + """SELECT CAST(tx.i AS BIGINT) AS x, CAST(ty.i AS BIGINT) AS y, CAST(tz.i AS BIGINT) AS z,
  COALESCE(v3.v, 0) AS v
FROM range(-2, (SELECT nx FROM v3dims) + 2) tx(i) CROSS JOIN range(-1, (SELECT ny FROM v3dims) + 1) ty(i)
CROSS JOIN range(0, (SELECT nz FROM v3dims)) tz(i)
LEFT JOIN v3 ON v3.x = tx.i AND v3.y = ty.i AND v3.z = tz.i""")
def extend_zero(spark, sf_dir):
    """V3 (sparse) on its interval grown by (2,1,0); outside and absent read 0."""
    return C.densify(C.extend(fx.event_counts(spark, sf_dir), (2, 1, 0), "zero")).df


def _mirror_sql(mode):
    fn = q.mirror_single if mode == "mirror_single" else q.mirror_double
    return q.with_(q.V2, q.V2DIMS) + f"""SELECT CAST(tx.i AS BIGINT) AS x, CAST(ty.j AS BIGINT) AS y, v2.z AS z, v2.v AS v
FROM v2dims, range(-3, (SELECT nx FROM v2dims) + 3) tx(i), range(-4, (SELECT ny FROM v2dims) + 4) ty(j), v2
WHERE v2.x = {fn('tx.i', 'v2dims.nx')} AND v2.y = {fn('ty.j', 'v2dims.ny')}"""


@register("extend_mirror_single", _mirror_sql("mirror_single"))
def extend_mirror_single(spark, sf_dir):
    """V2 grown by (3,4,0) with mirror-single (edge sample not repeated)."""
    return C.extend(fx.embedding_u16(spark, sf_dir), (3, 4, 0), "mirror_single").df


@register("extend_mirror_double", _mirror_sql("mirror_double"))
def extend_mirror_double(spark, sf_dir):
    """V2 grown by (3,4,0) with mirror-double (edge sample repeated)."""
    return C.extend(fx.embedding_u16(spark, sf_dir), (3, 4, 0), "mirror_double").df


@register("copy_into", q.with_(q.V4, q.V5) + """SELECT v4.x, v4.y, v4.z, COALESCE(s.v, v4.v) AS v FROM v4
LEFT JOIN (SELECT * FROM v5 WHERE x BETWEEN 0 AND 9 AND y BETWEEN 0 AND 24) s ON s.x = v4.x AND s.y = v4.y AND s.z = v4.z""")
def copy_into(spark, sf_dir):
    """Write V5's values over V4 inside V5's crop (0,0,0)+(10,25,7)."""
    v5 = C.crop(fx.lineitem_revenue(spark, sf_dir), (0, 0, 0), (10, 25, 7))
    return C.copy_into(v5, fx.lineitem_counts(spark, sf_dir)).df


@register("copy_real", q.with_(q.V4, q.V5) + f"""SELECT v4.x, v4.y, v4.z,
  COALESCE({q.to_int('CAST(s.v AS DOUBLE) / 1000.0', 0, 255, 'SMALLINT')}, {q.to_int('CAST(v4.v AS DOUBLE)', 0, 255, 'SMALLINT')}) AS v
FROM v4 LEFT JOIN (SELECT * FROM v5 WHERE x BETWEEN 0 AND 9 AND y BETWEEN 0 AND 24) s ON s.x = v4.x AND s.y = v4.y AND s.z = v4.z""")
def copy_real(spark, sf_dir):
    """C12 through double into uint8 (round half away, saturate)."""
    v5 = C.crop(fx.lineitem_revenue(spark, sf_dir), (0, 0, 0), (10, 25, 7))
    v5 = v5.with_df(v5.df.select("x", "y", "z", (F.col("v").cast("double") / 1000.0).alias("v")))
    return C.copy_real(v5, fx.lineitem_counts(spark, sf_dir), "uint8").df


@register("first_slice_float", q.with_(q.V4) + "SELECT x, y, CAST(0 AS BIGINT) AS z, CAST(v AS FLOAT) AS v FROM v4 WHERE z = 0")
def first_slice_float(spark, sf_dir):
    """C14: materialise the first 2-D slice as float32."""
    return C.first_slice_float(fx.lineitem_counts(spark, sf_dir)).df
