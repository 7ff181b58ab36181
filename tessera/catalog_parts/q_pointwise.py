"""D / A5 / E: pointwise converters and pairwise voxel operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sqlcheck as q
from ..catalog import register
from ..functions import pointwise as P
from ..operators import pairwise as E
from ..operators.coords import translate
from ..sources import fixtures as fx

# ------------------------------------------------------------------ D


@register("contrast_window", q.with_(q.V2) + f"""SELECT x, y, z,
  {q.to_int('greatest(0.0, least(255.0, 255.0 - 255.0 * (CAST(v AS DOUBLE) - 26000.0) / 6000.0))', 0, 255, 'SMALLINT')} AS v FROM v2""")
def contrast_window(spark, sf_dir):
    """max(0, min(255, 255 - 255*(v-26000)/6000)) as uint8 (bright becomes dark)."""
    v = fx.embedding_u16(spark, sf_dir).df
    return v.select("x", "y", "z", P.contrast_window("v").alias("v"))


@register("invert", q.with_(q.V2) + "SELECT x, y, z, CAST(65535.0 - CAST(v AS DOUBLE) AS FLOAT) AS v FROM v2")
def invert(spark, sf_dir):
    """D3: 0xffff - v as float32."""
    v = fx.embedding_u16(spark, sf_dir).df
    return v.select("x", "y", "z", P.invert("v").alias("v"))


@register("clamp", q.with_(q.V1) + f"SELECT x, y, z, {q.clamp('v * 1000.0', -200.0, 300.0)} AS v FROM v1")
def clamp(spark, sf_dir):
    """Clamp V1*1000 to [-200, 300] (NaN would pass through)."""
    v = fx.embedding_image(spark, sf_dir).df
    return v.select("x", "y", "z", P.clamp(F.col("v") * 1000.0, -200.0, 300.0).alias("v"))


@register("convert_u8", q.with_(q.V1) + f"SELECT x, y, z, {q.to_int('v * 400.0 + 128.0', 0, 255, 'SMALLINT')} AS v FROM v1")
def convert_u8(spark, sf_dir):
    """D1 + P1/P2: V1*400+128 to uint8: round half away from zero, saturate."""
    v = fx.embedding_image(spark, sf_dir).df
    return v.select("x", "y", "z", P.to_type(F.col("v") * 400.0 + 128.0, "uint8").alias("v"))


@register("convert_i32", q.with_(q.V2) + "SELECT x, y, z, CAST(v AS INTEGER) AS v FROM v2")
def convert_i32(spark, sf_dir):
    """uint16 -> int32 (exact)."""
    v = fx.embedding_u16(spark, sf_dir).df
    return v.select("x", "y", "z", P.to_type("v", "int32").alias("v"))


@register("convert_f32", q.with_(q.V1) + "SELECT x, y, z, CAST(v * 3.0 AS FLOAT) AS v FROM v1")
def convert_f32(spark, sf_dir):
    """Double -> float32."""
    v = fx.embedding_image(spark, sf_dir).df
    return v.select("x", "y", "z", P.to_type(F.col("v") * 3.0, "float32").alias("v"))


@register("soft_limit", q.with_(q.V1) + f"SELECT x, y, z, round({q.soft_limit_sql('v * 40.0', 10.0, 0.5)}, 6) AS v FROM v1")
def soft_limit(spark, sf_dir):
    """The soft limiter with L = 10, gamma = 0.5 on V1*40."""
    v = fx.embedding_image(spark, sf_dir).df
    return v.select("x", "y", "z", F.round(P.soft_limit(F.col("v") * 40.0, 10.0, 0.5), 6).alias("v"))


@register("function_image", q.with_(q.V2) + "SELECT x, y, z, CAST(((x * y) % 256 + 256) % 256 AS SMALLINT) AS v FROM v2")
def function_image(spark, sf_dir):
    """A5: the function image x*y as uint8 (wrapping) on V2's coordinates."""
    v = fx.embedding_u16(spark, sf_dir).df
    return v.select("x", "y", "z", P.function_image("x", "y").alias("v"))


@register("unsigned_byte", q.with_(q.V2) + """SELECT x, y, z, sb, CAST((sb % 256 + 256) % 256 AS SMALLINT) AS v FROM (
  SELECT x, y, z, CAST(CASE WHEN v % 256 >= 128 THEN v % 256 - 256 ELSE v % 256 END AS INTEGER) AS sb FROM v2)""")
def unsigned_byte(spark, sf_dir):
    """Java's signed byte of the low 8 bits and its unsigned reading."""
    v = fx.embedding_u16(spark, sf_dir).df
    low = F.pmod("v", F.lit(256))
    sb = F.when(low >= 128, low - 256).otherwise(low).cast("int")
    return v.select("x", "y", "z", sb.alias("sb")).select("x", "y", "z", "sb", P.unsigned_byte("sb").alias("v"))


# ------------------------------------------------------------------ E

FULL = """FROM v4 FULL OUTER JOIN v5 ON v4.x = v5.x AND v4.y = v5.y AND v4.z = v5.z"""
KEYS = "COALESCE(v4.x, v5.x) AS x, COALESCE(v4.y, v5.y) AS y, COALESCE(v4.z, v5.z) AS z"


@register("vol_add", q.with_(q.V4, q.V5) + f"SELECT {KEYS}, COALESCE(v4.v, 0) + COALESCE(v5.v, 0) AS v {FULL}")
def vol_add(spark, sf_dir):
    """V4 + V5 (absent = 0: full outer join)."""
    return E.add(fx.lineitem_counts(spark, sf_dir), fx.lineitem_revenue(spark, sf_dir)).df


@register("vol_sub", q.with_(q.V4, q.V5) + f"SELECT {KEYS}, COALESCE(v5.v, 0) - COALESCE(v4.v, 0) AS v {FULL}")
def vol_sub(spark, sf_dir):
    """V5 - V4."""
    return E.sub(fx.lineitem_revenue(spark, sf_dir), fx.lineitem_counts(spark, sf_dir)).df


@register("vol_mul", q.with_(q.V4, q.V5) + "SELECT v4.x, v4.y, v4.z, v4.v * v5.v AS v FROM v4 JOIN v5 ON v4.x = v5.x AND v4.y = v5.y AND v4.z = v5.z")
def vol_mul(spark, sf_dir):
    """V4 * V5 (absent = 0, so an inner join suffices)."""
    return E.mul(fx.lineitem_counts(spark, sf_dir), fx.lineitem_revenue(spark, sf_dir)).df


@register("vol_div", q.with_(q.V4, q.V5, q.V4DIMS) + f"""SELECT tx.i AS x, ty.i AS y, tz.i AS z,
  {q.ieee_div('CAST(COALESCE(v5.v, 0) AS DOUBLE)', 'CAST(COALESCE(v4.v, 0) AS DOUBLE)')} AS v
FROM range(0, (SELECT nx FROM v4dims)) tx(i) CROSS JOIN range(0, (SELECT ny FROM v4dims)) ty(i) CROSS JOIN range(0, (SELECT nz FROM v4dims)) tz(i)
LEFT JOIN v4 ON v4.x = tx.i AND v4.y = ty.i AND v4.z = tz.i
LEFT JOIN v5 ON v5.x = tx.i AND v5.y = ty.i AND v5.z = tz.i""")
def vol_div(spark, sf_dir):
    """V5 / V4 over the whole interval, IEEE rules (0/0 = NaN, x/0 = Inf)."""
    return E.div(fx.lineitem_revenue(spark, sf_dir), fx.lineitem_counts(spark, sf_dir)).df


@register("vol_max", q.with_(q.V4, q.V5) + """SELECT x, y, z, greatest(max(v), 0) AS v FROM (
  SELECT x, y, z, v FROM v4 UNION ALL SELECT x + 1, y, z, v FROM v4 UNION ALL SELECT x, y, z, v // 100000 FROM v5)
GROUP BY x, y, z""")
def vol_max(spark, sf_dir):
    """Per-voxel max over three volumes and the output's zero content."""
    v4 = fx.lineitem_counts(spark, sf_dir)
    v5 = fx.lineitem_revenue(spark, sf_dir)
    v5s = v5.with_df(v5.df.select("x", "y", "z", F.floor(F.col("v") / 100000).cast("bigint").alias("v")))
    return E.vmax([v4, translate(v4, (1, 0, 0)), v5s]).df


@register("multiply_cell", q.with_(q.V4, q.V5) + """SELECT v4.x, v4.y, v4.z, v4.v * v5.v AS v FROM v4 JOIN v5
  ON v4.x = v5.x AND v4.y = v5.y AND v4.z = v5.z WHERE v4.x BETWEEN 8 AND 15 AND v4.y BETWEEN 16 AND 31 AND v4.z BETWEEN 0 AND 3""")
def multiply_cell(spark, sf_dir):
    """E5: Multiply filling one cell (8,16,0)+(8,16,4)."""
    return E.multiply_cell(fx.lineitem_counts(spark, sf_dir), fx.lineitem_revenue(spark, sf_dir),
                           (8, 16, 0), (8, 16, 4)).df


@register("pair", q.with_(q.V4, q.V5) + "SELECT v4.x, v4.y, v4.z, v4.v AS a, v5.v AS b FROM v4 JOIN v5 ON v4.x = v5.x AND v4.y = v5.y AND v4.z = v5.z")
def pair(spark, sf_dir):
    """Both values side by side on equal coordinates."""
    return E.pair(fx.lineitem_counts(spark, sf_dir), fx.lineitem_revenue(spark, sf_dir))
