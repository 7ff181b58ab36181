"""D5/U5 user converters, U7/H9 chained operator factories, A6 image source."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sqlcheck as q
from ..catalog import register
from ..functions.pointwise import convert
from ..operators import blocks as B
from ..operators import resample as RS
from ..session import scratch_dir
from ..sources import fixtures as fx
from ..sources import image as IM
from ..volume import Volume


@register("user_converter", q.with_(q.V2) + "SELECT x, y, z, CAST((v * 3 + 7) % 1000 AS INTEGER) AS v FROM v2")
def user_converter(spark, sf_dir):
    """A user lambda converter written as a Column expression (stays in codegen)."""
    return convert(fx.embedding_u16(spark, sf_dir), lambda v: (v * 3 + 7) % 1000, "int32").df


def _tanh2(s):
    import numpy as np
    return np.tanh(s * 2.0)


@register("pandas_converter", q.with_(q.V1) + "SELECT x, y, z, round(tanh(v * 2.0), 6) AS v FROM v1")
def pandas_converter(spark, sf_dir):
    """A user converter as a pandas UDF (Arrow batches), for functions without a Column form."""
    udf = F.pandas_udf(lambda s: _tanh2(s), "double")
    out = convert(fx.embedding_image(spark, sf_dir), udf)
    return out.df.select("x", "y", "z", F.round("v", 6).alias("v"))


def _to_float(vol: Volume) -> Volume:
    """Operator factory: reads type and dimensionality from its source."""
    return convert(vol, lambda v: v.cast("float"), "float32")


def _back_to(dtype: str):
    def op(vol: Volume) -> Volume:
        return convert(vol, lambda v: v, dtype)
    return op


@register("chain_factory", q.with_(q.V2, q.V2DIMS) + f"""SELECT tx AS x, ty AS y, CAST(0 AS BIGINT) AS z,
  {q.to_int('SUM(CAST(v AS DOUBLE)) / (CAST(least(2, (SELECT nx FROM v2dims) - 2 * tx) AS DOUBLE) * least(2, (SELECT ny FROM v2dims) - 2 * ty))', 0, 65535, 'INTEGER')} AS v
FROM (SELECT x // 2 AS tx, y // 2 AS ty, v FROM v2) GROUP BY tx, ty""")
def chain_factory(spark, sf_dir):
    """Convert -> downsample -> convert as a checked chain (type and dimensionality tested at each step)."""
    v = fx.embedding_u16(spark, sf_dir)
    out = (v.then(_to_float, expect_dtype="uint16", expect_ndim=2)
           .then(lambda f: RS.downsample2(f, "float64"), expect_dtype="float32")
           .then(_back_to("uint16"), expect_dtype="float64"))
    return out.df


@register("image_tiles", q.with_(q.V2) + "SELECT x, y, z, CAST(v // 256 AS SMALLINT) AS v FROM v2")
def image_tiles(spark, sf_dir):
    """V2 as 8-bit tiles (64 x 64 PNG files written by the tasks), read back with Spark's image source."""
    v = fx.embedding_u16(spark, sf_dir)
    u8 = convert(v, lambda c: F.floor(c / 256), "uint8")
    folder = scratch_dir(spark, "png")
    IM.write_png_tiles(B.from_voxels(u8, (64, 64, 1)), folder)
    return IM.read_png_tiles(spark, folder)
