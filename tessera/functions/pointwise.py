"""Pointwise converters (D*) and the pinned numeric rules.

Everything here returns a Column: JVM-side, whole-stage codegen, no Python.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, functions as F

from ..volume import dtype_of

INF = float("inf")
NAN = float("nan")


def _c(v) -> Column:
    return v if isinstance(v, Column) else F.col(v) if isinstance(v, str) else F.lit(v)


def round_half_away(v) -> Column:
    """``floor(v+0.5)`` for v >= 0, ``ceil(v-0.5)`` for v < 0 (BIGINT)."""
    v = _c(v).cast("double")
    return F.when(v >= 0, F.floor(v + 0.5)).otherwise(F.ceil(v - 0.5))


def to_type(v, dtype: str) -> Column:
    """D1 with P1/P2: convert to ``dtype``; integers round and saturate, NaN -> 0."""
    t = dtype_of(dtype)
    v = _c(v)
    if not t.integer:
        if dtype == "float32":
            return v.cast("float")
        return v.cast("double")
    lo, hi = F.lit(t.lo if abs(t.hi) < 2 ** 63 else Decimal(t.lo)), F.lit(t.hi if abs(t.hi) < 2 ** 63 else Decimal(t.hi))
    d = v.cast("double")
    inside = F.when(F.isnan(d) | (d <= float(t.lo)) | (d >= float(t.hi)), F.lit(0.0)).otherwise(d)
    if dtype == "uint64":  # a bigint holds the lower half of the range; doubles above have no fraction
        half = float(2 ** 63)
        rounded = (F.when(inside >= half, (inside - half).cast("bigint").cast("decimal(20,0)") + F.lit(Decimal(2 ** 63)))
                   .otherwise(round_half_away(F.when(inside >= half, F.lit(0.0)).otherwise(inside)).cast("decimal(20,0)")))
    else:
        rounded = round_half_away(inside)
    from_float = (F.when(F.isnan(d), F.lit(0)).when(d <= float(t.lo), lo).when(d >= float(t.hi), hi)
                  .otherwise(rounded.cast(t.spark)).cast(t.spark))
    # an integer column stays one (its type is known when the plan is made, so one branch is left)
    kept = F.greatest(lo, F.least(hi, v.cast("decimal(20,0)" if dtype == "uint64" else "bigint"))).cast(t.spark)
    return F.when(F.typeof(v).isin("tinyint", "smallint", "int", "bigint"), kept).otherwise(from_float)


def wrap_to(v, dtype: str) -> Column:
    """Integer wrap-around (A5/D6): bytes keep their low bits."""
    t = dtype_of(dtype)
    span = int(t.hi - t.lo + 1)
    return (F.pmod(_c(v).cast("bigint") - F.lit(int(t.lo)), F.lit(span)) + F.lit(int(t.lo))).cast(t.spark)


def ieee_div(a, b) -> Column:
    """x/0 = +-Inf, 0/0 = NaN, as Java doubles; ANSI Spark would raise."""
    a, b = _c(a).cast("double"), _c(b).cast("double")
    return (F.when(b == 0, F.when(a > 0, F.lit(INF)).when(a < 0, F.lit(-INF)).otherwise(F.lit(NAN)))
            .otherwise(a / b))


def contrast_window(v, lo: float = 26000.0, width: float = 6000.0) -> Column:
    """``max(0, min(255, 255 - 255*(v-lo)/width))`` -> uint8 (bright becomes dark)."""
    d = _c(v).cast("double")
    w = F.greatest(F.lit(0.0), F.least(F.lit(255.0), F.lit(255.0) - F.lit(255.0) * (d - F.lit(float(lo))) / F.lit(float(width))))
    return to_type(w, "uint8")


def invert(v, top: float = 65535.0) -> Column:
    """D3: ``0xffff - v`` as float32."""
    return (F.lit(float(top)) - _c(v).cast("double")).cast("float")


def clamp(v, lo: float = -3.4028234663852886e38, hi: float = 3.4028234663852886e38) -> Column:
    """``min(hi, max(lo, v))`` with Java semantics: NaN stays NaN.

    ``greatest``/``least`` order NaN above every number in Spark, so NaN is
    routed around them explicitly.
    """
    d = _c(v).cast("double")
    return F.when(F.isnan(d), d).otherwise(F.least(F.lit(float(hi)), F.greatest(F.lit(float(lo)), d)))


def unsigned_byte(v) -> Column:
    """The unsigned reading of a signed byte (``b & 0xff``)."""
    return F.pmod(_c(v).cast("int"), F.lit(256)).cast("short")


def soft_limit_constants(limit: float, gamma: float) -> tuple[float, float]:
    """D7 constants: ``g = 1/gamma^(1/(gamma-1))``; returns ``(g - L, L - g^gamma)``."""
    g = 1.0 / math.pow(gamma, 1.0 / (gamma - 1.0))
    return g - limit, limit - math.pow(g, gamma)


def soft_limit(x, limit: float, gamma: float) -> Column:
    """``x < L ? x : (x + g - L)^gamma + L - g^gamma`` (value and slope continuous at L)."""
    a, b = soft_limit_constants(limit, gamma)
    x = _c(x).cast("double")
    return F.when(x < F.lit(float(limit)), x).otherwise(F.pow(x + F.lit(a), F.lit(float(gamma))) + F.lit(b))


def function_image(x, y, expr=lambda x, y: x * y, dtype: str = "uint8") -> Column:
    """A5: a value computed from the position, wrapped into ``dtype`` like bytes."""
    return wrap_to(expr(_c(x), _c(y)), dtype)


def convert(vol, fn, dtype: str | None = None):
    """A user converter per voxel.  ``fn`` maps the value Column to a
    Column (JVM-side, preferred) or is a ``pandas_udf`` (Arrow batches)."""
    from ..volume import AXES, Volume, VolumeMeta
    out = fn(F.col("v"))
    if dtype:
        out = to_type(out, dtype)
    return Volume(vol.df.select(*AXES, out.alias("v")),
                  VolumeMeta(vol.dims, dtype or vol.dtype, vol.meta.min, dense=vol.meta.dense))
