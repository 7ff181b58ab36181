"""Pairwise and n-ary voxel operators.

Operands align on equal coordinates, the result has A's interval: one equi-join on ``(x, y, z)``.  Absent
voxels are 0, so add/sub/max need every voxel of either side (full outer
join); mul keeps the inner join; div densifies first (0/0 is NaN).  Both sides
are hash-partitioned on the coordinates; for equally blocked block-form
volumes the join key is the grid position instead (see ``blockops``).
E1-E3 give A's voxel type; an integer result outside its range saturates.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.pointwise import ieee_div, to_type
from ..volume import AXES, Volume, VolumeMeta, dtype_of, spanning
from .coords import crop, densify


def _within(b: Volume, a: Volume) -> DataFrame:
    """The voxels of B inside A's interval; outside it there is no result."""
    if tuple(a.meta.min) == tuple(b.meta.min) and tuple(a.dims) == tuple(b.dims):
        return b.df
    return crop(b, a.meta.min, a.dims).df


def _full(a: Volume, b: Volume) -> DataFrame:
    l = a.df.select(*AXES, F.col("v").alias("va"))
    r = _within(b, a).select(*AXES, F.col("v").alias("vb"))
    return l.join(r, list(AXES), "full_outer")


def _inner(a: Volume, b: Volume) -> DataFrame:
    l = a.df.select(*AXES, F.col("v").alias("va"))
    r = b.df.select(*AXES, F.col("v").alias("vb"))
    return l.join(r, list(AXES), "inner")


def _saturated(op: str, va, vb, a: Volume, b: Volume):
    """E1-E3 in A's voxel type: integers saturate at its ends (P2), floats are rounded to it."""
    t = dtype_of(a.dtype)
    if not t.integer:
        x, y = va.cast("double"), vb.cast("double")
        return {"add": x + y, "subtract": x - y, "multiply": x * y}[op].cast(t.spark)
    x, y = (c.cast("bigint") if dtype_of(v.dtype).integer else to_type(c, "int64") for c, v in ((va, a), (vb, b)))
    exact = {"add": F.try_add, "subtract": F.try_subtract, "multiply": F.try_multiply}[op](x, y)
    down = {"add": x < 0, "subtract": x < 0, "multiply": (x < 0) != (y < 0)}[op]  # the side an overflow is on
    full = F.coalesce(exact, F.when(down, F.lit(-2 ** 63)).otherwise(F.lit(2 ** 63 - 1)))
    if a.dtype == "int64":
        return full
    return F.greatest(F.lit(int(t.lo)), F.least(F.lit(int(t.hi)), full)).cast(t.spark)


def _zero(c: str, df: DataFrame):
    return F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType))


def add(a: Volume, b: Volume) -> Volume:
    """A + B in A's type."""
    df = _full(a, b)
    return Volume(df.select(*AXES, _saturated("add", _zero("va", df), _zero("vb", df), a, b).alias("v")), a.meta)


def sub(a: Volume, b: Volume) -> Volume:
    """A - B."""
    df = _full(a, b)
    return Volume(df.select(*AXES, _saturated("subtract", _zero("va", df), _zero("vb", df), a, b).alias("v")), a.meta)


def mul(a: Volume, b: Volume) -> Volume:
    """A * B (absent on either side gives 0, so inner)."""
    df = _inner(a, b)
    return Volume(df.select(*AXES, _saturated("multiply", F.col("va"), F.col("vb"), a, b).alias("v")), a.meta)


def div(a: Volume, b: Volume) -> Volume:
    """A / B over A's whole interval in double with IEEE rules."""
    da, db = densify(a), b
    df = da.df.select(*AXES, F.col("v").alias("va")).join(
        db.df.select(*AXES, F.col("v").alias("vb")), list(AXES), "left")
    out = ieee_div(F.col("va").cast("double"), F.coalesce(F.col("vb").cast("double"), F.lit(0.0)))
    return Volume(df.select(*AXES, out.alias("v")), VolumeMeta(a.dims, "float64", a.meta.min))


def vmax(sources: list[Volume], floor: float | None = 0) -> Volume:
    """Per-voxel max over n volumes, on the interval that spans them; with ``floor=0`` also over the output's
    previous (zero) content, as the reference's cell op does.  ``floor=None``: plain max.

    A union and one aggregation: partial max per partition before the shuffle.
    """
    u = reduce(lambda x, y: x.unionByName(y), [s.df.select(*AXES, "v") for s in sources])
    m = F.max("v")
    if floor is not None:
        m = F.greatest(m, F.lit(floor).cast(u.schema["v"].dataType))
    return Volume(u.groupBy(*AXES).agg(m.alias("v")), spanning([s.meta for s in sources]))


def multiply_cell(a: Volume, b: Volume, lo, size) -> Volume:
    """E5: A * B restricted to one cell's interval (crop pushes into both scans)."""
    return mul(crop(a, lo, size), crop(b, lo, size))


def pair(a: Volume, b: Volume) -> DataFrame:
    """``x, y, z, a, b`` for voxels present in both."""
    return _inner(a, b).select(*AXES, F.col("va").alias("a"), F.col("vb").alias("b"))
