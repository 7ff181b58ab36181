"""Grid and interval arithmetic (B1-B11) and the backward interval pass (H8).

Grids are generated with ``spark.range`` and integer arithmetic, split into
partitions like any other scan: the block list is never built in the driver.
Axis 0 (x) advances fastest, as in the reference's grid order (``id``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..volume import idiv

AXES = ("x", "y", "z")
G = ("gx", "gy", "gz")
O = ("ox", "oy", "oz")
S = ("sx", "sy", "sz")


def _counts(dims, block):
    return [(int(d) + int(b) - 1) // int(b) if int(d) > 0 else 0 for d, b in zip(dims, block)]


def block_grid(spark: SparkSession, dims, block, out_block=None, num_partitions: int | None = None) -> DataFrame:
    """Every block of ``dims`` in ``block`` steps, x fastest.

    Columns: ``id, gx, gy, gz`` (grid position = offset / out_block),
    ``ox, oy, oz`` (world offset), ``sx, sy, sz`` (size cropped at the end).
    ``out_block`` must divide ``block`` (the reference assumes it, we check).
    A zero-length axis yields no blocks.
    """
    dims = [int(d) for d in dims]
    block = [int(b) for b in block]
    out_block = [int(b) for b in (out_block or block)]
    for b, o in zip(block, out_block):
        if b % o != 0:
            raise ValueError(f"grid block {block} is not a multiple of the output block {out_block}")
    n = _counts(dims, block)
    total = math.prod(n)
    i = F.col("id")
    stride = [1, n[0], n[0] * n[1]]
    cols = [i]
    offs = []
    for a in range(3):
        cell = idiv(i, stride[a]) % F.lit(max(n[a], 1)) if total else F.lit(0).cast("bigint")
        offs.append((cell * F.lit(block[a])).alias(O[a]))
    df = spark.range(0, total, numPartitions=num_partitions) if num_partitions else spark.range(0, total)
    df = df.select(i, *offs)
    return df.select(
        "id",
        *[idiv(F.col(O[a]), out_block[a]).alias(G[a]) for a in range(3)],
        *[F.col(O[a]) for a in range(3)],
        *[F.least(F.lit(block[a]), F.lit(dims[a]) - F.col(O[a])).cast("int").alias(S[a]) for a in range(3)],
    )


def grid_offsets(spark: SparkSession, lo, hi, spacing) -> DataFrame:
    """All offsets from ``lo`` to ``hi`` inclusive in ``spacing`` steps (x fastest).

    An empty interval on any axis yields no rows.
    """
    counts = [max(0, (int(h) - int(l)) // int(s) + 1) for l, h, s in zip(lo, hi, spacing)]
    total = math.prod(counts)
    i = F.col("id")
    stride = [1, counts[0], counts[0] * counts[1]]
    return spark.range(0, total).select(
        "id", *[(F.lit(int(lo[a])) + (idiv(i, stride[a]) % F.lit(max(counts[a], 1)))
                 * F.lit(int(spacing[a]))).alias(O[a]) for a in range(3)])


def grid_cell(offset: Column, lo: int, spacing: int) -> Column:
    """``(offset - min) / spacing`` truncating toward zero (Java integer division)."""
    d = offset - F.lit(int(lo))
    q = idiv(F.abs(d), int(spacing))
    return F.when(d < 0, -q).otherwise(q)


def floor_scaled(x: Column, scale: float) -> Column:
    """``floor(x * scale)``."""
    return F.floor(x * F.lit(float(scale)))


def ceil_scaled(x: Column, scale: float) -> Column:
    """``ceil(x * scale)``."""
    return F.ceil(x * F.lit(float(scale)))


def radius_for_scale(level: Column, base: int = 1023) -> Column:
    """``round(base * 2^-s)`` (half up)."""
    return F.floor(F.lit(float(base)) * F.pow(F.lit(2.0), -level.cast("double")) + F.lit(0.5)).cast("int")


def padded_interval(grid: DataFrame, r, dims) -> DataFrame:
    """Per block, the source interval grown by ``r`` and clamped to the image."""
    out = grid
    for a in range(3):
        out = out.withColumn(f"lo_{AXES[a]}", F.greatest(F.lit(0).cast("bigint"), F.col(O[a]) - F.lit(int(r[a]))))
        out = out.withColumn(f"hi_{AXES[a]}", F.least(F.lit(int(dims[a]) - 1).cast("bigint"),
                                                     F.col(O[a]) + F.col(S[a]) - 1 + F.lit(int(r[a]))))
    return out


def expand_interval(grid: DataFrame, pad) -> DataFrame:
    """Per block, the interval grown by ``pad`` (not clamped)."""
    out = grid
    for a in range(3):
        out = out.withColumn(f"lo_{AXES[a]}", F.col(O[a]) - F.lit(int(pad[a])))
        out = out.withColumn(f"hi_{AXES[a]}", F.col(O[a]) + F.col(S[a]) - 1 + F.lit(int(pad[a])))
    return out


# ------------------------------------------------------------------ H8

def op_stencil(r):
    """Backward rule of a stencil/window op of radius ``r`` per axis."""
    r = [int(v) for v in r]
    return lambda lo, hi, a: (lo - F.lit(r[a]), hi + F.lit(r[a]))


def op_downsample2(ndims: int = 3):
    """Backward rule of the x2 half-pixel downsampling: ``[2lo, 2hi+1]``."""
    return lambda lo, hi, a: (lo * 2, hi * 2 + 1) if a < ndims else (lo, hi)


def source_ranges(grid: DataFrame, ops) -> DataFrame:
    """H8: per target block, the source interval a chain of ops reads.

    ``ops`` are applied last-to-first (the backward pass of a chain whose
    first element reads the source).
    """
    lo = [F.col(O[a]) for a in range(3)]
    hi = [F.col(O[a]) + F.col(S[a]) - 1 for a in range(3)]
    for op in reversed(ops):
        nxt = [op(lo[a], hi[a], a) for a in range(3)]
        lo = [n[0] for n in nxt]
        hi = [n[1] for n in nxt]
    return grid.select(*G, *O, *S, *[lo[a].cast("bigint").alias(f"src_lo_{AXES[a]}") for a in range(3)],
                       *[hi[a].cast("bigint").alias(f"src_hi_{AXES[a]}") for a in range(3)])
