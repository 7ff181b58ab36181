"""The data model: a volume is a DataFrame of voxels plus its metadata.

Voxel form (the SQL form)::

    x BIGINT, y BIGINT, z BIGINT, v <numeric>      -- 2-D volumes use z = 0

An absent voxel inside ``dims`` reads as 0.  The block form (the scale form)
lives in :mod:`tessera.operators.blocks`; both carry the same ``VolumeMeta``.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Callable

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

AXES = ("x", "y", "z")


@dataclass(frozen=True)
class DType:
    name: str
    numpy: str           # little-endian numpy dtype of block payloads
    spark: T.DataType    # column type in voxel form
    lo: float            # saturation range on conversion (P2)
    hi: float
    integer: bool


# The sample types of the container formats and their ranges; unsigned types are held in the next wider Spark type.
DTYPES = {
    "uint8": DType("uint8", "<u1", T.ShortType(), 0, 255, True),
    "int8": DType("int8", "<i1", T.ByteType(), -128, 127, True),
    "uint16": DType("uint16", "<u2", T.IntegerType(), 0, 65535, True),
    "int16": DType("int16", "<i2", T.ShortType(), -32768, 32767, True),
    "uint32": DType("uint32", "<u4", T.LongType(), 0, 4294967295, True),
    "int32": DType("int32", "<i4", T.IntegerType(), -2147483648, 2147483647, True),
    "uint64": DType("uint64", "<u8", T.DecimalType(20, 0), 0, 18446744073709551615, True),
    "int64": DType("int64", "<i8", T.LongType(), -9223372036854775808, 9223372036854775807, True),
    "float32": DType("float32", "<f4", T.FloatType(), -3.4028234663852886e38, 3.4028234663852886e38, False),
    "float64": DType("float64", "<f8", T.DoubleType(), -np.inf, np.inf, False),
}


def dtype_of(name: str) -> DType:
    try:
        return DTYPES[name]
    except KeyError:
        raise ValueError(f"unsupported voxel type {name!r}; supported: {sorted(DTYPES)}") from None


@dataclass(frozen=True)
class VolumeMeta:
    """Interval and type of a volume: ``min`` inclusive, ``dims`` sizes."""

    dims: tuple[int, int, int]
    dtype: str = "float64"
    min: tuple[int, int, int] = (0, 0, 0)
    attrs: dict = field(default_factory=dict, compare=False)
    # every voxel inside dims has a row (set by densify and by dense sources)
    dense: bool = False
    # number of axes of a stored dataset; None: 3 if the third axis is longer than 1, else 2
    rank: int | None = None

    @property
    def ndim(self) -> int:
        """Axes that operators work on: a third axis of size 1 has no neighbours."""
        return 3 if self.dims[2] > 1 else 2

    @property
    def stored_rank(self) -> int:
        return self.rank or self.ndim

    @property
    def max(self) -> tuple[int, int, int]:
        return tuple(m + d - 1 for m, d in zip(self.min, self.dims))

    @property
    def num_elements(self) -> int:
        return int(np.prod(self.dims))


def spanning(metas: list["VolumeMeta"]) -> "VolumeMeta":
    """The first one's metadata on the smallest interval that holds all of them."""
    lo = tuple(min(m.min[d] for m in metas) for d in range(3))
    hi = tuple(max(m.max[d] for m in metas) for d in range(3))
    return replace(metas[0], min=lo, dims=tuple(h - l + 1 for l, h in zip(lo, hi)), dense=False)


@dataclass(frozen=True)
class Volume:
    """A voxel DataFrame with its metadata; operators return new Volumes."""

    df: DataFrame
    meta: VolumeMeta

    @property
    def dims(self):
        return self.meta.dims

    @property
    def dtype(self):
        return self.meta.dtype

    def with_df(self, df: DataFrame, **meta_changes) -> "Volume":
        return Volume(df, replace(self.meta, **meta_changes) if meta_changes else self.meta)

    def then(self, op: Callable[["Volume"], "Volume"], *, expect_dtype: str | None = None,
             expect_ndim: int | None = None) -> "Volume":
        """Chain an operator (H9), checking type and dimensionality first."""
        if expect_dtype is not None and self.dtype != expect_dtype:
            raise TypeError(f"operator expects {expect_dtype}, volume is {self.dtype}")
        if expect_ndim is not None and self.meta.ndim != expect_ndim:
            raise ValueError(f"operator expects {expect_ndim}-D input, volume is {self.meta.ndim}-D")
        return op(self)


def idiv(c, k: int):
    """Floor division of an integer column by a positive constant (BIGINT).

    Computed through a double quotient: exact for |c| < 2^52, far beyond any
    coordinate or block id.
    """
    return F.floor(c / F.lit(int(k))).cast("bigint")
