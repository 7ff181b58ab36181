"""Parquet blocks and voxels (A13): the columnar store Spark prunes natively.

Blocks are dealt to files and sorted by the Morton code of their grid position (the bits of gx, gy and gz in turn),
so a row group holds a compact box of the grid and a crop along any axis reads few of them: min/max
statistics of ``gx``, ``gy`` and ``gz`` skip the rest.  Voxels are laid out the same way, by the Morton code of cells of ``cell``
samples, and raster order inside a cell.  Datasets are folders (``dataset=...``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.blocks import BlockVolume
from ..volume import AXES, Volume, idiv

# Shifts and masks that spread 21 bits to every third place.
SPREAD = [(32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)]


def morton(x: Column, y: Column, z: Column) -> Column:
    """The bits of three grid positions (21 each) in turn, x lowest."""
    def spread(c: Column) -> Column:
        c = c.cast("long").bitwiseAND(F.lit(0x1FFFFF))
        for shift, mask in SPREAD:
            c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask))
        return c
    return spread(x).bitwiseOR(F.shiftleft(spread(y), 1)).bitwiseOR(F.shiftleft(spread(z), 2))


def _write(df: DataFrame, code: Column, path: str, dataset: str, mode: str, order: list[str], row_group_bytes: int) -> None:
    (df.withColumn("dataset", F.lit(dataset)).withColumn("_code", code)
     .repartitionByRange("dataset", "_code").sortWithinPartitions("dataset", "_code", *order).drop("_code")
     .write.mode(mode).option("parquet.block.size", str(row_group_bytes)).partitionBy("dataset").parquet(path))


def write_blocks(bv: BlockVolume, path: str, dataset: str, mode: str = "append", row_group_bytes: int = 128 << 20) -> None:
    _write(bv.df, morton(F.col("gx"), F.col("gy"), F.col("gz")), path, dataset, mode, [], row_group_bytes)


def read_blocks(spark: SparkSession, path: str, dataset: str, meta, block) -> BlockVolume:
    df = spark.read.parquet(path).filter(F.col("dataset") == dataset).drop("dataset")
    return BlockVolume(df.select("gx", "gy", "gz", "ox", "oy", "oz", "sx", "sy", "sz", "payload"), meta, tuple(block))


def write_voxels(vol: Volume, path: str, dataset: str, mode: str = "append", cell: int = 64, row_group_bytes: int = 128 << 20) -> None:
    code = morton(*[idiv(F.col(a) - F.lit(int(m)), cell) for a, m in zip(AXES, vol.meta.min)])
    _write(vol.df.select(*AXES, "v"), code, path, dataset, mode, ["z", "y", "x"], row_group_bytes)


def read_voxels(spark: SparkSession, path: str, dataset: str, meta) -> Volume:
    df = spark.read.parquet(path).filter(F.col("dataset") == dataset).select("x", "y", "z", "v")
    return Volume(df, meta)
