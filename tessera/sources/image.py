"""2-D image files (A6) through Spark's built-in ``image`` source.

Spark decodes with the JVM's ImageIO; an 8-bit grey image arrives as
``width, height, nChannels = 1`` and row-major bytes (x fastest).  Each image
becomes voxels ``x, y, z = 0, v`` (unsigned 8 bit) plus its origin path.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..volume import Volume, VolumeMeta


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Voxels of every image under ``path``: ``origin, x, y, z, v``; colour images have a plane per channel on z."""
    img = spark.read.format("image").load(path).select(
        F.col("image.origin").alias("origin"), F.col("image.width").alias("w"), F.col("image.height").alias("h"),
        F.col("image.nChannels").alias("c"), F.col("image.data").alias("data"))

    def unravel(it):
        for pdf in it:
            for row in pdf.itertuples(index=False):
                a = np.frombuffer(row.data, dtype=np.uint8).reshape(row.h, row.w, row.c).transpose(2, 0, 1)
                zz, yy, xx = np.mgrid[0:row.c, 0:row.h, 0:row.w]
                yield pd.DataFrame({"origin": row.origin, "x": xx.ravel().astype(np.int64),
                                    "y": yy.ravel().astype(np.int64), "z": zz.ravel().astype(np.int64),
                                    "v": a.ravel().astype(np.int16)})

    return img.mapInPandas(unravel, "origin string, x bigint, y bigint, z bigint, v smallint")


def read_image(spark: SparkSession, path: str) -> Volume:
    """One image file as a uint8 volume (dims read from the image header)."""
    df = read_images(spark, path)
    found = spark.read.format("image").load(path).select("image.width", "image.height", "image.nChannels").limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"{path} holds {'several images' if found else 'no image'}; use read_images")
    r = found[0]
    return Volume(df.drop("origin"), VolumeMeta((int(r["width"]), int(r["height"]), int(r["nChannels"])), "uint8"))


def _png_gray8(a: np.ndarray) -> bytes:
    """Minimal 8-bit greyscale PNG (zlib + CRC from the standard library)."""
    import struct
    import zlib
    h, w = a.shape
    raw = b"".join(b"\x00" + a[y].tobytes() for y in range(h))

    def chunk(t, d):
        return struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d) & 0xffffffff)

    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def write_png_tiles(bv, folder: str) -> None:
    """Each 2-D uint8 block becomes ``tile_<ox>_<oy>.png``, written by the task that holds it."""
    import os

    def write(it):
        for pdf in it:
            for row in pdf.itertuples(index=False):
                a = np.frombuffer(row.payload, dtype=np.uint8).reshape(row.sy, row.sx)
                path = os.path.join(folder, f"tile_{row.ox}_{row.oy}.png")
                tmp = path + ".tmp"
                with open(tmp, "wb") as f:
                    f.write(_png_gray8(a))
                os.replace(tmp, path)
            yield pd.DataFrame({"n": [len(pdf)]})

    # the files are the output: run the write through the noop sink, nothing returns to the driver
    bv.df.filter(F.col("sz") == 1).mapInPandas(write, "n long").write.format("noop").mode("overwrite").save()


def read_png_tiles(spark: SparkSession, folder: str) -> DataFrame:
    """Voxels of all tiles, placed at the offsets in their file names."""
    vox = read_images(spark, folder)
    off = F.regexp_extract("origin", r"tile_(\d+)_(\d+)\.png$", 1).cast("bigint")
    offy = F.regexp_extract("origin", r"tile_(\d+)_(\d+)\.png$", 2).cast("bigint")
    return vox.select((F.col("x") + off).alias("x"), (F.col("y") + offy).alias("y"), "z", "v")
