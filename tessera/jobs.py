"""End-to-end jobs (J1-J5): the reference's workflows as Spark batch jobs.

Each job reads a chunked container (or any BlockVolume), runs distributed
operators and writes chunked output.  Run from the command line with
``python -m tessera.jobs <job> --key value ...`` (e.g. under spark-submit).
"""

from __future__ import annotations

import argparse
import math

import numpy as np

from pyspark.sql import SparkSession, functions as F

from .operators import blocks as B
from .operators import compare as CMP
from .operators import resample as RS
from .sources import chunked as CH
from .session import cut_lineage
from .volume import AXES, Volume


def radius_for_scale(scale_index: int, base: int = 1023) -> int:
    """``round(base * 2^-s)``."""
    return int(math.floor(base * math.pow(2.0, -scale_index) + 0.5))


def contrast_enhance(spark: SparkSession, n5url: str, n5dataset: str, n5outurl: str, n5outdataset: str,
                     scaleindex: int) -> None:
    """CLLCN (r from the scale level, k=3, limit 10, gamma 0.5, centre, stretch, keepMinMax),
    zero border, range 0..65535; output dataset created with the source attributes, empty blocks skipped."""
    src = CH.open_blocks(spark, n5url, n5dataset)
    r = radius_for_scale(scaleindex)
    out = B.cllcn(src, r, 3.0, 10.0, 0.5, True, True, True, "zero", 0.0, 65535.0)
    m = CH.read_meta(n5url, n5dataset)
    CH.save_blocks(out, n5outurl, n5outdataset, layout=m["layout"], codec=m["codec"], sep=m.get("sep", "."),
                   block=src.block, skip_empty=True, attrs=m.get("attrs"))


def clahe_gradients(spark: SparkSession, url: str, dataset: str, outurl: str, scaleindex: int,
                    block=(16, 16, 16)) -> dict:
    """CLAHE (radius from the scale level), convert to double, centre gradients along each axis with
    mirror-single borders; the datasets are written side by side (A11).  All in block form: the CLAHE
    result is checkpointed once (shared folder) and read by the gradient branches."""
    src = CH.open_blocks(spark, url, dataset)
    r = radius_for_scale(scaleindex)
    cl = B.clahe(src, r, out_dtype=src.dtype)
    cl = B.BlockVolume(cut_lineage(cl.df), cl.meta, cl.block)
    names = {}
    for d, a in enumerate(AXES[:cl.meta.ndim]):
        g = B.center_gradient(cl, d, "mirror_single")
        name = f"{dataset.rstrip('/')}-gradient-{a}"
        CH.save_blocks(g, outurl, name, "n5", "gzip", block=block)
        names[a] = name
    return names


def contrast_export(spark: SparkSession, url: str, dataset: str, outurl: str, block=(64, 64, 64)):
    """Contrast window to uint8 (pointwise on block payloads, no shuffle), saved as N5 and as Zarr
    ('/' separator), then compared block by block (A12)."""
    src = CH.open_blocks(spark, url, dataset)
    u8 = B.map_pointwise(src, lambda a: np.maximum(0.0, np.minimum(255.0, 255.0 - 255.0 * (a.astype(np.float64) - 26000.0)
                                                                   / 6000.0)), "uint8")
    CH.save_blocks(u8, outurl, "contrast-n5", "n5", "gzip", block=block, skip_empty=False)
    CH.save_blocks(u8, outurl, "contrast-zarr", "zarr", "gzip", "/", block=block, skip_empty=False)
    a = CH.open_blocks(spark, outurl, "contrast-n5")
    b = CH.open_blocks(spark, outurl, "contrast-zarr")
    return CMP.compare_blocks(a, b)


def smooth_cells(spark: SparkSession, url: str, dataset: str, sigma: float = 3.0, cell: int = 32):
    """Mirror-double border, float, Gaussian sigma, result in cells of ``cell``; cut, smoothed and put into cells in one exchange."""
    src = CH.open_blocks(spark, url, dataset)
    cells = B.retile(src.chain(), tuple(cell if n > 1 else 1 for n in src.dims))
    return B.gauss(cells, (sigma,) * 3, "mirror_double", out_dtype="float32")


def view_plane(spark: SparkSession, url: str, dataset: str, size=(512, 512, 1), target_block=None) -> Volume:
    """Mirror-double, float, x2 downsampling, affine (rotate z 0.3, y 0.1, x 0.6; scale 0.9),
    n-linear, back to uint8, on the plane ``[0, size)``.  Block form throughout."""
    src = CH.open_blocks(spark, url, dataset)
    if any(b % 2 for b, n in zip(src.block, src.dims) if n > 1):
        src = src.chain()  # blocks of an odd size are halved in an exchange
    ds = B.downsample2(src, "float64")
    t = RS.affine_identity()
    for axis, ang in ((2, 0.3), (1, 0.1), (0, 0.6)):
        t = RS.rotate(t, axis, ang)
    t = RS.scale(t, 0.9)
    tb = target_block or tuple(min(64, s) for s in size)
    plane = B.affine(ds, t, (0, 0, 0), size, tb, "mirror_double", "uint8")
    return B.to_voxels(plane)


def main(argv=None):
    p = argparse.ArgumentParser(prog="tessera.jobs")
    p.add_argument("job", choices=["contrast-enhance", "clahe-gradients", "contrast-export",
                                   "smooth-cells", "view-plane", "pyramid"])
    p.add_argument("--n5url", "-i", required=True)
    p.add_argument("--n5dataset", "-d", required=True)
    p.add_argument("--n5outurl", "-o")
    p.add_argument("--n5outdataset", "-e")
    p.add_argument("--scaleindex", "-s", type=int, default=0)
    p.add_argument("--levels", "-l", type=int, default=3)
    p.add_argument("--size", type=int, nargs=3, default=(512, 512, 1))
    a = p.parse_args(argv)
    from .session import get_spark
    spark = get_spark()
    if a.job == "contrast-enhance":
        contrast_enhance(spark, a.n5url, a.n5dataset, a.n5outurl or a.n5url, a.n5outdataset, a.scaleindex)
    elif a.job == "clahe-gradients":
        print(clahe_gradients(spark, a.n5url, a.n5dataset, a.n5outurl or a.n5url, a.scaleindex))
    elif a.job == "contrast-export":
        contrast_export(spark, a.n5url, a.n5dataset, a.n5outurl or a.n5url).show()
    elif a.job == "smooth-cells":
        out = smooth_cells(spark, a.n5url, a.n5dataset)
        CH.save_blocks(out, a.n5outurl or a.n5url, a.n5outdataset or f"{a.n5dataset.rstrip('/')}-smooth", "n5", "gzip")
    elif a.job == "view-plane":
        tile = tuple(min(64, s) for s in a.size)
        out = B.from_voxels(view_plane(spark, a.n5url, a.n5dataset, tuple(a.size), tile), tile)
        CH.save_blocks(out, a.n5outurl or a.n5url, a.n5outdataset or f"{a.n5dataset.rstrip('/')}-plane", "n5", "gzip")
    else:
        print(write_pyramid(spark, a.n5url, a.n5dataset, a.levels, a.n5outurl, a.n5outdataset))


def write_pyramid(spark: SparkSession, url: str, dataset: str, levels: int, outurl: str | None = None,
                  group: str | None = None) -> list[str]:
    """H6 as a job: x2 downsampling again and again (rounded to the type at each level), all levels from one read of the
    source and written in one job, each as its own dataset ``<group>/s<k>`` in the source's block size."""
    outurl = outurl or url
    group = group or dataset.rsplit("/", 1)[0]
    src = CH.open_blocks(spark, url, dataset)
    rows, metas = B.pyramid(src, levels)
    names = [f"{group}/s{k}" for k in range(1, levels + 1)]
    CH.save_many(rows.withColumn("dataset", F.concat(F.lit(f"{group}/s"), F.col("level").cast("string"))), outurl,
                 {name: (meta, src.block) for name, meta in zip(names, metas)}, "n5", "gzip")
    return names


if __name__ == "__main__":
    main()
