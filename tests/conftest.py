import os
import sys

import numpy as np
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_spark
    s = get_spark("local[*]", 8, app_name="tessera-tests")
    yield s


def make_volume(spark, arr, dtype="uint16"):
    """Voxel volume from a numpy array with axes (z, y, x)."""
    from tessera.volume import Volume, VolumeMeta
    a = np.asarray(arr)
    if a.ndim == 2:
        a = a[None]
    zz, yy, xx = np.meshgrid(np.arange(a.shape[0]), np.arange(a.shape[1]), np.arange(a.shape[2]), indexing="ij")
    import pandas as pd
    pdf = pd.DataFrame({"x": xx.ravel().astype(np.int64), "y": yy.ravel().astype(np.int64),
                        "z": zz.ravel().astype(np.int64), "v": a.ravel()})
    vt = {"uint8": "smallint", "uint16": "int", "int32": "int", "int64": "bigint", "float32": "float",
          "float64": "double"}[dtype]
    pdf["v"] = pdf["v"].astype({"smallint": "int16", "int": "int32", "bigint": "int64", "float": "float32",
                                "double": "float64"}[vt])
    df = spark.createDataFrame(pdf, f"x bigint, y bigint, z bigint, v {vt}")
    return Volume(df, VolumeMeta((a.shape[2], a.shape[1], a.shape[0]), dtype))


def to_array(vol, fill=0.0):
    """Voxel volume -> numpy (z, y, x), absent voxels = fill."""
    pdf = vol.df.toPandas()
    nx, ny, nz = vol.dims
    mx, my, mz = vol.meta.min
    out = np.full((nz, ny, nx), fill, dtype=np.float64)
    out[pdf.z - mz, pdf.y - my, pdf.x - mx] = pdf.v.astype(np.float64)
    return out


@pytest.fixture
def mk(spark):
    return lambda arr, dtype="uint16": make_volume(spark, arr, dtype)
