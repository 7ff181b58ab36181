"""Driver contract: entry() smoke, registry shape, and a representative set of
queries against their DuckDB oracles on the smallest scale."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracles import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
NO_ORACLE = set()

SUBSET = ["cllcn", "cllcn_blocks", "box_stats", "lcn", "clahe", "block_grid", "radius_by_scale", "crop",
          "extend_mirror_single", "extend_zero", "contrast_window", "vol_add", "vol_div", "vol_max",
          "gradient_center_rai", "hessian_2d", "tubeness_2d", "gauss", "dog_blocks", "downsample", "pyramid",
          "affine_2d", "retile_roundtrip", "nonempty_blocks", "chunk_roundtrip_zarr", "job_contrast_enhance",
          "pair", "vol_sub", "copy_into"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert [f.name for f in df.schema.fields] == ["x", "y", "z", "v"]
    assert df.count() > 0


def test_registry_has_oracles():
    from tessera.catalog import ORACLES, QUERIES
    assert set(E.oracle_sql()) <= set(E.queries()) and set(QUERIES) <= set(E.queries())
    assert set(QUERIES) - set(ORACLES) == NO_ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF)


SPARK_TO_DUCK = {"LongType": "BIGINT", "IntegerType": "INTEGER", "ShortType": "SMALLINT", "DoubleType": "DOUBLE",
                 "FloatType": "FLOAT", "StringType": "VARCHAR"}


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    spark_types = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__) for f in df.schema.fields}
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert spark_types == duck_types
    res = compare(df.toPandas(), rel.df())
    assert res["cols_match"] and res["match"], res


def test_tubeness_3d_query_matches_numpy(spark):
    """The one query without a SQL oracle: brute-force check against numpy on the same Hessian."""
    import numpy as np
    from tessera.operators import stencil as S
    from tessera.sources import fixtures as fx
    h = S.hessian(fx.lineitem_counts(spark, SF), (1.0, 1.0, 1.0), "zero").toPandas().sort_values(["x", "y", "z"])
    m = np.empty((len(h), 3, 3))
    for d in range(3):
        for e in range(d, 3):
            m[:, d, e] = m[:, e, d] = h[f"h{d}{e}"].to_numpy()
    want = np.round(S.tubeness_values(np.linalg.eigvalsh(m)), 6)
    got = E.queries()["tubeness_3d"](spark, SF).toPandas().sort_values(["x", "y", "z"])
    assert len(got) == len(want)
    assert np.allclose(got.v.to_numpy(), want, atol=2e-6)
