"""Same-data check across containers.

Voxel form: one full outer join on coordinates (absent = 0) and one global
aggregate.  Block form: a join of digests on grid keys of equally blocked
volumes; numpy compares the payloads of those that differ; one global aggregate.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..volume import AXES, Volume, dtype_of


def compare_volumes(a: Volume, b: Volume) -> DataFrame:
    """Counts of voxels only in a, only in b, in both, differing, and the max |a-b|."""
    l = a.df.select(*AXES, F.col("v").alias("va"))
    r = b.df.select(*AXES, F.col("v").alias("vb"))
    j = l.join(r, list(AXES), "full_outer")
    # compared in the native types (their common type); only the size of a difference is a double
    va, vb = (F.coalesce(c, F.lit(0).cast(j.schema[c].dataType)) for c in ("va", "vb"))
    differs = ~va.eqNullSafe(vb)
    size = F.abs(F.try_subtract(va, vb).cast("double"))
    diff = F.when(differs, F.coalesce(size, F.abs(va.cast("double") - vb.cast("double")))).otherwise(F.lit(0.0))
    return j.agg(
        F.count_if(F.col("vb").isNull()).cast("bigint").alias("only_a"),
        F.count_if(F.col("va").isNull()).cast("bigint").alias("only_b"),
        F.count_if(F.col("va").isNotNull() & F.col("vb").isNotNull()).cast("bigint").alias("both"),
        F.count_if(differs).cast("bigint").alias("n_diff"),
        F.coalesce(F.max(diff), F.lit(0.0)).alias("max_abs_diff"))


# Keys of differing blocks up to this many are broadcast (24 bytes each); beyond it they are joined by shuffle.
MAX_BROADCAST_KEYS = 1_000_000


def differing_blocks(a, b) -> tuple[DataFrame, DataFrame]:
    """(grid positions where a block is stored in a or b, those whose bytes differ), from SHA-256 digests: no payload moves.

    An absent block is all zero.  Volumes of different types differ wherever a sample is not zero.
    """
    from ..session import cut_lineage

    def digests(v, name):
        zero = F.expr("unhex(repeat('00', octet_length(payload)))")
        digest = F.when(F.col("payload") == zero, F.lit(None)).otherwise(F.sha2("payload", 256))
        return v.df.select("gx", "gy", "gz", digest.alias(name))
    found = cut_lineage(digests(a, "da").join(digests(b, "db"), ["gx", "gy", "gz"], "full_outer"))
    same = F.col("da").eqNullSafe(F.col("db"))
    if a.dtype != b.dtype:
        same = F.col("da").isNull() & F.col("db").isNull()
    return found.select("gx", "gy", "gz"), found.where(~same).select("gx", "gy", "gz")


def compare_blocks(a, b) -> DataFrame:
    """A12 in block form: ``n_blocks, n_diff_voxels, max_abs_diff`` over the union of stored blocks.

    Digests are joined first; payloads are only shuffled for blocks whose digests differ.
    """
    from .blockops import aligned
    if not aligned(a, b):
        raise ValueError("block comparison needs equal intervals and blocks; bring one side onto the other's first (on_interval)")
    keys = ["gx", "gy", "gz"]
    everywhere, differ = differing_blocks(a, b)
    few = differ.limit(MAX_BROADCAST_KEYS + 1).count() <= MAX_BROADCAST_KEYS
    only = lambda v: v.df.join(F.broadcast(differ) if few else differ, keys, "left_semi")
    l = only(a).select(*keys, "sx", "sy", "sz", F.col("payload").alias("pa"))
    r = only(b).select(*keys, F.col("sx").alias("sx_b"), F.col("sy").alias("sy_b"), F.col("sz").alias("sz_b"),
                       F.col("payload").alias("pb"))
    j = l.join(r, keys, "full_outer")
    da, db = np.dtype(dtype_of(a.meta.dtype).numpy), np.dtype(dtype_of(b.meta.dtype).numpy)

    def diff(it):
        for pdf in it:
            nd, mx = [], []
            for row in pdf.itertuples(index=False):
                sx = row.sx if not pd.isna(row.sx) else row.sx_b
                sy = row.sy if not pd.isna(row.sy) else row.sy_b
                sz = row.sz if not pd.isna(row.sz) else row.sz_b
                n = int(sx) * int(sy) * int(sz)
                va = np.frombuffer(row.pa, dtype=da) if row.pa is not None else np.zeros(n, da)
                vb = np.frombuffer(row.pb, dtype=db) if row.pb is not None else np.zeros(n, db)
                same = (va == vb) | ((va != va) & (vb != vb))  # in the native types; NaN equals NaN
                x, y = va[~same], vb[~same]
                size = np.abs(x.astype(np.float64) - y.astype(np.float64))
                if x.dtype.kind in "iu" and y.dtype.kind in "iu":  # large integers differ by less than a double shows
                    size = np.maximum(size, 1.0)
                nd.append(len(x))
                mx.append(float(size.max()) if len(size) else 0.0)
            yield pd.DataFrame({"nd": nd, "mx": mx})

    per = j.mapInPandas(diff, "nd bigint, mx double")
    stored = everywhere.select(F.lit(1).alias("n"), F.lit(0).cast("long").alias("nd"), F.lit(0.0).alias("mx"))
    return stored.unionAll(per.select(F.lit(0).alias("n"), "nd", "mx")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_blocks"), F.coalesce(F.sum("nd"), F.lit(0)).alias("n_diff_voxels"),
        F.coalesce(F.max("mx"), F.lit(0.0)).alias("max_abs_diff"))
