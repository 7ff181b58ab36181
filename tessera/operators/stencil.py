"""Stencils (F1-F7): gradients, Hessian, tubeness.

Voxel form.  Neighbours along an axis come from one-row RANGE frames
(``rangeBetween(1, 1)`` / ``(-1, -1)``): a gap in sparse rows yields NULL
(= absent = 0) instead of bridging to the next row as ``lead``/``lag`` would.
All frames over one axis share a window spec, so each axis costs one hash
exchange on the other two coordinates.  Values are computed in double (the
reference's gradient job converts to double first).

Border rule for the +-1 neighbours (x in [0, n)):

* ``zero``: outside reads 0;
* ``mirror_single``: s(-1) = s(1), s(n) = s(n-2);
* ``mirror_double``: s(-1) = s(0), s(n) = s(n-1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..volume import AXES, Volume, VolumeMeta
from .coords import densify

# Eigenvalues of 3x3 matrices run in numpy over Arrow batches (mapInPandas).


def _w(axis: str) -> Window:
    others = [a for a in AXES if a != axis]
    return Window.partitionBy(*others).orderBy(axis)


def neighbours(df: DataFrame, col: str, axis: str, n: int, lo: int, extension: str) -> tuple[Column, Column]:
    """Columns for ``col`` at axis-1 and axis+1 under the extension rule."""
    w = _w(axis)
    prev_ = F.coalesce(F.first(col).over(w.rangeBetween(-1, -1)), F.lit(0.0))
    next_ = F.coalesce(F.first(col).over(w.rangeBetween(1, 1)), F.lit(0.0))
    here = F.col(col)
    first = F.col(axis) == F.lit(lo)
    last = F.col(axis) == F.lit(lo + n - 1)
    if extension == "zero":
        return prev_, next_
    if extension == "mirror_single":
        if n == 1:
            return here, here
        return F.when(first, next_).otherwise(prev_), F.when(last, prev_).otherwise(next_)
    if extension == "mirror_double":
        return F.when(first, here).otherwise(prev_), F.when(last, here).otherwise(next_)
    raise ValueError(extension)


def _prep(vol: Volume, dense: bool) -> DataFrame:
    v = vol if (dense or vol.meta.dense) else densify(vol)
    return v.df.select(*AXES, F.col("v").cast("double").alias("v"))


def center_gradient(vol: Volume, axis: int, extension: str = "zero", sigma: float | None = None,
                    dense: bool = False) -> Volume:
    """F1 (sigma None: ``0.5*(s(x+1)-s(x-1))``), F2 (``mirror_single``), F4 (``*2/sigma``)."""
    a = AXES[axis]
    df = _prep(vol, dense)
    prev_, next_ = neighbours(df, "v", a, vol.dims[axis], vol.meta.min[axis], extension)
    norm = 0.5 if sigma is None else 2.0 / sigma
    return Volume(df.select(*AXES, ((next_ - prev_) * F.lit(norm)).alias("v")),
                  VolumeMeta(vol.dims, "float64", vol.meta.min))


def gradient_forward(vol: Volume, axis: int, extension: str = "zero", dense: bool = False) -> Volume:
    """``s(x+1) - s(x)``; the last sample follows the extension."""
    a = AXES[axis]
    df = _prep(vol, dense)
    _, next_ = neighbours(df, "v", a, vol.dims[axis], vol.meta.min[axis], extension)
    return Volume(df.select(*AXES, (next_ - F.col("v")).alias("v")), VolumeMeta(vol.dims, "float64", vol.meta.min))


def gradient_magnitude(vol: Volume, sigma, extension: str = "zero", dense: bool = False) -> Volume:
    """``sqrt(sum_d ((s(x+e_d) - s(x-e_d)) * 2/sigma_d)^2)`` over the volume's axes."""
    df = _prep(vol, dense)
    nd = vol.meta.ndim
    sq = None
    for d in range(nd):
        prev_, next_ = neighbours(df, "v", AXES[d], vol.dims[d], vol.meta.min[d], extension)
        g = (next_ - prev_) * F.lit(2.0 / sigma[d])
        df = df.withColumn(f"g{d}", g)
    for d in range(nd):
        t = F.col(f"g{d}") * F.col(f"g{d}")
        sq = t if sq is None else sq + t
    return Volume(df.select(*AXES, F.sqrt(sq).alias("v")), VolumeMeta(vol.dims, "float64", vol.meta.min))


def hessian(vol: Volume, sigma, extension: str = "zero", dense: bool = False) -> DataFrame:
    """gradients ``g_e`` (F4), then ``H_de = (g_e(x+e_d) - g_e(x-e_d)) * 2/sigma_e`` for e >= d.

    Gradients are evaluated one sample beyond the volume on the extended image
    (padded by two samples), so the Hessian at the border reads true gradients.
    Returns ``x, y, z, h00, h01, h11 [, h02, h12, h22]``.
    """
    from .coords import extend
    nd = vol.meta.ndim
    pad = tuple(2 if d < nd else 0 for d in range(3))
    big = extend(vol, pad, extension)
    big = big if extension != "zero" else densify(big)
    df = big.df.select(*AXES, F.col("v").cast("double").alias("v"))
    for e in range(nd):
        # on the padded grid the outermost samples have one neighbour missing; they are cropped below
        prev_, next_ = neighbours(df, "v", AXES[e], big.dims[e], big.meta.min[e], "zero")
        df = df.withColumn(f"g{e}", (next_ - prev_) * F.lit(2.0 / sigma[e]))
    lo, hi = vol.meta.min, vol.meta.max
    df = df.select(*AXES, *[f"g{e}" for e in range(nd)])
    cols = []
    for d in range(nd):
        for e in range(d, nd):
            prev_, next_ = neighbours(df, f"g{e}", AXES[d], big.dims[d], big.meta.min[d], "zero")
            df = df.withColumn(f"h{d}{e}", (next_ - prev_) * F.lit(2.0 / sigma[e]))
            cols.append(f"h{d}{e}")
    keep = F.lit(True)
    for d in range(3):
        keep = keep & F.col(AXES[d]).between(lo[d], hi[d])
    return df.filter(keep).select(*AXES, *cols)


def tubeness_2d_expr(h00: Column, h01: Column, h11: Column) -> Column:
    """F7 for n = 2 in closed form: with |l0| <= |l1|, ``l1 < 0 -> |l1| - |l0|``,
    ``l1 > 0 -> -(l1 - |l0|)``, else 0 (the reference's rule reduced to n = 2)."""
    m = (h00 + h11) / 2.0
    dd = F.sqrt(((h00 - h11) / 2.0) * ((h00 - h11) / 2.0) + h01 * h01)
    la, lb = m - dd, m + dd
    l1 = F.when(F.abs(la) > F.abs(lb), la).otherwise(lb)
    l0 = F.when(F.abs(la) > F.abs(lb), lb).otherwise(la)
    return (F.when(l1 < 0, (-l1 - F.abs(l0)))
            .when(l1 > 0, -(l1 - F.abs(l0)))
            .otherwise(F.lit(0.0)))


def tubeness_2d_values(h00, h01, h11):
    """``tubeness_2d_expr`` on arrays."""
    import numpy as np
    m = (h00 + h11) / 2.0
    dd = np.sqrt(((h00 - h11) / 2.0) * ((h00 - h11) / 2.0) + h01 * h01)
    la, lb = m - dd, m + dd
    l1 = np.where(np.abs(la) > np.abs(lb), la, lb)
    l0 = np.where(np.abs(la) > np.abs(lb), lb, la)
    return np.where(l1 < 0, -l1 - np.abs(l0), np.where(l1 > 0, -(l1 - np.abs(l0)), 0.0))


def tubeness_values(ev):
    """F7 rule on eigenvalues ``ev`` (rows x n), numpy; sorted by |l| ascending inside."""
    import numpy as np
    ev = np.take_along_axis(ev, np.argsort(np.abs(ev), axis=1, kind="stable"), axis=1)
    n = ev.shape[1]
    top = ev[:, n - 1]
    out = np.zeros(len(ev))
    neg = top < 0
    for sign, mask in ((-1.0, neg), (1.0, ~neg)):
        e = ev[mask] * sign  # make the wanted sign positive
        prod = e[:, n - 1].copy()
        ok = np.ones(len(e), dtype=bool)
        for d in range(n - 2, 1, -1):
            ok &= e[:, d] > 0
            prod *= np.where(e[:, d] > 0, e[:, d], 1.0)
        ok &= e[:, 1] > 0
        prod *= (e[:, 1] - np.abs(e[:, 0]))
        with np.errstate(invalid="ignore", divide="ignore"):
            val = np.power(prod, 1.0 / (n - 1)) / -ev[mask][:, n - 1]
        out[mask] = np.where(ok, val, 0.0)
    return out


def tubeness(vol: Volume, sigma, extension: str = "zero", dense: bool = False) -> Volume:
    """tubeness from the Hessian.  2-D: closed-form columns.  3-D:
    eigenvalues with ``numpy.linalg.eigvalsh`` over Arrow batches."""
    h = hessian(vol, sigma, extension, dense)
    if vol.meta.ndim == 2:
        df = h.select(*AXES, tubeness_2d_expr(F.col("h00"), F.col("h01"), F.col("h11")).alias("v"))
        return Volume(df, VolumeMeta(vol.dims, "float64", vol.meta.min))

    def fn(it):
        import numpy as np
        for pdf in it:
            m = np.empty((len(pdf), 3, 3))
            for d in range(3):
                for e in range(d, 3):
                    m[:, d, e] = m[:, e, d] = pdf[f"h{d}{e}"].to_numpy()
            ev = np.linalg.eigvalsh(m)
            yield pdf[["x", "y", "z"]].assign(v=tubeness_values(ev))

    df = h.mapInPandas(fn, "x bigint, y bigint, z bigint, v double")
    return Volume(df, VolumeMeta(vol.dims, "float64", vol.meta.min))
