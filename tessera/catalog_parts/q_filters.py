"""F8-F10 (Gaussian, DoG, separable convolution) and H4-H7 (downsampling, pyramid, affine)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from .. import sqlcheck as q
from ..catalog import register
from ..functions.pointwise import invert
from ..operators import convolve as CV
from ..operators import resample as RS
from ..sources import fixtures as fx
from ..volume import Volume

I64 = (-9223372036854774784, 9223372036854774784)


def _kernel_values(half, name: str = "k") -> str:
    """A kernel table (k, w): given numbers, or for a sigma the normalised Gaussian computed in SQL."""
    if isinstance(half, float):
        n = max(2, int(3.0 * half + 0.5) + 1)
        w = lambda i: f"exp(-(CAST({i} AS DOUBLE) * {i}) / {q.lit(2.0 * half * half)})"
        return (f"{name} AS (SELECT k, {w('k')} / (SELECT SUM({w('j')}) FROM range({1 - n}, {n}) s(j)) AS w "
                f"FROM range({1 - n}, {n}) t(k))")
    rows = [f"({i}, {q.lit(float(half[abs(i)]))})" for i in range(-(len(half) - 1), len(half))]
    return f"{name} AS (SELECT * FROM (VALUES {', '.join(rows)}) t(k, w))"


def _sep_sql(src: str, halves: list, out: str, extension: str, dims: str, vcol: str = "v") -> list[str]:
    """CTEs applying one kernel per axis (x, y, then z) by joining a kernel table."""
    ctes, cur = [], src
    for d, half in enumerate(halves):
        a = "xyz"[d]
        kn = f"{out}_k{d}"
        ctes.append(_kernel_values(half, kn))
        n = f"(SELECT n{a} FROM {dims})"
        if extension == "zero":
            cond = f"s.{a} = t.{a} + {kn}.k"
        else:
            fn = q.mirror_single if extension == "mirror_single" else q.mirror_double
            cond = f"s.{a} = {fn(f't.{a} + {kn}.k', n)}"
        same = " AND ".join(f"s.{o} = t.{o}" for o in "xyz" if o != a)
        nxt = f"{out}_{d}"
        ctes.append(f"""{nxt} AS (SELECT t.x, t.y, t.z, SUM({kn}.w * s.{vcol}) AS {vcol} FROM {cur} t CROSS JOIN {kn}
  JOIN {cur} s ON {cond} AND {same} GROUP BY t.x, t.y, t.z)""")
        cur = nxt
    return ctes, cur


def _gauss_sql():
    half = 2.0
    ctes, last = _sep_sql("v2", [half, half], "g", "zero", "v2dims")
    return (q.with_(q.V2, q.V2DIMS, *ctes)
            + f"SELECT x, y, z, {q.to_int('v', 0, 65535, 'INTEGER')} AS v FROM {last}")


@register("gauss", _gauss_sql())
def gauss(spark, sf_dir):
    """F8: separable Gaussian sigma = 2 (P4 kernel, 7 taps each side), zero border, result as uint16."""
    return CV.gauss(fx.embedding_u16(spark, sf_dir), (2.0, 2.0, 0.0), "zero", out_dtype="uint16", dense=True).df


def _gauss_mirror_sql():
    half = 1.5
    ctes, last = _sep_sql("v2", [half, half], "g", "mirror_double", "v2dims")
    return (q.with_(q.V2, q.V2DIMS, *ctes)
            + f"SELECT x, y, z, {q.to_int('v', 0, 65535, 'INTEGER')} AS v FROM {last}")


@register("gauss_mirror", _gauss_mirror_sql())
def gauss_mirror(spark, sf_dir):
    """F8 with the mirror-double border used by the smoothing chain (sigma = 1.5)."""
    return CV.gauss(fx.embedding_u16(spark, sf_dir), (1.5, 1.5, 0.0), "mirror_double", out_dtype="uint16", dense=True).df


def _dog_sql():
    inv = "inv AS (SELECT x, y, z, CAST(CAST(65535.0 - CAST(v AS DOUBLE) AS FLOAT) AS DOUBLE) AS v FROM v2)"
    h4, h3 = 4.0, 3.0
    c1, l1 = _sep_sql("inv", [h4, h4], "a", "mirror_single", "v2dims")
    c2, l2 = _sep_sql("inv", [h3, h3], "b", "mirror_single", "v2dims")
    return (q.with_(q.V2, q.V2DIMS, inv, *c1, *c2)
            + f"SELECT {l1}.x, {l1}.y, {l1}.z, round({l1}.v - {l2}.v, 3) AS v FROM {l1} JOIN {l2} USING (x, y, z)"
            .replace(f"SELECT {l1}.x, {l1}.y, {l1}.z", "SELECT x, y, z"))


@register("dog", _dog_sql())
def dog(spark, sf_dir):
    """difference of Gaussians sigma 4 - sigma 3 on the inverted float image, mirror-single border."""
    v = fx.embedding_u16(spark, sf_dir)
    inv = Volume(v.df.select("x", "y", "z", invert("v").alias("v")), v.meta)
    d = CV.dog(inv, (4.0, 4.0, 0.0), (3.0, 3.0, 0.0), "mirror_single", dense=True)
    return d.df.select("x", "y", "z", F.round("v", 3).alias("v"))


BOX = np.array([0.4, 0.2, 0.1])
BOX_Y = np.array([0.5, 0.25])


def _conv_sql():
    ctes, last = _sep_sql("v2", [BOX, BOX_Y], "c", "zero", "v2dims")
    return q.with_(q.V2, q.V2DIMS, *ctes) + f"SELECT x, y, z, round(v, 4) AS v FROM {last}"


@register("convolve_separable", _conv_sql())
def convolve_separable(spark, sf_dir):
    """separable convolution with user half-kernels (0.4,0.2,0.1) along x and (0.5,0.25) along y."""
    out = CV.convolve_separable(fx.embedding_u16(spark, sf_dir), [BOX, BOX_Y, None], "zero", dense=True)
    return out.df.select("x", "y", "z", F.round("v", 4).alias("v"))


# ------------------------------------------------------------------ H4-H7

def _down_sql(src: str, dims: tuple[str, str, str], name: str) -> str:
    nx, ny, nz = dims
    return f"""{name} AS (SELECT tx AS x, ty AS y, tz AS z,
    {q.to_int(f'SUM(CAST(v AS DOUBLE)) / (CAST(least(2, {nx} - 2 * tx) AS DOUBLE) * least(2, {ny} - 2 * ty) * least(2, {nz} - 2 * tz))', I64[0], I64[1], 'BIGINT')} AS v
  FROM (SELECT x // 2 AS tx, y // 2 AS ty, z // 2 AS tz, v FROM {src}) GROUP BY tx, ty, tz)"""


@register("downsample", q.with_(q.V4, q.V4DIMS, _down_sql("v4", (q.NX4, q.NY4, q.NZ4), "d1"))
          + "SELECT x, y, z, v FROM d1")
def downsample(spark, sf_dir):
    """H4: half-pixel x2 downsampling of V4 (sparse counts), mean over samples inside the dims, rounded."""
    return RS.downsample2(fx.lineitem_counts(spark, sf_dir)).df


@register("pyramid", q.with_(q.V4, q.V4DIMS,
                             _down_sql("v4", (q.NX4, q.NY4, q.NZ4), "d1"),
                             _down_sql("d1", tuple(f"(({n} + 1) // 2)" for n in (q.NX4, q.NY4, q.NZ4)), "d2"),
                             _down_sql("d2", tuple(f"((({n} + 1) // 2 + 1) // 2)" for n in (q.NX4, q.NY4, q.NZ4)), "d3"))
          + """SELECT 1 AS level, x, y, z, v FROM d1 UNION ALL SELECT 2, x, y, z, v FROM d2
UNION ALL SELECT 3, x, y, z, v FROM d3""")
def pyramid(spark, sf_dir):
    """H6: three levels of repeated x2 downsampling (each level rounded to the type before the next)."""
    levels = RS.pyramid(fx.lineitem_counts(spark, sf_dir), 3)
    out = None
    for i, lv in enumerate(levels, 1):
        d = lv.df.select(F.lit(i).alias("level"), "x", "y", "z", "v")
        out = d if out is None else out.unionByName(d)
    return out


def _affine_matrix():
    t = RS.affine_identity()
    t = RS.rotate(t, 2, 0.3)
    t = RS.scale(t, 0.9)
    return t


def _affine_sql():
    # the inverse written out: unscale by 0.9, rotate back by 0.3
    p = ["((cos(0.3) * x + sin(0.3) * y) / 0.9)", "((cos(0.3) * y - sin(0.3) * x) / 0.9)"]
    ms = q.mirror_double
    return q.with_(q.V2, q.V2DIMS, f"""tg AS (SELECT x, y, z, {p[0]} AS p0, {p[1]} AS p1 FROM v2),
fl AS (SELECT x, y, z, floor(p0) AS f0, floor(p1) AS f1, p0 - floor(p0) AS t0, p1 - floor(p1) AS t1 FROM tg),
cn AS (SELECT * FROM (VALUES (0, 0), (1, 0), (0, 1), (1, 1)) t(b0, b1)),
ex AS (SELECT x, y, z, CAST(f0 + b0 AS BIGINT) AS c0, CAST(f1 + b1 AS BIGINT) AS c1,
         1.0 * (CASE WHEN b0 = 1 THEN t0 ELSE 1.0 - t0 END) * (CASE WHEN b1 = 1 THEN t1 ELSE 1.0 - t1 END) AS w FROM fl, cn)""") + f"""
SELECT ex.x, ex.y, ex.z, {q.to_int('SUM(ex.w * CAST(COALESCE(s.v, 0) AS DOUBLE))', 0, 65535, 'INTEGER')} AS v
FROM ex LEFT JOIN v2 s ON s.x = {ms('ex.c0', '(SELECT nx FROM v2dims)')} AND s.y = {ms('ex.c1', '(SELECT ny FROM v2dims)')} AND s.z = ex.z
GROUP BY ex.x, ex.y, ex.z"""


@register("affine_2d", _affine_sql())
def affine_2d(spark, sf_dir):
    """H7: rotate(z, 0.3) then scale(0.9), n-linear, mirror-double outside, onto V2's own interval, uint16."""
    v = fx.embedding_u16(spark, sf_dir)
    return RS.affine(v, _affine_matrix(), (0, 0, 0), v.dims, "mirror_double", out_dtype="uint16").df
