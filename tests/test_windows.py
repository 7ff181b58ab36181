"""Window statistics: arithmetic chosen by type, sums local to the window, block size and plan without influence."""

import numpy as np
import pytest
from conftest import to_array

from tessera.operators import blocks as B
from tessera.operators import exact as X
from tessera.operators import kernels as K
from tessera.operators import localstats as ls
from tessera.operators import running as R
from tessera.volume import VolumeMeta


def direct(img, r):
    """Window sums of a slice by explicit windows, in float64 over float32 samples."""
    pad = np.pad(img.astype(np.float32).astype(np.float64), r)
    win = np.lib.stride_tricks.sliding_window_view(pad, (2 * r + 1, 2 * r + 1))
    return win.sum((2, 3)), (win * win).sum((2, 3))


def blocks_of(spark, a, dtype, block):
    """BlockVolume straight from an array (z, y, x), NaN included."""
    rows = []
    for z in range(0, a.shape[0], block[2]):
        for y in range(0, a.shape[1], block[1]):
            for x in range(0, a.shape[2], block[0]):
                p = a[z:z + block[2], y:y + block[1], x:x + block[0]]
                rows.append((x // block[0], y // block[1], z // block[2], x, y, z, p.shape[2], p.shape[1], p.shape[0], bytearray(B.encode(p, dtype))))
    return B.BlockVolume(spark.createDataFrame(rows, B.BLOCK_SCHEMA), VolumeMeta(a.shape[::-1], dtype, rank=3), block)


def test_exact_only_by_type():
    assert K.exact_sums("uint16", 1023) and K.exact_sums("uint8", 5)
    assert not any(K.exact_sums(t, 1) for t in ("int32", "int64", "float32", "float64"))


@pytest.mark.parametrize("k", [1, 2, 3, 7, 11, 20])
def test_window_sums_are_local(k):
    rng = np.random.default_rng(k)
    a = rng.random((3, 20))
    want = np.lib.stride_tricks.sliding_window_view(a, k, 1).sum(-1)
    assert np.allclose(K.window_sums(a, k, 1), want, rtol=1e-12)
    a[1, 7], a[2, 3] = np.nan, 1e300
    got, fine = K.window_sums(a, k, 1), np.lib.stride_tricks.sliding_window_view(a, k, 1)
    assert (np.isnan(got) == np.isnan(fine.sum(-1))).all()
    clean = (fine < 1e299).all(-1)
    assert np.allclose(got[clean], fine.sum(-1)[clean], rtol=1e-12)


@pytest.mark.parametrize("dtype,scale", [("int32", 2 ** 30), ("uint16", 65535), ("float32", 1.0)])
@pytest.mark.parametrize("block", [(8, 8, 1), (32, 32, 2)])
@pytest.mark.parametrize("strips", [False, True])
def test_cllcn_any_type_block_and_plan(spark, dtype, scale, block, strips):
    rng = np.random.default_rng(3)
    a = (rng.random((2, 32, 32)) * scale).astype(dtype)
    if dtype == "float32":
        a[0, 5, 6] = 1e15
        a[1, 20, 9] = np.nan
    r, kw = 2, dict(min_intensity=0.0, max_intensity=float(scale))
    got = to_array(B.to_voxels(B.cllcn(blocks_of(spark, a, dtype, block), r, strips=strips, **kw)))
    for z in range(2):
        S, Q = direct(a[z], r)
        f = K.cllcn_from_sums(a[z].astype(np.float32).astype(np.float64), S, Q, r, fp_max=float(scale))
        want = K.to_dtype(K.clamp(f.astype(np.float32).astype(np.float64), 0.0, scale), dtype).astype(np.float64)
        far = ~np.isnan(S)
        if dtype == "uint16":
            assert np.array_equal(got[z], want)
        else:
            assert np.allclose(got[z][far], want[far], rtol=1e-4, atol=1e-4 * scale)
        if dtype == "float32" and z == 0:  # windows without the huge sample are as if it were not there
            b = a[z].copy()
            b[5, 6] = 0.5
            S2, _ = direct(b, r)
            clean = S < 1e14
            assert np.allclose(S[clean], S2[clean])


@pytest.mark.parametrize("r", [1, 4, 11, 60])
@pytest.mark.parametrize("block", [(5, 4, 2), (16, 16, 1), (40, 3, 3)])
def test_running_sums_equal_halo_plan(spark, r, block):
    rng = np.random.default_rng(r)
    a = rng.integers(0, 65536, (3, 23, 37)).astype(np.uint16)
    a[:, 4:12, 10:25] = 0
    a[2] = 0
    bv = B.nonempty(blocks_of(spark, a, "uint16", block))
    for kw in ({}, {"gamma": 1.0}, {"center": True, "stretch": False}):
        want = to_array(B.to_voxels(B.cllcn(bv, r, strips=False, **kw)))
        assert np.array_equal(to_array(B.to_voxels(B.cllcn_strips(bv, r, prefix=True, **kw))), want)
        assert np.array_equal(to_array(B.to_voxels(B.cllcn_strips(bv, r, prefix=False, **kw))), want)


def test_thin_strips(spark, monkeypatch):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 65536, (5, 20, 20)).astype(np.uint16)
    bv = blocks_of(spark, a, "uint16", (10, 10, 5))
    want = to_array(B.to_voxels(B.cllcn(bv, 3, strips=False)))
    monkeypatch.setattr(B, "MAX_GROUP_BYTES", 40_000)
    out = B.cllcn_strips(bv, 3, extension="zero", prefix=False)
    assert out.block == (10, 10, 5) and np.array_equal(to_array(B.to_voxels(out)), want)


@pytest.mark.parametrize("mode", ["zero", "mirror_single", "mirror_double"])
def test_bytes_per_voxel_do_not_grow_with_the_radius(spark, mode, monkeypatch):
    """256-wide blocks: what the running sums ship per voxel, at r = 256 and 1023, under every border."""
    rng = np.random.default_rng(1)
    a = rng.integers(0, 65536, (1, 256, 2304)).astype(np.uint16)
    bv = blocks_of(spark, a, "uint16", (256, 256, 1))
    sent, real = {}, R.grouped_rows
    for r in (256, 1023):
        seen = []

        def spy(df, *rest):
            seen.append(df.selectExpr("sum(octet_length(payload)) AS n").first()["n"])
            return real(df, *rest)
        monkeypatch.setattr(R, "grouped_rows", spy)
        R.window_pass(bv.df, bv.dims, bv.block, 0, r, mode, lambda p, s: (p, X.fields(B.decode(p, "uint16", *s), True)),
                      lambda kept, f, s: kept)
        sent[r] = seen[0] / a.size
    assert all(v <= 48 for v in sent.values()), sent


@pytest.mark.parametrize("n", [1, 2, 3, 7])
@pytest.mark.parametrize("mode", ["zero", "mirror_single", "mirror_double"])
def test_folded_windows(n, mode):
    """E(u) - E(w) is the sum over [w, u) of the extended line, however far out."""
    line = np.random.default_rng(n).integers(1, 100, n)
    run = np.concatenate([[0], line.cumsum()])
    ext = lambda i: line[j] if (j := int(B._index_map(i, i, n, mode)[0])) >= 0 else 0
    u = np.arange(-25, 26)
    y, sign, t, f, last = R.terms(u, n, mode)
    e = sign * run[y] + t * run[n] + f * line[0] + last * line[-1]
    assert np.array_equal(np.diff(e), [ext(i) for i in u[:-1]])


@pytest.mark.parametrize("mode", ["zero", "mirror_single", "mirror_double"])
@pytest.mark.parametrize("r", [1, 5, 30])
@pytest.mark.parametrize("block", [(5, 4, 2), (16, 16, 1), (40, 3, 3)])
def test_running_sums_under_any_border(spark, mode, r, block):
    rng = np.random.default_rng(r)
    a = rng.integers(0, 65536, (2, 11, 19)).astype(np.uint16)
    a[:, 4:9, 6:15] = 0
    bv = B.nonempty(blocks_of(spark, a, "uint16", block))
    want = to_array(B.to_voxels(B.cllcn(bv, r, extension=mode, strips=False)))
    assert np.array_equal(to_array(B.to_voxels(B.cllcn(bv, r, extension=mode, strips=True))), want)


def exact_box(img, r):
    """Window sums of float32 samples as fractions, rounded once."""
    from fractions import Fraction
    v = img.astype(np.float32)
    pad = np.pad(v, r)
    out = np.zeros((2, *img.shape))
    for y in range(img.shape[0]):
        for x in range(img.shape[1]):
            win = pad[y:y + 2 * r + 1, x:x + 2 * r + 1].ravel()
            if np.isfinite(win).all():
                out[:, y, x] = float(sum(map(Fraction, win.tolist()))), float(sum(Fraction(w) ** 2 for w in win.tolist()))
            else:
                with np.errstate(invalid="ignore"):
                    out[:, y, x] = win.astype(np.float64).sum(), (win.astype(np.float64) ** 2).sum()
    return out


WIDE = {"int32": [2 ** 30, -2 ** 31, 2 ** 31 - 1, 3], "int64": [2 ** 62 + 12345, -2 ** 63, 7], "uint32": [2 ** 32 - 1, 5],
        "float32": [1e15, 3e38, 1e-40, -2.5, np.nan, np.inf], "float64": [1e15, 1e300, -1e-30, np.inf, -np.inf]}


@pytest.mark.parametrize("dtype", list(WIDE))
def test_wide_sums_are_exact_in_every_plan_and_block(spark, dtype):
    """Large, tiny and infinite samples: all plans and block sizes agree bit for bit with fractions rounded once."""
    rng, r = np.random.default_rng(5), 2
    a = (rng.random((1, 12, 14)) * 1000 - (0 if dtype == "uint32" else 500)).astype(dtype)
    for k, v in enumerate(WIDE[dtype]):
        a[0, 2 + 2 * (k % 4), 1 + 2 * k] = np.array([v]).astype(dtype)[0]
    want = exact_box(a[0], r)
    for block in ((14, 12, 1), (5, 4, 1), (3, 7, 1)):
        for running in (False, True):
            out = B.channels_to_voxels(B.box_stats(blocks_of(spark, a, dtype, block), r, running=running), ["S", "Q", "mean", "var", "std"])
            pdf = out.select("x", "y", "S", "Q").toPandas()
            got = np.zeros_like(want)
            got[:, pdf.y, pdf.x] = pdf[["S", "Q"]].to_numpy().T
            assert np.allclose(got, want, rtol=3e-16, atol=0, equal_nan=True), (block, running)
            if running is False and block == (14, 12, 1):
                first = got
            assert np.array_equal(got, first, equal_nan=True)


def test_limbs_hold_every_float():
    """Sums of limbs give the samples back: extremes of float32, both signs."""
    v = np.array([0.0, 1.0, -1.0, 1e-45, -1e-45, 3.4028234663852886e38, 2.0 ** -126, 16777215.0, -0.1, 123456.789], np.float32)
    s, q = X.sums(X.fields(v, False), False, v.shape)
    w = v.astype(np.float64)
    assert np.array_equal(s, w) and np.array_equal(q, w * w)
    f = X.unpack(X.pack(X.fields(v, False)), v.shape)
    assert np.array_equal(X.sums(f, False, v.shape)[0], w)


def test_voxel_form_casts_through_float(mk):
    rng = np.random.default_rng(8)
    a = (2 ** 26 + rng.integers(0, 2 ** 22, (24, 24))).astype(np.int32)
    kw = dict(min_intensity=0.0, max_intensity=float(2 ** 27))
    vol = mk(a, "int32")
    voxel = to_array(ls.cllcn(vol, 3, **kw))
    block = to_array(B.to_voxels(B.cllcn(B.from_voxels(vol, (8, 8, 1)), 3, **kw)))
    assert np.allclose(voxel, block, rtol=1e-6)
