"""CLLCN and box statistics against numpy brute force (explicit windows)."""

import numpy as np
import pytest

from tessera.operators import blocks as B
from tessera.operators import kernels as K
from tessera.operators import localstats as ls

from conftest import to_array

NP_MODE = {"zero": "constant", "mirror_single": "reflect", "mirror_double": "symmetric"}


def brute_cllcn(img2d, r, extension, **kw):
    """Direct per-pixel windows on the padded slice; the kernel formula on those sums."""
    pad = np.pad(img2d.astype(np.float32), r, mode=NP_MODE[extension])
    h, w = img2d.shape
    S = np.zeros((h, w))
    Q = np.zeros((h, w))
    for y in range(h):
        for x in range(w):
            win = pad[y:y + 2 * r + 1, x:x + 2 * r + 1].astype(np.float64)
            S[y, x], Q[y, x] = win.sum(), (win * win).sum()
    # reuse the kernel's formula with the brute-force sums
    orig = K.box_sums
    try:
        K.box_sums = lambda a, rr, exact=False: (S, Q)
        f = K.cllcn_slice(pad, r, **kw)
    finally:
        K.box_sums = orig
    stored = f.astype(np.float32).astype(np.float64)
    return K.to_dtype(K.clamp(stored, 0.0, 65535.0), "uint16")


@pytest.fixture(scope="module")
def s5():
    rng = np.random.default_rng(5)
    return rng.integers(0, 65536, size=(11, 13)).astype(np.uint16)  # S5: 13 x 11


@pytest.mark.parametrize("r", [1, 5, 40])
@pytest.mark.parametrize("extension", ["zero", "mirror_single", "mirror_double"])
def test_cllcn_voxel_form_matches_brute_force(mk, s5, r, extension):
    vol = mk(s5)
    got = to_array(ls.cllcn(vol, r, extension=extension))[0]
    want = brute_cllcn(s5, r, extension)
    assert np.array_equal(got, want)


@pytest.mark.parametrize("block", [(4, 3, 1), (16, 16, 1), (5, 11, 1)])
def test_cllcn_block_form_equals_voxel_form(mk, s5, block):
    vol = mk(s5)
    want = to_array(ls.cllcn(vol, 3, extension="mirror_single"))
    got = to_array(B.to_voxels(B.cllcn(B.from_voxels(vol, block), 3, extension="mirror_single")))
    assert np.array_equal(got, want)


def test_box_stats_full_windows(mk, s5):
    vol = mk(s5)
    pdf = ls.box_stats(vol, 2).toPandas().sort_values(["y", "x"])
    pad = np.pad(s5.astype(np.int64), 2)
    S = np.array([[pad[y:y + 5, x:x + 5].sum() for x in range(13)] for y in range(11)])
    assert np.array_equal(pdf.S.to_numpy().reshape(11, 13), S)


def test_constant_image_gives_nan_then_zero_and_keep_min_max(mk):
    const = np.full((12, 12), 1000, dtype=np.uint16)
    got = to_array(ls.cllcn(mk(const), 2))[0]
    # zero border: the interior window is constant -> s = 0 -> NaN -> 0 (P11); border windows see zeros
    assert (got[5:7, 5:7] == 0).all()
    ends = np.zeros((12, 12), dtype=np.uint16)
    ends[:, 6:] = 65535
    got = to_array(ls.cllcn(mk(ends), 2))[0]
    assert np.array_equal(got, ends.astype(float))  # keepMinMax leaves 0 and 65535 unchanged


def test_stretch_gamma_one_has_no_limiter(mk, s5):
    got = to_array(ls.cllcn(mk(s5), 2, gamma=1.0, center=False, stretch=True))[0]
    assert np.array_equal(got, brute_cllcn(s5, 2, "zero", gamma=1.0, center=False, stretch=True))


def test_sparse_input_is_densified(mk, s5):
    """Absent voxels read as 0: a sparse volume gives the same result as the dense one with zeros."""
    from tessera.volume import Volume, VolumeMeta
    a = s5.copy()
    a[3:6, 2:9] = 0
    dense = mk(a)
    sparse = Volume(dense.df.filter("v != 0"), VolumeMeta(dense.dims, "uint16"))
    assert np.array_equal(to_array(ls.cllcn(sparse, 2)), to_array(ls.cllcn(dense, 2)))
    assert np.array_equal(to_array(ls.cllcn(sparse, 2, extension="mirror_double")),
                          to_array(ls.cllcn(dense, 2, extension="mirror_double")))


@pytest.mark.parametrize("extension", ["zero", "mirror_double"])
def test_cllcn_strip_passes_equal_single_pass(mk, s5, extension):
    vol = mk(s5)
    want = to_array(ls.cllcn(vol, 4, extension=extension))
    got = to_array(B.to_voxels(B.cllcn(B.from_voxels(vol, (4, 3, 1)), 4, extension=extension, strips=True)))
    assert np.array_equal(got, want)


@pytest.mark.parametrize("shape", [(9, 1), (1, 9)])
@pytest.mark.parametrize("extension", ["zero", "mirror_single", "mirror_double"])
def test_size_one_axes(mk, shape, extension):
    """1 x 9 and 9 x 1 slices; mirror maps with n = 1 read the single sample."""
    a = (np.arange(9, dtype=np.uint16) * 7000 + 123).reshape(shape)
    vol = mk(a)
    want = brute_cllcn(a, 2, extension)
    assert np.array_equal(to_array(ls.cllcn(vol, 2, extension=extension))[0], want)
    got = to_array(B.to_voxels(B.cllcn(B.from_voxels(vol, (2, 2, 1)), 2, extension=extension)))[0]
    assert np.array_equal(got, want)


@pytest.mark.parametrize("extension", ["zero", "mirror_single", "mirror_double"])
@pytest.mark.parametrize("dtype", ["uint16", "float64"])
@pytest.mark.parametrize("r", [0, 1, 3])
def test_windows_are_segments_of_lines(mk, monkeypatch, extension, dtype, r):
    """Lines cut into segments of a few samples give what whole lines give; no window partition is a line."""
    a = np.random.default_rng(r).integers(0, 65536, size=(2, 37, 41)).astype(dtype)
    want = to_array(ls.cllcn(mk(a, dtype), max(r, 1), extension=extension))
    sums = {(x.x, x.y, x.z): (x.S, x.Q) for x in ls.box_sums(mk(a, dtype), r, r, extension).collect()}
    monkeypatch.setattr(ls, "SEGMENT", 5)
    cut = ls.box_sums(mk(a, dtype), r, r, extension)
    assert {(x.x, x.y, x.z): (x.S, x.Q) for x in cut.collect()} == sums and len(sums) == a.size
    assert np.array_equal(to_array(ls.cllcn(mk(a, dtype), max(r, 1), extension=extension)), want)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if line.strip(" :+-").startswith("Window ")]
    assert windows and all("_seg" in line for line in windows)
