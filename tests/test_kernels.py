import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.synthetic import slide
from tilewright.operators import folds, kernels, normalization, tissue


def flooded(mask, eight):
    h, w = mask.shape
    out = np.zeros((h, w), int)
    for y, x in zip(*np.nonzero(mask)):
        if out[y, x]:
            continue
        stack, out[y, x] = [(y, x)], y * w + x + 1
        while stack:
            a, b = stack.pop()
            for dy in (-1, 0, 1):
                for dx in (-1, 0, 1):
                    c, d = a + dy, b + dx
                    if (dy or dx) and (eight or not dy * dx) and 0 <= c < h and 0 <= d < w and mask[c, d] and not out[c, d]:
                        out[c, d] = y * w + x + 1
                        stack.append((c, d))
    return out


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 12), st.integers(1, 12), st.integers(0, 10**6), st.booleans())
def test_label_is_flood_fill(h, w, seed, eight):
    rng = np.random.default_rng(seed)
    mask = rng.random((h, w)) < rng.random()
    assert (kernels.label(mask, eight) == flooded(mask, eight)).all()


def neighbours(a, y, x, disk, mask=None):
    r = disk.shape[0] // 2
    return [int(a[y + dy, x + dx]) for dy in range(-r, r + 1) for dx in range(-r, r + 1) if disk[dy + r, dx + r] and 0 <= y + dy < a.shape[0] and 0 <= x + dx < a.shape[1] and (mask is None or mask[y + dy, x + dx])]


def test_entropy_brute_force():
    a = np.random.default_rng(1).integers(0, 12, (14, 17)).astype(np.uint8)
    got = kernels.entropy(a, 5)
    for y in range(14):
        for x in range(17):
            p = np.bincount(neighbours(a, y, x, kernels.disk(5))) / len(neighbours(a, y, x, kernels.disk(5)))
            assert got[y, x] == pytest.approx(-(p[p > 0] * np.log2(p[p > 0])).sum(), abs=1e-9)


def test_median_and_mad_brute_force():
    rng = np.random.default_rng(2)
    a, mask = rng.integers(0, 256, (12, 13)).astype(np.uint8), rng.random((12, 13)) < 0.7
    med, mad = kernels.masked_median_mad(a, mask, 4)
    for y in range(12):
        for x in range(13):
            v = sorted(neighbours(a, y, x, kernels.disk(4), mask))
            if v:
                m = v[(len(v) + 1) // 2 - 1]
                assert med[y, x] == m and mad[y, x] == sorted(abs(k - m) for k in v)[(len(v) + 1) // 2 - 1]


def test_gaussian_derivatives_brute_force():
    a = np.random.default_rng(5).random((15, 11))
    for order in (0, 1, 2):
        r, sigma = 6, 1.5
        x = np.arange(-r, r + 1)
        g = np.exp(-x * x / (2 * sigma**2))
        g /= g.sum()
        k = (g, -x / sigma**2 * g, (x * x / sigma**4 - 1 / sigma**2) * g)[order]
        p = np.pad(a, [(0, 0), (r, r)], mode="symmetric")
        want = np.stack([np.convolve(row, k, "valid") for row in p])
        p = np.pad(want, [(r, r), (0, 0)], mode="symmetric")
        want = np.stack([np.convolve(c, g, "valid") for c in p.T], 1)
        assert np.allclose(kernels._gauss(a, sigma, (0, order)), want)


def test_small_objects_and_holes():
    m = np.zeros((8, 8), bool)
    m[1:5, 1:5] = True
    m[2, 2] = False
    m[7, 7] = True
    assert kernels.remove_small(m, 1).sum() == 15
    assert kernels.fill_small(m, 1)[2, 2]
    assert not kernels.remove_small(m, 15).any()  # the limit itself goes


def test_otsu_splits_two_values():
    assert 10 <= kernels.otsu(np.array([10] * 50 + [200] * 50)) < 200
    assert kernels.otsu(np.array([7, 7, 7])) == 7


def test_opening_removes_thin_lines():
    m = np.zeros((20, 20), bool)
    m[5, :] = True
    m[8:17, 8:17] = True
    assert not kernels.opening(m, 3)[5].any() and kernels.opening(m, 3)[12, 12]


def test_gray_and_saturation():
    px = np.array([[[128, 128, 128], [255, 0, 0], [0, 0, 0]]], np.uint8)
    assert kernels.gray(px).tolist() == [[128, 76, 0]]
    assert kernels.saturation(px).tolist() == [[0, 255, 0]]


def test_focus_ignores_what_is_outside():
    g = np.random.default_rng(3).integers(0, 255, (10, 10)).astype(np.uint8)
    where = np.zeros((10, 10), bool)
    where[2:8, 2:8] = True
    other = g.copy()
    other[~where] = 0
    assert kernels.laplacian_variance(g, where) == kernels.laplacian_variance(other, where)
    assert kernels.laplacian_variance(g, np.zeros((10, 10), bool)) is None


def test_resize_means_and_nearest():
    a = np.arange(64, dtype=np.uint8).reshape(8, 8)
    assert np.abs(kernels.resized(a, 4, 4) - a.reshape(4, 2, 4, 2).mean((1, 3))).max() <= 0.5
    assert (kernels.resized_nearest(a, 16, 16)[::2, ::2] == a).all()


def test_tissue_is_found_whole():
    rgb, t, _ = slide()
    for method in ("otsu", "otsu_s", "union", "union_s", "adaptive", "intersection"):
        mask, used = tissue.tissue_mask(rgb, method)
        assert (mask & t).sum() / (mask | t).sum() > 0.8, (method, used)
    assert tissue.tissue_mask(rgb, None, " Hirano ")[1] == "otsu_s"
    with pytest.raises(ValueError):
        tissue.tissue_mask(rgb, "guess")


def test_line_feature_sees_the_band():
    rgb, t, band = slide(192, 256)
    line = folds.line_folds(folds.line_feature(rgb, t, 8.0), t, 8.0)
    assert line.any() and (line & band).sum() / line.sum() > 0.95
    with pytest.raises(ValueError):
        folds.line_feature(rgb, np.zeros_like(t), 8.0)


def test_level_inversion():
    levels, counts = np.array([0.0, 1, 2, 3]), np.array([4, 10, 7, 1])
    assert folds.level_at(levels, counts, 0.64) == 2 and folds.level_at(levels, counts, 0.34) == 2
    assert folds.level_at(levels, counts, 0.05) == 3


def test_identity_matrices_square_the_pixel():
    eye = {"method": "macenko", "stain_matrix": [[1, 0, 0], [0, 1, 0]], "max_c": [1, 1]}
    twice = eye | {"max_c": [2, 2]}
    out = normalization.normalize(np.array([[[64, 128, 255]]], np.uint8), twice, eye)
    assert out.tolist() == [[[16, 64, 255]]]  # 64^2 / 255 and 128^2 / 255, cut


def test_constant_image_goes_to_the_targets_colour():
    flat = lambda c: np.full((4, 4, 3), c, np.uint8)
    source, target = (normalization.freeze(flat(c), None, "reinhard") for c in ((200, 120, 140), (150, 90, 160)))
    out = normalization.normalize(flat((200, 120, 140)), target, source)
    assert np.abs(out.astype(int) - np.array([150, 90, 160])).max() <= 3


def test_background_stays_and_the_fit_is_that_of_the_crop():
    rgb, t, _ = slide()
    for method in normalization.METHODS:
        p = normalization.freeze(rgb, t, method)
        assert p == normalization.freeze(rgb[t].reshape(1, -1, 3), None, method)
        out = normalization.normalize(rgb, p, p, t)
        assert (out[~t] == rgb[~t]).all()
    with pytest.raises(ValueError):
        normalization.freeze(rgb, np.zeros_like(t))


def test_hash_of_parameters_ignores_order():
    assert normalization.params_hash({"a": 1, "b": [2]}) == normalization.params_hash({"b": [2], "a": 1})


def test_stain_vectors_are_near_the_dyes():
    from tests.synthetic import DYES

    rng = np.random.default_rng(0)
    c = rng.random((5000, 2)) * np.array([1.2, 1.0])
    c[:1000, 0], c[1000:2000, 1] = 0.01, 0.01
    px = np.clip(255 * np.exp(-c @ DYES), 1, 255).astype(np.uint8)
    m = np.array(normalization.Macenko.fitted(px)["stain_matrix"])
    want = DYES / np.linalg.norm(DYES, axis=1, keepdims=True)
    assert np.abs(m - want).max() < 0.1


def test_fold_filters_look_at_each_region_alone():
    feature, fold = np.zeros((60, 80)), np.zeros((60, 80), bool)
    for y, x, h, w, v in ((5, 5, 10, 40, 1.0), (30, 5, 10, 40, 0.05), (30, 60, 9, 9, 1.0)):
        fold[y : y + h, x : x + w] = True
        feature[y : y + h, x : x + w] = v
    out = folds.filtered(fold, feature, 8.0, 0.4)
    assert out[8, 20] and not out[33, 20] and not out[34, 64]  # kept; without contrast; a round speck
    assert kernels.boxes(kernels.label(fold))[0] == ((5, 15, 5, 45), 5 * 80 + 5 + 1, 400)


def test_outlines_follow_the_border():
    m = np.zeros((9, 9), bool)
    m[2:6, 3:8] = True
    m[8, 0] = True
    rings = kernels.outlines(m)
    assert rings[0] == [(3, 2), (7, 2), (7, 5), (3, 5), (3, 2)] and rings[1] == [(0, 8), (0, 8)]
    rng = np.random.default_rng(8)
    for _ in range(60):
        m = rng.random((7, 8)) < 0.5
        labels = kernels.label(m)
        for ring, (_, k, area) in zip(kernels.outlines(m), kernels.boxes(labels)):
            assert ring[0] == ring[-1] and all(labels[y, x] == k for x, y in ring)
            ys, xs = np.nonzero(labels == k)
            assert {min(x for x, _ in ring), max(x for x, _ in ring)} == {xs.min(), xs.max()} and {min(y for _, y in ring), max(y for _, y in ring)} == {ys.min(), ys.max()}


def test_polygons_are_scaled_to_the_plane():
    from tilewright.operators import artifacts

    classes = np.full((8, 8), 7)
    classes[:4, :4], classes[4:, :4] = 2, 4
    (ring,) = artifacts.polygons(classes, "pen", 1.0, 0.5)
    assert ring[0] == ring[-1] and all(0 <= x <= 6 and 8 <= y <= 14 for x, y in ring)
    assert artifacts.fits_plane((8, 8), (16, 16), 1.0, 0.5) and not artifacts.fits_plane((8, 8), (32, 32), 1.0, 0.5)
    assert artifacts.finest_model([2.0, 1.0], 1.5) == 1.0 and artifacts.finest_model([]) is None


def test_lab_in_bytes():
    colours = np.array([[255, 255, 255], [0, 0, 0], [255, 0, 0], [0, 255, 0], [0, 0, 255], [128, 128, 128]], np.uint8)
    want = [[255, 128, 128], [0, 128, 128], [136, 208, 195], [224, 42, 211], [82, 207, 20], [137, 128, 128]]
    assert normalization.to_lab8(colours).tolist() == want
    back = normalization.Reinhard.pixels(normalization.Reinhard.channels(colours)).astype(int)
    assert np.abs(back - colours)[[0, 1, 5]].max() <= 1 and np.abs(back - colours).max() <= 8  # bytes of Lab are coarse at the edge of the gamut
    p = normalization.freeze(colours.reshape(1, -1, 3), None, "reinhard")
    assert np.allclose(p["means"], [np.mean([w[0] for w in want]) / 2.55, np.mean([w[1] for w in want]) - 128, np.mean([w[2] for w in want]) - 128])
