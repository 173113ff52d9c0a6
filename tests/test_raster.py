"""Properties of masks, stains and scores, and agreement of the array kernels with their relational forms."""

import numpy as np
import pytest

from tesselon.functions import pixels as P
from tesselon.operators import masks as M
from tesselon.operators import raster as R


def square(size, ground, colour, lo, hi):
    img = np.full((size, size, 3), ground, np.uint8)
    img[lo:hi, lo:hi] = colour
    return img


SMALL = dict(border_px=0, edge_strip=0, guard_px=0, crop_px=0, rim_px=0, ink_dilate=1, green_dilate=3, close=3, open=3)


def test_pale_tissue_is_found():
    img = square(256, 245, (220, 205, 220), 64, 192)
    c = M.configured(expected=(0.05, 0.70), bright_gray=255, void_gray=255, pale_gray=255, edge_strip=0, guard_px=0, rim_px=0, crop_px=0, score_min=0.08, od_percentile=25, part_area=1e-5)
    mask, got = M.build_mask(img, c)
    assert mask[64:192, 64:192].mean() > 0.60 and got["mask_frac"] > 0.10


def test_pen_stripe_is_left_out():
    img = square(256, 240, (200, 140, 170), 40, 220)
    img[120:132, 20:236] = (230, 30, 210)
    mask, _ = M.build_mask(img)
    assert mask[120:132, 20:236].mean() < 0.30 and mask[60:180, 60:180].mean() > 0.70


def test_low_cover_tries_the_loose_mask():
    img = square(256, 250, (236, 228, 236), 96, 160)
    _, got = M.best_mask(img, M.configured(trigger=(0.90, 0.70)))
    assert got["fallback_attempted"] and got["mask_status"] in ("ok", "low_tissue", "high_tissue")


def test_sparse_canvas_uses_the_effective_status():
    img = square(256, 0, 240, 40, 216)
    img[96:160, 96:160] = (170, 140, 150)
    c = M.configured("sparse_canvas_pure_v1", expected=(0.12, 0.62), edge_strip=0, guard_px=0, rim_px=0, crop_px=0, score_min=0.0, loose_score_min=0.0, od_percentile=15, loose_od_percentile=10, part_area=1e-5)
    mask, got = M.best_mask(img, c)
    assert mask.any() and got["mask_frac"] < 0.12 and got["mask_frac_effective"] > 0.08
    assert (got["mask_status"], got["mask_status_effective"], got["status_basis"]) == ("low_tissue", "ok", "effective")


def stained(seed=123, size=256):
    rng = np.random.default_rng(seed)
    h, e = (np.array(v) / np.linalg.norm(v) for v in R.DEFAULT_STAINS[:2])
    left = np.arange(size)[None, :, None] < size // 2
    strong, weak = rng.uniform(0.40, 1.10, (size, size, 1)), rng.uniform(0.05, 0.35, (size, size, 1))
    od = np.where(left, strong, weak) * h + np.where(left, weak, strong) * e + 0.02
    return np.clip(255 * np.exp(-od), 0, 255).astype(np.uint8), h, e


def test_stain_vectors_are_recovered():
    img, h, e = stained()
    got = R.stain_vectors(img, min_pixels=500)
    assert got["source"] == "estimated" and got["h"] @ h > 0.85 and got["e"] @ e > 0.85
    assert abs(got["r"] @ got["h"]) < 1e-9 and abs(got["r"] @ got["e"]) < 1e-9


def test_stain_fallbacks():
    white = R.stain_vectors(np.full((128, 128, 3), 255, np.uint8), min_pixels=200)
    assert (white["source"], white["reason"]) == ("fallback", "too_few_pixels")
    rng = np.random.default_rng(7)
    noise = np.stack([rng.integers(lo, hi, (192, 192)) for lo, hi in ((110, 190), (80, 170), (100, 190))], -1).astype(np.uint8)
    got = R.stain_vectors(noise, min_pixels=200, max_dot=0.10)
    assert (got["source"], got["reason"]) == ("fallback", "he_unstable")
    assert R.stain_vectors(noise[..., 0])["reason"] == "bad_image"
    assert R.stain_vectors(noise, fixed=True)["source"] == "fixed" and R.stain_vectors(noise, dynamic=False)["source"] == "static"


def test_blood_scores_differ():
    tiles = [np.full((64, 64, 3), c, np.uint8) for c in ((200, 40, 40), (120, 80, 150), (235, 225, 235))]
    scores = [R.tile_features(t)["blood_score"] for t in tiles]
    assert max(scores) > 0 and np.std(scores) > 0 and np.argmax(scores) == 0


def labels_by_flood(mask):
    """8-connected labels by flood fill."""
    out, n = np.full(mask.shape, -1), 0
    for y, x in zip(*np.nonzero(mask)):
        if out[y, x] < 0:
            todo = [(y, x)]
            out[y, x] = n
            while todo:
                a, b = todo.pop()
                for i in range(max(0, a - 1), min(mask.shape[0], a + 2)):
                    for j in range(max(0, b - 1), min(mask.shape[1], b + 2)):
                        if mask[i, j] and out[i, j] < 0:
                            out[i, j] = n
                            todo.append((i, j))
            n += 1
    return out, n


@pytest.mark.parametrize("seed", range(6))
def test_components(seed):
    rng = np.random.default_rng(seed)
    mask = rng.random((rng.integers(1, 40), rng.integers(1, 40))) < rng.uniform(0.1, 0.7)
    want, n = labels_by_flood(mask)
    c = R.Components(mask)
    assert c.n == n and (c.pixels == want[mask]).all()
    for k in range(n):
        y, x = np.nonzero(want == k)
        assert (c.area[k], c.left[k], c.right[k], c.top[k], c.bottom[k]) == (len(y), x.min(), x.max() + 1, y.min(), y.max() + 1)


@pytest.mark.parametrize("size", [3, 5, 11])
def test_morphology(size):
    rng = np.random.default_rng(size)
    mask = rng.random((31, 27)) < 0.1
    want = np.zeros_like(mask)
    for y, x in zip(*np.nonzero(mask)):
        for dy, dx in R.ellipse_offsets(size):
            if 0 <= y + dy < 31 and 0 <= x + dx < 27:
                want[y + dy, x + dx] = True
    assert (R.dilate(mask, size) == want).all()
    assert (R.erode(~mask, size) == ~want).all()
    assert (R.closed(mask, size) >= mask).all() and (R.opened(mask, size) <= mask).all()


def test_holes_and_small_parts():
    mask = np.zeros((50, 50), bool)
    mask[10:30, 10:30] = True
    mask[15, 15] = False
    mask[40, 40] = True
    assert R.holes_filled(mask, 0.001)[15, 15] and not R.holes_filled(mask, 0.001)[0, 0]
    assert not R.large_only(mask, 0.01)[40, 40] and R.large_only(mask, 0.01)[20, 20]


def test_otsu_and_resizing():
    assert 10 <= R.otsu(np.array([10] * 50 + [200] * 50)) < 200
    a = np.arange(64, dtype=np.uint8).reshape(8, 8)
    assert (R.resize_area(a, 4, 4) == np.rint(a.reshape(4, 2, 4, 2).mean((1, 3)))).all()
    assert R.resize_bilinear(a, 8, 8).tolist() == a.tolist() == R.resize_nearest(a, 8, 8).tolist()


def test_macenko_brings_stains_together():
    a, _, _ = stained(1)
    b = np.clip(a.astype(float) * (0.8, 0.95, 0.85), 0, 255).astype(np.uint8)
    n = R.Macenko().fit(a)
    assert np.abs(n.normalize(b).mean((0, 1)) - a.mean((0, 1))).max() < np.abs(b.mean((0, 1)) - a.mean((0, 1))).max()
    with pytest.raises(ValueError):
        n.normalize(np.full((32, 32, 3), 255, np.uint8))


def test_kernels_agree_with_relational_forms(spark):
    from tesselon.plans.base import pixels
    from tesselon.plans.q_pixels import _images

    p = pixels(spark)
    by = {str(r["img"]): r.asDict() for r in P.tile_metrics(p, ["img"]).join(P.focus(p, ["img"]), "img").join(P.blood_score(p, ["img"]), "img").collect()}
    metrics = {r["img"]: r.asDict() for r in M.kernel_table(_images(spark), "tile_metrics").collect()}
    features = {r["img"]: r.asDict() for r in M.kernel_table(_images(spark), "tile_features").collect()}
    assert len(by) == len(metrics) == 4
    for k, row in by.items():
        for c in ("tissue_frac", "qc_rbc_frac", "qc_artifact_frac", "brightness", "focus", "adipose_proxy"):
            assert row[c] == pytest.approx(metrics[k][c], abs=1e-6), c
        assert row["blood_score"] == pytest.approx(features[k]["blood_score"], abs=1e-6)
        assert row["laplacian_var"] == pytest.approx(features[k]["texture"], abs=1e-6)


def test_one_bad_image_is_a_row_with_its_error(spark):
    good = square(64, 245, (150, 90, 160), 16, 48).tobytes()
    df = spark.createDataFrame([("a", 64, 64, bytearray(good)), ("b", 64, 64, bytearray(b"short"))], "img string, h int, w int, rgb binary")
    out = {r["img"]: r for r in M.mask_table(df, M.configured(**SMALL)).collect()}
    assert out["b"]["mask_status"] == "mask_error" and out["b"]["error_type"] and out["a"]["error_type"] is None


def test_unknown_settings_are_refused():
    with pytest.raises(ValueError):
        M.configured(nonsense=1)


def test_roi_retry():
    img = square(128, 245, (150, 90, 160), 32, 96)
    noise = np.random.default_rng(2).integers(0, 30, (64, 64, 3))
    img[32:96, 32:96] -= noise.astype(np.uint8)
    mask = np.zeros((128, 128), bool)
    c = M.configured(**SMALL, dark_pen=False, score_min=0.0, od_percentile=1, expected=(0.0, 0.9))
    new, ok = M.roi_retry(img, mask, img[16:112, 16:112], (16, 16, 112, 112), c, min_added=100)
    assert ok and new[40:88, 40:88].mean() > 0.5
    same, ok = M.roi_retry(img, mask, np.full((96, 96, 3), 255, np.uint8), (16, 16, 112, 112), c)
    assert not ok and (same == mask).all()
