"""Array kernels over one image, in NumPy: colour, filters, morphology, components, stains and resizing.

Images are (h, w, 3) arrays of uint8, masks (h, w) arrays of bool. Formulas that depend on a library's rounding follow the
public descriptions of that library; they agree with tesselon.functions.pixels, their relational form.
"""

from __future__ import annotations

import functools

import numpy as np

from ..functions.pixels import unmix_rows

# Colour


def od(rgb):
    return -np.log(np.clip(rgb.astype(np.float64) / 255.0, 1e-6, 1.0))


def gray(rgb):
    r, g, b = (rgb[..., k].astype(np.int64) for k in range(3))
    return ((r * 4899 + g * 9617 + b * 1868 + 8192) >> 14).astype(np.uint8)


def hsv(rgb):
    r, g, b = (rgb[..., k].astype(np.float64) for k in range(3))
    v, d = rgb.max(-1).astype(np.float64), (rgb.max(-1).astype(np.int64) - rgb.min(-1)).astype(np.float64)
    with np.errstate(all="ignore"):
        s = np.where(v > 0, 255 * d / v, 0)
        h = np.where(v == r, 60 * (g - b) / d, np.where(v == g, 120 + 60 * (b - r) / d, 240 + 60 * (r - g) / d))
    h = np.where(d == 0, 0, h)
    h = np.where(h < 0, h + 360, h) / 2
    return (np.floor(h + 0.5).astype(np.int64) % 180), np.floor(s + 0.5).astype(np.int64), rgb.max(-1).astype(np.int64)


def unmixed(rgb):
    """Haematoxylin and eosin amounts by the fixed vectors."""
    c = od(rgb) @ np.array(unmix_rows()).T
    return np.maximum(c[..., 0], 0), np.maximum(c[..., 1], 0)


def unmixed3(density, vectors):
    """Three stain amounts from optical density; vectors that are nearly dependent fall back to two stains and the residual."""
    m = np.array([_unit(v) for v in vectors], np.float64)
    if abs(np.linalg.det(m)) >= 1e-4:
        c = density @ np.linalg.inv(m)
        return [np.maximum(c[..., k], 0) for k in range(3)]
    c = np.maximum(density @ np.linalg.pinv(m[:2]), 0)
    rest = np.abs(density - c @ m[:2]).sum(-1)
    return [c[..., 0], c[..., 1], rest]


def red_dominance(rgb):
    x = rgb.astype(np.float64)
    return (x[..., 0] - 0.5 * (x[..., 1] + x[..., 2])) / 255.0


def black_canvas(rgb, gray_max=8, rgb_max=12):
    return (gray(rgb) <= gray_max) | (rgb <= rgb_max).all(-1)


def scaled(a, low, high, valid=None):
    """a between two percentiles of its valid values, clipped to 0..1; zeros if these are equal."""
    values = a[valid] if valid is not None and valid.any() else a.ravel()
    lo, hi = np.percentile(values, [low, high]) if values.size else (0.0, 0.0)
    return np.zeros(a.shape) if hi <= lo + 1e-6 else np.clip((a - lo) / (hi - lo), 0, 1)


# Filters: borders are mirrored without the edge pixel


def _pad(a, n):
    return np.pad(a, n, mode="reflect" if min(a.shape) > n else "edge")


def sobel(a):
    p = _pad(a.astype(np.float64), 1)
    dx, dy = p[:, 2:] - p[:, :-2], p[2:, :] - p[:-2, :]
    gx = dx[:-2] + 2 * dx[1:-1] + dx[2:]
    gy = dy[:, :-2] + 2 * dy[:, 1:-1] + dy[:, 2:]
    return np.sqrt(gx * gx + gy * gy)


def laplacian(a):
    p = _pad(a.astype(np.float64), 1)
    return p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]


def blur5(a):
    """Gaussian blur by the binomial kernel of five."""
    k = np.array([1, 4, 6, 4, 1]) / 16.0
    p = _pad(a.astype(np.float64), 2)
    p = sum(w * p[:, i : p.shape[1] - 4 + i] for i, w in enumerate(k))
    return np.floor(sum(w * p[i : p.shape[0] - 4 + i] for i, w in enumerate(k)) + 0.5)


def otsu(values):
    """The threshold of 0..255 of the largest variance between both sides, the lowest of equal ones."""
    n = np.bincount(np.clip(values, 0, 255).astype(np.int64).ravel(), minlength=256).astype(np.float64)
    w0, s0 = np.cumsum(n), np.cumsum(n * np.arange(256))
    w1 = w0[-1] - w0
    with np.errstate(all="ignore"):
        between = np.where((w0 > 0) & (w1 > 0), w0 * w1 * (s0 / w0 - (s0[-1] - s0) / w1) ** 2, -1)
    return int(between.argmax()) if between.max() > 0 else 0


# Morphology: outside of the image nothing is set, and nothing is unset


@functools.lru_cache(maxsize=64)
def ellipse_rows(size: int) -> tuple[tuple[int, int], ...]:
    """(row offset, half width) of the elliptical kernel of an odd size."""
    r = size // 2
    return tuple((dy, int(np.rint(r * np.sqrt(max(0.0, (r * r - dy * dy) / (r * r)))) if r else 0)) for dy in range(-r, r + 1))


def ellipse_offsets(size: int) -> list[tuple[int, int]]:
    return [(dy, dx) for dy, half in ellipse_rows(size) for dx in range(-half, half + 1)]


def odd(k, least=3):
    return max(least, int(k) | 1)


def dilate(mask, size):
    """Grown by the elliptical kernel: horizontal windows from running sums, shifted and joined."""
    h, w = mask.shape
    total = np.concatenate([np.zeros((h, 1), np.int32), np.cumsum(mask, axis=1, dtype=np.int32)], axis=1)
    x = np.arange(w)
    out, wide = np.zeros_like(mask, bool), {}
    for dy, half in ellipse_rows(size):
        if half not in wide:
            wide[half] = total[:, np.minimum(x + half + 1, w)] > total[:, np.maximum(x - half, 0)]
        src = wide[half]
        if dy >= 0:
            out[dy:] |= src[: h - dy] if dy < h else src[:0]
        elif -dy < h:
            out[:dy] |= src[-dy:]
    return out


def erode(mask, size):
    return ~dilate(~mask, size)


def closed(mask, size, times=1):
    for _ in range(times):
        mask = dilate(mask, size)
    for _ in range(times):
        mask = erode(mask, size)
    return mask


def opened(mask, size, times=1):
    for _ in range(times):
        mask = erode(mask, size)
    for _ in range(times):
        mask = dilate(mask, size)
    return mask


class Components:
    """The 8-connected components of a mask, numbered from 0 in the order of their first pixel."""

    def __init__(self, mask):
        self.mask = mask = np.asarray(mask, bool)
        h, w = mask.shape
        edge = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, start = np.nonzero(edge == 1)
        end = np.nonzero(edge == -1)[1]
        n = len(row)
        # Runs of neighbouring rows touch if neither ends before the other begins, corners included.
        wide = w + 2
        lo = np.searchsorted(row * wide + end, (row + 1) * wide + start, "left")
        hi = np.searchsorted(row * wide + start, (row + 1) * wide + end, "right")
        many = np.maximum(hi - lo, 0)
        a = np.repeat(np.arange(n), many)
        b = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many)
        label = np.arange(n)
        while len(a):
            la, lb = label[a], label[b]
            off = la != lb
            if not off.any():
                break
            least = np.minimum(la, lb)[off]
            np.minimum.at(label, la[off], least)
            np.minimum.at(label, lb[off], least)
            while (label[label] != label).any():
                label = label[label]
        _, label = np.unique(label, return_inverse=True)
        self.n = int(label.max()) + 1 if n else 0
        self.pixels = np.repeat(label, end - start)  # of the set pixels, in row order
        self.area = np.bincount(self.pixels, minlength=self.n)
        self.left, self.top = np.full(self.n, w), np.full(self.n, h)
        self.right, self.bottom = np.zeros(self.n, int), np.zeros(self.n, int)
        np.minimum.at(self.left, label, start)
        np.maximum.at(self.right, label, end)
        np.minimum.at(self.top, label, row)
        np.maximum.at(self.bottom, label, row + 1)

    def mean(self, layer):
        return np.bincount(self.pixels, weights=layer[self.mask].astype(np.float64), minlength=self.n) / np.maximum(self.area, 1)

    def near_border(self, px):
        h, w = self.mask.shape
        return (self.left <= px) | (self.top <= px) | (self.right >= w - px) | (self.bottom >= h - px)

    def only(self, keep):
        """The mask of the components that are kept."""
        out = np.zeros_like(self.mask)
        if self.n:
            out[self.mask] = np.asarray(keep, bool)[self.pixels]
        return out


def min_area(ratio, size):
    return max(1, round(ratio * size))


def large_only(mask, ratio):
    c = Components(mask)
    return c.only(c.area >= min_area(ratio, mask.size))


def holes_filled(mask, ratio):
    """Small gaps that do not touch the border are filled."""
    c = Components(~mask)
    return mask | c.only((c.area <= min_area(ratio, mask.size)) & ~c.near_border(0))


def bbox_fraction(rgb, min_ratio=0.0002):
    """The share of the image in the box around all larger parts that are no black canvas."""
    c = Components(~black_canvas(rgb))
    big = c.area >= min_area(min_ratio, c.mask.size)
    if not big.any():
        return 0.0
    return float((c.right[big].max() - c.left[big].min()) * (c.bottom[big].max() - c.top[big].min()) / c.mask.size)


# Resizing


def resize_area(a, h, w):
    """Means over the source area of each pixel, rounded half to even."""
    def weights(n, m):
        lo, hi = np.arange(m)[:, None] * n / m, np.arange(1, m + 1)[:, None] * n / m
        k = np.arange(n)[None, :]
        return np.clip(np.minimum(hi, k + 1) - np.maximum(lo, k), 0, None) * m / n

    x = np.tensordot(weights(a.shape[0], h), a.astype(np.float64), (1, 0))
    x = np.moveaxis(np.tensordot(weights(a.shape[1], w), x, (1, 1)), 0, 1)
    return np.rint(np.round(x, 9)).astype(a.dtype)


def resize_bilinear(a, h, w):
    def axis(n, m):
        p = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
        lo = np.minimum(np.floor(p).astype(int), n - 1)
        return lo, np.minimum(lo + 1, n - 1), p - lo

    y0, y1, fy = axis(a.shape[0], h)
    x0, x1, fx = axis(a.shape[1], w)
    x = a.astype(np.float64)
    fy, fx = fy.reshape(-1, 1, *[1] * (a.ndim - 2)), fx.reshape(1, -1, *[1] * (a.ndim - 2))
    top, low = x[y0][:, x0] * (1 - fx) + x[y0][:, x1] * fx, x[y1][:, x0] * (1 - fx) + x[y1][:, x1] * fx
    return np.rint(top * (1 - fy) + low * fy).astype(a.dtype)


def resize_nearest(a, h, w):
    return a[(np.arange(h) * a.shape[0] // h)][:, (np.arange(w) * a.shape[1] // w)]


# Stains


def _unit(v):
    v = np.asarray(v, np.float64)
    n = np.linalg.norm(v)
    return v / n if n > 1e-8 else v


# The stain vectors used where none can be estimated.
DEFAULT_STAINS = ((0.651, 0.701, 0.290), (0.216, 0.801, 0.558), (0.316, -0.598, 0.737))


def stain_vectors(rgb, *, od_min=0.12, gray_max=245, sat_min=6, min_pixels=1200, sample_max=60_000, angles=(1.0, 99.0), max_dot=0.985, min_score=1.20, fixed=False, dynamic=True, default=DEFAULT_STAINS):
    """Haematoxylin, eosin and residual vectors of an image, and why they are what they are.

    The plane of the two main directions of unit optical density is searched for its extreme angles; the two vectors
    found are named by which pairing with the default ones is closer, and refused if they are too alike or too far off.
    """
    h0, e0, r0 = np.abs(_unit(default[0])), np.abs(_unit(default[1])), _unit(default[2])

    def out(source, reason, n=0, valid=0.0, score=float("nan"), dot=float("nan"), vectors=(h0, e0, r0)):
        return {"h": vectors[0], "e": vectors[1], "r": vectors[2], "source": source, "reason": reason, "pixels": int(n), "valid_frac": float(valid), "pair_score": float(score), "he_dot": float(dot)}

    if fixed:
        return out("fixed", "fixed_cfg")
    if not dynamic:
        return out("static", "dynamic_disabled")
    if rgb.ndim != 3 or rgb.shape[2] != 3:
        return out("fallback", "bad_image")
    density = od(rgb)
    stained = ~black_canvas(rgb) & (gray(rgb) <= gray_max) & ((density.sum(-1) >= od_min) | (hsv(rgb)[1] >= sat_min))
    n, valid = int(stained.sum()), stained.mean()
    if n < min_pixels:
        return out("fallback", "too_few_pixels", n, valid)
    px = density[stained]
    if len(px) > sample_max:
        px = px[np.linspace(0, len(px) - 1, sample_max).astype(np.int64)]
    size = np.linalg.norm(px, axis=1)
    px = px[size > 1e-8] / size[size > 1e-8, None]
    n = len(px)
    if n < min_pixels:
        return out("fallback", "too_few_nonzero_od", n, valid)
    cov = np.cov(px.T)
    if not np.isfinite(cov).all():
        return out("fallback", "cov_invalid", n, valid)
    power, axes = np.linalg.eigh(cov)  # ascending
    if power[1] <= 1e-8:
        return out("fallback", "cov_rank_low", n, valid)
    plane = axes[:, 1:]
    p = px @ plane
    lo, hi = angles if 0 <= angles[0] < angles[1] <= 100 else (1.0, 99.0)
    found = [np.abs(_unit(plane @ [np.cos(t), np.sin(t)])) for t in np.percentile(np.arctan2(p[:, 1], p[:, 0]), [lo, hi])]
    score, h, e = max(((a @ h0 + b @ e0, a, b) for a, b in (found, found[::-1])), key=lambda x: x[0])
    dot = abs(h @ e)
    if dot >= max_dot or score < min_score:
        return out("fallback", "he_unstable", n, valid, score, dot)
    r = _unit(np.cross(h, e))
    if np.linalg.norm(r) <= 1e-8:
        r = r0
    return out("estimated", "ok", n, valid, score, dot, (h, e, -r if r @ r0 < 0 else r))


class Macenko:
    """Stain normalisation by the published method: fit on a reference tile, then bring other tiles to its stains."""

    def __init__(self, light=240.0, beta=0.15, alpha=1.0):
        self.light, self.beta, self.alpha, self.target = light, beta, alpha, None

    def _stains(self, rgb):
        d = -np.log((rgb.reshape(-1, 3).astype(np.float64) + 1) / self.light)
        strong = d[(d >= self.beta).all(1)]
        if len(strong) < 16:
            raise ValueError("too little stain")
        plane = np.linalg.eigh(np.cov(strong.T))[1][:, 1:]
        p = strong @ plane
        ends = [plane @ [np.cos(t), np.sin(t)] for t in np.percentile(np.arctan2(p[:, 1], p[:, 0]), [self.alpha, 100 - self.alpha])]
        a, b = (v if v.sum() >= 0 else -v for v in ends)
        he = np.array([a, b] if a[0] > b[0] else [b, a]).T
        amounts = np.linalg.lstsq(he, d.T, rcond=None)[0]
        return he, amounts, np.maximum(np.percentile(amounts, 99, axis=1), 1e-6)

    def fit(self, rgb):
        he, _, top = self._stains(rgb)
        self.target = he, top
        return self

    def normalize(self, rgb):
        _, amounts, top = self._stains(rgb)
        he, goal = self.target
        out = self.light * np.exp(-he @ (amounts * (goal / top)[:, None]))
        return np.clip(out.T.reshape(rgb.shape), 0, 255).astype(np.uint8)


# Tiles


def tile_metrics(rgb):
    """The quality metrics of a tile."""
    g = gray(rgb)
    h, s, v = hsv(rgb)
    he, eo = (np.round(c, 9) for c in unmixed(rgb))
    rbc = (scaled(eo, 5, 99) > 0.58) & (scaled(he, 5, 99) < 0.42) & (red_dominance(rgb) > 0.06)
    stained = (od(rgb).sum(-1) > 0.12) & ((rgb.max(-1).astype(int) - rgb.min(-1) >= 12) | (rgb.mean(-1) <= 245))
    pen = (v < 70) & (s > 18) | (h >= 25) & (h <= 110) & (s > 22) & (v < 250) | (h >= 85) & (h <= 140) & (s > 22) & (v < 250) | ((h >= 145) | (h <= 10)) & (s > 150) & (v < 245)
    return {
        "tissue_frac": float((stained & ~rbc).mean()),
        "focus": float(sobel(g).mean()),
        "brightness": float(rgb.mean()),
        "qc_artifact_frac": float((pen | (g < 70)).mean()),
        "qc_rbc_frac": float(rbc.mean()),
        "adipose_proxy": float((g > 240).mean() - 0.001 * laplacian(g).var()),
    }


def tile_features(rgb):
    """What the score of a tile is made of."""
    g = gray(rgb)
    h, s, v = hsv(rgb)
    he, eo = (np.round(c, 9) for c in unmixed(rgb))
    x = rgb.astype(np.int64)
    r, gr, b = x[..., 0], x[..., 1], x[..., 2]
    pen = (v < 90) & (s > 30) | (h >= 35) & (h <= 105) & (s > 45) & (v < 245) | (h >= 100) & (h <= 140) & (s > 45) & (v < 245) | ((h >= 145) | (h <= 10)) & (s > 140) & (v < 245)
    pool = (r > 140) & (r - gr > 35) & (r - b > 35)
    red = (r / 255.0 > 0.55) & ((r - gr) / 255.0 > 0.12) & ((r - b) / 255.0 > 0.12)
    rbc = (scaled(eo, 5, 99) > 0.58) & (scaled(he, 5, 99) < 0.42) & (red_dominance(rgb) > 0.06)
    return {
        "h_mean": float(he.mean()),
        "h_p90": float(np.percentile(he, 90)),
        "e_mean": float(eo.mean()),
        "blood_score": float(np.maximum(red_dominance(rgb), 0).mean() + 0.7 * red.mean() + 0.3 * (red & (he < np.percentile(he, 35))).mean()),
        "texture": float(laplacian(g).var()),
        "white_frac": float((g > 235).mean()),
        "artifact_frac": float((pen | pool | (g < 70)).mean()),
        "rbc_frac": float(rbc.mean()),
    }


def patch_verdict(rgb, white=230, black=15):
    """Why a training patch is bad, or ''."""
    whites, blacks, stained = (rgb >= white).all(-1).mean(), (rgb <= black).all(-1).mean(), (rgb < white).any(-1).mean()
    mean = rgb.mean()
    if mean < 10 or mean > 245:
        return "mean"
    if whites > 0.95:
        return "white"
    if blacks > 0.95:
        return "black"
    return "tissue" if stained < 0.20 else ""


def normaliser_verdict(rgb):
    """Why a tile is not normalised: dark ones first, then those with little tissue, else ''."""
    if (rgb <= 15).all(-1).mean() >= 0.95 or rgb.mean() <= 1:
        return "skip_black"
    return "skip_low_tissue" if (rgb < 230).any(-1).mean() < 0.20 else ""


def clean_mask(rgb, pen_s=140, pen_v=(40, 245), size=11, times=2):
    """Stained pixels away from pen marks of any colour."""
    _, s, v = hsv(rgb)
    pen = (s >= pen_s) & (v >= pen_v[0]) & (v <= pen_v[1])
    for _ in range(times):
        pen = dilate(pen, size)
    return (rgb < 230).any(-1) & ~black_canvas(rgb) & ~pen


def window_share(mask, ys, xs, half):
    """The share of mask pixels in the square around each point of ys by xs, clipped at the image."""
    total = np.pad(mask.astype(np.int64).cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    (y1, x1), (y2, x2) = ((np.maximum(v - half, 0) for v in (ys, xs)), (np.minimum(v + half + 1, n) for v, n in zip((ys, xs), mask.shape)))
    n = total[np.ix_(y2, x2)] - total[np.ix_(y1, x2)] - total[np.ix_(y2, x1)] + total[np.ix_(y1, x1)]
    return n / ((y2 - y1)[:, None] * (x2 - x1))


def augmented(rgb, seed, jitter=0.1):
    """A training tile flipped, turned by quarters, and with its colours and brightness shifted a little, by a seed alone."""
    r = np.random.default_rng(seed)
    out = rgb[:, ::-1] if r.random() < 0.5 else rgb
    out = out[::-1] if r.random() < 0.5 else out
    out = np.rot90(out, r.integers(4)).astype(np.float64)
    out = out * (1 + r.uniform(-jitter, jitter, 3)) + 255 * r.uniform(-jitter, jitter) / 2
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def overlay(rgb, mask, share=0.3, colour=(0, 255, 0)):
    """The image with the mask blended in."""
    out = rgb.astype(np.float64)
    out[mask] = (1 - share) * out[mask] + share * np.array(colour)
    return np.rint(out).astype(np.uint8)
