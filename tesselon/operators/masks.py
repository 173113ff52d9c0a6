"""Tissue masks: a fixed sequence of steps over layers of one image, a second try with looser thresholds, and status.

A step never sets a pixel that an exclusion found before it has claimed, so the exclusions are one growing set: pens,
edges, blood, black canvas, and later white background. Everything runs per image; a table of images is one mapInPandas.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions.shipping import map_pandas
from . import raster as R


@dataclass(frozen=True)
class MaskConfig:
    """Thresholds of the steps; areas are shares of the image, percentiles are of the valid pixels."""

    # The defaults.
    border_px: int = 10
    bright_gray: int = 244
    bright_sat: int = 20
    valid_gray: tuple[int, int] = (8, 252)
    od_percentile: float = 55
    score_min: float = 0.36
    loose_od_percentile: float = 35
    loose_score_min: float = 0.28
    od_cap: float | None = None
    rapid_cap: float | None = None
    weights: tuple[float, float, float] = (0.55, 0.30, 0.15)  # rapid, od, edge
    guard_gray: int = 242
    ink_dilate: int = 3
    green_dilate: int = 31
    green_value: int = 70
    dark_pen: bool = True
    dark_pen_value: int = 165
    dark_pen_sat: int = 12
    dark_pen_area: float = 3e-5
    dark_pen_edge: int = 96
    dark_pen_green: float = 0.001
    dark_pen_dilate: int = 5
    edge_strip: int = 48
    edge_sat: int = 30
    edge_value: int = 175
    rbc: tuple[float, float, float] = (0.58, 0.42, 0.06)  # eosin over, haematoxylin under, red over
    clots: bool = True
    clot_h: float = 0.30
    clot_e: float = 0.52
    clot_red: float = 0.12
    clot_sat: int = 55
    clot_gray: int = 205
    clot_edge: float = 0.55
    clot_residual: float = 0.82
    clot_hue: tuple[int, int] = (14, 170)
    clot_dilate: int = 5
    clot_area: float = 3.5e-4
    blood_is_background: bool = True
    close: int = 11
    open: int = 5
    hole_area: float = 2.5e-4
    part_area: float = 2e-4
    void_gray: int = 228
    void_sat: int = 24
    void_h: float = 0.22
    void_edge: float = 0.25
    pale_gray: int = 210
    pale_sat: int = 52
    pale_edge: float = 0.16
    pale_h: float = 0.24
    void_area: float = 3.5e-4
    void_overlap: float = 0.002
    void_near: float = 0.10
    void_margin: int = 4
    rescue_h: float = 0.34
    rescue_sat: int = 14
    rescue_edge: float = 0.03
    rescue_od: float = 0.08
    rescue_area: float = 3e-5
    soft: bool = True
    soft_od: float = 0.06
    soft_h: float = 0.14
    soft_sat: int = 10
    soft_gray: int = 242
    soft_area: float = 1.2e-4
    soft_white: float = 0.55
    soft_touch: float = 0.001
    soft_kernel: int = 11
    soft_edge: float = 0.02
    supplement: bool = False
    supplement_od: float = 0.08
    supplement_h: float = 0.16
    supplement_e: float = 0.10
    supplement_sat: int = 10
    supplement_gray: int = 242
    supplement_edge: float = 0.01
    supplement_kernel: int = 13
    supplement_area: float = 3e-5
    supplement_white: float = 0.35
    supplement_share: float = 0.15
    guard_px: int = 96
    guard_strict: tuple[float, float, float, int, int] = (0.12, 0.18, 0.22, 170, 120)  # od, h, score under; gray over, sat under
    guard_loose: tuple[float, float, float] = (0.18, 0.20, 0.35)
    rim_px: int = 8
    rim_h: float = 0.20
    rim_od: float = 0.22
    rim_white: float = 0.25
    rim_small: float = 0.0012
    crop_px: int = 16
    expected: tuple[float, float] = (0.15, 0.60)
    expected_effective: tuple[float, float] = (0.08, 0.80)
    trigger: tuple[float, float] | None = None
    sparse: bool = False
    stains: tuple = R.DEFAULT_STAINS
    dynamic_stains: bool = True


# Fixed values.
#: Named overlays of the defaults; a profile's values win over those given beside it.
PROFILES: dict[str, dict] = {
    "default": {},
    "scale_balanced_v1": {"soft": False, "supplement": True, "supplement_share": 0.12, "dark_pen": False, "guard_px": 128, "crop_px": 96, "blood_is_background": True},
    "sparse_canvas_pure_v1": {"sparse": True},
}


def configured(profile: str = "default", **given) -> MaskConfig:
    """The defaults with what is given, under the profile's values."""
    known = {f.name for f in fields(MaskConfig)}
    if unknown := set(given) - known:
        raise ValueError(f"no such settings: {sorted(unknown)}")
    return replace(MaskConfig(), **{**given, **PROFILES[profile]})


def _zone(shape, px, side_px=None):
    z = np.zeros(shape, bool)
    if px > 0:
        s = px if side_px is None else side_px
        z[:px], z[-px:], z[:, :s], z[:, -s:] = True, True, True, True
    return z


class _Layers:
    """What the steps look at: colour layers of the image with its border whitened, scaled by its valid pixels."""

    def __init__(self, rgb, c: MaskConfig):
        work = rgb.copy()
        if c.border_px > 0:
            work[_zone(rgb.shape[:2], c.border_px)] = 255
        self.rgb, self.gray = work, R.gray(work).astype(np.int64)
        self.hue, self.sat, self.value = R.hsv(work)
        self.canvas = R.black_canvas(work)
        bright = (self.gray >= c.bright_gray) & (self.sat <= c.bright_sat)
        self.bright = bright
        self.valid = ~self.canvas & ~bright & (self.gray >= c.valid_gray[0]) & (self.gray <= c.valid_gray[1])
        x = work.astype(np.float64)
        self.rapid = np.maximum(0.5 * (x[..., 0] + x[..., 2]) - x[..., 1], 0)
        density = R.od(work)
        self.od = density.sum(-1)
        h, e, r = R.unmixed3(density, c.stains)
        edge = R.sobel(R.blur5(self.gray))
        self.rapid_n, self.od_n, self.edge = (R.scaled(a, lo, hi, self.valid) for a, lo, hi in ((self.rapid, 5, 98), (self.od, 10, 98), (edge, 30, 99)))
        self.h, self.e, self.residual = (R.scaled(a, 5, 99, self.valid) for a in (h, e, r))
        self.red = R.red_dominance(work)
        self.score = c.weights[0] * self.rapid_n + c.weights[1] * self.od_n + c.weights[2] * self.edge
        self.white = (self.gray >= 240) & (self.sat <= 20)


def _base(a: _Layers, c: MaskConfig, loose: bool):
    some = a.valid if a.valid.any() else np.ones_like(a.valid)
    rapid_min = R.otsu(a.rapid[some])
    od_min = np.percentile(a.od[some], c.loose_od_percentile if loose else c.od_percentile)
    rapid_min = rapid_min if c.rapid_cap is None else min(rapid_min, c.rapid_cap)
    od_min = od_min if c.od_cap is None else min(od_min, c.od_cap)
    score_min = c.loose_score_min if loose else c.score_min
    signal = (a.rapid >= rapid_min) | (a.od >= od_min)
    return signal & (a.score >= score_min) & a.valid & ~((a.gray >= c.guard_gray) & (a.sat <= c.bright_sat)), {"od_min": float(od_min), "rapid_min": float(rapid_min), "score_min": score_min}


def _pens(a: _Layers, c: MaskConfig):
    h, s, v = a.hue, a.sat, a.value
    ink = (v < 70) & (s > 18) | (h >= 25) & (h <= 110) & (s > 22) & (v < 250) | (h >= 85) & (h <= 140) & (s > 22) & (v < 250) | ((h >= 145) | (h <= 10)) & (s > 150) & (v < 245)
    if c.ink_dilate > 1:
        ink = R.dilate(ink, R.odd(c.ink_dilate))
    ink &= ~a.canvas
    core = (h >= 25) & (h <= 110) & (s > 22) & (v > c.green_value) & ~a.canvas
    near = R.dilate(core, R.odd(c.green_dilate))
    ink |= near
    if c.dark_pen:
        parts = R.Components((v < c.dark_pen_value) & (s > c.dark_pen_sat) & ~a.canvas)
        by_green = parts.mean(near) * parts.area / parts.mask.size >= c.dark_pen_green
        dark = parts.only((parts.area >= R.min_area(c.dark_pen_area, parts.mask.size)) & (parts.near_border(c.dark_pen_edge) | by_green))
        ink |= R.dilate(dark, R.odd(c.dark_pen_dilate)) if c.dark_pen_dilate > 1 else dark
    return ink


def _blood(a: _Layers, c: MaskConfig, ink):
    x = a.rgb.astype(np.int64)
    like = (x[..., 0] > 140) & (x[..., 0] - x[..., 1] > 30) & (x[..., 0] - x[..., 2] > 25) & (a.sat > 35)
    rbc = (a.e > c.rbc[0]) & (a.h < c.rbc[1]) & (a.red > c.rbc[2]) & ~a.canvas
    clot = np.zeros_like(rbc)
    if c.clots:
        clot = like & (a.h <= c.clot_h) & (a.e >= c.clot_e) & (a.red >= c.clot_red) & (a.sat >= c.clot_sat) & (a.gray <= c.clot_gray) & ~ink & ~a.canvas
        clot &= (a.residual <= c.clot_residual) & ((a.hue <= c.clot_hue[0]) | (a.hue >= c.clot_hue[1])) & (a.edge <= c.clot_edge)
        if c.clot_dilate > 1:
            clot = R.dilate(clot, R.odd(c.clot_dilate))
        clot = R.large_only(clot, c.clot_area)
    return rbc, clot, rbc | clot if c.blood_is_background else clot


def build_mask(rgb, c: MaskConfig = MaskConfig(), loose: bool = False):
    """(mask, statistics) of an image; loose: with the thresholds of the second try."""
    a = _Layers(rgb, c)
    shape, size = a.gray.shape, a.gray.size
    base, stats = _base(a, c, loose)
    ink = _pens(a, c)
    strip = min(c.edge_strip, max(1, min(shape) // 3)) if c.edge_strip > 0 else 0
    edge_art = _zone(shape, strip, max(8, strip // 2)) & (a.sat < c.edge_sat) & (a.value > c.edge_value) if strip else np.zeros(shape, bool)
    rbc, clot, blood = _blood(a, c, ink)
    out_of = ink | edge_art | blood | a.canvas

    clean = R.opened(R.closed(base & ~out_of, R.odd(c.close)), R.odd(c.open))
    clean = R.large_only(R.holes_filled(clean, c.hole_area), c.part_area) & ~out_of

    hard = (a.gray >= c.void_gray) & (a.sat <= c.void_sat)
    pale = (a.gray >= c.pale_gray) & (a.sat <= c.pale_sat) & (a.edge <= c.pale_edge) & (a.h <= c.pale_h)
    background = hard & (a.h <= c.void_h) & (a.edge <= c.void_edge)
    clean &= ~background
    voids = R.Components((hard | pale) & ~a.canvas)
    gap = (voids.mean(clean) >= c.void_overlap) | (voids.mean(R.dilate(clean, 9)) >= c.void_near) & ~voids.near_border(c.void_margin)
    cavity = voids.only((voids.area >= R.min_area(c.void_area, size)) & gap)
    clean &= ~cavity
    out_of = out_of | background
    may = a.valid & ~out_of

    rescue = R.large_only((a.h >= c.rescue_h) & (a.sat >= c.rescue_sat) & (a.edge >= c.rescue_edge) & (a.od_n >= c.rescue_od) & may, c.rescue_area)
    clean = (clean | rescue) & ~out_of

    soft = np.zeros(shape, bool)
    if c.soft:
        parts = R.Components(may & ((a.od_n >= c.soft_od) & (a.gray <= c.soft_gray) | (a.h >= c.soft_h) | (a.sat >= c.soft_sat)))
        keep = (parts.area >= R.min_area(c.soft_area, size)) & (parts.mean(a.white) <= c.soft_white) & (parts.mean(a.edge) >= c.soft_edge)
        soft = parts.only(keep & (parts.mean(R.dilate(clean, R.odd(c.soft_kernel))) >= c.soft_touch))
        clean = (clean | soft) & ~out_of

    added = np.zeros(shape, bool)
    if c.supplement and clean.any():
        near = R.dilate(clean, R.odd(c.supplement_kernel)) & ~clean & may
        near &= (a.gray <= c.supplement_gray) & (a.sat >= c.supplement_sat) & (a.edge >= c.supplement_edge) & (a.od_n >= c.supplement_od) & ((a.h >= c.supplement_h) | (a.e >= c.supplement_e))
        parts = R.Components(near)
        added = parts.only((parts.area >= R.min_area(c.supplement_area, size)) & (parts.mean(a.white) <= c.supplement_white))
        most = max(1, round(c.supplement_share * max(1, int(clean.sum()))))
        if added.sum() > most:  # the best by score, the first of equal ones
            at = np.flatnonzero(added)
            added = np.zeros(size, bool)
            added[at[np.argsort(-a.score.ravel()[at], kind="stable")[:most]]] = True
            added = added.reshape(shape)
        clean = (clean | added) & ~out_of

    zone = _zone(shape, min(c.guard_px, max(1, min(shape) // 3))) if c.guard_px > 0 else np.zeros(shape, bool)
    od, h, score, gray, sat = c.guard_strict
    false = zone & (a.od_n <= od) & (a.h <= h) & (a.score <= score) & (a.gray >= gray) & (a.sat <= sat)
    od, h, score = c.guard_loose
    false |= zone & (a.od_n <= od) & (a.h <= h) & (a.score <= score)
    clean &= ~false

    rim = np.zeros(shape, bool)
    if c.rim_px > 0:
        parts = R.Components(clean)
        h, od = parts.mean(a.h), parts.mean(a.od_n)
        pale_part = (h <= c.rim_h) & (od <= c.rim_od) & (parts.mean((a.gray >= 232) & (a.sat <= 35)) >= c.rim_white)
        small = (parts.area <= R.min_area(c.rim_small, size)) & (h <= c.rim_h + 0.05) & (od <= c.rim_od + 0.05)
        rim = parts.only(parts.near_border(c.rim_px) & (pale_part | small))
        clean &= ~rim
    crop = _zone(shape, min(c.crop_px, max(1, min(shape) // 8))) & clean if c.crop_px > 0 else np.zeros(shape, bool)
    clean &= ~crop
    shares = {"mask": clean, "ink": ink, "edge_art": edge_art, "rbc_like": rbc, "clot_like": clot, "drop_blood_like": blood, "large_white_void": cavity, "pale_void": pale, "hard_white_bg": background, "h_rescue": rescue}
    shares |= {"soft_rescue": soft, "supplement_added": added, "edge_false": false, "border_drop": rim, "edge_crop_removed": crop, "black_canvas": a.canvas, "bg_white": a.bright, "valid_stats": a.valid}
    return clean, {**stats, "mode": "fallback" if loose else "primary", **{f"{k}_frac": float(v.mean()) for k, v in shares.items()}}


def _band(value, low, high):
    return "low_tissue" if value < low else "high_tissue" if value > high else "ok"


def with_stains(rgb, c: MaskConfig) -> tuple[MaskConfig, str]:
    """The settings with the image's own stain vectors where they can be estimated, and where they come from."""
    if not c.dynamic_stains:
        return c, "static"
    found = R.stain_vectors(rgb, default=c.stains)
    return replace(c, stains=(tuple(found["h"]), tuple(found["e"]), tuple(found["r"]))), found["source"]


def status_fields(rgb, mask, c: MaskConfig = MaskConfig()) -> dict:
    """The mask's share of the image and of what is no black canvas, and the status that each earns."""
    seen = ~R.black_canvas(rgb)
    frac, effective = float(mask.mean()), float(mask.sum() / max(1, int(seen.sum())))
    status = _band(frac, *c.expected)
    return {
        "mask_frac": frac,
        "mask_frac_effective": effective,
        "non_black_frac": float(seen.mean()),
        "mask_status": status,
        "mask_status_effective": _band(effective, *c.expected_effective) if c.sparse else status,
        "status_basis": "effective" if c.sparse else "global",
    }


def best_mask(rgb, c: MaskConfig = MaskConfig()):
    """(mask, fields): the strict mask, or the loose one where the strict one is out of its band and the loose one is nearer."""
    band, key = (c.expected_effective, "mask_frac_effective") if c.sparse else (c.expected, "mask_frac")
    low, high = c.trigger or band

    def tried(loose):
        mask, stats = build_mask(rgb, c, loose)
        return mask, stats | status_fields(rgb, mask, c)

    def off(x):
        return max(band[0] - x, x - band[1], 0.0)

    mask, got = tried(False)
    attempted = not low <= got[key] <= high
    used = False
    if attempted:
        other = tried(True)
        if used := off(other[1][key]) < off(got[key]):
            mask, got = other
    return mask, got | {"fallback_used": used, "fallback_attempted": attempted}


def white_leak(rgb, mask, c: MaskConfig = MaskConfig()):
    """The share of the mask that looks white."""
    white = (R.gray(rgb) >= c.void_gray) & (R.hsv(rgb)[1] <= c.void_sat)
    return float((mask & white).sum() / max(1, int(mask.sum())))


def roi_retry(rgb, mask, fine_rgb, box, c: MaskConfig = MaskConfig(), *, min_gain=0.0015, min_added=3000, min_nonwhite=0.85, max_leak=0.01):
    """(mask, accepted): a finer view of a region (x1, y1, x2, y2) is masked and joined where that gains tissue and no glare."""
    x1, y1, x2, y2 = box
    part, _ = best_mask(fine_rgb, c)
    new = mask.copy()
    new[y1:y2, x1:x2] |= R.resize_nearest(part, y2 - y1, x2 - x1)
    gained = new & ~mask
    white = (R.gray(rgb) >= c.void_gray) & (R.hsv(rgb)[1] <= c.void_sat)
    nonwhite = float((gained & ~white).sum() / max(1, int(gained.sum())))
    ok = (gained.mean() >= min_gain or gained.sum() >= min_added) and nonwhite >= min_nonwhite
    ok = ok and white_leak(rgb, new, c) - white_leak(rgb, mask, c) <= max_leak and status_fields(rgb, new, c)["mask_status_effective"] != "high_tissue"
    return (new, True) if ok else (mask, False)


FIELDS = "img string, h int, w int, mask binary, mask_frac double, mask_frac_effective double, mask_status string, mask_status_effective string, status_basis string, fallback_used boolean, fallback_attempted boolean, stain_source string, white_leak double, error_type string, error_message string"


def mask_table(images: DataFrame, c: MaskConfig = MaskConfig(), suffix: str | None = None) -> DataFrame:
    """Masks and their status for a table of images (img, h, w, rgb); an image that fails becomes a row with its error.

    With the name of a column of file suffixes, images on a sparse canvas get the sparse profile.
    """
    names = [f.split()[0] for f in FIELDS.split(", ")]
    cols = ["img", "h", "w", "rgb", *([suffix] if suffix else [])]

    def run(frames):
        import pandas as pd

        for frame in frames:
            rows = []
            for img, h, w, data, *ext in frame[cols].itertuples(index=False):
                row = dict.fromkeys(names) | {"img": img, "h": h, "w": w}
                try:
                    rgb = np.frombuffer(data, np.uint8).reshape(int(h), int(w), 3)
                    own = c
                    if ext and (str(ext[0]).lower() == ".mrxs" or R.black_canvas(rgb).mean() >= 0.75 or R.bbox_fraction(rgb) <= 0.15):
                        own = replace(c, **PROFILES["sparse_canvas_pure_v1"])
                    own, source = with_stains(rgb, own)
                    mask, got = best_mask(rgb, own)
                    got["stain_source"] = source
                    row |= {k: v for k, v in got.items() if k in row} | {"mask": np.packbits(mask).tobytes(), "white_leak": white_leak(rgb, mask, own)}
                except Exception as e:  # one bad image must not end the others
                    row |= {"mask_status": "mask_error", "mask_status_effective": "mask_error", "error_type": type(e).__name__, "error_message": " ".join(str(e).split())[:500]}
                rows.append(row)
            yield pd.DataFrame(rows, columns=names)

    return map_pandas(images.select(*cols), run, FIELDS)


def kernel_table(images: DataFrame, *kernels: str, keep: tuple[str, ...] = ("img",)) -> DataFrame:
    """The columns `keep` and the numbers of the kernels (`tile_metrics`, `tile_features`) for a table of images (h, w, rgb), in one pass."""
    functions = [getattr(R, k) for k in kernels]
    names = [n for f in functions for n in f(np.zeros((4, 4, 3), np.uint8))]

    def run(frames):
        import pandas as pd

        for frame in frames:
            rows = []
            for h, w, data in frame[["h", "w", "rgb"]].itertuples(index=False):
                rgb = np.frombuffer(data, np.uint8).reshape(int(h), int(w), 3)
                rows.append({k: v for f in functions for k, v in f(rgb).items()})
            yield pd.concat([frame[list(keep)].reset_index(drop=True), pd.DataFrame(rows, columns=names)], axis=1)

    schema = T.StructType([*(images.schema[c] for c in keep), *(T.StructField(n, T.DoubleType()) for n in names)])
    return map_pandas(images.select(*keep, "h", "w", "rgb"), run, schema)
