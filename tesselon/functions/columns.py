"""Scalar functions, Column to Column: names, tolerant casts, statuses, geometry and small vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Names


def known(x) -> Column:
    """A number, with NaN as null: comparisons with it are then as false as they are for an array."""
    return F.nanvl(_c(x).cast("double"), F.lit(None).cast("double"))


def is_known(x) -> Column:
    """Neither null nor NaN, as two conditions, of which a scan takes the first."""
    return _c(x).isNotNull() & ~F.isnan(_c(x))


def sanitize_part(text, max_len: int = 80) -> Column:
    """A safe part of a file name: runs of other characters become one underscore, outer dots and underscores go."""
    s = F.regexp_replace(F.trim(_c(text)), r"\\", "/")
    s = F.regexp_replace(F.regexp_replace(s, "[^A-Za-z0-9._-]+", "_"), "_+", "_")
    s = F.regexp_replace(s, "^[._]+|[._]+$", "")
    return F.substring(F.when(s == "", F.lit("item")).otherwise(s), 1, max_len)


def sanitize_stem(stem) -> Column:
    """A safe file stem: blanks to underscores, colons and dots to hyphens, runs collapsed, ends trimmed."""
    s = F.regexp_replace(F.regexp_replace(_c(stem), r"\s+", "_"), "[:.]", "-")
    s = F.regexp_replace(F.regexp_replace(s, "_+", "_"), "-+", "-")
    return F.regexp_replace(s, "^[_-]+|[_-]+$", "")


def file_name(path) -> Column:
    return F.element_at(F.split(_c(path), "/"), -1)


def file_stem(path) -> Column:
    """The file name without its last suffix; a leading dot begins no suffix."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def file_suffix(path) -> Column:
    """The last suffix in lower case, with its dot, or ''."""
    return F.lower(F.regexp_extract(file_name(path), r".(\.[^.]+)$", 1))


def relative_stem(root, path) -> Column:
    """The path below root without suffix; of a path outside of root, its file stem."""
    top = F.concat(F.regexp_replace(_c(root), "/+$", ""), F.lit("/"))
    rel = F.when(F.startswith(_c(path), top), F.substr(_c(path), F.length(top) + 1)).otherwise(file_name(path))
    return F.regexp_replace(rel, r"(?<=[^/])\.[^./]*$", "")


def slide_uid(center, rel_stem) -> Column:
    """center, stem and a digest of both, so that equal names in different folders stay apart."""
    rel = F.regexp_replace(F.regexp_replace(_c(rel_stem), r"\\", "/"), "^/+|/+$", "")
    digest = F.substring(F.sha1(F.concat(_c(center), F.lit("::"), rel)), 1, 10)
    return F.concat_ws("__", sanitize_part(center, 40), sanitize_part(file_name(rel), 80), digest)


def slide_key(uid, slide_id) -> Column:
    """The uid, or the id where the uid is missing or blank."""
    return F.coalesce(F.nullif(F.trim(_c(uid)), F.lit("")), F.trim(_c(slide_id)))


def slide_match(slide_id, uid, path, query) -> Column:
    q = F.trim(_c(query))
    return F.coalesce((F.trim(_c(slide_id)) == q) | (F.trim(_c(uid)) == q) | (file_stem(path) == q), F.lit(False))


def patch_name(slide, x, y, mpp, read_px) -> Column:
    return F.format_string("%s__x%d__y%d__mpp%.3f__r%d", _c(slide), _c(x), _c(y), _c(mpp), _c(read_px))


def ranked_name(rank, x, y, prob) -> Column:
    return F.format_string("%05d_x%d_y%d_p%.4f.png", _c(rank), _c(x), _c(y), _c(prob))


def patch_name_parts(name) -> dict[str, Column]:
    """slide_id, x, y, mpp and read_px of a patch file name; null where a part is missing."""
    def number(pattern, kind):
        return F.nullif(F.regexp_extract(_c(name), pattern, 1), F.lit("")).try_cast(kind)

    return {
        "slide_id": F.substring_index(_c(name), "__x", 1),
        "x": number(r"__x(-?\d+)", "int"),
        "y": number(r"__y(-?\d+)", "int"),
        "mpp": number(r"__mpp(\d+(?:\.\d+)?)", "double"),
        "read_px": number(r"__r(\d+)", "int"),
    }


def epoch_of(path) -> Column:
    return F.nullif(F.regexp_extract(_c(path), r"epoch(\d+)", 1), F.lit("")).try_cast("int")


def normalize_header(name) -> Column:
    return F.lower(F.trim(_c(name)))


def squeeze(text, most: int = 500) -> Column:
    """Error text on one line."""
    return F.substring(F.trim(F.regexp_replace(_c(text), r"\s+", " ")), 1, most)


def duration(seconds) -> Column:
    """Seconds as 1h02m03s, 2m03s or 3s."""
    s = F.floor(_c(seconds)).cast("long")
    h, m, r = F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"), s % 60
    return F.when(h > 0, F.format_string("%dh%02dm%02ds", h, m, r)).when(m > 0, F.format_string("%dm%02ds", m, r)).otherwise(F.format_string("%ds", r))


def content_hash(content) -> Column:
    return F.md5(_c(content))


# Tolerant casts


def to_bool(text) -> Column:
    """1, true, t, yes and y in any case are true, all else and null are false."""
    return F.coalesce(F.lower(F.trim(_c(text).cast("string"))).isin("1", "true", "t", "yes", "y"), F.lit(False))


def to_bool_or(text, default: bool | None = None) -> Column:
    """As to_bool, with 0, false, f, no and n as false and the default for all else."""
    s = F.lower(F.trim(_c(text).cast("string")))
    return F.when(s.isin("1", "true", "t", "yes", "y"), F.lit(True)).when(s.isin("0", "false", "f", "no", "n"), F.lit(False)).otherwise(F.lit(default).cast("boolean"))


def to_int(text, default: int = 0) -> Column:
    """Whole numbers, decimal ones cut off towards zero; the default for all else."""
    x = F.trim(_c(text).cast("string")).try_cast("double")
    return F.coalesce(F.nanvl(x, F.lit(None).cast("double")).try_cast("long"), F.lit(default).cast("long"))


def to_float(text, default: float | None = None) -> Column:
    x = F.trim(_c(text).cast("string")).try_cast("double")
    return F.coalesce(F.nanvl(x, F.lit(None).cast("double")), F.lit(default).cast("double"))


# Statuses


def missing(text) -> Column:
    """Null, blank, nan and none in any case."""
    return F.coalesce(F.lower(F.trim(_c(text))).isin("", "nan", "none"), F.lit(True))


def resolved_status(effective, overall, unknown: str = "unknown") -> Column:
    """The effective status unless it is missing, else the overall one."""
    return F.when(~missing(effective), F.trim(_c(effective))).otherwise(F.coalesce(_c(overall), F.lit(unknown)))


def status_list(text, default: str = "ok") -> Column:
    """Comma-separated statuses, trimmed and in lower case, without empty ones."""
    found = F.filter(F.transform(F.split(F.coalesce(_c(text), F.lit("")), ","), lambda s: F.lower(F.trim(s))), lambda s: s != "")
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(default)))


def band_status(value, low, high) -> Column:
    return F.when(_c(value) < low, "low_tissue").when(_c(value) > high, "high_tissue").otherwise("ok")


def tumor_band(prob, high: float = 0.738, mid: float = 0.5) -> Column:
    return F.when(_c(prob) >= high, "high").when(_c(prob) >= mid, "mid").otherwise("low")


def readiness_reason(high_only, scored, ratio, min_high: int, min_scored: int, min_ratio: float) -> Column:
    """The first gate that fails, or ''."""
    return (
        F.when(_c(high_only) < min_high, f"high_tumor_only<{min_high}")
        .when(_c(scored) < min_scored, f"scored_ok<{min_scored}")
        .when(_c(ratio) < min_ratio, f"high_ratio<{min_ratio:.2f}")
        .otherwise("")
    )


def sparse_canvas(suffix, black_frac, bbox_frac, black_min: float = 0.75, bbox_max: float = 0.15) -> Column:
    return (_c(black_frac) >= black_min) | (_c(bbox_frac) <= bbox_max) | (F.lower(F.trim(_c(suffix))) == ".mrxs")


def retry_accepted(gain, added_px, nonwhite, leak_delta, status, min_gain: float = 0.0015, min_added: int = 3000, min_nonwhite: float = 0.85, max_leak: float = 0.01) -> Column:
    return ((_c(gain) >= min_gain) | (_c(added_px) >= min_added)) & (_c(nonwhite) >= min_nonwhite) & (_c(leak_delta) <= max_leak) & (_c(status) != "high_tissue")


def band_distance(value, low, high) -> Column:
    return F.greatest(F.lit(low) - _c(value), _c(value) - F.lit(high), F.lit(0.0))


# Geometry: half-way values round to even


def to_level0(mask_xy, downsample) -> Column:
    return F.bround(_c(mask_xy).cast("float").cast("double") * _c(downsample)).cast("int")


def clamp(x, low, high) -> Column:
    return F.greatest(low, F.least(_c(x), high))


def clamp_origin(x, canvas, read) -> Column:
    """The start of a window of `read` pixels that lies inside the canvas where it can."""
    return clamp(x, F.lit(0), F.greatest(F.lit(0), _c(canvas) - read))


def window_inside(x, y, read, width, height) -> Column:
    """Whether a window of `read` pixels from x, y lies wholly inside the slide."""
    return (_c(x) >= 0) & (_c(y) >= 0) & (_c(x) + F.lit(read) <= _c(width)) & (_c(y) + F.lit(read) <= _c(height))


def grid_step(stride, downsample) -> Column:
    """Steps of the candidate grid in mask pixels, halved on fine masks."""
    step = F.greatest(F.lit(4), F.bround(_c(stride) / _c(downsample)).cast("int"))
    return F.when(_c(downsample) <= 16, F.greatest(F.lit(4), F.floor(step / 2).cast("int"))).otherwise(step)


def read_pixels(mpp, target_mpp: float, out: int) -> Column:
    return F.greatest(F.bround(F.lit(float(out)) * target_mpp / _c(mpp)).cast("int"), F.lit(out))


def expanded(low, high, size, pad_px, pad_frac) -> tuple[Column, Column]:
    """An interval widened by the larger of a fixed and a relative pad, inside 0..size."""
    pad = F.greatest(F.lit(pad_px), F.bround((_c(high) - _c(low)) * pad_frac).cast("int"))
    return F.greatest(F.lit(0), _c(low) - pad), F.least(_c(size), _c(high) + pad)


def mpp(props) -> Column:
    """Microns a pixel from a map of slide properties: both axes, the vendor's, or guessed from the objective power."""
    p = _c(props)
    x, y, own = (F.element_at(p, k).try_cast("double") for k in ("openslide.mpp-x", "openslide.mpp-y", "aperio.MPP"))
    power = F.coalesce(F.element_at(p, "openslide.objective-power"), F.element_at(p, "aperio.AppMag")).try_cast("double")
    return F.when((x > 0) & (y > 0), (x + y) / 2).when(own > 0, own).when(power >= 40, 0.25).when(power >= 20, 0.5)


def bounds(x, y, w, h, canvas_w, canvas_h, clamped: bool = False) -> list[Column]:
    """The bounds of a slide's content if all four are known, else its canvas; clamped: inside the canvas."""
    x, y, w, h, cw, ch = map(_c, (x, y, w, h, canvas_w, canvas_h))
    known = x.isNotNull() & y.isNotNull() & w.isNotNull() & h.isNotNull()
    bx, by, bw, bh = (F.when(known, a).otherwise(b) for a, b in ((x, F.lit(0)), (y, F.lit(0)), (w, cw), (h, ch)))
    if clamped:
        bx, by = clamp(bx, F.lit(0), cw), clamp(by, F.lit(0), ch)
        bw, bh = F.least(bw, cw - bx), F.least(bh, ch - by)
    return [bx, by, bw, bh]


# Small vectors


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def unit(a) -> Column:
    """The vector at length 1; vectors next to 0 stay as they are."""
    n = norm(a)
    return F.transform(_c(a), lambda x: F.when(n > 1e-8, x.cast("double") / n).otherwise(x.cast("double")))


def cosine(a, b) -> Column:
    """The cosine, -1 if a vector is next to 0."""
    n = norm(a) * norm(b)
    return F.when(n > 1e-8, dot(a, b) / n).otherwise(F.lit(-1.0))


def cross(a, b) -> Column:
    a, b = _c(a), _c(b)
    return F.array(a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def vector3(text) -> Column:
    """Three finite numbers from text like '0.6, 0.7, 0.3', else null."""
    v = F.transform(F.split(_c(text), r"\s*,\s*"), lambda s: F.trim(s).try_cast("double"))
    return F.when((F.size(v) == 3) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)), v)
