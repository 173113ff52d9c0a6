"""Queries over slides that are opened and read: levels, tiles, thumbnails, scores, features, mining and a run of stages.

A slide stands for each supplier: its pixels are whole-number arithmetic of its key, so SQL makes the same ones, and the
number of slides grows with the tables. Every tenth slide cannot be opened.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions.shipping import map_pandas
from ..operators import gate, masks, raster, summary, training
from ..sources import plugins
from . import run, stages
from .base import PIXELS, SIDE, query, table
from .q_more import _grown, _kernel, scratch
from .q_pixels import _GRAY, _HSV, _OD

WIDE = 64


class PlainSlide:
    """Tissue of a little colour, and a bright ground from column 48 on; outside of it all is white."""

    def __init__(self, path: str):
        self.k = int(path.rsplit("/", 1)[1].removesuffix(".svs"))
        if self.k % 10 == 9:
            raise OSError("unreadable")

    def levels(self):
        return [(WIDE, WIDE, 1.0), (WIDE // 4, WIDE // 4, 4.0)]

    def properties(self):
        return {"openslide.mpp-x": "0.25", "openslide.mpp-y": "0.25"}

    def read(self, x0, y0, level, w, h):
        step = int(self.levels()[level][2])
        y, x = np.mgrid[:h, :w] * step
        x, y = x + x0, y + y0
        mix = (x * 7 + y * 13 + self.k * 5) % 41
        ground = x >= 48
        out = np.stack([np.where(ground, 240 + mix % 10, 120 + mix), np.where(ground, 241, 90 + (x * 3 + y * self.k) % 37), np.where(ground, 239, 130 + (mix * 3 + y) % 39)], -1)
        out[(x < 0) | (y < 0) | (x >= WIDE) | (y >= WIDE)] = 255
        return out.astype(np.uint8)


class QuarterMeans:
    """Channel means of each quarter of a tile."""

    dim = 12

    def encode(self, tiles):
        n, h, w, _ = tiles.shape
        return np.concatenate([tiles[:, a : a + h // 2, b : b + w // 2].reshape(n, -1, 3).mean(1) for a in (0, h // 2) for b in (0, w // 2)], axis=1).astype(np.float32)


def opened(spark, sf):
    """(slide_uid, path, k) of every slide."""
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(F.concat(F.lit("S"), k.cast("string")).alias("slide_uid"), F.concat(F.lit("/plain/"), k.cast("string"), F.lit(".svs")).alias("path"), k.cast("long").alias("k"))


def spots(spark, sf):
    """Four windows of each slide, all of them inside."""
    k, i = F.col("k"), F.col("patch_id")
    rows = opened(spark, sf).withColumn("patch_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))))
    return rows.select("slide_uid", "path", "patch_id", (4 + (k * 3 + i * 11) % 40).cast("int").alias("x0"), ((k * 7 + i * 13) % 48).cast("int").alias("y0"))


SLIDES = f"""slides AS (SELECT 'S' || s_suppkey AS slide_uid, s_suppkey::BIGINT AS k, s_suppkey % 10 = 9 AS bad FROM supplier),
xy AS (SELECT slide_uid, k, i // {WIDE} AS y, i % {WIDE} AS x, ((i % {WIDE}) * 7 + (i // {WIDE}) * 13 + k * 5) % 41 AS mix FROM (SELECT *, unnest(range({WIDE * WIDE})) AS i FROM slides WHERE NOT bad)),
px AS (SELECT slide_uid, x, y, CASE WHEN x >= 48 THEN 240 + mix % 10 ELSE 120 + mix END AS r, CASE WHEN x >= 48 THEN 241 ELSE 90 + (x * 3 + y * k) % 37 END AS g, CASE WHEN x >= 48 THEN 239 ELSE 130 + (mix * 3 + y) % 39 END AS b FROM xy)"""
SPOTS = "spots AS (SELECT slide_uid, bad, patch_id, 4 + (k * 3 + patch_id * 11) % 40 AS x0, (k * 7 + patch_id * 13) % 48 AS y0 FROM (SELECT *, unnest(range(4))::BIGINT AS patch_id FROM slides))"
_BAD = "CASE WHEN bad THEN 'OSError: unreadable' END"
_SUMS = "sum(r * w)::BIGINT AS r, sum(g * w)::BIGINT AS g, sum(b * w)::BIGINT AS b"


def _summed(tiles, *keep):
    """Sums of each channel, weighted by place, in place of the pixels."""
    def sums(frames):
        for frame in frames:
            out = []
            for h, w, data in frame[["h", "w", "rgb"]].itertuples(index=False):
                x = np.frombuffer(data, np.uint8).reshape(-1, 3).astype(np.int64) if data is not None else None
                out.append([None] * 3 if x is None else (x * np.arange(1, len(x) + 1)[:, None]).sum(0).tolist())
            frame = frame[list(keep)].copy()
            for c, v in zip("rgb", zip(*out) if out else [()] * 3):
                frame[c] = list(v)
            yield frame

    kinds = dict(tiles.dtypes)
    return map_pandas(tiles.select(*keep, "h", "w", "rgb"), sums, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", r long, g long, b long")


@query("""WITH s AS (SELECT 'S' || s_suppkey AS slide_uid, s_suppkey % 10 = 9 AS bad FROM supplier)
SELECT slide_uid, level::INT AS level, width::INT AS width, width::INT AS height, downsample::DOUBLE AS downsample, 0.25::DOUBLE AS mpp, NULL::VARCHAR AS error FROM s, (VALUES (0, 64, 1), (1, 16, 4)) v(level, width, downsample) WHERE NOT bad
UNION ALL SELECT slide_uid, NULL, NULL, NULL, NULL, NULL, 'OSError: unreadable' FROM s WHERE bad""")
def k_slide_levels(spark, sf):
    """The levels of every slide; one that cannot be opened has its error."""
    return plugins.slide_levels(opened(spark, sf), PlainSlide)


@query(f"""WITH {SLIDES}, {SPOTS}, t AS (SELECT s.slide_uid, patch_id, (x - x0) // 2 + 8 * ((y - y0) // 2) + 1 AS w, round_even(avg(r), 0) AS r, round_even(avg(g), 0) AS g, round_even(avg(b), 0) AS b
  FROM spots s JOIN px p ON p.slide_uid = s.slide_uid AND x BETWEEN x0 AND x0 + 15 AND y BETWEEN y0 AND y0 + 15 GROUP BY 1, 2, 3),
u AS (SELECT slide_uid, patch_id, {_SUMS} FROM t GROUP BY ALL)
SELECT s.slide_uid, s.patch_id, {_BAD} AS error, r, g, b FROM spots s LEFT JOIN u USING (slide_uid, patch_id)""")
def k_read_tiles(spark, sf):
    """Windows read and brought to half their size by means over areas; reads that fail are counted, not fatal."""
    return _summed(plugins.read_tiles(spots(spark, sf), PlainSlide, 8, 16), "slide_uid", "patch_id", "error")


@query(f"""WITH {SLIDES}, u AS (SELECT slide_uid, {_SUMS} FROM (SELECT *, x // 4 + 16 * (y // 4) + 1 AS w FROM px WHERE x % 4 = 0 AND y % 4 = 0) GROUP BY slide_uid)
SELECT slide_uid AS img, CASE WHEN NOT bad THEN 1 END::INT AS level, CASE WHEN NOT bad THEN 4 END::DOUBLE AS downsample, {_BAD} AS error, r, g, b FROM slides LEFT JOIN u USING (slide_uid)""")
def k_thumbnails(spark, sf):
    """The level that is nearest to a downsample, whole."""
    return _summed(plugins.thumbnails(opened(spark, sf), PlainSlide, 5.0), "img", "level", "downsample", "error")


_EIGHT = "spots s JOIN px p ON p.slide_uid = s.slide_uid AND x BETWEEN x0 AND x0 + 7 AND y BETWEEN y0 AND y0 + 7"


@query(f"""WITH {SLIDES}, {SPOTS}, u AS (SELECT s.slide_uid, patch_id, least(greatest(avg((r + b) / 2.0::DOUBLE - g) / 80, 0), 1) AS p FROM {_EIGHT} GROUP BY 1, 2)
SELECT s.slide_uid, patch_id, p AS tumor_prob, {_BAD} AS error FROM spots s LEFT JOIN u USING (slide_uid, patch_id)""")
def k_scored_tiles(spark, sf):
    """A model's probabilities of tiles in batches; a tile that could not be read has none."""
    scored = plugins.score_tiles(plugins.read_tiles(spots(spark, sf), PlainSlide, 8, 8), plugins.StandInClassifier, batch=7)
    return scored.select("slide_uid", "patch_id", "tumor_prob", "error")


@query(f"""WITH {SLIDES}, {SPOTS}, q AS (SELECT s.slide_uid, patch_id, (y - y0) // 4 * 2 + (x - x0) // 4 AS q, avg(r) AS r, avg(g) AS g, avg(b) AS b FROM {_EIGHT} GROUP BY 1, 2, 3)
SELECT slide_uid, patch_id, (q * 3 + unnest([0, 1, 2]))::INT AS pos, unnest([r, g, b])::DOUBLE AS value FROM q""")
def k_encoded_tiles(spark, sf):
    """Features of tiles in batches, one number a row."""
    got = plugins.encode_tiles(plugins.read_tiles(spots(spark, sf), PlainSlide, 8, 8), QuarterMeans, batch=5)
    return got.select("slide_uid", "patch_id", F.posexplode("feature").alias("pos", "value")).withColumn("value", F.col("value").cast("double"))


@query(f"""WITH {SLIDES}, c AS (SELECT slide_uid, bad, i, (k * 5 + i * 17) % {WIDE} AS cx, (k * 11 + i * 23) % {WIDE} AS cy FROM (SELECT *, unnest(range(6))::BIGINT AS i FROM slides)),
a AS (SELECT slide_uid, i, least(greatest(cx - 8, 0), {WIDE - 16}) AS x0, least(greatest(cy - 8, 0), {WIDE - 16}) AS y0 FROM c WHERE NOT bad),
ta AS (SELECT a.slide_uid, i, (x - x0) // 2 + 8 * ((y - y0) // 2) + 1 AS w, round_even(avg(r), 0) AS r, round_even(avg(g), 0) AS g, round_even(avg(b), 0) AS b FROM a JOIN px p ON p.slide_uid = a.slide_uid AND x BETWEEN x0 AND x0 + 15 AND y BETWEEN y0 AND y0 + 15 GROUP BY 1, 2, 3),
tp AS (SELECT slide_uid, i, n + 1 AS w, cx + 2 - 4 + n % 8 AS x, cy - 3 - 4 + n // 8 AS y FROM (SELECT *, unnest(range(64)) AS n FROM c WHERE NOT bad)),
tv AS (SELECT t.slide_uid, i, w, coalesce(r, 255) AS r, coalesce(g, 255) AS g, coalesce(b, 255) AS b FROM tp t LEFT JOIN px USING (slide_uid, x, y)),
n AS (SELECT 'around' AS kind, * FROM ta UNION ALL SELECT 'point', * FROM tv)
SELECT kind, slide_uid, i, {_SUMS} FROM n GROUP BY ALL""")
def k_read_points(spark, sf):
    """Tiles of a wanted resolution around points, kept inside the canvas, and plain reads around shifted points."""
    k, i = F.col("k"), F.col("i")
    rows = opened(spark, sf).where(k % 10 != 9).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(5).cast("long"))))
    rows = rows.select("slide_uid", "path", "i", ((k * 5 + i * 17) % WIDE).alias("cx"), ((k * 11 + i * 23) % WIDE).alias("cy"))

    def read(frames):
        import pandas as pd

        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                slide = PlainSlide(row.path)
                out.append(("around", row.slide_uid, row.i, plugins.read_around(slide, row.cx, row.cy, 0.25, 0.5, 8).tobytes()))
                out.append(("point", row.slide_uid, row.i, plugins.read_point(slide, row.cx, row.cy, 8, (2, -3)).tobytes()))
            yield pd.DataFrame(out, columns=["kind", "slide_uid", "i", "rgb"]).assign(h=8, w=8)

    return _summed(map_pandas(rows, read, "kind string, slide_uid string, i long, rgb binary, h int, w int"), "kind", "slide_uid", "i")


@query(f"""WITH {SLIDES}, c AS (SELECT slide_uid, k, bad, (i % 2)::INT AS label, (k * 5 + i * 17) % 60 AS x, (k * 11 + i * 23) % 60 AS y, (k % 3)::INT AS bx FROM (SELECT *, unnest(range(6))::BIGINT AS i FROM slides)),
m AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || label || ':' || slide_uid || ':' || x || ':' || y), slide_uid || ':' || x || ':' || y) - 1 AS slot FROM c QUALIFY slot < 60),
a AS (SELECT slide_uid, x AS x_qp, y AS y_qp, least(greatest(x + bx - 8, 0), {WIDE - 16}) AS x0, least(greatest(y + 1 - 8, 0), {WIDE - 16}) AS y0 FROM m WHERE NOT bad GROUP BY ALL),
t AS (SELECT a.slide_uid, x_qp, y_qp, (x - x0) // 2 + 8 * ((y - y0) // 2) + 1 AS w, round_even(avg(r), 0) AS r, round_even(avg(g), 0) AS g, round_even(avg(b), 0) AS b FROM a JOIN px p ON p.slide_uid = a.slide_uid AND x BETWEEN x0 AND x0 + 15 AND y BETWEEN y0 AND y0 + 15 GROUP BY 1, 2, 3, 4),
u AS (SELECT slide_uid, x_qp, y_qp, {_SUMS} FROM t GROUP BY ALL)
SELECT m.label, slot::INT AS slot, (slot // 5)::INT AS grid_row, (slot % 5)::INT AS grid_col, m.slide_uid AS slide_id, {_BAD} AS error, CASE WHEN NOT bad THEN false END AS dark, u.r, u.g, u.b FROM m LEFT JOIN u ON u.slide_uid = m.slide_uid AND u.x_qp = m.x AND u.y_qp = m.y""")
def k_preview(spark, sf):
    """Sampled tiles of each label with their places in a montage."""
    k, i = F.col("k"), F.col("i")
    rows = opened(spark, sf).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(5).cast("long"))))
    rows = rows.select(F.col("slide_uid").alias("slide_id"), "path", (i % 2).cast("int").alias("label"), ((k * 5 + i * 17) % 60).alias("x_qp"), ((k * 11 + i * 23) % 60).alias("y_qp"), (k % 3).alias("bounds_x"), F.lit(1).alias("bounds_y"))
    return _summed(stages.preview(rows, PlainSlide, 60, 0.5, 8), "label", "slot", "grid_row", "grid_col", "slide_id", "error", "dark")


@query(f"""WITH {SLIDES}, c AS (SELECT slide_uid, x, y, x * 4 - 8 AS x0, y * 4 - 8 AS y0, y * 16 + x AS patch_id, greatest(least(x + 1, 11) - greatest(x - 1, 0) + 1, 0) / (least(x + 1, 15) - greatest(x - 1, 0) + 1)::DOUBLE AS density
  FROM slides, (SELECT unnest(range(0, 16, 2)) AS x), (SELECT unnest(range(0, 16, 2)) AS y) WHERE NOT bad),
t AS (SELECT c.slide_uid, patch_id, x0, y0, least(greatest(avg((r + b) / 2.0::DOUBLE - g) / 80, 0), 1) AS p, avg((least(r, g, b) < 230)::INT) AS stained
  FROM c JOIN px ON px.slide_uid = c.slide_uid AND px.x BETWEEN x0 AND x0 + 15 AND px.y BETWEEN y0 AND y0 + 15 WHERE density >= 0.3 AND x0 >= 0 AND y0 >= 0 AND x0 + 16 <= {WIDE} AND y0 + 16 <= {WIDE} GROUP BY ALL)
SELECT slide_uid, patch_id::BIGINT AS patch_id, x0::INT AS x0, y0::INT AS y0, p AS tumor_prob, rank FROM (SELECT *, row_number() OVER (PARTITION BY slide_uid ORDER BY p DESC, patch_id)::INT AS rank FROM t WHERE stained >= 0.2) WHERE rank <= 5""")
def k_mined(spark, sf):
    """The most likely patches of every slide, from windows of its clean mask."""
    s = stages.Settings(read=16, tile=16)
    got = stages.mine_stage(opened(spark, sf).select("slide_uid", "path"), PlainSlide, plugins.StandInClassifier, 5, 4.0, 2, 1, 0.3, s)
    return got.select("slide_uid", "patch_id", "x0", "y0", "tumor_prob", F.col("rank").cast("int").alias("rank"))


@query(f"""WITH {SLIDES} SELECT v.run::INT AS run, v.stage, v.code::INT AS code, v.message, CASE WHEN v.stage = 'tumor' THEN (SELECT count(*) * 4 FROM slides WHERE CASE WHEN v.run = 1 THEN k % 2 = 0 ELSE k % 2 <> 0 END) END::BIGINT AS read
FROM (VALUES (1, 'qc', 0, ''), (1, 'gate', 1, ''), (1, 'tumor', 0, ''), (1, 'uni', 2, 'ValueError: no encoder'), (2, 'tumor', 0, '')) v(run, stage, code, message) UNION ALL SELECT 0, 'all', 2, '', count(*) * 4 FROM slides""")
def k_stage_run(spark, sf):
    """Two runs of the stages, the first over half of the slides: what failed, and that the second one reads the rest only."""
    at = scratch(spark, "scores")
    every = spots(spark, sf)
    read = {}

    def tumor(n, rows):
        def go():
            part = f"{at}/run={n}"
            plugins.score_tiles(plugins.read_tiles(rows(), PlainSlide, 8, 8), plugins.StandInClassifier).write.parquet(part)
            read[n] = spark.read.parquet(part).count()

        return go

    def no_encoder():
        raise ValueError("no encoder")

    key = F.substring("slide_uid", 2, 20).cast("long")
    first = {"qc": lambda: True, "gate": lambda: False, "tumor": tumor(1, lambda: every.where(key % 2 == 0)), "uni": no_encoder}
    code, one = run.run_stages(spark, first, run.stage_list("qc,gate,tumor,uni"))
    _, two = run.run_stages(spark, {"tumor": tumor(2, lambda: summary.not_done(every, spark.read.parquet(at), ["slide_uid", "patch_id"]))}, ["tumor"])
    rows = [(n, r["stage"], r["code"], r["message"], read[n] if r["stage"] == "tumor" else None) for n, t in ((1, one), (2, two)) for r in t.collect()]
    rows.append((0, "all", code, "", spark.read.parquet(at).select("slide_uid", "patch_id").distinct().count()))
    return spark.createDataFrame(rows, "run int, stage string, code int, message string, read long")


@query("""WITH c AS (SELECT count(*) FILTER (s_suppkey % 10 = 9) AS bad FROM supplier) SELECT 'all known' AS rule, true AS ok FROM c UNION ALL SELECT 'no failures', bad = 0 FROM c""")
def q_required(spark, sf):
    """Whether the masks that the features need are there; a run is refused where they are not."""
    s = opened(spark, sf)
    status = F.when(F.col("k") % 10 == 9, "read_error").otherwise("ok")
    counts = gate.precheck(s.select("slide_uid"), s.select("slide_uid", status.alias("mask_status")))

    def holds(rule):
        try:
            gate.require(counts, rule, "masks")
            return True
        except ValueError:
            return False

    return spark.createDataFrame([("all known", holds("missing = 0")), ("no failures", holds("known_failures = 0"))], "rule string, ok boolean")


@query("SELECT * FROM (VALUES ('auto', 'cuda,mps', 'cuda'), ('auto', 'mps', 'mps'), ('auto', '', 'cpu'), ('cpu', 'cuda', 'cpu'), ('cuda', '', 'cpu')) v(wanted, available, device)")
def q_device(spark, sf):
    """Which device a model goes to."""
    cases = (("auto", "cuda,mps"), ("auto", "mps"), ("auto", ""), ("cpu", "cuda"), ("cuda", ""))
    return spark.createDataFrame([(w, a, plugins.device(w, tuple(filter(None, a.split(","))))) for w, a in cases], "wanted string, available string, device string")


@query(f"""WITH {PIXELS}, o AS (SELECT img, y * 24 + x + 1 AS w, (x + y) % 3 = 0 AS m, r, g, b FROM pixels),
p AS (SELECT img, w, CASE WHEN m THEN round_even((1 - 0.3::DOUBLE) * r, 0) ELSE r END AS r, CASE WHEN m THEN round_even((1 - 0.3::DOUBLE) * g + 0.3::DOUBLE * 255, 0) ELSE g END AS g, CASE WHEN m THEN round_even((1 - 0.3::DOUBLE) * b, 0) ELSE b END AS b FROM o)
SELECT img, {_SUMS} FROM p GROUP BY img""")
def k_overlay(spark, sf):
    """The preview of a mask over its image."""
    def sums(rgb):
        y, x = np.mgrid[: rgb.shape[0], : rgb.shape[1]]
        v = raster.overlay(rgb, (x + y) % 3 == 0).reshape(-1, 3).astype(np.int64)
        return {c: [int(n)] for c, n in zip("rgb", (v * np.arange(1, len(v) + 1)[:, None]).sum(0))}

    return _kernel(spark, sums, "r long, g long, b long")


_MASK = masks.MaskConfig()


def _banded(value: str, band) -> str:
    return f"CASE WHEN {value} < {band[0]!r}::DOUBLE THEN 'low_tissue' WHEN {value} > {band[1]!r}::DOUBLE THEN 'high_tissue' ELSE 'ok' END"


@query(f"""WITH {PIXELS}, {_HSV.format(src='pixels')}, m AS (SELECT img, y >= 6 AS seen, y >= 6 AND x >= 2 + 3 * img AND x < 12 AS m, {_GRAY} >= {_MASK.void_gray} AND sat <= {_MASK.void_sat} AS white FROM hsv),
f AS (SELECT img, avg(m::INT) AS frac, sum(m::INT) / sum(seen::INT) AS eff, avg(seen::INT) AS seen, sum((m AND white)::INT) / greatest(1, sum(m::INT)) AS leak FROM m GROUP BY img)
SELECT img, round(frac, 9) AS mask_frac, round(eff, 9) AS mask_frac_effective, round(seen, 9) AS non_black_frac, round(leak, 9) AS white_leak, {_banded('frac', _MASK.expected)} AS mask_status, {_banded('eff', _MASK.expected_effective)} AS mask_status_effective, 'effective' AS status_basis FROM f""")
def k_mask_status(spark, sf):
    """What a mask's share of an image says, on a canvas that is partly black, and how much of it is glare."""
    c = masks.configured("sparse_canvas_pure_v1")

    def fields(rgb):
        y, x = np.mgrid[: rgb.shape[0], : rgb.shape[1]]
        left = _left(rgb)
        mask = (y >= 6) & (x >= left) & (x < 12)
        seen = rgb.copy()
        seen[:6] = 0
        got = masks.status_fields(seen, mask, c)
        return {k: [round(v, 9) if isinstance(v, float) else v] for k, v in (got | {"white_leak": masks.white_leak(seen, mask, c)}).items()}

    names = "mask_frac double, mask_frac_effective double, non_black_frac double, mask_status string, mask_status_effective string, status_basis string, white_leak double"
    return _kernel(spark, fields, names)


def _left(rgb) -> int:
    """2 + 3 * img: the ground's red is 245 - (img * 5 % 23) % 7 in the first corner, other in each of the images."""
    return 2 + 3 * [245 - (5 * img) % 23 % 7 for img in range(4)].index(int(rgb[0, 0, 0]))


@query(f"""WITH {PIXELS}, {_HSV.format(src='pixels')}, d AS (SELECT img, {' + '.join(_OD.values())} AS od, {_GRAY} AS gr, r, g, b, sat FROM hsv),
n AS (SELECT img, count(*) FILTER (NOT (gr <= 8 OR (r <= 12 AND g <= 12 AND b <= 12)) AND gr <= 245 AND (od >= 0.12 OR sat >= 6)) AS n, count(*) AS all_n FROM d GROUP BY img)
SELECT img, v.*, CASE WHEN v.reason = 'too_few_pixels' THEN n ELSE 0 END::BIGINT AS pixels, round(CASE WHEN v.reason = 'too_few_pixels' THEN n / all_n ELSE 0 END, 9) AS valid_frac FROM n, (VALUES ('fixed', 'fixed_cfg'), ('static', 'dynamic_disabled'), ('fallback', 'too_few_pixels')) v(source, reason)""")
def k_stain_sources(spark, sf):
    """Why an image's stain vectors are the default ones, and how many pixels could have told."""
    def reasons(rgb):
        got = [raster.stain_vectors(rgb, **how) for how in ({"fixed": True}, {"dynamic": False}, {"min_pixels": 1200})]
        return {"source": [g["source"] for g in got], "reason": [g["reason"] for g in got], "pixels": [g["pixels"] for g in got], "valid_frac": [round(g["valid_frac"], 9) for g in got]}

    return _kernel(spark, reasons, "source string, reason string, pixels long, valid_frac double")


_PENS = masks.configured(border_px=0, dark_pen=False, ink_dilate=1)
_GREEN = raster.ellipse_offsets(raster.odd(_PENS.green_dilate))


@query(f"""WITH {PIXELS}, {_HSV.format(src='pixels')}, k AS (SELECT unnest([{', '.join(str(a) for a, _ in _GREEN)}]) AS dy, unnest([{', '.join(str(b) for _, b in _GREEN)}]) AS dx),
seen AS (SELECT * FROM hsv WHERE NOT ({_GRAY} <= 8 OR (r <= 12 AND g <= 12 AND b <= 12))),
ink AS (SELECT img, y, x FROM seen WHERE (v < 70 AND sat > 18) OR (hue BETWEEN 25 AND 110 AND sat > 22 AND v < 250) OR (hue BETWEEN 85 AND 140 AND sat > 22 AND v < 250) OR ((hue >= 145 OR hue <= 10) AND sat > 150 AND v < 245)),
core AS (SELECT img, y, x FROM seen WHERE hue BETWEEN 25 AND 110 AND sat > 22 AND v > {_PENS.green_value}), near AS {_grown('core')},
every AS (SELECT * FROM ink UNION SELECT * FROM near WHERE y BETWEEN 0 AND {SIDE - 1} AND x BETWEEN 0 AND {SIDE - 1})
SELECT i.img, count(e.y) AS n, coalesce(sum(e.y), 0)::BIGINT AS sy, coalesce(sum(e.x), 0)::BIGINT AS sx FROM (SELECT DISTINCT img FROM pixels) i LEFT JOIN every e ON e.img = i.img GROUP BY i.img""")
def k_ink(spark, sf):
    """Pen marks of the tissue mask, green ones with what is near them."""
    def pens(rgb):
        y, x = np.nonzero(masks._pens(masks._Layers(rgb, _PENS), _PENS))
        return {"n": [len(y)], "sy": [int(y.sum())], "sx": [int(x.sum())]}

    return _kernel(spark, pens, "n long, sy long, sx long")


_FIT = training.Training(epochs=3, rate=0.05, decay=0.01, batches=2)


def _fit_sql() -> str:
    """Six steps of two batches in turn. From zeros both classes' weights stay opposite, so those of class 1 tell all."""
    (a, b), out = _FIT.betas, []
    out.append("""e AS (SELECT vec_id, (label % 2)::INT AS y, list_append(embedding::DOUBLE[], 1.0::DOUBLE) AS x FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL),
c AS (SELECT y, (SELECT count(*) FROM e) / (2.0::DOUBLE * count(*)) AS cw FROM e GROUP BY y), d AS (SELECT vec_id, y, cw, x FROM e JOIN c USING (y)),
s0 AS (SELECT list_transform(any_value(x), lambda v: 0.0::DOUBLE) AS w, list_transform(any_value(x), lambda v: 0.0::DOUBLE) AS m, list_transform(any_value(x), lambda v: 0.0::DOUBLE) AS v FROM e)""")
    for n in range(1, _FIT.epochs * _FIT.batches + 1):
        rate = training.rate_at(_FIT, (n - 1) // _FIT.batches)
        out.append(f"""p{n} AS (SELECT x, cw, cw * (1 / (1 + exp(-2 * list_dot_product(x, w))) - y) AS off FROM d, s{n - 1} WHERE vec_id % {_FIT.batches} = {(n - 1) % _FIT.batches}),
g{n} AS (SELECT pos, sum(off * xi) / sum(cw) AS g FROM (SELECT unnest(x) AS xi, generate_subscripts(x, 1) AS pos, off, cw FROM p{n}) GROUP BY pos),
u{n} AS (SELECT pos, w[pos] AS w, {a!r}::DOUBLE * m[pos] + {1 - a!r}::DOUBLE * g AS m, {b!r}::DOUBLE * v[pos] + {1 - b!r}::DOUBLE * g * g AS v FROM g{n}, s{n - 1}),
s{n} AS (SELECT list(w * {1 - rate * _FIT.decay!r}::DOUBLE - {rate!r}::DOUBLE * (m / {1 - a**n!r}::DOUBLE) / (sqrt(v / {1 - b**n!r}::DOUBLE) + {_FIT.eps!r}::DOUBLE) ORDER BY pos) AS w, list(m ORDER BY pos) AS m, list(v ORDER BY pos) AS v FROM u{n})""")
    return "WITH " + ",\n".join(out) + f"\nSELECT (generate_subscripts(w, 1) - 1)::INT AS pos, round(unnest(w), 6) AS weight FROM s{n}"


@query(_fit_sql())
def k_trained_head(spark, sf):
    """The weights of class 1 after three epochs of two steps on stored features."""
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding", (F.col("label") % 2).alias("y"))
    head, _ = training.fit_head(rows, "embedding", "y", t=_FIT, batch="vec_id")
    return spark.createDataFrame([(i, round(float(w), 6)) for i, w in enumerate(head[1])], "pos int, weight double")
