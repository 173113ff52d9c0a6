"""Queries: pixel formulas, neighbourhoods and image metrics over rows of pixels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import pixels as P
from ..operators import raster
from .base import PIXELS, SIDE, pixels, query

_OD = {c: f"-ln(least(greatest({c} / 255.0::DOUBLE, 1e-6), 1))" for c in "rgb"}
_GRAY = "((r * 4899 + g * 9617 + b * 1868 + 8192) // 16384)"
_HE = ["greatest(" + " + ".join(f"({k!r}::DOUBLE * {_OD[c]})" for k, c in zip(row, "rgb")) + ", 0)" for row in P.unmix_rows()]
_UNMIXED = f"{PIXELS}, he AS (SELECT *, round({_HE[0]}, 9) AS h, round({_HE[1]}, 9) AS e FROM pixels)"
_HSV = """hsv0 AS (SELECT *, greatest(r, g, b) AS v, greatest(r, g, b) - least(r, g, b) AS d FROM {src}),
hsv1 AS (SELECT *, CASE WHEN d = 0 THEN 0.0 WHEN v = r THEN 60.0::DOUBLE * (g - b) / d WHEN v = g THEN 120 + 60.0::DOUBLE * (b - r) / d ELSE 240 + 60.0::DOUBLE * (r - g) / d END AS h0, CASE WHEN v = 0 THEN 0.0 ELSE 255.0::DOUBLE * d / v END AS s0 FROM hsv0),
hsv AS (SELECT * EXCLUDE (h0, s0, d), CAST(floor((CASE WHEN h0 < 0 THEN h0 + 360 ELSE h0 END) / 2 + 0.5) AS INT) % 180 AS hue, CAST(floor(s0 + 0.5) AS INT) AS sat FROM hsv1)"""


def _norm(c: str) -> str:
    lo, hi = (f"quantile_cont({c}, {q}) OVER (PARTITION BY img)" for q in (0.05, 0.99))
    return f"CASE WHEN {hi} <= {lo} + 1e-6 THEN 0.0 ELSE least(greatest(({c} - {lo}) / ({hi} - {lo}), 0.0), 1.0) END"


@query(f"WITH {PIXELS} SELECT img, y, x, round({_OD['r']}, 9) AS od_r, round({_OD['r']} + {_OD['g']} + {_OD['b']}, 9) AS od_sum, greatest(0.0, 0.5 * (r + b) - g)::DOUBLE AS rapid, {_GRAY}::INT AS gray FROM pixels")
def q_pixel_od(spark, sf):
    od = {c: P.optical_density(c) for c in "rgb"}
    return pixels(spark).select("img", "y", "x", F.round(od["r"], 9).alias("od_r"), F.round(od["r"] + od["g"] + od["b"], 9).alias("od_sum"), P.rapid_channel().cast("double").alias("rapid"), P.gray().alias("gray"))


@query(f"WITH {_UNMIXED} SELECT img, y, x, round(h, 7) AS h, round(e, 7) AS e FROM he")
def q_pixel_unmix(spark, sf):
    h, e = P.unmix()
    return pixels(spark).select("img", "y", "x", F.round(F.round(h, 9), 7).alias("h"), F.round(F.round(e, 9), 7).alias("e"))


@query(f"WITH {_UNMIXED} SELECT img, y, x, round({_norm('h')}, 6) AS hn FROM he")
def q_pixel_norm01(spark, sf):
    h, _ = P.unmix()
    return pixels(spark).withColumn("h", F.round(h, 9)).select("img", "y", "x", F.round(P.norm01("h", ["img"]), 6).alias("hn"))


@query(f"WITH {PIXELS}, {_HSV.format(src='pixels')} SELECT img, y, x, hue, sat, v FROM hsv")
def q_pixel_hsv(spark, sf):
    h, s, v = P.hsv()
    return pixels(spark).select("img", "y", "x", h.alias("hue"), s.alias("sat"), v.alias("v"))


_INK = f"(v < 70 AND sat > 18) OR (hue BETWEEN 25 AND 110 AND sat > 22 AND v < 250) OR (hue BETWEEN 85 AND 140 AND sat > 22 AND v < 250) OR ((hue >= 145 OR hue <= 10) AND sat > 150 AND v < 245) OR {_GRAY} < 70"
_TILES = f"""{_UNMIXED}, n AS (SELECT *, {_norm('h')} AS hn, {_norm('e')} AS en FROM he), {_HSV.format(src='n')},
m AS (SELECT *, en > 0.58 AND hn < 0.42 AND (r - 0.5 * (g + b)) / 255.0 > 0.06 AS rbc, ({_OD['r']} + {_OD['g']} + {_OD['b']} > 0.12) AND (greatest(r, g, b) - least(r, g, b) >= 12 OR (r + g + b) / 3.0 <= 245) AS t FROM hsv)"""


@query(f"""WITH {_TILES} SELECT img, round(avg((t AND NOT rbc)::INT), 9) AS tissue_frac, round(avg(rbc::INT), 9) AS qc_rbc_frac, round(avg(({_INK})::INT), 9) AS qc_artifact_frac, round(avg((r + g + b) / 3.0::DOUBLE), 6) AS brightness,
  round(avg((greatest(r, g, b) <= 15)::INT), 9) AS black_frac, round(avg((least(r, g, b) >= 230)::INT), 9) AS white_frac FROM m GROUP BY img""")
def q_tile_metrics(spark, sf):
    """Tissue, red cells, artefacts, brightness, black and white shares."""
    out = P.tile_metrics(pixels(spark), ["img"])
    return out.select("img", *(F.round(c, 6 if c == "brightness" else 9).alias(c) for c in out.columns[1:]))


@query(f"""WITH {PIXELS}, {_HSV.format(src='pixels')} SELECT img, round(avg(((v < 90 AND sat > 30) OR (hue BETWEEN 35 AND 105 AND sat > 45 AND v < 245) OR (hue BETWEEN 100 AND 140 AND sat > 45 AND v < 245) OR ((hue >= 145 OR hue <= 10) AND sat > 140 AND v < 245)
  OR (r > 140 AND r - g > 35 AND r - b > 35) OR {_GRAY} < 70)::INT), 9) AS artifact_frac FROM hsv GROUP BY img""")
def q_artifact(spark, sf):
    h, s, v = P.hsv()
    p = pixels(spark).withColumns({"h_": h, "s_": s, "v_": v, "g_": P.gray()})
    return p.groupBy("img").agg(F.round(F.avg(P.ink_score(F.col("h_"), F.col("s_"), F.col("v_"), F.col("g_")).cast("int")), 9).alias("artifact_frac"))


@query(f"""WITH {_UNMIXED}, l AS (SELECT *, h < quantile_cont(h, 0.35) OVER (PARTITION BY img) AS low, r / 255.0::DOUBLE > 0.55 AND (r - g) / 255.0::DOUBLE > 0.12 AND (r - b) / 255.0::DOUBLE > 0.12 AS red FROM he)
SELECT img, round(avg(greatest(0, (r - 0.5 * (g + b)) / 255.0::DOUBLE)) + 0.7 * avg(red::INT) + 0.3 * avg((red AND low)::INT), 8) AS blood_score FROM l GROUP BY img""")
def q_blood(spark, sf):
    return P.blood_score(pixels(spark), ["img"]).withColumn("blood_score", F.round("blood_score", 8))


_N = f"""{PIXELS}, q AS (SELECT img, y, x, {_GRAY} AS g FROM pixels), o AS (SELECT unnest([-1, 0, 1]) AS d), n AS (SELECT c.img, c.y, c.x, a.d AS dy, b.d AS dx, q.g FROM q c, o a, o b, q
  WHERE q.img = c.img AND q.y = CASE WHEN c.y + a.d < 0 THEN 1 WHEN c.y + a.d > {SIDE - 1} THEN {SIDE - 2} ELSE c.y + a.d END AND q.x = CASE WHEN c.x + b.d < 0 THEN 1 WHEN c.x + b.d > {SIDE - 1} THEN {SIDE - 2} ELSE c.x + b.d END),
f AS (SELECT img, y, x, sum(g * dx * (2 - abs(dy))) AS gx, sum(g * dy * (2 - abs(dx))) AS gy, sum(g * CASE WHEN dx = 0 AND dy = 0 THEN -4 WHEN dx = 0 OR dy = 0 THEN 1 ELSE 0 END) AS l, max(CASE WHEN dx = 0 AND dy = 0 THEN g END) AS g0 FROM n GROUP BY img, y, x)"""


@query(f"WITH {_N} SELECT img, round(avg(sqrt(gx * gx + gy * gy)), 6) AS focus, round(var_pop(l), 6) AS laplacian_var, round(avg((g0 > 240)::INT) - 0.001 * var_pop(l), 6) AS adipose_proxy FROM f GROUP BY img")
def q_focus(spark, sf):
    """Mean Sobel gradient, variance of the Laplacian and the fat proxy."""
    out = P.focus(pixels(spark), ["img"])
    return out.select("img", *(F.round(c, 6).alias(c) for c in out.columns[1:]))


_KERNEL = raster.ellipse_offsets(5)


@query(f"WITH {PIXELS}, m AS (SELECT img, y, x FROM pixels WHERE r > 190 AND g < 100), k AS (SELECT unnest([{', '.join(str(a) for a, _ in _KERNEL)}]) AS dy, unnest([{', '.join(str(b) for _, b in _KERNEL)}]) AS dx) SELECT DISTINCT img, (y + dy)::INT AS y, (x + dx)::INT AS x FROM m, k WHERE y + dy BETWEEN 0 AND {SIDE - 1} AND x + dx BETWEEN 0 AND {SIDE - 1}")
def q_dilate(spark, sf):
    return P.dilate(pixels(spark).where("r > 190 and g < 100").select("img", "y", "x"), ["img"], _KERNEL, SIDE, SIDE)


@query(f"WITH {PIXELS} SELECT img, (y // 2)::INT AS y, (x // 2)::INT AS x, round_even(avg(r), 0)::INT AS r, round_even(avg(g), 0)::INT AS g, round_even(avg(b), 0)::INT AS b FROM pixels GROUP BY img, y // 2, x // 2")
def q_area_downsample(spark, sf):
    return P.area_downsample(pixels(spark), ["img"], 2)


@query(f"""WITH {PIXELS}, d AS (SELECT img, {', '.join(f'{v} AS o{c}' for c, v in _OD.items())} FROM pixels), u AS (SELECT img, orr / n AS r, og / n AS g, ob / n AS b FROM (SELECT img, "or" AS orr, og, ob, sqrt("or" * "or" + og * og + ob * ob) AS n FROM d) WHERE n > 1e-8)
SELECT img, {', '.join(f'round(covar_samp({a}, {b}), 7) AS cov_{a}{b}' for a, b in ('rr', 'rg', 'rb', 'gg', 'gb', 'bb'))} FROM u GROUP BY img""".replace(" AS or,", ' AS "or",'))
def q_covariance(spark, sf):
    out = P.od_covariance(pixels(spark), ["img"])
    return out.select("img", *(F.round(c, 7).alias(c) for c in out.columns[1:]))


@query(f"""WITH {PIXELS}, b AS (SELECT img, y, x, {_GRAY} AS gr, r, g, b FROM pixels) SELECT img, count(*) FILTER (gr <= 8 OR (r <= 12 AND g <= 12 AND b <= 12)) AS black, CASE WHEN avg((r + g + b) / 3.0) < 10 OR avg((r + g + b) / 3.0) > 245 THEN 'mean' WHEN avg((least(r, g, b) >= 230)::INT) > 0.95 THEN 'white' WHEN avg((greatest(r, g, b) <= 15)::INT) > 0.95 THEN 'black'
  WHEN avg((least(r, g, b) < 230)::INT) < 0.20 THEN 'tissue' ELSE '' END AS verdict FROM b GROUP BY img""")
def q_patch_verdict(spark, sf):
    """Black-canvas pixels, and why a patch is bad."""
    mean = F.avg((F.col("r") + F.col("g") + F.col("b")) / 3.0)
    white, black, stained = (F.avg(c.cast("int")) for c in (F.least("r", "g", "b") >= 230, F.greatest("r", "g", "b") <= 15, F.least("r", "g", "b") < 230))
    verdict = F.when((mean < 10) | (mean > 245), "mean").when(white > 0.95, "white").when(black > 0.95, "black").when(stained < 0.20, "tissue").otherwise("")
    return pixels(spark).groupBy("img").agg(F.count_if(P.black_canvas(P.gray())).alias("black"), verdict.alias("verdict"))


@query(f"""WITH {PIXELS}, v AS (SELECT img, (r + g + b) / 3.0::DOUBLE AS m, greatest(r, g, b) AS hi, least(r, g, b) AS lo, unnest([r, g, b]) AS v FROM pixels),
a AS (SELECT img, avg(m) AS mean, avg((m <= 5)::INT) AS dark, avg((hi <= 15)::INT) AS black, avg((NOT lo > 220)::INT) AS tissue, stddev_pop(v) AS sd FROM v GROUP BY img)
SELECT img, mean < 5 OR dark >= 0.8 AS is_black, black >= 0.95 OR mean < 10 AS to_purge, tissue >= 0.6 AS is_tissue, sd < 5 AS low_texture, round(tissue, 9) AS tissue_share, round(sd, 6) AS sd, round(24 * 24 * tissue / 16, 6) AS candidates FROM a""")
def q_tile_flags(spark, sf):
    """Black, dark, tissue and flat tiles, and how many candidates to expect."""
    out = P.tile_flags(pixels(spark), ["img"])
    n = F.round(P.candidate_estimate(F.lit(SIDE), F.lit(SIDE), "tissue_share", F.lit(4)), 6)
    return out.withColumn("candidates", n).withColumns({"tissue_share": F.round("tissue_share", 9), "sd": F.round("sd", 6)})


@query(f"""WITH {PIXELS}, a AS (SELECT img, avg(r) AS m FROM pixels GROUP BY img), b AS (SELECT img, avg(least(r + 10, 255)) AS m FROM pixels WHERE img % 2 = 0 GROUP BY img)
SELECT img, round(a.m, 6) AS mean_raw, round(b.m, 6) AS mean_norm, round(b.m - a.m, 6) AS mean_diff FROM a JOIN b USING (img)""")
def q_before_and_after(spark, sf):
    """Tiles before and after a change of colour, joined by name."""
    p = pixels(spark)
    raw = p.groupBy("img").agg(F.avg("r").alias("mean"))
    new = p.where("img % 2 = 0").groupBy("img").agg(F.avg(F.least(F.col("r") + 10, F.lit(255))).alias("mean"))
    out = P.before_and_after(raw, new, "img", ["mean"])
    return out.select("img", *(F.round(c, 6).alias(c) for c in out.columns[1:]))


@query()
def k_masks(spark, sf):
    """Tissue masks with status for synthetic slides."""
    from ..operators import masks
    from ..sources import plugins

    slides = spark.range(6).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("slide_uid"), F.concat(F.lit("/synthetic/"), F.col("id").cast("string"), F.lit(".svs")).alias("path"))
    thumbs = plugins.thumbnails(slides, plugins.SyntheticSlide, 4.0)
    return masks.mask_table(thumbs, masks.configured(guard_px=8, crop_px=4, edge_strip=8)).drop("mask")


@query()
def k_end_to_end(spark, sf):
    """Masks, candidates, quality, selection, scores and features of synthetic slides."""
    from ..operators import gate, masks, select
    from ..sources import plugins
    from . import stages

    s = stages.Settings(mask=masks.configured(guard_px=8, crop_px=4, edge_strip=8), mask_downsample=4.0, stride=96, read=64, tile=32, max_candidates=60, qc=select.QcThresholds(0.1, 1, 40, 0.9, 0.9, None, None), quotas=select.Quotas(20), tumor=gate.TumorGate(high=0.4, mid=0.2, topk=10, min_high=1, min_scored=1, min_ratio=0.0))
    slides = spark.range(4).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("slide_uid"), F.concat(F.lit("/synthetic/"), F.col("id").cast("string"), F.lit(".svs")).alias("path"))
    rows = stages.held(stages.mask_stage(slides, plugins.SyntheticSlide, s), "masks")
    pool = stages.held(stages.qc_stage(slides, stages.held(stages.candidates(rows, s), "candidates"), plugins.SyntheticSlide, s), "pool")
    chosen, summary = stages.select_stage(slides, pool, s)
    scored, gated = stages.tumor_stage(slides, chosen.select("slide_uid", "patch_id", "x0", "y0"), plugins.SyntheticSlide, plugins.StandInClassifier, s)
    _, pooled = stages.feature_stage(slides, scored, gated, plugins.SyntheticSlide, plugins.StandInEncoder, s)
    out = summary.join(gated, "slide_uid").join(pooled, "slide_uid", "left")
    return out.select("slide_uid", "candidates_after_mask", "qc_pass", "selected_count", "qc_status", "scored_ok", "tumor_prob_ge_thr", "uni_ready", "n_patches", F.size("mean_vector").alias("dim"))


def _images(spark):
    """The pixels as images."""
    channels = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("y", "x", "r", "g", "b"))), lambda p: F.array(p["r"], p["g"], p["b"])))
    rows = pixels(spark).groupBy("img").agg(F.unhex(F.array_join(F.transform(channels, lambda v: F.lpad(F.hex(v), 2, "0")), "")).alias("rgb"))
    return rows.select(F.col("img").cast("string").alias("img"), F.lit(SIDE).alias("h"), F.lit(SIDE).alias("w"), "rgb")
