"""Queries: what is read from and written to files, points of annotations and windows, and the array kernels on images."""

from __future__ import annotations

import functools
import os
import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.shipping import map_pandas
from ..operators import gate, geo, masks, raster, summary
from ..schemas import conform, _schema
from ..sources import sinks, slides
from . import run, stages
from .base import ORACLES, PATCHES, PIXELS, SIDE, patches, pixels, query, table
from .q_pixels import _GRAY, _HSV, _OD, _UNMIXED, _images


@functools.cache
def _own(app: str) -> str:
    return "file://" + tempfile.mkdtemp(prefix="tesselon-")


def scratch(spark, name: str) -> str:
    """A new path in the folder that the cluster shares, for what a query writes and reads back."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{(named or _own(spark.sparkContext.applicationId)).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_SUMMARY = _schema("slide_uid STRING, seq LONG, qc_pass LONG, mask_frac DOUBLE")


@query("""SELECT 'S' || o_custkey AS slide_uid, o_orderkey AS seq, o_orderkey % 1000 AS qc_pass, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS mask_frac
FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1""")
def q_summary_csv(spark, sf):
    """A summary read from CSV by slide: the last row of a slide counts, what is no number is null."""
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias(" Slide_UID"), k.alias("seq"), (k % 1000).alias("qc_pass"), F.when(k % 5 == 0, "nan").otherwise(F.col("o_totalprice").cast("string")).alias("mask_frac"))
    at = scratch(spark, "summary")
    sinks.csv(rows, at)
    return slides.summary(spark, at, _SUMMARY, ["slide_uid"], "seq")


@query("""SELECT lpad(l_orderkey::VARCHAR, 9, '0') AS slide_id, CASE WHEN l_linenumber <> 3 THEN l_partkey END::INT AS x_qp, l_suppkey::INT AS y_qp, (l_linenumber % 2)::INT AS label, count(*) AS n FROM lineitem GROUP BY ALL""")
def q_coordinates_csv(spark, sf):
    """Labelled coordinates from CSV under other headers; ids keep their zeros."""
    n = F.col("l_linenumber")
    rows = table(spark, sf, "lineitem").select(F.lpad(F.col("l_orderkey").cast("string"), 9, "0").alias("SLIDE_ID"), F.when(n == 3, "none").otherwise(F.col("l_partkey").cast("string")).alias("X "), F.col("l_suppkey").alias("y"), (n % 2).alias("Label"))
    at = scratch(spark, "coordinates")
    sinks.csv(rows, at)
    return slides.coordinates(spark, at).groupBy("slide_id", "x_qp", "y_qp", "label").agg(F.count("*").alias("n"))


@query("SELECT user_id AS slide, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos, event_id AS patch, round(value, 6) AS score FROM events")
def q_aligned_arrays(spark, sf):
    """Rows from arrays that belong together by position, as scores stored beside their patches."""
    e = table(spark, sf, "events").groupBy(F.col("user_id").alias("slide")).agg(F.array_sort(F.collect_list(F.struct("event_id", "value"))).alias("a"))
    held = e.select("slide", F.col("a.event_id").alias("patch"), F.transform("a.value", lambda v: F.round(v, 6)).alias("score"))
    return slides.aligned(held, ["slide"], ["patch", "score"])


@query("SELECT c_mktsegment AS center, c_custkey AS slide, round(c_acctbal, 2) AS v FROM customer")
def q_center_sink(spark, sf):
    """A table written in one folder for each center, read back."""
    at = scratch(spark, "centers")
    sinks.by_center(table(spark, sf, "customer").select(F.col("c_mktsegment").alias("center"), F.col("c_custkey").alias("slide"), F.round("c_acctbal", 2).alias("v")), at)
    return spark.read.parquet(at).select("center", "slide", "v")


@query(f"""WITH {PATCHES}, r AS (SELECT *, row_number() OVER (PARTITION BY slide ORDER BY prob DESC, patch) AS r FROM patches), o AS (SELECT 'all_scored' AS kind, * FROM r UNION ALL SELECT 'topk_scored', * FROM r WHERE r <= 7 UNION ALL SELECT 'high_only', * FROM r WHERE prob >= 0.3)
SELECT kind, slide, count(*) AS n, sum(patch)::BIGINT AS patches FROM o GROUP BY ALL""")
def q_scored_sink(spark, sf):
    """All scored patches, the top ones and the high ones of each slide, written and read back."""
    at = scratch(spark, "scored")
    sinks.scored_outputs(patches(spark, sf), at, "slide", "prob", "patch", gate.TumorGate(high=0.3, topk=7))
    parts = [spark.read.parquet(f"{at}/{k}").select(F.lit(k).alias("kind"), "slide", "patch") for k in ("all_scored", "topk_scored", "high_only")]
    return summary.union_all(*parts).groupBy("kind", "slide").agg(F.count("*").alias("n"), F.sum("patch").alias("patches"))


@query("SELECT vec_id AS patch_id, label, len(embedding)::INT AS dim, round(list_sum(embedding::DOUBLE[]), 4) AS total FROM embeddings")
def q_feature_sink(spark, sf):
    """Features narrowed to floats, written and read back."""
    at = scratch(spark, "features")
    sinks.features(table(spark, sf, "embeddings").select(F.col("vec_id").alias("patch_id"), "label", F.col("embedding").cast("array<double>").alias("feature")), at)
    total = F.aggregate("feature", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return spark.read.parquet(at).select("patch_id", "label", F.when(F.col("feature").isNotNull(), F.size("feature")).alias("dim"), F.round(total, 4).alias("total"))


@query("""SELECT 'log' AS kind, o_orderkey AS patch, CASE o_orderstatus WHEN 'F' THEN 'unreadable' END AS error FROM orders UNION ALL SELECT 'rows', o_orderkey, NULL FROM orders WHERE o_orderstatus <> 'F'""")
def q_status_log(spark, sf):
    """Good rows go to their table, every row's status to the log."""
    at = scratch(spark, "status")
    sinks.with_log(table(spark, sf, "orders").select(F.col("o_orderkey").alias("patch"), F.when(F.col("o_orderstatus") == "F", "unreadable").alias("error")), f"{at}/rows", f"{at}/log")
    return summary.union_all(spark.read.parquet(f"{at}/log").withColumn("kind", F.lit("log")), spark.read.parquet(f"{at}/rows").withColumn("kind", F.lit("rows"))).select("kind", "patch", "error")


@query("SELECT 'old' AS kind, count(*) AS n, sum(n_nationkey)::BIGINT AS total FROM nation UNION ALL SELECT 'new', count(*), sum(r_regionkey)::BIGINT FROM region")
def q_csv_backup(spark, sf):
    """A CSV table that is written again: what was there before is kept."""
    at = scratch(spark, "index")
    sinks.csv(table(spark, sf, "nation").select(F.col("n_nationkey").alias("k")), at, ["k"])
    old = sinks.csv(table(spark, sf, "region").select(F.col("r_regionkey").alias("k")), at, ["k"])
    both = [conform(spark.read.option("header", True).csv(p), _schema("k LONG")).select(F.lit(kind).alias("kind"), "k") for kind, p in (("old", old), ("new", at))]
    return summary.union_all(*both).groupBy("kind").agg(F.count("*").alias("n"), F.sum("k").alias("total"))


@query("SELECT o_orderpriority AS stage, count(*) AS n, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY 1")
def q_metrics_json(spark, sf):
    """Metrics written as JSON and read back."""
    at = scratch(spark, "metrics")
    sinks.metrics_json(table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("stage")).agg(F.count("*").alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean")), at)
    return spark.read.schema("stage string, n long, mean double").json(at)


@query("SELECT 'qc' AS stage, 'S' || s_suppkey AS slide_uid, CASE WHEN s_acctbal < 0 THEN 'failed' ELSE 'done' END AS status, 1700000000::BIGINT AS timestamp_unix FROM supplier")
def q_control_rows(spark, sf):
    """One control row for each slide that a stage is done with."""
    s = table(spark, sf, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("slide_uid"), "s_acctbal")
    return sinks.control_rows(s, "qc", F.when(F.col("s_acctbal") < 0, "failed").otherwise("done"), 1_700_000_000)


@query("SELECT l_orderkey, l_linenumber, l_partkey AS x, l_suppkey * 9 AS y FROM lineitem WHERE l_partkey - 60 >= 0 AND l_suppkey * 9 - 60 >= 0 AND l_partkey + 60 <= 1500 AND l_suppkey * 9 + 60 <= 800")
def q_strict_bounds(spark, sf):
    """Windows that lie wholly inside the slide."""
    p = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("x"), (F.col("l_suppkey") * 9).alias("y"))
    return p.where(C.window_inside(F.col("x") - 60, F.col("y") - 60, 120, F.lit(1500), F.lit(800)))


@query("""WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey - 100 AS x, l_suppkey * 7 - 30 AS y FROM lineitem), t AS (SELECT *, x >= 0 AND y >= 0 AND x < 900 AND y < 500 AS ok, x + 150 >= 0 AND y + 40 >= 0 AND x + 150 < 900 AND y + 40 < 500 AS moved FROM p)
SELECT l_orderkey, l_linenumber, CASE WHEN ok THEN x WHEN moved THEN x + 150 END AS cx, CASE WHEN ok THEN y WHEN moved THEN y + 40 END AS cy FROM t""")
def q_canvas_points(spark, sf):
    """Annotation points on the canvas: as they are, else shifted by the bounds, else null."""
    p = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") - 100).alias("x"), (F.col("l_suppkey") * 7 - 30).alias("y"), F.lit(150).alias("bx"), F.lit(40).alias("by"), F.lit(900).alias("w"), F.lit(500).alias("h"))
    x, y = geo.to_canvas("x", "y", "bx", "by", "w", "h")
    return p.select("l_orderkey", "l_linenumber", x.alias("cx"), y.alias("cy"))


_BOXES = {"Tumor": (10.5, 20.5, 150.5, 130.5), "Stroma": (160.5, 10.5, 190.5, 60.5), "Ignore": (40.5, 40.5, 80.5, 90.5)}


@query(f"""WITH s AS (SELECT 'S' || s_suppkey AS slide_id, 2.0 + s_suppkey % 20 AS mpp, greatest(1, CAST(round_even(56.0::DOUBLE / (2.0 + s_suppkey % 20), 0) AS INT)) AS step FROM supplier),
g AS (SELECT slide_id, mpp, x, y FROM (SELECT *, unnest(range(0, 200, step))::INT AS y FROM s) a, LATERAL (SELECT unnest(range(0, 200, a.step))::INT AS x) b),
c AS (SELECT *, CASE WHEN x BETWEEN 10.5 AND 150.5 AND y BETWEEN 20.5 AND 130.5 THEN 1 WHEN x BETWEEN 160.5 AND 190.5 AND y BETWEEN 10.5 AND 60.5 THEN 0 END AS label FROM g WHERE NOT (x BETWEEN 40.5 AND 80.5 AND y BETWEEN 40.5 AND 90.5)),
k AS (SELECT * FROM c WHERE label IS NOT NULL QUALIFY row_number() OVER (PARTITION BY slide_id, label ORDER BY x, y) <= 60),
e AS (SELECT slide_id FROM (SELECT slide_id, label, count(*) AS n FROM k GROUP BY ALL) GROUP BY slide_id HAVING max(n) >= 20)
SELECT slide_id, x AS x_qp, y AS y_qp, label::INT AS label, mpp::DOUBLE AS mpp0 FROM k SEMI JOIN e USING (slide_id)""")
def q_training_points(spark, sf):
    """Labelled grid points of annotated polygons: the first of each class, slides with enough of one."""
    k = F.col("s_suppkey")
    s = table(spark, sf, "supplier").select(F.concat(F.lit("S"), k.cast("string")).alias("slide_id"), (2.0 + k % 20).cast("double").alias("mpp"), F.lit(200).alias("w"), F.lit(200).alias("h"))
    ring = F.array(*(F.struct(F.lit(n).alias("class_name"), F.array(F.array(*(F.array(F.lit(a), F.lit(b)) for a, b in ((x1, y1), (x2, y1), (x2, y2), (x1, y2))))).alias("rings")) for n, (x1, y1, x2, y2) in _BOXES.items()))
    a = s.select("slide_id", F.explode(ring).alias("r")).select("slide_id", "r.*")
    return stages.training_points(s, a, {"Tumor": 1, "Stroma": 0}, 56.0, 60, 20, ("Ignore",))


@query("SELECT * FROM (VALUES ('one/summary.csv', 'one/gate_summary.csv'), ('two/summary.csv', 'one/summary.csv')) v(other, path)")
def q_summary_path(spark, sf):
    """Where a stage's summary goes: beside another's of the same folder under a name of its own."""
    rows = [("one/summary.csv", run.summary_path("one", "one", "gate")), ("two/summary.csv", run.summary_path("one", "two", "gate"))]
    return spark.createDataFrame(rows, "other string, path string")


@query("SELECT * FROM (VALUES ('stride', '512'), ('qc.focus_min', '7.0'), ('tumor.high', '0.9'), ('mask.expected', '(0.1, 0.5)'), ('mask.soft', 'False'), ('tile', '224')) v(name, value)")
def q_settings(spark, sf):
    """Settings from YAML, laid over the defaults and under a profile."""
    with tempfile.TemporaryDirectory() as folder:  # read here, on the driver
        at = os.path.join(folder, "c.yaml")
        with open(at, "w") as f:
            f.write("stride: 512\nqc: {focus_min: 7.0}\nmask: {od_percentile: 40, soft: true, expected: [0.1, 0.5]}\ntumor: {high: 0.9}\n")
        s = run.read_settings(at, "scale_balanced_v1")
    got = {"stride": s.stride, "qc.focus_min": s.qc.focus_min, "tumor.high": s.tumor.high, "mask.expected": s.mask.expected, "mask.soft": s.mask.soft, "tile": s.tile}
    return spark.createDataFrame([(k, str(v)) for k, v in got.items()], "name string, value string")


def _kernel(spark, function, schema: str):
    """(img, ...) of a function from an image to rows, over the images of the pixel queries."""
    def rows(frames):
        import pandas as pd

        for frame in frames:
            for img, h, w, data in frame[["img", "h", "w", "rgb"]].itertuples(index=False):
                out = pd.DataFrame(function(np.frombuffer(data, np.uint8).reshape(int(h), int(w), 3)))
                out.insert(0, "img", int(img))
                yield out

    return map_pandas(_images(spark), rows, "img int, " + schema)


_INVERSE = np.linalg.inv(np.array([np.array(v) / np.linalg.norm(v) for v in raster.DEFAULT_STAINS]))


def _amount(k: int) -> str:
    return "greatest(" + " + ".join(f"({_INVERSE[c, k]!r}::DOUBLE * {_OD[n]})" for c, n in enumerate("rgb")).replace("np.float64(", "(") + ", 0)"


@query(f"WITH {PIXELS} SELECT img, round(avg({_amount(0)}), 7) AS h, round(avg({_amount(1)}), 7) AS e, round(avg({_amount(2)}), 7) AS r FROM pixels GROUP BY img")
def k_three_stains(spark, sf):
    """Mean amounts of three stains in each image."""
    def amounts(rgb):
        return {n: [round(float(c.mean()), 7)] for n, c in zip("her", raster.unmixed3(raster.od(rgb), raster.DEFAULT_STAINS))}

    return _kernel(spark, amounts, "h double, e double, r double")


@query(f"""WITH RECURSIVE {PIXELS}, m AS (SELECT img, y, x, y * {SIDE} + x AS id FROM pixels WHERE (x + 3 * y + img) % 7 < 3 AND (x * y + img) % 5 < 3),
r AS (SELECT img, y, x, id, id AS root FROM m UNION SELECT n.img, n.y, n.x, n.id, r.root FROM r JOIN m n ON n.img = r.img AND abs(n.y - r.y) <= 1 AND abs(n.x - r.x) <= 1 AND r.root < n.id),
c AS (SELECT img, id, min(y) AS y, min(x) AS x, min(root) AS root FROM r GROUP BY img, id)
SELECT img::INT AS img, root::BIGINT AS first, count(*) AS area, min(x)::BIGINT AS left, min(y)::BIGINT AS top, (max(x) + 1)::BIGINT AS right, (max(y) + 1)::BIGINT AS bottom FROM c GROUP BY img, root""")
def k_components(spark, sf):
    """8-connected components: their first pixel, area and box."""
    def run_(frames):
        import pandas as pd

        for frame in frames:
            for img, data in frame[["img", "mask"]].itertuples(index=False):
                mask = np.array(data, bool).reshape(SIDE, SIDE)
                c = raster.Components(mask)
                first = np.full(c.n, SIDE * SIDE)
                np.minimum.at(first, c.pixels, np.flatnonzero(mask))
                yield pd.DataFrame({"img": int(img), "first": first, "area": c.area, "left": c.left, "top": c.top, "right": c.right, "bottom": c.bottom})

    x, y, i = F.col("x"), F.col("y"), F.col("img")
    p = pixels(spark).withColumn("on", ((x + 3 * y + i) % 7 < 3) & ((x * y + i) % 5 < 3))
    p = p.groupBy("img").agg(F.transform(F.array_sort(F.collect_list(F.struct("y", "x", "on"))), lambda s: s["on"].cast("int")).alias("mask"))
    return map_pandas(p, run_, "img int, first long, area long, left long, top long, right long, bottom long")


_PEN = raster.ellipse_offsets(11)


def _grown(of: str) -> str:
    return f"(SELECT DISTINCT img, y + dy AS y, x + dx AS x FROM {of}, k)"


@query(f"""WITH {PIXELS}, {_HSV.format(src='pixels')}, k AS (SELECT unnest([{', '.join(str(a) for a, _ in _PEN)}]) AS dy, unnest([{', '.join(str(b) for _, b in _PEN)}]) AS dx),
pen AS (SELECT img, y, x FROM hsv WHERE sat >= 140 AND v BETWEEN 40 AND 245), one AS {_grown('pen')}, two AS {_grown('one')},
ok AS (SELECT img, y, x FROM pixels WHERE least(r, g, b) < 230 AND NOT ({_GRAY} <= 8 OR (r <= 12 AND g <= 12 AND b <= 12)))
SELECT i.img, count(c.y) AS n, coalesce(sum(c.y), 0)::BIGINT AS sy, coalesce(sum(c.x), 0)::BIGINT AS sx FROM (SELECT DISTINCT img FROM pixels) i LEFT JOIN (SELECT ok.* FROM ok ANTI JOIN two USING (img, y, x)) c ON c.img = i.img GROUP BY i.img""")
def k_clean_mask(spark, sf):
    """Stained pixels away from pen marks."""
    def clean(rgb):
        y, x = np.nonzero(raster.clean_mask(rgb))
        return {"n": [len(y)], "sy": [int(y.sum())], "sx": [int(x.sum())]}

    return _kernel(spark, clean, "n long, sy long, sx long")


def _as(name: str) -> str:
    return f"({ORACLES[name]})"


@query(f"""SELECT m.img::VARCHAR AS img, round(m.tissue_frac, 6) AS tissue_frac, round(f.focus, 3) AS focus, round(m.brightness, 3) AS brightness, round(m.qc_artifact_frac, 6) AS qc_artifact_frac, round(m.qc_rbc_frac, 6) AS qc_rbc_frac, round(f.adipose_proxy, 3) AS adipose_proxy,
  round(b.blood_score, 6) AS blood_score, round(f.laplacian_var, 3) AS texture, round(a.artifact_frac, 6) AS artifact_frac, round(x.h_mean, 6) AS h_mean, round(x.h_p90, 6) AS h_p90, round(x.e_mean, 6) AS e_mean, round(x.white_frac, 6) AS white_frac, round(m.qc_rbc_frac, 6) AS rbc_frac
FROM {_as('q_tile_metrics')} m JOIN {_as('q_focus')} f USING (img) JOIN {_as('q_blood')} b USING (img) JOIN {_as('q_artifact')} a USING (img)
JOIN (WITH {_UNMIXED} SELECT img, avg(h) AS h_mean, quantile_cont(h, 0.9) AS h_p90, avg(e) AS e_mean, avg(({_GRAY} > 235)::INT) AS white_frac FROM he GROUP BY img) x USING (img)""")
def k_tile_kernels(spark, sf):
    """The array kernels over the same images: quality metrics and tile features, in one pass."""
    out = masks.kernel_table(_images(spark), "tile_metrics", "tile_features")
    return out.select("img", *(F.round(c, 3 if c in ("focus", "brightness", "adipose_proxy", "texture") else 6).alias(c) for c in out.columns[1:]))
