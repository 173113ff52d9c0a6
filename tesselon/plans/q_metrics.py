"""Queries: classifier metrics, calibration, histograms and training history."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import ranks
from ..operators import metrics as M
from .base import LABELLED, PATCHES, labelled, patches, query, table

_PRED = f"{PATCHES}, pred AS (SELECT patch, CASE WHEN kind = 'purchase' THEN 1 ELSE 0 END AS y, round(prob * (1 + k % 3), 6) AS s FROM patches)"


def _pred(spark, sf):
    return patches(spark, sf).select("patch", "slide", (F.col("kind") == "purchase").cast("int").alias("y"), F.round(F.col("prob") * (1 + F.col("k") % 3), 6).alias("s"))


def _rates(eps: str = "+ 1e-9", wrap=("", "")) -> str:
    def d(x):
        return f"greatest({x}, 1)" if wrap[0] else f"({x} {eps})"
    return ", ".join(
        f"round({a} / {d(b)}, 9) AS {n}"
        for n, a, b in (("acc", "(tp + tn)", "tp + tn + fp + fn"), ("sens", "tp", "tp + fn"), ("spec", "tn", "tn + fp"), ("precision", "tp", "tp + fp"), ("npv", "tn", "tn + fn"), ("fpr", "fp", "fp + tn"), ("fnr", "fn", "fn + tp"))
    )


_RATES = ("acc", "sens", "spec", "precision", "npv", "fpr", "fnr")


@query(f"""WITH {LABELLED}, p AS (SELECT slide, label AS y, patch % 31 <> 3 AND patch % 37 <> 4 AND least(n_chars / 5000.0::DOUBLE, 1) >= 0.3 AS hit FROM labelled), c AS (SELECT slide, count(*) FILTER (y <> 1 AND NOT hit) AS tn, count(*) FILTER (y <> 1 AND hit) AS fp, count(*) FILTER (y = 1 AND NOT hit) AS fn,
  count(*) FILTER (y = 1 AND hit) AS tp FROM p GROUP BY slide) SELECT slide, tn, fp, fn, tp, {_rates()} FROM c""")
def q_confusion_rates(spark, sf):
    s = F.when(F.col("patch") % 31 == 3, float("nan")).when(F.col("patch") % 37 != 4, F.least(F.col("n_chars") / 5000.0, F.lit(1.0)))
    p = labelled(spark, sf).withColumn("s", s)
    return M.confusion(p, "label", "s", 0.3, ("slide",)).withColumns({c: F.round(c, 9) for c in _RATES})


@query(f"WITH {LABELLED}, n AS (SELECT label, count(*) AS n FROM labelled GROUP BY label) SELECT label, n AS n_label, round((SELECT sum(n) FROM n) / (2 * greatest(n, 1)), 9) AS weight FROM n")
def q_class_weights(spark, sf):
    return M.class_weights(labelled(spark, sf), "label").withColumn("weight", F.round("weight", 9))


@query(f"""WITH {_PRED}, r AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2 AS r FROM pred WHERE s IS NOT NULL), t AS (SELECT sum(r) FILTER (y = 1) AS sr, count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS n FROM r)
SELECT round((sr - p * (p + 1) / 2) / (p * n), 9) AS roc_auc FROM t""")
def q_roc_auc(spark, sf):
    return M.roc_auc(_pred(spark, sf), "y", "s").withColumn("roc_auc", F.round("roc_auc", 9))


_STEPS = f"""{_PRED}, n AS (SELECT s, count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS q FROM pred WHERE s IS NOT NULL GROUP BY s),
c AS (SELECT s, p, q, sum(p) OVER (ORDER BY s DESC) AS tp, sum(q) OVER (ORDER BY s DESC) AS fp, sum(p) OVER () AS ap, sum(q) OVER () AS aq FROM n)"""


@query(f"WITH {_STEPS} SELECT round(sum(p / ap * (tp / (tp + fp))), 9) AS average_precision FROM c")
def q_avg_precision(spark, sf):
    return M.average_precision(_pred(spark, sf), "y", "s").withColumn("average_precision", F.round("average_precision", 9))


@query(f"WITH {_STEPS} SELECT s AS threshold, round(fp / aq, 9) AS fpr, round(tp / ap, 9) AS tpr FROM c")
def q_roc_curve(spark, sf):
    return M.roc_curve(_pred(spark, sf), "y", "s").withColumns({c: F.round(c, 9) for c in ("fpr", "tpr")})


@query(f"WITH {_STEPS} SELECT s AS threshold, round(tp / (tp + fp), 9) AS precision, round(tp / ap, 9) AS recall FROM c")
def q_pr_curve(spark, sf):
    return M.pr_curve(_pred(spark, sf), "y", "s").withColumns({c: F.round(c, 9) for c in ("precision", "recall")})


_SWEEP = f"""{_PRED}, g AS (SELECT unnest(range(501)) / 500.0::DOUBLE AS t), c AS (SELECT t, count(*) FILTER (y = 0 AND NOT coalesce(s >= t, FALSE)) AS tn, count(*) FILTER (y = 0 AND s >= t) AS fp, count(*) FILTER (y = 1 AND NOT coalesce(s >= t, FALSE)) AS fn, count(*) FILTER (y = 1 AND s >= t) AS tp FROM g, pred GROUP BY t)"""


@query(f"WITH {_SWEEP} SELECT round(t, 9) AS threshold, tn, fp, fn, tp, round(tp / (tp + fn + 1e-9) + tn / (tn + fp + 1e-9) - 1, 9) + 0.0 AS objective FROM c")
def q_threshold_sweep(spark, sf):
    return M.threshold_sweep(_pred(spark, sf), "y", "s").select(F.round("threshold", 9).alias("threshold"), "tn", "fp", "fn", "tp", (F.round("objective", 9) + 0.0).alias("objective"))


@query(f"""WITH {_SWEEP}, o AS (SELECT t, tp / (tp + fp + 1e-9) AS pr, tp / (tp + fn + 1e-9) AS re FROM c), f AS (SELECT t, 2 * pr * re / (pr + re + 1e-9) AS f1 FROM o)
SELECT round(t, 9) AS threshold, round(f1, 9) AS objective FROM f ORDER BY round(f1, 12) DESC, t LIMIT 1""")
def q_best_threshold_f1(spark, sf):
    return M.best_threshold(M.threshold_sweep(_pred(spark, sf), "y", "s", mode="f1")).select(F.round("threshold", 9).alias("threshold"), F.round("objective", 9).alias("objective"))


@query(f"""WITH {_PRED}, w AS (SELECT patch, y, s, CASE WHEN y = 0 THEN 'fp' ELSE 'fn' END AS kind, CASE WHEN y = 0 THEN s ELSE -s END AS e FROM pred WHERE (y = 0 AND s >= 0.5) OR (y = 1 AND NOT coalesce(s >= 0.5, FALSE)))
SELECT patch, y, s, kind, row_number() OVER (PARTITION BY kind ORDER BY e DESC NULLS LAST, patch) AS rank FROM w QUALIFY rank <= 50""")
def q_hard_fp_fn(spark, sf):
    return M.hard_examples(_pred(spark, sf), "y", "s", "patch", 50).select("patch", "y", C.known("s").alias("s"), "kind", F.col("rank").cast("long").alias("rank"))


@query("""WITH RECURSIVE h AS (SELECT row_number() OVER (ORDER BY year(o_orderdate), month(o_orderdate)) AS e, round(avg(o_totalprice) / 300000, 6) AS m FROM orders GROUP BY year(o_orderdate), month(o_orderdate)),
f AS (SELECT e, m, m AS best, TRUE AS improved, 0 AS bad, FALSE AS stopped FROM h WHERE e = 1
  UNION ALL SELECT h.e, h.m, CASE WHEN h.m > best + 1e-4 THEN h.m ELSE best END, h.m > best + 1e-4 AND NOT stopped, CASE WHEN h.m > best + 1e-4 THEN 0 ELSE bad + 1 END, stopped OR (CASE WHEN h.m > best + 1e-4 THEN 0 ELSE bad + 1 END) >= 3 FROM f JOIN h ON h.e = f.e + 1)
SELECT e AS epoch, m AS auc, best, improved, bad::INT AS bad, stopped FROM f""")
def q_early_stop(spark, sf):
    o = table(spark, sf, "orders").groupBy((F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("mon")).agg(F.round(F.avg("o_totalprice") / 300000, 6).alias("auc"))
    from pyspark.sql import Window

    h = o.select(F.row_number().over(Window.orderBy("mon")).alias("epoch"), "auc")
    return ranks.best_so_far(h, "epoch", "auc")


@query("""WITH e AS (SELECT l_suppkey, count(*) AS n, quantile_cont(l_extendedprice, 0.7) AS a, quantile_cont(l_discount, 0.7) AS b FROM lineitem GROUP BY l_suppkey)
SELECT round(greatest(quantile_cont(a, 0.75), 8.0), 9) AS l_extendedprice, round(greatest(quantile_cont(b, 0.75), 0.25), 9) AS l_discount FROM e WHERE n >= 64""")
def q_calibration_percentiles(spark, sf):
    out = M.calibration(table(spark, sf, "lineitem"), "l_suppkey", {"l_extendedprice": (0.7, 0.75, 8.0), "l_discount": (0.7, 0.75, 0.25)})
    return out.select(*(F.round(c, 9).alias(c) for c in out.columns))


@query(f"WITH {_PRED} SELECT y, least(greatest(CAST(floor(s * 40) AS INT), 0), 39) AS bin, count(*) AS n FROM pred WHERE s IS NOT NULL GROUP BY ALL")
def q_histogram(spark, sf):
    return M.histogram(_pred(spark, sf), ["y"], "s", 40)


@query("""WITH h AS (SELECT least(greatest(CAST(floor(value) AS INT), 0), 255) AS bin, count(*) AS n FROM events GROUP BY 1), c AS (SELECT bin, sum(n) OVER (ORDER BY bin) AS w0, sum(n * bin) OVER (ORDER BY bin) AS s0, sum(n) OVER () AS n, sum(n * bin) OVER () AS s FROM h)
SELECT bin AS threshold, round(w0 / n * (1 - w0 / n) * pow(s0 / w0 - (s - s0) / (n - w0), 2), 6) AS between FROM c WHERE w0 < n ORDER BY between DESC, bin LIMIT 1""")
def q_histogram_otsu(spark, sf):
    return M.otsu(table(spark, sf, "events"), "value")


@query(f"""WITH {_PRED}, w AS (SELECT CAST(patch % 4 + 1 AS INT) AS epoch, count(*) FILTER (y = 0 AND s >= 0.5) AS fp, count(*) FILTER (y = 1 AND NOT coalesce(s >= 0.5, FALSE)) AS fn FROM pred GROUP BY 1)
SELECT epoch, least(fp, CASE WHEN epoch = 1 THEN 200 ELSE 50 END) AS n_fp, least(fn, CASE WHEN epoch = 1 THEN 200 ELSE 50 END) AS n_fn FROM w""")
def q_hard_example_files(spark, sf):
    """How many hard examples each epoch's file holds, the epoch read from its name."""
    p = _pred(spark, sf).withColumn("file", F.format_string("hard_fp_epoch%d_thr0.50.csv", (F.col("patch") % 4 + 1).cast("int")))
    c = p.groupBy(C.epoch_of("file").alias("epoch")).agg(*M.cells("y", "s"))
    limit = F.when(F.col("epoch") == 1, 200).otherwise(50)
    return c.select("epoch", F.least("fp", limit.cast("long")).alias("n_fp"), F.least("fn", limit.cast("long")).alias("n_fn"))


@query("""SELECT source AS slide, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, slide LIMIT 15""")
def q_error_slides_top(spark, sf):
    return table(spark, sf, "documents").groupBy(F.col("source").alias("slide")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "slide").limit(15)


@query("SELECT o_orderpriority AS stage, count(*) AS runs, round(sum(o_totalprice), 2) AS seconds FROM orders GROUP BY 1")
def q_stage_timings(spark, sf):
    return table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("stage")).agg(F.count("*").alias("runs"), F.round(F.sum(F.col("o_totalprice").cast("decimal(20,2)")), 2).cast("double").alias("seconds"))
