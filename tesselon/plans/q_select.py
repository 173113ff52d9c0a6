"""Queries: gates, ranking, caps, quotas, sampling and quality predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import ranks
from ..operators import gate, select, summary
from .base import LABELLED, PATCHES, labelled, patches, query, table

GATE = gate.TumorGate(high=0.2, mid=0.1, topk=40, min_high=4, min_scored=30, min_ratio=0.06)

_REGATE = f"""
WITH {PATCHES}, bands AS (SELECT slide, count(*) AS scored_ok, count(*) FILTER (prob >= 0.2) AS hi, count(*) FILTER (prob >= 0.1 AND prob < 0.2) AS mid, count(*) FILTER (prob < 0.1) AS low FROM patches WHERE prob IS NOT NULL GROUP BY slide),
reason AS (SELECT *, round(hi / greatest(scored_ok, 1), 9) AS ratio, CASE WHEN hi < 4 THEN 'high_tumor_only<4' WHEN scored_ok < 30 THEN 'scored_ok<30' WHEN hi / greatest(scored_ok, 1) < 0.06 THEN 'high_ratio<0.06' ELSE '' END AS why FROM bands)
SELECT slide, scored_ok, hi AS tumor_prob_ge_thr, mid AS tumor_prob_mid, low AS tumor_prob_low, least(scored_ok, 40) AS kept_topk, hi AS high_tumor_only_count, ratio AS high_ratio, why AS uni_discard_reason, why = '' AS uni_ready FROM reason"""


@query(_REGATE)
def q_regate(spark, sf):
    """Slides re-gated from stored scores."""
    return gate.regate(patches(spark, sf), "slide", "prob", "patch", GATE).withColumn("high_ratio", F.round("high_ratio", 9))


@query(f"WITH {PATCHES} SELECT slide, patch, round((rank() OVER (PARTITION BY slide ORDER BY value) + (count(*) OVER (PARTITION BY slide, value) - 1) / 2) / count(*) OVER (PARTITION BY slide), 9) AS pct FROM patches")
def q_pct_rank_avg(spark, sf):
    return patches(spark, sf).select("slide", "patch", F.round(ranks.pct_rank_avg(["slide"], "value"), 9).alias("pct"))


_FEATURES = """feats AS (SELECT slide, patch, value AS h_mean, value * (k % 7 + 1) AS h_p90, CAST(k AS DOUBLE) AS e_mean, CAST(k * 37 % 101 AS DOUBLE) AS blood_score, CAST(patch * 7919 % 997 AS DOUBLE) AS texture,
  CAST(patch * 31 % 89 AS DOUBLE) AS white_frac, CAST(k % 13 AS DOUBLE) AS artifact_frac, CAST(patch * 17 % 53 AS DOUBLE) AS rbc_frac FROM patches)"""


def _features(spark, sf):
    p, k = F.col("patch"), F.col("k")
    return patches(spark, sf).select(
        "slide",
        "patch",
        F.col("value").alias("h_mean"),
        (F.col("value") * (k % 7 + 1)).alias("h_p90"),
        k.cast("double").alias("e_mean"),
        (k * 37 % 101).cast("double").alias("blood_score"),
        (p * 7919 % 997).cast("double").alias("texture"),
        (p * 31 % 89).cast("double").alias("white_frac"),
        (k % 13).cast("double").alias("artifact_frac"),
        (p * 17 % 53).cast("double").alias("rbc_frac"),
    )


def _pct(value: str) -> str:
    return f"(rank() OVER (PARTITION BY slide ORDER BY {value}) + (count(*) OVER (PARTITION BY slide, {value}) - 1) / 2) / count(*) OVER (PARTITION BY slide)"


_SCORED = f"""
WITH {PATCHES}, {_FEATURES}, ranked AS (SELECT slide, patch, {', '.join(f'{_pct(k)} AS {v}' for k, v in select.RANKS.items())} FROM feats),
scored AS (SELECT *, round(0.30 * h_mean_p + 0.30 * h_p90_p + 0.30 * tex_p + 0.10 * e_p - 0.40 * white_p - 0.60 * artifact_p - 0.30 * blood_p - 0.60 * rbc_p, 9) AS score FROM ranked),
typed AS (SELECT *, {_pct('score')} AS cell_rich_p FROM scored)
SELECT slide, patch, score + 0.0 AS cell_rich_score, round(cell_rich_p, 9) AS cell_rich_p, CASE WHEN (blood_p >= 0.85 OR rbc_p >= 0.85) AND h_p90_p < 0.70 THEN 'C' WHEN cell_rich_p >= 0.70 AND artifact_p <= 0.70 THEN 'A'
  WHEN cell_rich_p >= 0.45 AND artifact_p <= 0.80 THEN 'B' ELSE 'D' END AS type FROM typed"""


@query(_SCORED)
def q_composite_type(spark, sf):
    """Percentile ranks of eight features, their weighted sum, its rank and the type."""
    out = select.score_patches(_features(spark, sf), ["slide"])
    return out.select("slide", "patch", (F.round("cell_rich_score", 9) + 0.0).alias("cell_rich_score"), F.round("cell_rich_p", 9).alias("cell_rich_p"), "type")


@query(f"WITH {PATCHES} SELECT slide, patch, value FROM patches QUALIFY row_number() OVER (PARTITION BY slide, floor(value / 25), floor(k / 20) ORDER BY value DESC, patch) <= 3")
def q_spatial_cap(spark, sf):
    p = patches(spark, sf).withColumns({"x": F.col("value"), "y": F.col("k") * 25 / 20})
    return select.spatial_cap(p, ["slide"], "x", "y", "value", "patch", cell=25, most=3).select("slide", "patch", "value")


def _quota_sql(target: int, na: int, nb: int, nc: int, max_d: int, one: bool, fill: bool) -> str:
    d_room = f"least({target} - n2, {max_d})" if not one else f"CASE WHEN {target} > n2 THEN greatest(least({target} - n2, {max_d}), 1) ELSE 0 END"
    order = "ORDER BY value DESC, patch"
    last = f"""five AS (SELECT *, sum(CASE WHEN step > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY slide) AS n4, sum(CASE WHEN step = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY slide {order} ROWS UNBOUNDED PRECEDING) AS r4 FROM three)
SELECT slide, patch, type, CASE WHEN step = 0 THEN 4 ELSE step END AS step FROM five WHERE step > 0 OR (step = 0 AND r4 <= {target} - n4)""" if fill else "five AS (SELECT 1) SELECT slide, patch, type, step FROM three WHERE step > 0"
    return f"""
WITH {PATCHES}, zero AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY slide, type {order}) <= CASE type WHEN 'A' THEN {na} WHEN 'B' THEN {nb} WHEN 'C' THEN {nc} ELSE 0 END THEN 1 ELSE 0 END AS s0 FROM patches),
half AS (SELECT *, sum(s0) OVER (PARTITION BY slide {order} ROWS UNBOUNDED PRECEDING) AS r0 FROM zero),
one AS (SELECT *, CASE WHEN s0 = 1 AND r0 > {target} THEN -1 ELSE s0 END AS s1 FROM half),
mid AS (SELECT *, sum(CASE WHEN s1 > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY slide) AS n1, sum(CASE WHEN s1 = 0 AND type <> 'D' THEN 1 ELSE 0 END) OVER (PARTITION BY slide {order} ROWS UNBOUNDED PRECEDING) AS r1 FROM one),
two AS (SELECT *, CASE WHEN s1 = 0 AND type <> 'D' AND r1 <= {target} - n1 THEN 2 ELSE s1 END AS s2 FROM mid),
low AS (SELECT *, sum(CASE WHEN s2 > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY slide) AS n2, sum(CASE WHEN s2 = 0 AND type = 'D' THEN 1 ELSE 0 END) OVER (PARTITION BY slide {order} ROWS UNBOUNDED PRECEDING) AS r2 FROM two),
three AS (SELECT *, CASE WHEN s2 = 0 AND type = 'D' AND r2 <= {d_room} THEN 3 ELSE s2 END AS step FROM low),
{last}"""


def _quota(spark, sf, q):
    return select.quota_select(patches(spark, sf), ["slide"], "value", "type", "patch", q).select("slide", "patch", "type", "step")


@query(_quota_sql(45, 14, 9, 7, 4, False, False))
def q_quota_select(spark, sf):
    return _quota(spark, sf, select.Quotas(45, {"A": 0.3, "B": 0.2, "C": 0.15}, blood_cap=0.2, max_d=0.1))


@query(_quota_sql(60, 12, 12, 6, 0, True, False))
def q_quota_select_one_d(spark, sf):
    return _quota(spark, sf, select.Quotas(60, {"A": 0.2, "B": 0.2, "C": 0.1}, blood_cap=0.1, max_d=0.0, one_d_at_least=True))


@query(_quota_sql(50, 25, 25, 10, 5, False, True))
def q_quota_select_fill(spark, sf):
    """Quotas over the target, and anything to reach it."""
    return _quota(spark, sf, select.Quotas(50, {"A": 0.5, "B": 0.5, "C": 0.2}, blood_cap=0.3, max_d=0.1, allow_under_target=False))


@query(f"WITH {PATCHES} SELECT slide, patch, round(prob, 9) AS prob, row_number() OVER (PARTITION BY slide ORDER BY prob DESC, patch) AS rank FROM patches QUALIFY rank <= 10")
def q_topk_per_slide(spark, sf):
    return gate.top_scored(patches(spark, sf), "slide", "prob", "patch", 10).select("slide", "patch", F.round("prob", 9).alias("prob"), F.col("rank").cast("long").alias("rank"))


@query(f"WITH {PATCHES}, top AS (SELECT *, row_number() OVER (PARTITION BY slide ORDER BY prob DESC, patch) AS r FROM patches) SELECT slide, patch, round(prob, 9) AS prob FROM top WHERE r <= 5 AND prob >= 0.3")
def q_high_only_from_topk(spark, sf):
    return gate.high_only(patches(spark, sf), "slide", "prob", "patch", gate.TumorGate(high=0.3, topk=5, high_from_topk=True)).select("slide", "patch", F.round("prob", 9).alias("prob"))


@query(f"WITH {PATCHES} SELECT slide, patch, round(prob, 9) AS prob FROM patches ORDER BY prob DESC, patch LIMIT 25")
def q_topk_global(spark, sf):
    return patches(spark, sf).orderBy(C.known("prob").desc_nulls_last(), "patch").limit(25).select("slide", "patch", F.round("prob", 9).alias("prob"))


@query(f"WITH {PATCHES} SELECT slide, patch FROM patches QUALIFY row_number() OVER (PARTITION BY slide ORDER BY md5('42:' || slide || ':' || patch), patch) <= 5")
def q_sample_exact_n(spark, sf):
    return ranks.sample_exact(patches(spark, sf), ["slide"], 5, 42, ["patch"]).select("slide", "patch")


@query("SELECT lang, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5('7:' || lang || ':' || doc_id), doc_id) <= 15")
def q_sample_per_class(spark, sf):
    return ranks.sample_exact(table(spark, sf, "documents").select("lang", "doc_id"), ["lang"], 15, 7, ["doc_id"])


@query(f"""WITH {PATCHES}, n AS (SELECT slide, patch, row_number() OVER (PARTITION BY slide ORDER BY patch) - 1 AS i, count(*) OVER (PARTITION BY slide) AS c FROM patches),
steps AS (SELECT DISTINCT slide, c, CAST(floor(k * (c - 1) / 9.0::DOUBLE) AS BIGINT) AS i FROM (SELECT DISTINCT slide, c FROM n), (SELECT unnest(range(10)) AS k) WHERE c > 10)
SELECT n.slide, patch FROM n LEFT JOIN steps s ON s.slide = n.slide AND s.i = n.i WHERE n.c <= 10 OR s.i IS NOT NULL""")
def q_even_sample(spark, sf):
    return ranks.even_sample(patches(spark, sf), ["slide"], ["patch"], 10).select("slide", "patch")


_QC = "l_quantity / 50 >= 0.3 AND l_extendedprice / 1000 >= 5 AND l_extendedprice / 400 >= 20 AND l_discount <= 0.06 AND l_tax <= 0.05 AND l_extendedprice / 400 <= 180 AND l_tax * 10 < 0.75"


@query(f"SELECT l_returnflag, count(*) AS n, count(*) FILTER ({_QC}) AS n_pass FROM lineitem GROUP BY l_returnflag")
def q_qc_conjunction(spark, sf):
    t = select.QcThresholds(0.3, 5, 20, 0.06, 0.05, 180, 0.75)
    c = F.col
    rows = table(spark, sf, "lineitem").select(
        "l_returnflag", (c("l_quantity") / 50).alias("tissue_frac"), (c("l_extendedprice") / 1000).alias("focus"), (c("l_extendedprice") / 400).alias("brightness"),
        c("l_discount").alias("qc_artifact_frac"), c("l_tax").alias("qc_rbc_frac"), (c("l_tax") * 10).alias("adipose_proxy"),
    )
    return rows.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.count_if(select.qc_predicate(t)).alias("n_pass"))


@query("""WITH s AS (SELECT DISTINCT user_id AS slide FROM events), good AS (SELECT user_id AS slide, count(*) AS n, avg(value) AS m FROM events WHERE value > 300 GROUP BY user_id)
SELECT s.slide, coalesce(n, 0) AS n_pass, round(m, 9) AS mean_value, CASE WHEN coalesce(n, 0) < 1 THEN 'reject' WHEN n < 2 THEN 'warn' ELSE 'ok' END AS verdict FROM s LEFT JOIN good USING (slide)""")
def q_zero_row_slides(spark, sf):
    """Slides without a passing patch keep a row of zeros."""
    p = patches(spark, sf)
    good = p.where("value > 300").groupBy("slide").agg(F.count("*").alias("n_pass"), F.round(F.avg("value"), 9).alias("mean_value"))
    out = p.select("slide").distinct().join(good, "slide", "left").withColumn("n_pass", F.coalesce("n_pass", F.lit(0).cast("long")))
    return out.withColumn("verdict", select.slide_verdict(F.col("n_pass"), 1, 2))


@query(f"""WITH {PATCHES} SELECT slide, 'mask_error' AS status, 0 AS n_good, NULL::DOUBLE AS best FROM patches WHERE kind = 'error' GROUP BY slide
UNION ALL SELECT slide, 'ok', count(*), round(max(value), 9) FROM patches WHERE kind <> 'error' GROUP BY slide""")
def q_error_branch_union(spark, sf):
    """Failed rows take a branch of their own and come back without the columns that they lack."""
    p = patches(spark, sf)
    bad = p.where("kind = 'error'").groupBy("slide").agg(F.lit("mask_error").alias("status"), F.lit(0).cast("long").alias("n_good"))
    good = p.where("kind <> 'error'").groupBy("slide").agg(F.lit("ok").alias("status"), F.count("*").alias("n_good"), F.round(F.max("value"), 9).alias("best"))
    return summary.union_all(bad, good).select("slide", "status", "n_good", "best")


@query("SELECT doc_id, source FROM documents ANTI JOIN labels USING (doc_id)")
def q_resume_antijoin(spark, sf):
    return summary.not_done(table(spark, sf, "documents").select("doc_id", "source"), table(spark, sf, "labels"), ["doc_id"])


@query("SELECT doc_id, source FROM documents SEMI JOIN labels USING (doc_id)")
def q_semi_join_exists(spark, sf):
    return summary.only_known(table(spark, sf, "documents").select("doc_id", "source"), table(spark, sf, "labels"), ["doc_id"])


@query(f"WITH {PATCHES}, m AS (SELECT slide, md5('3:' || slide || ':' || patch) AS h, patch FROM patches), s AS (SELECT *, row_number() OVER (PARTITION BY slide ORDER BY h, patch) - 1 AS slot FROM m QUALIFY slot < 30), g AS (SELECT *, CAST(ceil(sqrt(count(*) OVER (PARTITION BY slide))) AS INT) AS grid FROM s) SELECT slide, patch, grid, CAST(slot // grid AS INT) AS grid_row, CAST(slot % grid AS INT) AS grid_col FROM g")
def q_montage_layout(spark, sf):
    return summary.montage(patches(spark, sf), ["slide"], "patch", 30, 3).select("slide", "patch", "grid", "grid_row", "grid_col")


@query(f"""WITH {PATCHES}, r AS (SELECT slide, patch, k, value, prob, row_number() OVER (PARTITION BY slide ORDER BY prob DESC, patch) - 1 AS rank FROM patches)
SELECT slide, patch, printf('%05d_x%d_y%d_p%.4f.png', rank, CAST(floor(value) AS BIGINT), k, prob) AS name FROM r WHERE rank < 5""")
def q_ranked_names(spark, sf):
    top = gate.top_scored(patches(spark, sf), "slide", "prob", "patch", 5)
    return top.select("slide", "patch", C.ranked_name(F.col("rank") - 1, F.floor("value"), "k", "prob").alias("name"))


@query(f"WITH {LABELLED}, c AS (SELECT slide, count(*) AS n, sum(label) AS p FROM labelled GROUP BY slide) SELECT slide, n AS n_patches, p::BIGINT AS n_pos, (n - p)::BIGINT AS n_neg, round(p / n, 9) AS tumor_frac, n = p AS pos_only, p = 0 AS neg_only, n <> p AND p <> 0 AS mixed FROM c")
def q_label_composition(spark, sf):
    return summary.label_composition(labelled(spark, sf), "slide", "label").withColumn("tumor_frac", F.round("tumor_frac", 9))


@query("""WITH c AS (SELECT user_id AS slide, count(*) AS n, count(*) FILTER (event_type <> 'error') AS ok, count(*) FILTER (event_type = 'view') AS a, count(*) FILTER (event_type = 'click') AS b,
  round(avg(value) FILTER (event_type <> 'error'), 9) AS m, round(quantile_cont(value, 0.5) FILTER (event_type <> 'error'), 9) AS med FROM events GROUP BY user_id)
SELECT slide, n AS candidates_after_mask, ok AS qc_pass, ok AS selected_count, a + b AS good_count, m AS mean_blood_score, med AS median_cell_rich FROM c""")
def q_slide_summary(spark, sf):
    """Counts, means and the exact median of each slide's selection."""
    p = patches(spark, sf).withColumns({"qc_ok": F.col("kind") != "error", "blood_score": F.col("value"), "rbc_frac": F.col("prob"), "cell_rich_p": F.col("value")})
    out = select.qc_summary(p.select("slide").distinct(), p, p.where("qc_ok"), "slide")
    return out.select("slide", "candidates_after_mask", "qc_pass", "selected_count", "good_count", F.round("mean_blood_score", 9).alias("mean_blood_score"), F.round("median_cell_rich", 9).alias("median_cell_rich"))
