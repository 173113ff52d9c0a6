"""Slide gates: tumour bands, top-k export, readiness, the mask and quality gate, and prechecks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import is_known, known, missing, readiness_reason, resolved_status, to_bool, to_float, tumor_band
from ..functions.ranks import top_per_key


@dataclass(frozen=True)
class TumorGate:
    high: float = 0.738
    mid: float = 0.5
    topk: int = 5000
    min_high: int = 100
    min_scored: int = 200
    min_ratio: float = 0.01
    high_from_topk: bool = False


def top_scored(scored: DataFrame, by: str, prob: str, key: str, k: int) -> DataFrame:
    """The k best patches of each slide with their rank; those without a score, null or NaN, come last and have none."""
    return top_per_key(scored.withColumn(prob, known(prob)), [by], [F.col(prob).desc_nulls_last(), F.col(key)], k, rank_col="rank")


def high_only(scored: DataFrame, by: str, prob: str, key: str, g: TumorGate) -> DataFrame:
    """Patches of the high band, of all scored ones or of the top k; NaN is no score."""
    base = top_scored(scored, by, prob, key, g.topk).drop("rank") if g.high_from_topk else scored
    return base.where((F.col(prob) >= g.high) & ~F.isnan(prob))


def regate(scored: DataFrame, by: str, prob: str, key: str, g: TumorGate) -> DataFrame:
    """One row per slide from persisted scores: band counts, ratio, export sizes, readiness and its reason.

    Null and NaN are no scores. A single aggregation: the top k of a slide hold min(k, n) rows, and of the high ones min(k, high), as they come first.
    """
    p = known(prob)
    out = scored.where(is_known(prob)).withColumn("band", tumor_band(p, g.high, g.mid)).groupBy(by).agg(
        F.count("*").alias("scored_ok"),
        F.count_if(F.col("band") == "high").alias("tumor_prob_ge_thr"),
        F.count_if(F.col("band") == "mid").alias("tumor_prob_mid"),
        F.count_if(F.col("band") == "low").alias("tumor_prob_low"),
    )
    out = out.withColumn("kept_topk", F.least("scored_ok", F.lit(g.topk).cast("long")))
    out = out.withColumn("high_tumor_only_count", F.least("tumor_prob_ge_thr", F.lit(g.topk).cast("long")) if g.high_from_topk else F.col("tumor_prob_ge_thr"))
    out = out.withColumn("high_ratio", F.col("tumor_prob_ge_thr") / F.greatest("scored_ok", F.lit(1)))
    out = out.withColumn("uni_discard_reason", readiness_reason("high_tumor_only_count", "scored_ok", "high_ratio", g.min_high, g.min_scored, g.min_ratio))
    return out.withColumn("uni_ready", F.col("uni_discard_reason") == "")


def resolved_diagnostics(rows: DataFrame) -> DataFrame:
    """Mask diagnostics as later stages see them: the effective status stands in for the global one where it is known."""
    status = resolved_status("mask_status_effective", "mask_status")
    return rows.withColumns(
        {
            "mask_status_global": F.coalesce("mask_status", F.lit("unknown")),
            "mask_status_effective": status,
            "mask_status": status,
            "status_basis": F.coalesce("status_basis", F.lit("global")),
            "fallback_used": to_bool("fallback_used"),
            "sparse_canvas_mode": to_bool("sparse_canvas_mode"),
            "mask_frac": to_float("mask_frac"),
            "mask_frac_effective": to_float("mask_frac_effective"),
            "profile_used": F.coalesce("profile_used", F.lit("")),
        }
    )


def lookup(slides: DataFrame, table: DataFrame, columns: list[str], uid: str = "slide_uid", slide_id: str = "slide_id", order: str | None = None) -> DataFrame:
    """slides with columns of table, found by uid and else by id.

    Of a table that repeats a key the row that is last in `order` counts, so that slides never fan out; without an order,
    which only tables of one row a key can do without, the largest row.
    """
    value = F.struct(*(F.col(c) for c in columns))
    last = F.max_by(value, F.struct(F.col(order), value)) if order else F.max(value)
    by_uid = table.where(~missing(uid)).groupBy(F.trim(F.col(uid)).alias("__uid")).agg(last.alias("__a"))
    by_id = table.where(~missing(slide_id)).groupBy(F.trim(F.col(slide_id)).alias("__id")).agg(last.alias("__b"))
    out = slides.join(by_uid, F.trim(slides[uid]) == F.col("__uid"), "left").join(by_id, F.trim(slides[slide_id]) == F.col("__id"), "left")
    found = F.coalesce("__a", "__b")
    return out.withColumns({c: found[c] for c in columns}).drop("__uid", "__id", "__a", "__b")


@dataclass(frozen=True)
class SlideGate:
    ok: tuple[str, ...] = ("ok", "high_tissue")
    min_candidates: int = 200
    min_qc_pass: int = 80
    adaptive: bool = True
    dataset_rate: float = 16 / 18
    subset_rate: float = 3 / 4
    dataset_min: int = 16
    subset_min: int = 3
    subset_prefix: str = "DigitalSlide"


def gated_slides(masks: DataFrame, runs: DataFrame, g: SlideGate = SlideGate(), on: str = "slide_uid") -> DataFrame:
    """Mask rows, left-joined with the run's counts (rows that repeat a key fan out), and whether each slide passes."""
    out = masks.join(runs.select(on, "candidates_after_mask", "qc_pass"), on, "left")
    out = out.withColumn("status_for_gate", F.lower(resolved_status("mask_status_effective", "mask_status")))
    out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("candidates_after_mask", "qc_pass")})
    return out.withColumn("slide_pass", F.col("status_for_gate").isin(*g.ok) & (F.col("candidates_after_mask") >= g.min_candidates) & (F.col("qc_pass") >= g.min_qc_pass))


def gate_totals(slides: DataFrame, g: SlideGate = SlideGate(), slide_id: str = "slide_id") -> DataFrame:
    """One row: how many slides passed, of all and of the subset, how many must, and the verdict."""
    sub = F.startswith(F.col(slide_id), F.lit(g.subset_prefix))
    out = slides.agg(
        F.count("*").alias("n_total"),
        F.count_if("slide_pass").alias("n_pass"),
        F.count_if(sub).alias("n_subset"),
        F.count_if(sub & F.col("slide_pass")).alias("n_subset_pass"),
    )
    if g.adaptive:
        need = {"required": F.ceil(F.lit(g.dataset_rate) * F.col("n_total")), "required_subset": F.ceil(F.lit(g.subset_rate) * F.col("n_subset"))}
    else:
        need = {"required": F.lit(g.dataset_min), "required_subset": F.lit(g.subset_min)}
    out = out.withColumns({k: v.cast("long") for k, v in need.items()})
    return out.withColumn("passed", (F.col("n_pass") >= F.col("required")) & (F.col("n_subset_pass") >= F.col("required_subset")))


#: Mask statuses after which a slide is not opened.
FAILED = ("read_error", "open_error", "mask_error")


def precheck(slides: DataFrame, masks: DataFrame, by: str = "slide_uid") -> DataFrame:
    """One row: slides whose mask is there, missing after a known failure, and missing without a reason."""
    status = masks.select(F.col(by).alias("__k"), F.lower(F.trim("mask_status")).alias("__s")).groupBy("__k").agg(F.max("__s").alias("__s"))
    out = slides.join(status, slides[by] == F.col("__k"), "left")
    bad = F.col("__s").isin(*FAILED)
    return out.agg(
        F.count("*").alias("slides"),
        F.count_if(F.col("__k").isNotNull() & ~F.coalesce(bad, F.lit(False))).alias("found"),
        F.count_if(bad).alias("known_failures"),
        F.count_if(F.col("__k").isNull()).alias("missing"),
    )


def require(counts: DataFrame, rule: str, message: str) -> None:
    """Raise unless the one row of counts satisfies a rule."""
    row = counts.where(rule).first()
    if row is None:
        raise ValueError(f"{message}: {counts.first()}")


