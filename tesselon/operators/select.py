"""Choosing patches: quality predicates, percentile scores, types, spatial caps and type quotas."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import known
from ..functions.ranks import pct_rank_avg, top_per_key


@dataclass(frozen=True)
class QcThresholds:
    # The defaults.
    tissue_min: float = 0.80
    focus_min: float = 50.0
    brightness_min: float = 80.0
    artifact_max: float = 0.12
    rbc_max: float = 0.20
    brightness_max: float | None = 240.0
    adipose_max: float | None = 0.75


def qc_predicate(t: QcThresholds = QcThresholds(), **columns: str) -> Column:
    """The quality conjunction; columns names the metric columns where they differ. Null and NaN never pass."""
    def c(name):
        return known(columns.get(name, name))

    out = (c("tissue_frac") >= t.tissue_min) & (c("focus") >= t.focus_min) & (c("brightness") >= t.brightness_min)
    out &= (c("qc_artifact_frac") <= t.artifact_max) & (c("qc_rbc_frac") <= t.rbc_max)
    if t.brightness_max is not None:
        out &= c("brightness") <= t.brightness_max
    if t.adipose_max is not None:
        out &= c("adipose_proxy") < t.adipose_max
    return F.coalesce(out, F.lit(False))


# Fixed values.
#: How much each percentile rank adds to the cell-rich score.
WEIGHTS = {"h_mean": 0.30, "h_p90": 0.30, "texture": 0.30, "e_mean": 0.10, "white_frac": -0.40, "artifact_frac": -0.60, "blood_score": -0.30, "rbc_frac": -0.60}
#: The rank columns' names.
RANKS = {"h_mean": "h_mean_p", "h_p90": "h_p90_p", "texture": "tex_p", "e_mean": "e_p", "white_frac": "white_p", "artifact_frac": "artifact_p", "blood_score": "blood_p", "rbc_frac": "rbc_p"}


def patch_type() -> Column:
    """C (blood-rich) before A (rich in cells) before B, else D."""
    blood = ((F.col("blood_p") >= 0.85) | (F.col("rbc_p") >= 0.85)) & (F.col("h_p90_p") < 0.70)
    return (
        F.when(blood, "C")
        .when((F.col("cell_rich_p") >= 0.70) & (F.col("artifact_p") <= 0.70), "A")
        .when((F.col("cell_rich_p") >= 0.45) & (F.col("artifact_p") <= 0.80), "B")
        .otherwise("D")
    )


def score_patches(features: DataFrame, by: list[str], weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """features with a percentile rank of each within its slide, the weighted score, its own rank, and the type."""
    out = features.withColumns({rank: pct_rank_avg(by, name) for name, rank in RANKS.items()})
    score = sum((F.lit(w) * F.col(RANKS[k]) for k, w in weights.items()), F.lit(0.0))
    out = out.withColumn("cell_rich_score", score)
    return out.withColumn("cell_rich_p", pct_rank_avg(by, F.round("cell_rich_score", 9))).withColumn("type", patch_type())


def spatial_cap(patches: DataFrame, by: list[str], x: str, y: str, score: str, key: str, cell: int = 256, most: int = 40) -> DataFrame:
    """The best patches of each square cell of each slide."""
    cells = patches.withColumns({"__cx": F.floor(F.col(x) / cell), "__cy": F.floor(F.col(y) / cell)})
    return top_per_key(cells, [*by, "__cx", "__cy"], [known(score).desc_nulls_last(), F.col(key)], most).drop("__cx", "__cy")


@dataclass(frozen=True)
class Quotas:
    target: int
    frac: dict[str, float] = field(default_factory=lambda: {"A": 0.70, "B": 0.25, "C": 0.05})
    blood_cap: float = 0.05
    max_d: float = 0.10
    allow_under_target: bool = True
    #: Of the patches of type D one is taken even where none is allowed.
    one_d_at_least: bool = False

    def wanted(self, kind: str) -> int:
        n = round(self.target * self.frac.get(kind, 0.0))
        return min(n, round(self.target * self.blood_cap)) if kind == "C" else n


def quota_select(patches: DataFrame, by: list[str], score: str, kind: str, key: str, q: Quotas) -> DataFrame:
    """The rows that the quotas choose for each slide, with `step`, the pass that chose them.

    1: the best of types A, B and C up to their quotas. 2: the best of all but D up to the target. 3: type D up to its own
    limit. 4 (if allow_under_target is off): anything. Each pass is a window that ranks what is left by how many the
    passes before it took; ties go to the smaller key.
    """
    best = [known(score).desc_nulls_last(), F.col(key)]
    slide = Window.partitionBy(*by)
    wanted = F.create_map(*(F.lit(v) for k in "ABC" for v in (k, q.wanted(k))))

    def rank(of: Column) -> Column:
        return F.sum(of.cast("int")).over(slide.orderBy(*best).rowsBetween(Window.unboundedPreceding, 0))

    def taken() -> Column:
        return F.sum((F.col("step") > 0).cast("int")).over(slide)

    out = patches.withColumn("step", F.when(F.row_number().over(Window.partitionBy(*by, kind).orderBy(*best)) <= F.coalesce(wanted[F.col(kind)], F.lit(0)), 1).otherwise(0))
    # If the quotas add up to more than the target, the best of what they took stay.
    out = out.withColumn("__r", rank(F.col("step") == 1)).withColumn("step", F.when((F.col("step") == 1) & (F.col("__r") > q.target), -1).otherwise(F.col("step")))
    free = (F.col("step") == 0) & (F.col(kind) != "D")
    out = out.withColumn("__n", taken()).withColumn("__r", rank(free))
    out = out.withColumn("step", F.when(free & (F.col("__r") <= q.target - F.col("__n")), 2).otherwise(F.col("step")))
    free = (F.col("step") == 0) & (F.col(kind) == "D")
    room = F.least(q.target - F.col("__n"), F.lit(round(q.target * q.max_d)))
    if q.one_d_at_least:
        room = F.when(q.target > F.col("__n"), F.greatest(room, F.lit(1))).otherwise(room)
    out = out.withColumn("__n", taken()).withColumn("__r", rank(free))
    out = out.withColumn("step", F.when(free & (F.col("__r") <= room), 3).otherwise(F.col("step")))
    if not q.allow_under_target:
        free = F.col("step") == 0
        out = out.withColumn("__n", taken()).withColumn("__r", rank(free))
        out = out.withColumn("step", F.when(free & (F.col("__r") <= q.target - F.col("__n")), 4).otherwise(F.col("step")))
    return out.where("step > 0").drop("__r", "__n")


def qc_summary(slides: DataFrame, candidates: DataFrame, selected: DataFrame, by: str = "slide_uid") -> DataFrame:
    """One row per slide, zeros where it has no candidates or selection: counts by type and the means of the selection."""
    pool = candidates.groupBy(by).agg(F.count("*").alias("candidates_after_mask"), F.count_if(F.col("qc_ok")).alias("qc_pass"))
    own = selected.groupBy(by).agg(
        F.count("*").alias("selected_count"),
        F.count_if(F.col("type").isin("A", "B")).alias("good_count"),
        *(F.count_if(F.col("type") == t).alias(f"type{t}") for t in "ABCD"),
        F.avg("blood_score").alias("mean_blood_score"),
        F.avg("rbc_frac").alias("mean_rbc_frac"),
        F.percentile("cell_rich_p", 0.5).alias("median_cell_rich"),
    )
    out = slides.select(by).join(pool, by, "left").join(own, by, "left")
    counts = ["candidates_after_mask", "qc_pass", "selected_count", "good_count", *(f"type{t}" for t in "ABCD")]
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast("long")) for c in counts})


def slide_verdict(good: Column, reject_under: int = 200, warn_under: int = 800) -> Column:
    return F.when(good < reject_under, "reject").when(good < warn_under, "warn").otherwise("ok")
