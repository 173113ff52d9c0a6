"""Classifier metrics over predictions (label 0/1, score): every one an aggregate or a window over distinct scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import is_known, known

EPS = 1e-9


def cells(y: str, score: str, threshold: float | Column = 0.5) -> list[Column]:
    """The confusion matrix as aggregates; a score that is null or NaN reaches no threshold."""
    pos, hit = F.col(y) == 1, F.coalesce(known(score) >= threshold, F.lit(False))
    return [F.count_if(~pos & ~hit).alias("tn"), F.count_if(~pos & hit).alias("fp"), F.count_if(pos & ~hit).alias("fn"), F.count_if(pos & hit).alias("tp")]


def with_rates(df: DataFrame, eps: float = EPS, floor_one: bool = False) -> DataFrame:
    """Seven rates of the cells; denominators get eps, or with floor_one are 1 at least."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def rate(a, b):
        return a / (F.greatest(b, F.lit(1)) if floor_one else b + eps)

    return df.withColumns(
        {
            "acc": rate(tp + tn, tp + tn + fp + fn),
            "sens": rate(tp, tp + fn),
            "spec": rate(tn, tn + fp),
            "precision": rate(tp, tp + fp),
            "npv": rate(tn, tn + fn),
            "fpr": rate(fp, fp + tn),
            "fnr": rate(fn, fn + tp),
        }
    )


def confusion(predictions: DataFrame, y: str, score: str, threshold: float = 0.5, by: tuple[str, ...] = ()) -> DataFrame:
    return with_rates(predictions.groupBy(*by).agg(*cells(y, score, threshold)))


def class_weights(predictions: DataFrame, y: str) -> DataFrame:
    """n / (2 max(n_c, 1)) of each class."""
    n = predictions.groupBy(F.col(y).alias("label")).agg(F.count("*").alias("n_label"))
    return n.crossJoin(F.broadcast(n.agg(F.sum("n_label").alias("n_all")))).select("label", "n_label", (F.col("n_all") / (2 * F.greatest("n_label", F.lit(1)))).alias("weight"))


def steps(predictions: DataFrame, y: str, score: str) -> DataFrame:
    """(score, pos, neg, tp, fp): counts of each distinct score and cumulated from the highest down; null and NaN have no place.

    Scores are first counted, then cumulated in two levels: inside ranges that hold about as many distinct scores each,
    however these are spread, and over the few ranges' sums, so that no single task sees all scores.
    """
    n = predictions.where(is_known(score)).groupBy(known(score).alias("score")).agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))
    ranges = min(512, max(32, int(predictions.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    bounds = n.agg(F.percentile_approx("score", [k / ranges for k in range(1, ranges)], 20 * ranges).alias("bounds"))
    n = n.crossJoin(F.broadcast(bounds))
    part = F.aggregate("bounds", F.lit(0), lambda k, b: k + (F.col("score") >= b).cast("int"))
    inside = Window.partitionBy("part").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    n = n.withColumn("part", part).drop("bounds")
    n = n.withColumns({"ip": F.sum("pos").over(inside), "in": F.sum("neg").over(inside)})
    ranges = n.groupBy("part").agg(F.sum("pos").alias("p"), F.sum("neg").alias("q"))
    before = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("part", F.coalesce(F.sum("p").over(before), F.lit(0)).alias("bp"), F.coalesce(F.sum("q").over(before), F.lit(0)).alias("bn"))
    return n.join(ranges, "part").select("score", "pos", "neg", (F.col("ip") + F.col("bp")).cast("long").alias("tp"), (F.col("in") + F.col("bn")).cast("long").alias("fp"))


def _totals(s: DataFrame) -> DataFrame:
    return F.broadcast(s.agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg")))


def roc_auc(predictions: DataFrame, y: str, score: str) -> DataFrame:
    """One row: the area under the ROC curve, ties counting half; null with one class only."""
    s = steps(predictions, y, score)
    # Each positive beats the negatives below its score and half of those at it.
    beaten = F.col("pos") * (F.col("all_neg") - F.col("fp") + F.col("neg") / 2)
    return s.crossJoin(_totals(s)).agg((F.sum(beaten) / F.nullif(F.first("all_pos") * F.first("all_neg"), F.lit(0))).alias("roc_auc"))


def average_precision(predictions: DataFrame, y: str, score: str) -> DataFrame:
    """One row: the sum over distinct scores of the gain in recall times the precision there; null with one class only."""
    s = steps(predictions, y, score)
    both = s.crossJoin(_totals(s))
    ap = F.sum(F.col("pos") / F.col("all_pos") * F.col("tp") / (F.col("tp") + F.col("fp")))
    return both.agg(F.when((F.first("all_pos") > 0) & (F.first("all_neg") > 0), ap).alias("average_precision"))


def roc_curve(predictions: DataFrame, y: str, score: str) -> DataFrame:
    s = steps(predictions, y, score)
    return s.crossJoin(_totals(s)).select(F.col("score").alias("threshold"), (F.col("fp") / F.col("all_neg")).alias("fpr"), (F.col("tp") / F.col("all_pos")).alias("tpr"))


def pr_curve(predictions: DataFrame, y: str, score: str) -> DataFrame:
    s = steps(predictions, y, score)
    return s.crossJoin(_totals(s)).select(F.col("score").alias("threshold"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), (F.col("tp") / F.col("all_pos")).alias("recall"))


def threshold_sweep(predictions: DataFrame, y: str, score: str, n: int = 501, mode: str = "youden") -> DataFrame:
    """The confusion matrix, rates and objective at n even thresholds from 0 to 1; null and NaN reach none of them.

    Each row falls into the bucket of the highest threshold that it reaches, and suffix sums over at most n + 1 buckets
    give all matrices, instead of one pass over the rows for each threshold.
    """
    last = n - 1
    s = known(score)
    reach = F.floor(s * last).cast("int")
    # The product may round to the other side of a threshold; compare with the threshold itself.
    reach = F.when(s >= (reach + 1) / F.lit(float(last)), reach + 1).when(s < reach / F.lit(float(last)), reach - 1).otherwise(reach)
    found = predictions.groupBy(F.least(F.greatest(F.coalesce(reach, F.lit(-1)), F.lit(-1)), F.lit(last)).alias("k")).agg(F.count_if(F.col(y) == 1).alias("p"), F.count_if(F.col(y) == 0).alias("q"))
    grid = predictions.sparkSession.range(-1, n).select(F.col("id").cast("int").alias("k"))
    w = Window.orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    full = grid.join(F.broadcast(found), "k", "left").select("k", F.coalesce("p", F.lit(0)).alias("p"), F.coalesce("q", F.lit(0)).alias("q"))
    out = full.select("k", F.sum("p").over(w).alias("tp"), F.sum("q").over(w).alias("fp"), F.sum("p").over(whole).alias("ap"), F.sum("q").over(whole).alias("an"))
    out = out.where("k >= 0").select((F.col("k") / F.lit(float(last))).alias("threshold"), (F.col("an") - F.col("fp")).alias("tn"), "fp", (F.col("ap") - F.col("tp")).alias("fn"), "tp")
    out = with_rates(out)
    f1 = 2 * F.col("precision") * F.col("sens") / (F.col("precision") + F.col("sens") + EPS)
    return out.withColumn("objective", f1 if mode == "f1" else F.col("sens") + F.col("spec") - 1)


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The row of the largest objective, the lowest threshold of equal ones."""
    return sweep.orderBy(F.desc(F.round("objective", 12)), "threshold").limit(1)


def hard_examples(predictions: DataFrame, y: str, score: str, key: str, limit: int, threshold: float = 0.5) -> DataFrame:
    """The most confident false positives and false negatives, with their kind and rank from 1; those without a score come last."""
    w = Window.partitionBy("kind").orderBy(F.desc_nulls_last("wrong"), key)
    hit = F.coalesce(known(score) >= threshold, F.lit(False))
    fp, fn = (F.col(y) == 0) & hit, (F.col(y) == 1) & ~hit
    out = predictions.where(fp | fn).withColumns({"kind": F.when(fp, "fp").otherwise("fn"), "wrong": F.when(fp, known(score)).otherwise(-known(score))})
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit).drop("wrong")


def histogram(df: DataFrame, by: list[str], value: str, bins: int, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Rows of each bin; null and NaN are in none, values outside the range fall into the outer bins, and the upper end into the last."""
    b = F.floor((known(value) - low) / (high - low) * bins).cast("int")
    return df.where(is_known(value)).groupBy(*by, F.least(F.greatest(b, F.lit(0)), F.lit(bins - 1)).alias("bin")).agg(F.count("*").alias("n"))


def otsu(df: DataFrame, value: str) -> DataFrame:
    """One row: the threshold t of 0..255 that best parts values <= t from those above, the lowest of equal ones."""
    h = df.where(is_known(value)).groupBy(F.least(F.greatest(F.floor(known(value)), F.lit(0)), F.lit(255)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    w = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = h.select("bin", F.sum("n").over(w).alias("w0"), F.sum(F.col("n") * F.col("bin")).over(w).alias("s0"), F.sum("n").over(whole).alias("n"), F.sum(F.col("n") * F.col("bin")).over(whole).alias("s"))
    s = s.where("w0 < n").withColumn("between", F.round(F.col("w0") / F.col("n") * (1 - F.col("w0") / F.col("n")) * F.pow(F.col("s0") / F.col("w0") - (F.col("s") - F.col("s0")) / (F.col("n") - F.col("w0")), 2), 6))
    return s.orderBy(F.desc("between"), "bin").limit(1).select(F.col("bin").alias("threshold"), "between")


def calibration(df: DataFrame, image: str, values: dict[str, tuple[float, float, float]], min_pixels: int = 64) -> DataFrame:
    """One row: for each value the outer percentile over images of the inner one within an image, not under a floor."""
    each = df.groupBy(image).agg(F.count("*").alias("n"), *(F.percentile(known(c), inner).alias(c) for c, (inner, _, _) in values.items()))
    return each.where(F.col("n") >= min_pixels).agg(*(F.greatest(F.percentile(c, outer), F.lit(floor)).alias(c) for c, (_, outer, floor) in values.items()))
