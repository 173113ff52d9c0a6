"""Leakage-free splits by group, with a hard validation set."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranks import hash_order


@dataclass(frozen=True)
class HardSplit:
    val_frac: float = 0.2
    seed: int = 42
    low: float = 0.2
    high: float = 0.8
    min_low: int = 2
    prefer_mid: bool = True
    both_labels: bool = True


def group_shuffle_split(slides: DataFrame, slide: str, val_frac: float, seed: int) -> DataFrame:
    """slides with `part`: a random val_frac of them, one at least and never all, is `val`."""
    w = Window.orderBy(hash_order(seed, slide), slide)
    n = slides.agg(F.count("*").alias("n")).select("n", F.greatest(F.lit(1), F.least(F.ceil(F.col("n") * val_frac), F.col("n") - 1)).alias("n_val"))
    return slides.withColumn("__r", F.row_number().over(w)).crossJoin(F.broadcast(n)).withColumn("part", F.when(F.col("__r") <= F.col("n_val"), "val").otherwise("train")).drop("__r", "n", "n_val")


def hard_group_split(slides: DataFrame, slide: str = "slide_id", s: HardSplit = HardSplit()) -> DataFrame:
    """slides (one row each, with tumor_frac) and their `part`.

    The validation set is filled by priority: one slide of each pure class, low slides up to min_low, mid slides up to half
    of what is left, then high, mid and low ones. Every pool is in a random but fixed order, and each priority takes only
    slides that the ones before it left. If the set misses a label, its slide of the highest share is exchanged for a train
    slide that has the label. Without low slides the split is a plain shuffle. The table holds one row per slide, so
    windows over all of it stay small; patches join the result by slide.
    """
    f = F.col("tumor_frac")
    whole = Window.partitionBy()
    rnd = F.row_number().over(Window.orderBy(hash_order(s.seed, slide), slide))
    out = slides.withColumns({"__r": rnd, "__n": F.count("*").over(whole)})
    out = out.withColumn("__val", F.greatest(F.lit(1), F.least(F.bround(F.col("__n") * s.val_frac).cast("int"), F.col("__n") - 1)))
    out = out.withColumn("__band", F.when(f <= s.low, "low").when(f < s.high, "mid").otherwise("high"))
    out = out.withColumn("__pure", F.when(f >= 1 - 1e-12, "pos").when(f <= 1e-12, "neg"))
    out = out.withColumn("__plain", F.row_number().over(Window.orderBy("__r")) <= F.greatest(F.lit(1), F.least(F.ceil(F.col("__n") * s.val_frac), F.col("__n") - 1)))
    out = out.withColumn("__lows", F.count_if(F.col("__band") == "low").over(whole)).withColumn("__in", F.lit(0))

    def fill(df, pool, room, priority):
        free = (F.col("__in") == 0) & pool
        df = df.withColumn("__taken", F.count_if(F.col("__in") > 0).over(whole))
        df = df.withColumn("__k", F.sum(free.cast("int")).over(Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, 0)))
        left = F.col("__val") - F.col("__taken")
        return df.withColumn("__in", F.when(free & (F.col("__k") <= F.least(left, room(left))), priority).otherwise(F.col("__in"))).drop("__k", "__taken")

    def pure(df):
        first = F.row_number().over(Window.partitionBy("__pure").orderBy("__r")) == 1
        both = (F.count_if(F.col("__pure") == "pos").over(whole) > 0) & (F.count_if(F.col("__pure") == "neg").over(whole) > 0) & (F.col("__val") >= 2)
        return df.withColumn("__seed", F.col("__pure").isNotNull() & first & both).withColumn("__in", F.when(F.col("__seed"), 1).otherwise(0)).drop("__seed")

    if s.both_labels:
        out = pure(out)
    band = F.col("__band")
    out = fill(out, band == "low", lambda left: F.lit(s.min_low), 2)
    if s.prefer_mid:
        out = fill(out, band == "mid", lambda left: F.greatest(F.lit(1), F.floor(left / 2)), 3)
    for priority, name in ((4, "high"), (5, "mid"), (6, "low")):
        out = fill(out, band == name, lambda left: left, priority)
    out = out.withColumn("__v", F.when(F.col("__lows") > 0, F.col("__in") > 0).otherwise(F.col("__plain")))
    if s.both_labels:
        has = {1: f > 1e-12, 0: f < 1 - 1e-12}
        lack = {k: F.count_if(F.col("__v") & v).over(whole) == 0 for k, v in has.items()}
        out = out.withColumns({"__no1": lack[1], "__no0": lack[0]})
        give = ~F.col("__v") & ((F.col("__no1") & has[1]) | (F.col("__no0") & has[0]))
        out = out.withColumn("__give", give)
        out = out.withColumns(
            {
                "__in_rank": F.row_number().over(Window.partitionBy("__give").orderBy("__r")),
                "__out_rank": F.row_number().over(Window.partitionBy("__v").orderBy(F.desc("tumor_frac"), "__r")),
                "__any": F.count_if("__give").over(whole) > 0,
            }
        )
        swap_in = F.col("__give") & (F.col("__in_rank") == 1)
        swap_out = F.col("__any") & F.col("__v") & (F.col("__out_rank") == 1)
        out = out.withColumn("__v", (F.col("__v") & ~swap_out) | swap_in)
    return out.withColumn("part", F.when(F.col("__v"), "val").otherwise("train")).drop(*[c for c in out.columns if c.startswith("__")])
