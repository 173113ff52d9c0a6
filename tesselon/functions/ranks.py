"""Ranking, de-duplication and sampling by windows and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import known


def pct_rank_avg(by: list[str], value: Column | str) -> Column:
    """Rank within a group as a share of its rows, ties sharing the mean of their ranks; null for null values.

    Unlike percent_rank and cume_dist it is the mean of both ends of a tie: rank + (peers - 1) / 2, over the group's size.
    NaN is null. One sort serves both the rank and its peers.
    """
    v = known(value)
    group = Window.partitionBy(*by)
    order = group.orderBy(v.asc_nulls_last())
    peers = F.count(F.lit(1)).over(order.rangeBetween(Window.currentRow, Window.currentRow))
    return F.when(v.isNotNull(), (F.rank().over(order) + (peers - 1) / 2) / F.count(v).over(group))


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, rank_col: str | None = None) -> DataFrame:
    """The first n rows of each key; the row limit is pushed below the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= n)
    return out.withColumnRenamed("__rank", rank_col) if rank_col else out.drop("__rank")


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return top_per_key(df, keys, order, 1)


def keep_last(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """The row of the largest ordinal of each key, by a pre-aggregated max_by over the whole row."""
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    return df.groupBy(*keys).agg(F.max_by(row, F.col(ordinal)).alias("__row")).select("__row.*")


def hash_order(seed: int, *keys: str) -> Column:
    """An order that is random but the same in every run and engine."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys)))


def sample_exact(df: DataFrame, by: list[str], n: int, seed: int, key: list[str]) -> DataFrame:
    """Exactly n rows of each group, or all where it has fewer."""
    return top_per_key(df, by, [hash_order(seed, *by, *key), *(F.col(k) for k in key)], n)


def even_sample(df: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """n rows of each group at even steps of its order, the first and the last among them; all where it has fewer."""
    if n == 1:
        return top_per_key(df, by, [F.col(c) for c in order], 1)
    w = Window.partitionBy(*by)
    out = df.withColumn("__i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("__n", F.count("*").over(w))
    # Row i is step k's row if floor(k (rows - 1) / (n - 1)) = i for some k; the last such k is the one to test.
    k = F.ceil((F.col("__i") * F.lit(float(max(1, n - 1)))) / (F.col("__n") - 1))
    hit = F.floor(k * (F.col("__n") - 1) / F.lit(float(max(1, n - 1)))) == F.col("__i")
    return out.where((F.col("__n") <= n) | hit).drop("__i", "__n")


def best_so_far(df: DataFrame, order: str, metric: str, min_gain: float = 1e-4, patience: int = 3) -> DataFrame:
    """A bounded training history with best (so far), improved and stopped after `patience` rounds without a gain.

    A round improves if it beats the best by more than min_gain; what falls short never moves the best, so the best is a
    fold over the rounds, which a running maximum is not. The history is one array of epochs, small by nature.
    """
    first = F.struct(F.lit(None).cast("double").alias("best"), F.lit(0).alias("bad"), F.array().cast("array<struct<k:bigint,metric:double,best:double,improved:boolean,bad:int,stopped:boolean>>").alias("out"))

    def step(s, x):
        improved = s["best"].isNull() | (x["metric"] > s["best"] + min_gain)
        best, bad = F.when(improved, x["metric"]).otherwise(s["best"]), F.when(improved, 0).otherwise(s["bad"] + 1)
        over = F.exists(s["out"], lambda o: o["stopped"])
        row = F.struct(x["k"].alias("k"), x["metric"].alias("metric"), best.alias("best"), (improved & ~over).alias("improved"), bad.cast("int").alias("bad"), (over | (bad >= patience)).alias("stopped"))
        return F.struct(best.alias("best"), bad.cast("int").alias("bad"), F.concat(s["out"], F.array(row)).alias("out"))

    rows = F.array_sort(F.collect_list(F.struct(F.col(order).cast("bigint").alias("k"), F.col(metric).cast("double").alias("metric"))))
    return df.agg(rows.alias("rows")).select(F.explode(F.aggregate("rows", first, step, lambda s: s["out"])).alias("o")).select(F.col("o.k").alias(order), F.col("o.metric").alias(metric), "o.best", "o.improved", "o.bad", "o.stopped")
