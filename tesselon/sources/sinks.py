"""Where results go: Parquet by center, exports of a gate, features, CSV tables, logs of failed rows, control rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import gate

CONTROL = T.StructType([T.StructField("stage", T.StringType()), T.StructField("slide_uid", T.StringType()), T.StructField("status", T.StringType()), T.StructField("timestamp_unix", T.LongType())])


def by_center(df: DataFrame, path: str, center: str = "center") -> None:
    """One folder for each center; rows of a center are gathered before the write, large ones in several files."""
    df.repartition(F.col(center), F.pmod(F.xxhash64(*df.columns), F.lit(8))).write.mode("overwrite").partitionBy(center).parquet(path)


def scored_outputs(scored: DataFrame, path: str, by: str, prob: str, key: str, g: gate.TumorGate) -> None:
    """All scored patches, the top k and the high ones, each in its folder."""
    scored.write.mode("overwrite").parquet(f"{path}/all_scored")
    back = scored.sparkSession.read.parquet(f"{path}/all_scored")
    gate.top_scored(back, by, prob, key, g.topk).write.mode("overwrite").parquet(f"{path}/topk_scored")
    gate.high_only(back, by, prob, key, g).write.mode("overwrite").parquet(f"{path}/high_only")


def read_scored(spark: SparkSession, path: str) -> DataFrame | None:
    """All scored patches, else the top k, else None."""
    for name in ("all_scored", "topk_scored"):
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            return spark.read.parquet(f"{path}/{name}")
    return None


def features(df: DataFrame, path: str, vector: str = "feature") -> None:
    """Feature rows by slide, their numbers narrowed to floats."""
    df.withColumn(vector, F.col(vector).cast("array<float>")).write.mode("overwrite").parquet(path)


def csv(df: DataFrame, path: str, order: list[str] | None = None) -> str | None:
    """A CSV table with a header; what was there before moves to a backup, whose path is returned."""
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs, backup = at.getFileSystem(spark._jsc.hadoopConfiguration()), None
    if fs.exists(at):
        backup = f"{path.rstrip('/')}.bak-{uuid.uuid4().hex[:8]}"
        fs.rename(at, spark._jvm.org.apache.hadoop.fs.Path(backup))
    (df.orderBy(*order) if order else df).write.option("header", True).csv(path)
    return backup


def with_log(df: DataFrame, path: str, log: str, error: str = "error") -> None:
    """Good rows to path, every row's status to log."""
    df.write.mode("overwrite").parquet(log)
    back = df.sparkSession.read.parquet(log)
    back.where(F.col(error).isNull()).drop(error).write.mode("overwrite").parquet(path)


def metrics_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def control_rows(slides: DataFrame, stage: str, status, when: int) -> DataFrame:
    """One row for each slide that a stage is done with."""
    return slides.select(F.lit(stage).alias("stage"), "slide_uid", status.alias("status"), F.lit(when).cast("long").alias("timestamp_unix"))
