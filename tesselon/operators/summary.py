"""Summaries: last-write-wins upserts, unions, set algebra, audits, pooling, layout and the resume filter."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ranks import hash_order, keep_last


def union_all(*tables: DataFrame) -> DataFrame:
    """All rows, columns matched by name, missing ones null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows of both, the new one where both have a key; within a table the row that is last in `order` counts.

    Rows that are equal in that too are told apart by their other columns, so that the result never depends on chance.
    """
    both = union_all(old.withColumn("__batch", F.lit(0)), new.withColumn("__batch", F.lit(1)))
    rest = sorted(c for c in both.columns if c not in (*keys, "__batch", order))
    both = both.withColumn("__last", F.struct("__batch", F.col(f"`{order}`").alias("__order"), *(F.col(f"`{c}`") for c in rest)))
    return keep_last(both, keys, "__last").drop("__batch", "__last")


def _files(spark: SparkSession, root: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), lambda *parts: spark._jvm.org.apache.hadoop.fs.Path("/".join((root.rstrip("/"), *parts)))


def _pointers(spark: SparkSession, root: str) -> list[str]:
    """The names of the committed versions' pointers, the last one last; an error where versions have lost theirs."""
    fs, path = _files(spark, root)
    if fs.exists(path("_versions")):
        return sorted(name for f in fs.listStatus(path("_versions")) if (name := f.getPath().getName()).startswith("n-"))
    if fs.exists(path()) and any(f.getPath().getName().startswith("v-") for f in fs.listStatus(path())):
        raise RuntimeError(f"{root} has versions but no record of which of them are whole")
    return []


def write_version(df: DataFrame, root: str, partition_by: list[str] | None = None, keep: int = 3) -> str:
    """Write a table's new version beside the others, so that the version being read stays whole; returns its path.

    A version counts from the moment that its pointer, a file of the next number, is renamed into place. Whatever dies before
    leaves the last version as it is. One writer at a time; one that has been overtaken fails. The last `keep` versions stay.
    """
    spark = df.sparkSession
    fs, path = _files(spark, root)
    before = _pointers(spark, root)
    fs.mkdirs(path("_versions"))
    name = f"v-{uuid.uuid4().hex}"
    w = df.write.mode("errorifexists")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{root.rstrip('/')}/{name}")
    pointer = f"n-{int(before[-1][2:14]) + 1 if before else 1:012d}-{name}"
    if any(n[2:14] == pointer[2:14] for n in _pointers(spark, root)):
        raise RuntimeError(f"another writer has committed version {pointer[2:14]} of {root}")
    fs.create(path("_versions", f"tmp-{name}"), False).close()
    if not fs.rename(path("_versions", f"tmp-{name}"), path("_versions", pointer)):
        raise RuntimeError(f"could not commit {pointer} of {root}")
    for old in _pointers(spark, root)[:-keep]:
        fs.delete(path("_versions", old), False)
        fs.delete(path(old[15:]), True)
    return f"{root.rstrip('/')}/{name}"


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    """The version committed last, None where there is none."""
    have = _pointers(spark, root)
    return spark.read.parquet(f"{root.rstrip('/')}/{have[-1][15:]}") if have else None


def not_done(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key has no row in done."""
    return rows.join(done.select(*keys).distinct(), keys, "left_anti")


def only_known(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(known.select(*keys).distinct(), keys, "left_semi")


def overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that both tables have: leaks between two parts of a split."""
    return a.select(key).intersect(b.select(key))


def remaining(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).distinct().exceptAll(b.select(key).distinct())


def collisions(rows: DataFrame, old: str, new: str) -> DataFrame:
    """New names that several old ones would get, with the number of these."""
    return rows.groupBy(new).agg(F.count_distinct(old).alias("n_names"), F.min(old).alias("first_name")).where("n_names > 1")


def mean_pool(features: DataFrame, by: list[str], vector: str) -> DataFrame:
    """The mean vector of each group, position by position, summed before the shuffle."""
    one = features.select(*by, F.posexplode(vector).alias("pos", "v")).groupBy(*by, "pos").agg(F.avg(F.col("v").cast("double")).alias("v"), F.count("*").alias("n"))
    out = one.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("pos", "v"))).alias("p"), F.max("n").alias("n_patches"))
    return out.select(*by, F.transform("p", lambda s: s["v"]).alias("mean_vector"), "n_patches")


def label_composition(patches: DataFrame, slide: str, label: str) -> DataFrame:
    """Patches, positives and their share of each slide, and which slides have one class only."""
    out = patches.groupBy(slide).agg(F.count("*").alias("n_patches"), F.sum(label).cast("long").alias("n_pos"))
    out = out.withColumns({"n_neg": F.col("n_patches") - F.col("n_pos"), "tumor_frac": F.col("n_pos") / F.col("n_patches")})
    out = out.withColumns({"pos_only": F.col("n_neg") == 0, "neg_only": F.col("n_pos") == 0})
    return out.withColumn("mixed", ~F.col("pos_only") & ~F.col("neg_only"))


def split_summary(composition: DataFrame, by: list[str], low: float = 0.2, high: float = 0.8) -> DataFrame:
    """Of each part of a split: slides, patches, the mean of slide means, its range, and slides by stratum."""
    f = F.col("tumor_frac")
    return composition.groupBy(*by).agg(
        F.count("*").alias("n_slides"),
        F.sum("n_patches").cast("long").alias("n_patches"),
        F.avg(f).alias("mean_frac"),
        F.min(f).alias("min_frac"),
        F.max(f).alias("max_frac"),
        F.sum("n_pos").cast("long").alias("n_pos"),
        F.count_if(f <= low).alias("n_low"),
        F.count_if((f > low) & (f < high)).alias("n_mid"),
        F.count_if(f >= high).alias("n_high"),
        F.count_if("pos_only").alias("n_pos_only"),
        F.count_if("neg_only").alias("n_neg_only"),
    )


def montage(rows: DataFrame, by: list[str], key: str, most: int, seed: int, columns: int | None = None) -> DataFrame:
    """Row and column of each sampled tile in a grid of `columns`, or of as many columns as rows."""
    w = Window.partitionBy(*by)
    out = rows.withColumn("slot", F.row_number().over(w.orderBy(hash_order(seed, *by, key), key)) - 1).where(F.col("slot") < most)
    wide = F.lit(columns) if columns else F.ceil(F.sqrt(F.count("*").over(w))).cast("int")
    return out.withColumn("grid", wide).withColumns({"grid_row": F.floor(F.col("slot") / F.col("grid")).cast("int"), "grid_col": (F.col("slot") % F.col("grid")).cast("int")})
