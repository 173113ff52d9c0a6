"""Finding slides, masks and patches by their paths, and reading their tables. Paths come as a column or from a listing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.ranks import keep_first, keep_last
from ..schemas import TRAIN_COORDS, conform

SLIDE_SUFFIXES = (".svs", ".mrxs", ".ndpi", ".tif", ".tiff", ".scn", ".bif", ".vms")


def listed(spark: SparkSession, roots: Iterable[str], recursive: bool = True) -> DataFrame:
    """(path, center_root) of every file below the roots; file contents are not read."""
    out = None
    for root in roots:
        r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(root)
        one = r.select(F.regexp_replace("path", "^file:/+", "/").alias("path"), F.lit(root.rstrip("/")).alias("center_root"))
        out = one if out is None else out.unionByName(one)
    return out


def slide_records(files: DataFrame, suffixes: Iterable[str] = SLIDE_SUFFIXES) -> DataFrame:
    """Slide records of the files (path, center_root) that have a slide's suffix, the first path of each uid."""
    s = files.where(C.file_suffix("path").isin(*(x.lower() for x in suffixes)))
    rel = C.relative_stem("center_root", "path")
    s = s.select("path", C.file_name("center_root").alias("center"), "center_root", C.file_stem("path").alias("slide_id"), C.slide_uid(C.file_name("center_root"), rel).alias("slide_uid"), rel.alias("slide_relpath"))
    return keep_first(s, ["slide_uid"], [F.col("path")])


def slide_index(files: DataFrame, suffixes: Iterable[str] = SLIDE_SUFFIXES) -> DataFrame:
    """(stem, path): of equal stems the path of the earliest suffix, then the first by name."""
    order = F.create_map(*(F.lit(x) for k, s in enumerate(suffixes) for x in (s, k)))
    f = files.withColumns({"stem": C.file_stem("path"), "__p": order[C.file_suffix("path")]}).where("__p is not null")
    return f.groupBy("stem").agg(F.min_by("path", F.struct("__p", "path")).alias("path"))


def found_slides(wanted: DataFrame, index: DataFrame, name: str = "slide_id") -> DataFrame:
    """wanted with the path of its slide: an equal stem, else the smallest stem that begins with the name or begins it.

    A name's prefixes and a stem's prefixes of the lengths that names have are matched by equality, not by comparing all
    pairs.
    """
    q = wanted.select(name).distinct()
    lengths = q.select(F.length(name).alias("n")).distinct()
    whole = q.join(index, q[name] == index["stem"]).select(name, F.lit(0).alias("__k"), "stem", "path")
    longer = index.crossJoin(F.broadcast(lengths)).where(F.length("stem") > F.col("n")).withColumn("__pre", F.substr("stem", F.lit(1), F.col("n")))
    longer = q.join(longer, q[name] == longer["__pre"]).select(name, F.lit(1).alias("__k"), "stem", "path")
    parts = q.withColumn("__pre", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.length(name) - 1, F.lit(1))), lambda n: F.substr(F.col(name), F.lit(1), n))))
    shorter = parts.join(index, (parts["__pre"] == index["stem"]) & (F.length("stem") < F.length(name))).select(name, F.lit(1).alias("__k"), "stem", "path")
    best = whole.unionByName(longer).unionByName(shorter).groupBy(name).agg(F.min_by("path", F.struct("__k", "stem")).alias("path"), F.min(F.struct("__k", "stem"))["stem"].alias("stem"))
    return wanted.join(best, name, "left")


def first_mask(slides: DataFrame, files: DataFrame, suffixes: Iterable[str] = (".npy", ".png", ".tif", ".tiff")) -> DataFrame:
    """slides with mask_path: the first of uid, id and file stem, by suffix, that a mask file is named after."""
    order = F.create_map(*(F.lit(x) for k, s in enumerate(suffixes) for x in (s, k)))
    m = files.select(F.col("path").alias("mask_path"), C.file_stem("path").alias("__m"), order[C.file_suffix("path")].alias("__s")).where("__s is not null")
    names = slides.select("slide_uid", F.posexplode(F.array("slide_uid", "slide_id", C.file_stem("path"))).alias("__n", "__m"))
    best = names.join(m, "__m").groupBy("slide_uid").agg(F.min_by("mask_path", F.struct("__n", "__s", "mask_path")).alias("mask_path"))
    return slides.join(best, "slide_uid", "left")


def nearest_level(levels: DataFrame, target: float) -> DataFrame:
    """The level of each slide whose downsample is nearest to the target, the first of equal ones."""
    return levels.groupBy("slide_uid").agg(F.min_by(F.struct("level", "width", "height", "downsample"), F.struct(F.abs(F.col("downsample") - target), F.col("level"))).alias("l")).select("slide_uid", "l.*")


def mask_level(levels: DataFrame, masks: DataFrame) -> DataFrame:
    """The level of each slide whose size is nearest to its mask's (slide_uid, h, w)."""
    gap = F.abs(F.col("height") - F.col("h")) + F.abs(F.col("width") - F.col("w"))
    return levels.join(masks, "slide_uid").groupBy("slide_uid").agg(F.min_by("level", F.struct(gap, F.col("level"))).alias("level"))


def patches_by_path(files: DataFrame) -> DataFrame:
    """A training table from patch paths: the label is the folder's name, the rest is in the file name."""
    name = C.file_name("path")
    parts = C.patch_name_parts(name)
    label = F.element_at(F.split("path", "/"), -2).try_cast("int")
    out = files.select("path", label.alias("label"), *(v.alias(k) for k, v in parts.items()))
    return out.where("label is not null and x is not null and y is not null and slide_id <> ''")


def csv(spark: SparkSession, path: str, schema, aliases: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """A CSV file as text, brought to a schema: ids keep their leading zeros."""
    return conform(spark.read.option("header", True).option("inferSchema", False).csv(path), schema, aliases)


def summary(spark: SparkSession, path: str, schema, keys: list[str], order: str) -> DataFrame:
    """A summary CSV by its keys; of rows that repeat a key the one that is last in `order` counts."""
    return keep_last(csv(spark, path, schema), keys, order)


def aligned(rows: DataFrame, keep: list[str], arrays: list[str]) -> DataFrame:
    """One row (keep, pos, ...) for each position of arrays that belong together; shorter ones are null at their end."""
    return rows.select(*keep, F.posexplode(F.arrays_zip(*arrays)).alias("pos", "__z")).select(*keep, F.col("pos").cast("long").alias("pos"), *(F.col("__z")[a].alias(a) for a in arrays))


def coordinates(spark: SparkSession, path: str) -> DataFrame:
    """Labelled coordinates; x, y come before x_qp, y_qp where both are there."""
    return csv(spark, path, TRAIN_COORDS, {"x_qp": ("x",), "y_qp": ("y",)})


def first_source(sources: list[DataFrame], by: str) -> DataFrame:
    """For each key the rows of the first source that has the key."""
    ranked = None
    for k, s in enumerate(sources):
        one = s.withColumn("__source", F.lit(k))
        ranked = one if ranked is None else ranked.unionByName(one, allowMissingColumns=True)
    best = ranked.groupBy(by).agg(F.min("__source").alias("__source"))
    return ranked.join(best, [by, "__source"]).drop("__source")


def legacy_keys(rows: DataFrame, slides: DataFrame) -> DataFrame:
    """rows (center, slide_id) with the uid of the one slide they can mean, and a reason where there is none or several."""
    n = slides.groupBy("center", "slide_id").agg(F.count("*").alias("n"), F.min("slide_uid").alias("slide_uid"))
    out = rows.join(n, ["center", "slide_id"], "left")
    reason = F.when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "ambiguous").otherwise("")
    return out.withColumns({"reason": reason, "slide_uid": F.when(F.col("n") == 1, F.col("slide_uid"))}).drop("n")


def rename_plan(files: DataFrame, new_name: Column) -> DataFrame:
    """(path, old, new, action): rename, keep, or collision where several files would get one name."""
    f = files.select("path", C.file_name("path").alias("old"), new_name.alias("new"))
    n = f.groupBy("new").agg(F.count("*").alias("n"))
    return f.join(n, "new").select("path", "old", "new", F.when(F.col("n") > 1, "collision").when(F.col("old") == F.col("new"), "keep").otherwise("rename").alias("action"))


def bounds_audit(slides: DataFrame) -> DataFrame:
    """Slides by whether their bounds are known, shifted and smaller than the canvas, and whether they failed to open.

    slides: width, height, bounds_x, bounds_y, bounds_w, bounds_h and error.
    """
    known = F.col("bounds_x").isNotNull() & F.col("bounds_y").isNotNull() & F.col("bounds_w").isNotNull() & F.col("bounds_h").isNotNull()
    shift = known & ((F.col("bounds_x") != 0) | (F.col("bounds_y") != 0))
    smaller = known & ((F.col("bounds_w") < F.col("width")) | (F.col("bounds_h") < F.col("height")))
    rows = slides.select(known.alias("has_bounds"), F.coalesce(shift, F.lit(False)).alias("needs_shift"), F.coalesce(smaller, F.lit(False)).alias("bounds_smaller"), F.col("error").isNotNull().alias("failed"))
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))


def best_tile(tiles: DataFrame, by: str, tissue: str, order: str) -> DataFrame:
    """The tile of each image with the most tissue, the first of equal ones."""
    row = F.struct(*(F.col(c) for c in tiles.columns))
    return tiles.groupBy(by).agg(F.max_by(row, F.struct(F.col(tissue), -F.col(order))).alias("__r")).select("__r.*")
