"""Candidate grids, annotation polygons and point-in-polygon joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grid(slides: DataFrame, width: str, height: str, step: str | int, x: str = "x", y: str = "y") -> DataFrame:
    """A row for each point of each slide's grid, from 0 in steps below its size."""
    s = F.col(step) if isinstance(step, str) else F.lit(step)

    def axis(size):
        return F.when(F.col(size) > 0, F.sequence(F.lit(0).cast("int"), (F.col(size) - 1).cast("int"), s.cast("int"))).otherwise(F.array().cast("array<int>"))

    return slides.withColumn(y, F.explode(axis(height))).withColumn(x, F.explode(axis(width)))


def in_mask(candidates: DataFrame, mask: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates whose point is in a sparse mask of (slide, y, x) rows."""
    return candidates.join(mask.select(*keys).distinct(), keys, "left_semi")


def window_density(candidates: DataFrame, mask: DataFrame, by: str, half: int, least: float) -> DataFrame:
    """Candidates with the share of mask pixels in the square around them, clipped at the image, where it is enough.

    Each mask pixel is dealt to the coarse cells that its square can reach, so the range join is an equality join of
    cells with a residual, and only pixels that are set travel. candidates has width and height. Where the masks are
    made from images in the same job, raster.window_share has the shares without a join.
    """
    side = 2 * half + 1
    m = mask.select(F.col(by).alias("__b"), F.col("x").alias("__x"), F.col("y").alias("__y"))

    def near(c):
        return F.explode(F.sequence(F.floor((F.col(c) - half) / side).cast("int"), F.floor((F.col(c) + half) / side).cast("int")))

    m = m.withColumn("__cx", near("__x")).withColumn("__cy", near("__y"))
    c = candidates.withColumns({"__cx": F.floor(F.col("x") / side).cast("int"), "__cy": F.floor(F.col("y") / side).cast("int")})
    on = [c[by] == m["__b"], c["__cx"] == m["__cx"], c["__cy"] == m["__cy"], F.abs(c["x"] - m["__x"]) <= half, F.abs(c["y"] - m["__y"]) <= half]
    m = m.hint("merge")  # its size is not known beforehand, and masks must not meet on the driver to be broadcast
    hit = c.join(m, on, "left").groupBy(*(c[k] for k in candidates.columns)).agg(F.count("__x").alias("n_in"))

    def span(v, size):
        return F.least(F.col(v) + half, F.col(size) - 1) - F.greatest(F.col(v) - half, F.lit(0)) + 1

    out = hit.withColumn("density", F.col("n_in") / (span("x", "width") * span("y", "height")))
    return out.where(F.col("density") >= least).drop("n_in")


def edges(ring: Column) -> Column:
    """The edges of a ring (array of [x, y]), closed or open: where each begins, its extent along both axes, and its box."""
    following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))

    def edge(a, b):
        return F.struct(
            a[0].alias("ax"), a[1].alias("ay"), (b[0] - a[0]).alias("dx"), (b[1] - a[1]).alias("dy"),
            F.least(a[0], b[0]).alias("x1"), F.greatest(a[0], b[0]).alias("x2"), F.least(a[1], b[1]).alias("y1"), F.greatest(a[1], b[1]).alias("y2"),
        )

    return F.zip_with(ring, following, edge)


def in_polygon(x: Column, y: Column, rings: Column) -> Column:
    """Inside the first ring, by even-odd crossings, and in none of the holes that follow; all borders are outside.

    rings: the edges of each ring.
    """

    def odd(ring):
        return F.size(F.filter(ring, lambda e: (y >= e["y1"]) & (y < e["y2"]) & (x < e["dx"] * (y - e["ay"]) / e["dy"] + e["ax"]))) % 2 == 1

    def touched(ring):
        return F.exists(ring, lambda e: (y >= e["y1"]) & (y <= e["y2"]) & (x >= e["x1"]) & (x <= e["x2"]) & (e["dx"] * (y - e["ay"]) == e["dy"] * (x - e["ax"])))

    holes = F.slice(rings, 2, F.greatest(F.size(rings) - 1, F.lit(0)))
    return odd(rings[0]) & ~F.exists(holes, odd) & ~F.exists(rings, touched)


def points_in_polygons(points: DataFrame, polygons: DataFrame, by: list[str], how: str = "left_semi", cell: int = 1024) -> DataFrame:
    """Points in any polygon of their slide (left_semi) or in none (left_anti).

    polygons has rings, array<array<array<double>>>. Its box is dealt to square cells, so that the join is an equality
    join of slide and cell with the exact test as a residual; edges are made once for a polygon, not for each point.
    """
    xs, ys = F.transform(F.col("rings")[0], lambda p: p[0]), F.transform(F.col("rings")[0], lambda p: p[1])
    boxed = polygons.select(*(F.col(c).alias(f"__{c}") for c in by), F.transform("rings", edges).alias("edges"), F.array_min(xs).alias("x1"), F.array_max(xs).alias("x2"), F.array_min(ys).alias("y1"), F.array_max(ys).alias("y2"))
    boxed = boxed.withColumn("__cx", F.explode(F.sequence(F.floor(F.col("x1") / cell), F.floor(F.col("x2") / cell)))).withColumn("__cy", F.explode(F.sequence(F.floor(F.col("y1") / cell), F.floor(F.col("y2") / cell))))
    p = points.withColumns({"__px": F.floor(F.col("x") / cell), "__py": F.floor(F.col("y") / cell)})
    on = [p[c] == boxed[f"__{c}"] for c in by] + [p["__px"] == boxed["__cx"], p["__py"] == boxed["__cy"]]
    x, y = p["x"].cast("double"), p["y"].cast("double")
    on += [x.between(boxed["x1"], boxed["x2"]), y.between(boxed["y1"], boxed["y2"]), in_polygon(x, y, boxed["edges"])]
    return p.join(boxed, on, how).drop("__px", "__py")


#: What an annotation file holds: a FeatureCollection, or the bare list of its features.
FEATURE = "struct<geometry: struct<type: string, coordinates: string>, properties: struct<name: string, classification: struct<name: string>>>"


def annotations(files: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """(keep..., class_name, rings) for each polygon of each annotation file; a multipolygon gives a row for each part.

    The class is the nested property, else the name. Other geometries are left out, broken files have no rows.
    """
    whole = F.from_json(F.col(text), f"struct<features: array<{FEATURE}>>")["features"]
    bare = F.from_json(F.col(text), f"array<{FEATURE}>")
    f = files.select(*keep, F.explode(F.when(F.startswith(F.trim(F.col(text)), F.lit("[")), bare).otherwise(whole)).alias("f"))
    kind, coords = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    polygon = F.array(F.from_json(coords, "array<array<array<double>>>"))
    many = F.from_json(coords, "array<array<array<array<double>>>>")
    f = f.select(*keep, F.coalesce("f.properties.classification.name", "f.properties.name").alias("class_name"), F.explode(F.when(kind == "Polygon", polygon).when(kind == "MultiPolygon", many)).alias("rings"))
    return f.where("size(rings) > 0")


def to_canvas(x: str, y: str, bx: str, by: str, w: str, h: str) -> tuple[Column, Column]:
    """Annotation points as canvas points: as they are, else shifted by the bounds, else null."""
    def inside_canvas(a, b):
        return (a >= 0) & (b >= 0) & (a < F.col(w)) & (b < F.col(h))

    sx, sy = F.col(x) + F.col(bx), F.col(y) + F.col(by)
    ok, moved = inside_canvas(F.col(x), F.col(y)), inside_canvas(sx, sy)
    return F.when(ok, F.col(x)).when(moved, sx), F.when(ok, F.col(y)).when(moved, sy)
