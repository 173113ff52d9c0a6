"""Pixel formulas as column expressions, and neighbourhoods as windows, over rows (img, y, x, r, g, b).

They are the relational twins of tesselon.operators.raster, and what an independent engine can check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The haematoxylin and eosin vectors of the fixed unmixing.
HEMATOXYLIN, EOSIN = (0.650, 0.704, 0.286), (0.072, 0.990, 0.105)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def optical_density(v) -> Column:
    return -F.log(F.least(F.greatest(_c(v) / 255.0, F.lit(1e-6)), F.lit(1.0)))


def unmix_rows(h=HEMATOXYLIN, e=EOSIN) -> list[list[float]]:
    """The two rows of the pseudo-inverse of the unit stain vectors: constants of the plan."""
    def unit(v):
        n = sum(x * x for x in v) ** 0.5
        return [x / n for x in v]

    a, b = unit(h), unit(e)
    aa, bb, ab = (sum(x * y for x, y in zip(p, q)) for p, q in ((a, a), (b, b), (a, b)))
    det = aa * bb - ab * ab
    return [[(bb * x - ab * y) / det for x, y in zip(a, b)], [(aa * y - ab * x) / det for x, y in zip(a, b)]]


def unmix(r="r", g="g", b="b") -> tuple[Column, Column]:
    """Haematoxylin and eosin amounts, not under 0."""
    od = [optical_density(c) for c in (r, g, b)]
    return tuple(F.greatest(sum((F.lit(k) * o for k, o in zip(row, od)), F.lit(0.0)), F.lit(0.0)) for row in unmix_rows())


def gray(r="r", g="g", b="b") -> Column:
    """Luma in 14-bit fixed point, rounded half up."""
    return F.floor((_c(r) * 4899 + _c(g) * 9617 + _c(b) * 1868 + 8192) / 16384).cast("int")


def hsv(r="r", g="g", b="b") -> tuple[Column, Column, Column]:
    """Hue in 0..179, saturation and value in 0..255, rounded to whole numbers."""
    r, g, b = _c(r), _c(g), _c(b)
    v, low = F.greatest(r, g, b), F.least(r, g, b)
    d = (v - low).cast("double")
    s = F.when(v == 0, 0.0).otherwise(255.0 * d / v)
    h = F.when(d == 0, 0.0).when(v == r, 60.0 * (g - b) / d).when(v == g, 120.0 + 60.0 * (b - r) / d).otherwise(240.0 + 60.0 * (r - g) / d)
    h = F.when(h < 0, h + 360.0).otherwise(h) / 2
    return F.floor(h + 0.5).cast("int") % 180, F.floor(s + 0.5).cast("int"), v.cast("int")


def norm01(value: str, by: list[str], low: float = 5, high: float = 99) -> Column:
    """The value between two percentiles of its image, clipped to 0..1; 0 for flat images."""
    w = Window.partitionBy(*by)
    lo, hi = F.percentile(value, low / 100).over(w), F.percentile(value, high / 100).over(w)
    return F.when(hi <= lo + 1e-6, 0.0).otherwise(F.least(F.greatest((_c(value) - lo) / (hi - lo), F.lit(0.0)), F.lit(1.0)))


# The colour ranges of pens, blood and dark strokes below.


def ink_qc(h: Column, s: Column, v: Column, g: Column) -> Column:
    """Pen colours and dark strokes, as the quality check sees them."""
    pen = ((v < 70) & (s > 18)) | (h.between(25, 110) & (s > 22) & (v < 250)) | (h.between(85, 140) & (s > 22) & (v < 250)) | (((h >= 145) | (h <= 10)) & (s > 150) & (v < 245))
    return pen | (g < 70)


def ink_score(h: Column, s: Column, v: Column, g: Column, r="r", gr="g", b="b") -> Column:
    """Pen colours, pools of blood and dark strokes, as the scoring sees them."""
    pen = ((v < 90) & (s > 30)) | (h.between(35, 105) & (s > 45) & (v < 245)) | (h.between(100, 140) & (s > 45) & (v < 245)) | (((h >= 145) | (h <= 10)) & (s > 140) & (v < 245))
    pool = (_c(r) > 140) & (_c(r) - _c(gr) > 35) & (_c(r) - _c(b) > 35)
    return pen | pool | (g < 70)


def red_dominance(r="r", g="g", b="b") -> Column:
    return (_c(r) - 0.5 * (_c(g) + _c(b))) / 255.0


def black_canvas(g: Column, r="r", gr="g", b="b", gray_max: int = 8, rgb_max: int = 12) -> Column:
    return (g <= gray_max) | ((_c(r) <= rgb_max) & (_c(gr) <= rgb_max) & (_c(b) <= rgb_max))


def rapid_channel(r="r", g="g", b="b") -> Column:
    return F.greatest(F.lit(0.0), 0.5 * (_c(r) + _c(b)) - _c(g))


def tissue(r="r", g="g", b="b", od_min: float = 0.12, chroma_min: float = 12, gray_max: float = 245) -> Column:
    od = optical_density(r) + optical_density(g) + optical_density(b)
    chroma = F.greatest(r, g, b) - F.least(r, g, b)
    return (od > od_min) & ((chroma >= chroma_min) | ((_c(r) + _c(g) + _c(b)) / 3.0 <= gray_max))


def tile_metrics(pixels: DataFrame, by: list[str]) -> DataFrame:
    """Tissue, red cells, artefacts and brightness of each image, as the quality check sees them."""
    h, s, v = hsv()
    he, eo = unmix()
    p = pixels.withColumns({"__g": gray(), "__h": h, "__s": s, "__v": v, "__he": F.round(he, 9), "__eo": F.round(eo, 9)})
    p = p.withColumns({"__hn": norm01("__he", by), "__en": norm01("__eo", by)})
    rbc = (F.col("__en") > 0.58) & (F.col("__hn") < 0.42) & (red_dominance() > 0.06)
    p = p.withColumns({"__rbc": rbc, "__t": tissue(), "__ink": ink_qc(F.col("__h"), F.col("__s"), F.col("__v"), F.col("__g"))})

    def share(c):
        return F.avg(c.cast("int"))

    return p.groupBy(*by).agg(
        share(F.col("__t") & ~F.col("__rbc")).alias("tissue_frac"),
        share(F.col("__rbc")).alias("qc_rbc_frac"),
        share(F.col("__ink")).alias("qc_artifact_frac"),
        F.avg((F.col("r") + F.col("g") + F.col("b")) / 3.0).alias("brightness"),
        share(F.greatest("r", "g", "b") <= 15).alias("black_frac"),
        share(F.least("r", "g", "b") >= 230).alias("white_frac"),
    )


def blood_score(pixels: DataFrame, by: list[str]) -> DataFrame:
    he, _ = unmix()
    p = pixels.withColumn("__he", F.round(he, 9))
    p = p.withColumn("__low", F.col("__he") < F.percentile("__he", 0.35).over(Window.partitionBy(*by)))
    red = (F.col("r") / 255.0 > 0.55) & ((F.col("r") - F.col("g")) / 255.0 > 0.12) & ((F.col("r") - F.col("b")) / 255.0 > 0.12)
    parts = F.avg(F.greatest(F.lit(0.0), red_dominance())) + 0.7 * F.avg(red.cast("int")) + 0.3 * F.avg((red & F.col("__low")).cast("int"))
    return p.groupBy(*by).agg(parts.alias("blood_score"))


def shifted(pixels: DataFrame, by: list[str], value: str) -> DataFrame:
    """pixels with the 3x3 neighbourhood of value as n00..n22 (row, column), borders mirrored without the edge pixel."""
    row, col = Window.partitionBy(*by, "y").orderBy("x"), Window.partitionBy(*by, "x").orderBy("y")
    p = pixels.withColumns({"__w": F.coalesce(F.lag(value).over(row), F.lead(value).over(row), F.col(value)), "__e": F.coalesce(F.lead(value).over(row), F.lag(value).over(row), F.col(value))})
    names = {"__w": 0, value: 1, "__e": 2}
    out = {}
    for c, k in names.items():
        up, down = F.lag(c).over(col), F.lead(c).over(col)
        out |= {f"n0{k}": F.coalesce(up, down, F.col(c)), f"n1{k}": F.col(c), f"n2{k}": F.coalesce(down, up, F.col(c))}
    return p.withColumns(out).drop("__w", "__e")


def sobel() -> Column:
    """The gradient's size from the columns of shifted()."""
    n = {k: F.col(f"n{k}").cast("double") for k in ("00", "01", "02", "10", "12", "20", "21", "22")}
    gx = n["02"] - n["00"] + 2 * (n["12"] - n["10"]) + n["22"] - n["20"]
    gy = n["20"] - n["00"] + 2 * (n["21"] - n["01"]) + n["22"] - n["02"]
    return F.sqrt(gx * gx + gy * gy)


def laplacian() -> Column:
    return (F.col("n01") + F.col("n10") + F.col("n12") + F.col("n21") - 4 * F.col("n11")).cast("double")


def focus(pixels: DataFrame, by: list[str]) -> DataFrame:
    """Mean gradient, variance of the Laplacian and fat proxy of each image."""
    p = shifted(pixels.withColumn("__g", gray()), by, "__g").withColumns({"__m": sobel(), "__l": laplacian()})
    return p.groupBy(*by).agg(F.avg("__m").alias("focus"), F.var_pop("__l").alias("laplacian_var"), (F.avg((F.col("__g") > 240).cast("int")) - 0.001 * F.var_pop("__l")).alias("adipose_proxy"))


def dilate(mask: DataFrame, by: list[str], offsets: list[tuple[int, int]], width: int, height: int) -> DataFrame:
    """The sparse mask (by, y, x) grown by a kernel of (dy, dx) offsets, inside the image."""
    k = F.array(*(F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in offsets))
    out = mask.select(*by, "y", "x", F.explode(k).alias("k")).select(*by, (F.col("y") + F.col("k.dy")).alias("y"), (F.col("x") + F.col("k.dx")).alias("x"))
    return out.where(F.col("y").between(0, height - 1) & F.col("x").between(0, width - 1)).distinct()


def area_downsample(pixels: DataFrame, by: list[str], factor: int) -> DataFrame:
    """Means over whole blocks, rounded half to even."""
    block = pixels.groupBy(*by, F.floor(F.col("y") / factor).cast("int").alias("y"), F.floor(F.col("x") / factor).cast("int").alias("x"))
    return block.agg(*(F.bround(F.avg(c)).cast("int").alias(c) for c in ("r", "g", "b")))


def od_covariance(pixels: DataFrame, by: list[str]) -> DataFrame:
    """The covariance matrix of the unit optical-density vectors of each image, as six columns."""
    od = {c: optical_density(c) for c in ("r", "g", "b")}
    p = pixels.withColumns({f"__{c}": v for c, v in od.items()})
    n = F.sqrt(F.col("__r") * F.col("__r") + F.col("__g") * F.col("__g") + F.col("__b") * F.col("__b"))
    p = p.withColumn("__n", n).where("__n > 1e-8")
    u = {c: F.col(f"__{c}") / F.col("__n") for c in ("r", "g", "b")}
    return p.groupBy(*by).agg(*(F.covar_samp(u[a], u[b]).alias(f"cov_{a}{b}") for a, b in ("rr", "rg", "rb", "gg", "gb", "bb")))


def tile_flags(pixels: DataFrame, by: list[str]) -> DataFrame:
    """Whether each tile is black (by mean or by dark pixels), too dark to keep, tissue, and flat."""
    mean_rgb = (F.col("r") + F.col("g") + F.col("b")) / 3.0
    p = pixels.withColumns({"__m": mean_rgb, "__v": F.explode(F.array("r", "g", "b"))})

    def share(c):
        return F.avg(c.cast("int"))

    out = p.groupBy(*by).agg(
        F.avg("__m").alias("mean"),
        share(F.col("__m") <= 5).alias("dark_share"),
        share(F.greatest("r", "g", "b") <= 15).alias("black_share"),
        share(~(F.least("r", "g", "b") > 220)).alias("tissue_share"),
        F.stddev_pop("__v").alias("sd"),
    )
    return out.select(
        *by,
        ((F.col("mean") < 5) | (F.col("dark_share") >= 0.80)).alias("is_black"),
        ((F.col("black_share") >= 0.95) | (F.col("mean") < 10)).alias("to_purge"),
        (F.col("tissue_share") >= 0.60).alias("is_tissue"),
        (F.col("sd") < 5).alias("low_texture"),
        F.col("tissue_share"),
        F.col("sd"),
    )


def candidate_estimate(height, width, mask_frac, stride) -> Column:
    """About how many candidates a grid has in a mask."""
    return _c(height) * _c(width) * _c(mask_frac) / (_c(stride) * _c(stride))


def before_and_after(raw: DataFrame, normalised: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Tiles that both tables have, with each column of both and their difference."""
    a = raw.select(key, *(F.col(c).alias(f"{c}_raw") for c in columns))
    b = normalised.select(key, *(F.col(c).alias(f"{c}_norm") for c in columns))
    return a.join(b, key).withColumns({f"{c}_diff": F.col(f"{c}_norm") - F.col(f"{c}_raw") for c in columns})
