"""The stages as chains of tables: masks, quality and selection, gates, scores, features - and re-gating from stored scores."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.ranks import sample_exact
from ..functions.shipping import map_pandas
from ..operators import gate, geo, masks, select, summary
from ..sources import plugins


@dataclass(frozen=True)
class Settings:
    mask: masks.MaskConfig = field(default_factory=masks.MaskConfig)
    mask_downsample: float = 16.0
    stride: int = 384
    read: int = 448
    tile: int = 224
    max_candidates: int = 40_000
    seed: int = 42
    qc: select.QcThresholds = field(default_factory=select.QcThresholds)
    quotas: select.Quotas = field(default_factory=lambda: select.Quotas(10_000))
    cell: int = 256
    per_cell: int = 40
    slide_gate: gate.SlideGate = field(default_factory=gate.SlideGate)
    tumor: gate.TumorGate = field(default_factory=gate.TumorGate)
    max_features: int = 5000
    roi_pad: int = 8
    roi_share: float = 0.05


def mask_stage(slides: DataFrame, open_slide: Callable, s: Settings = Settings()) -> DataFrame:
    """A mask row for each slide; slides that cannot be read have a status and no mask.

    Where the mask holds too little tissue, the region around it is read at a finer level and masked once more
    (roi_attempted, roi_used); the finer mask is joined where that gains tissue and no glare.
    """
    thumbs = plugins.thumbnails(slides, open_slide, s.mask_downsample).join(slides.select(F.col("slide_uid").alias("img"), C.file_suffix("path").alias("suffix")), "img")
    made = masks.mask_table(thumbs.where("error is null"), s.mask, "suffix").join(thumbs.select("img", "downsample", F.col("h").alias("__h")).drop("__h"), "img")
    failed = thumbs.where("error is not null").select("img", F.lit("read_error").alias("mask_status"), F.lit("read_error").alias("mask_status_effective"), F.col("error").alias("error_message"))
    low = F.coalesce(F.col("mask_status_effective") == "low_tissue", F.lit(False))
    again = _finer(made.where(low).join(slides.select(F.col("slide_uid").alias("img"), "path"), "img"), open_slide, s)
    made = made.where(~low).withColumns({"roi_attempted": F.lit(False), "roi_used": F.lit(False)}).unionByName(again)
    return made.unionByName(failed, allowMissingColumns=True).withColumnRenamed("img", "slide_uid")


def _finer(rows: DataFrame, open_slide: Callable, s: Settings) -> DataFrame:
    """Mask rows after another look at the region around what was found, or around all that is no black canvas."""
    import numpy as np
    from pyspark.sql import types as T

    from ..operators import raster as R

    kept = [c for c in rows.columns if c != "path"]
    schema = T.StructType([*(rows.schema[c] for c in kept), T.StructField("roi_attempted", T.BooleanType()), T.StructField("roi_used", T.BooleanType())])

    def look(row):
        slide, h, w, ds = open_slide(row["path"]), int(row["h"]), int(row["w"]), float(row["downsample"])
        levels = slide.levels()
        level = min(range(len(levels)), key=lambda k: abs(levels[k][2] - ds))
        finer = max((k for k in range(len(levels)) if levels[k][2] < ds), key=lambda k: levels[k][2], default=None)
        rgb = slide.read(0, 0, level, w, h)
        mask = np.unpackbits(np.frombuffer(row["mask"], np.uint8))[: h * w].reshape(h, w).astype(bool)
        y, x = np.nonzero(mask if mask.any() else ~R.black_canvas(rgb))
        if finer is None or not len(y):
            return row
        pad = [max(s.roi_pad, round((int(v.max()) - int(v.min())) * s.roi_share)) for v in (x, y)]
        x1, x2, y1, y2 = max(0, int(x.min()) - pad[0]), min(w, int(x.max()) + 1 + pad[0]), max(0, int(y.min()) - pad[1]), min(h, int(y.max()) + 1 + pad[1])
        scale = ds / levels[finer][2]
        part = slide.read(round(x1 * ds), round(y1 * ds), finer, round((x2 - x1) * scale), round((y2 - y1) * scale))
        new, used = masks.roi_retry(rgb, mask, part, (x1, y1, x2, y2), s.mask)
        if used:
            got = masks.status_fields(rgb, new, s.mask)
            row |= {k: v for k, v in got.items() if k in row} | {"mask": np.packbits(new).tobytes(), "white_leak": masks.white_leak(rgb, new, s.mask)}
        return row | {"roi_attempted": True, "roi_used": used}

    def run(frames):
        import pandas as pd

        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                row |= {"roi_attempted": False, "roi_used": False}
                try:
                    row = look(row)
                except Exception as e:  # the first mask stands
                    row |= {"roi_attempted": True, "error_type": type(e).__name__, "error_message": " ".join(str(e).split())[:500]}
                out.append(row)
            yield pd.DataFrame(out, columns=[*kept, "roi_attempted", "roi_used"])

    return map_pandas(rows, run, schema)


def mask_pixels(mask_rows: DataFrame) -> DataFrame:
    """Sparse (slide_uid, y, x) rows of the masks."""
    def run(frames):
        import numpy as np
        import pandas as pd

        for frame in frames:
            for uid, h, w, data in frame[["slide_uid", "h", "w", "mask"]].itertuples(index=False):
                m = np.unpackbits(np.frombuffer(data, np.uint8))[: int(h) * int(w)].reshape(int(h), int(w))
                y, x = np.nonzero(m)
                yield pd.DataFrame({"slide_uid": uid, "y": y.astype("int32"), "x": x.astype("int32")})

    return map_pandas(mask_rows.where("mask is not null").select("slide_uid", "h", "w", "mask"), run, "slide_uid string, y int, x int")


def candidates(mask_rows: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Grid points in the mask, at most max_candidates of a slide, with their place in the slide; failed masks have none."""
    ok = mask_rows.where(~F.col("mask_status_effective").isin(*gate.FAILED)).withColumn("step", C.grid_step(F.lit(float(s.stride)), "downsample"))
    g = geo.grid(ok.select("slide_uid", "h", "w", "step", "downsample"), "w", "h", "step")
    g = geo.in_mask(g, mask_pixels(mask_rows), ["slide_uid", "y", "x"])
    g = sample_exact(g, ["slide_uid"], s.max_candidates, s.seed, ["y", "x"])
    place = {"x0": C.clamp_origin(C.to_level0("x", "downsample"), F.bround(F.col("w") * F.col("downsample")).cast("int"), s.read), "y0": C.clamp_origin(C.to_level0("y", "downsample"), F.bround(F.col("h") * F.col("downsample")).cast("int"), s.read)}
    return g.withColumns(place).withColumns({"patch_id": F.col("y").cast("long") * F.col("w") + F.col("x"), "x_mask": F.col("x"), "y_mask": F.col("y")}).select("slide_uid", "patch_id", "x_mask", "y_mask", "x0", "y0")


def qc_stage(slides: DataFrame, points: DataFrame, open_slide: Callable, s: Settings = Settings()) -> DataFrame:
    """Candidates with their quality metrics, tile features and whether they pass.

    Each tile is read once and measured by all kernels there; pixels never leave the read's task chain, and nothing is joined.
    """
    tiles = plugins.read_tiles(points.join(slides.select("slide_uid", "path"), "slide_uid"), open_slide, s.tile, s.read, tuple(points.columns))
    both = masks.kernel_table(tiles.where("error is null"), "tile_metrics", "tile_features", keep=tuple(points.columns))
    return both.withColumn("qc_ok", select.qc_predicate(s.qc))


def select_stage(slides: DataFrame, pool: DataFrame, s: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """(selected patches, one summary row per slide with a verdict); the cap's cells are squares of the mask."""
    scored = select.score_patches(pool.where("qc_ok"), ["slide_uid"])
    capped = select.spatial_cap(scored, ["slide_uid"], "x_mask", "y_mask", "cell_rich_p", "patch_id", s.cell, s.per_cell)
    chosen = select.quota_select(capped, ["slide_uid"], "cell_rich_p", "type", "patch_id", s.quotas)
    rows = select.qc_summary(slides, pool, chosen)
    return chosen, rows.withColumn("qc_status", F.when(F.col("candidates_after_mask") == 0, "no_candidates").when(F.col("qc_pass") == 0, "no_qc_pass").otherwise(select.slide_verdict(F.col("good_count"))))


def held(df: DataFrame, name: str) -> DataFrame:
    """What a model has made, so that it runs once: here in Spark's storage; runs that persist write it instead."""
    return df.persist()


def tumor_stage(slides: DataFrame, points: DataFrame, open_slide: Callable, make: Callable, s: Settings = Settings(), normaliser: Callable | None = None, save: Callable = held) -> tuple[DataFrame, DataFrame]:
    """(scored patches, slide rows with readiness).

    Tiles are brought to the normaliser's stains before the model sees them; those that fail, or could not be read, have no
    score and are counted. `save` (table, name) keeps the scores before anything reads them, so the model sees a tile once.
    """
    tiles = plugins.read_tiles(points.join(slides.select("slide_uid", "path"), "slide_uid"), open_slide, s.tile, s.read)
    scored = save(plugins.score_tiles(plugins.normalise_tiles(tiles, normaliser) if normaliser else tiles, make), "scored")
    failed = scored.groupBy("slide_uid").agg(F.count_if(F.col("error").isNotNull()).alias("norm_or_read_fail"), F.count("*").alias("selected_input"))
    return scored, slides.select("slide_uid").join(failed, "slide_uid", "left").join(gate.regate(scored, "slide_uid", "tumor_prob", "patch_id", s.tumor), "slide_uid", "left")


def feature_stage(slides: DataFrame, scored: DataFrame, gated: DataFrame, open_slide: Callable, make: Callable, s: Settings = Settings(), normaliser: Callable | None = None, save: Callable = held) -> tuple[DataFrame, DataFrame]:
    """(patch features, slide rows with the mean vector) of the slides that are ready, best patches first; as tumor_stage."""
    ready = summary.only_known(scored.where(C.known("tumor_prob") >= s.tumor.high), gated.where("uni_ready"), ["slide_uid"])
    top = gate.top_scored(ready, "slide_uid", "tumor_prob", "patch_id", s.max_features)
    tiles = plugins.read_tiles(top.join(slides.select("slide_uid", "path"), "slide_uid"), open_slide, s.tile, s.read)
    features = save(plugins.encode_tiles(plugins.normalise_tiles(tiles, normaliser, ("slide_uid", "patch_id")) if normaliser else tiles, make), "features")
    return features, summary.mean_pool(features.where("feature is not null"), ["slide_uid"], "feature")


def regate_from_scores(scored: DataFrame, g: gate.TumorGate, by: str = "slide_uid", prob: str = "tumor_prob", key: str = "patch_id") -> dict[str, DataFrame]:
    """The outputs of a gate from stored scores, without a model: slide rows, top k and high-only patches."""
    return {"slides": gate.regate(scored, by, prob, key, g), "topk": gate.top_scored(scored, by, prob, key, g.topk), "high_only": gate.high_only(scored, by, prob, key, g)}


def mine_stage(slides: DataFrame, open_slide: Callable, make: Callable, k: int, downsample: float = 16.0, stride: int = 16, half: int = 3, least: float = 0.10, s: Settings = Settings()) -> DataFrame:
    """The k most likely patches of each slide: windows of a pen-free mask that hold enough of it, read around their centre.

    Windows that do not lie wholly inside the slide are left out, as are flat ones and those that are no tissue.
    """
    import numpy as np

    from ..functions.shipping import map_pandas
    from ..operators import raster as R

    # Each slide costs much more than its row, so a few rows must not end in one task; no pixel leaves the task that reads it.
    spread = slides.where(F.col("slide_uid").isNotNull()).repartition(int(slides.sparkSession.conf.get("spark.sql.shuffle.partitions")), "slide_uid")
    thumbs = plugins.thumbnails(spread, open_slide, downsample, ("path",)).where("error is null")

    def windows(frames):
        import pandas as pd

        names, rows = ["slide_uid", "path", "y", "x", "height", "width", "downsample"], []
        for frame in frames:
            for uid, path, h, w, ds, data in frame[["img", "path", "h", "w", "downsample", "rgb"]].itertuples(index=False):
                mask = R.clean_mask(np.frombuffer(data, np.uint8).reshape(int(h), int(w), 3))
                y, x = np.arange(0, int(h), stride), np.arange(0, int(w), stride)
                i, j = np.nonzero(R.window_share(mask, y, x, half) >= least)
                rows += [(uid, path, a, b, int(h), int(w), ds) for a, b in zip(y[i].tolist(), x[j].tolist())]
                if len(rows) >= 10_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
        yield pd.DataFrame(rows, columns=names)

    points = map_pandas(thumbs.select("img", "path", "h", "w", "downsample", "rgb"), windows, "slide_uid string, path string, y int, x int, height int, width int, downsample double")
    x0, y0 = (F.bround(F.col(c) * F.col("downsample")).cast("int") - s.read // 2 for c in ("x", "y"))
    points = points.withColumns({"x0": x0, "y0": y0, "patch_id": F.col("y").cast("long") * F.col("width") + F.col("x")})
    points = points.where(C.window_inside("x0", "y0", s.read, F.col("width") * F.col("downsample"), F.col("height") * F.col("downsample")))

    def usable(frames):
        for frame in frames:
            keep = []
            for h, w, data, error in frame[["h", "w", "rgb", "error"]].itertuples(index=False):
                rgb = np.frombuffer(data, np.uint8).reshape(int(h), int(w), 3) if error is None and data is not None else None
                keep.append(rgb is not None and not R.patch_verdict(rgb) and rgb.std() >= 5)
            yield frame[keep]

    tiles = plugins.read_tiles(points, open_slide, s.tile, s.read)
    scored = plugins.score_tiles(map_pandas(tiles, usable, tiles.schema), make)
    return gate.top_scored(scored, "slide_uid", "tumor_prob", "patch_id", k)


def preview(points: DataFrame, open_slide: Callable, n: int, target: float = 0.5, out: int = 224, seed: int = 42, columns: int = 5) -> DataFrame:
    """n tiles of each label for a look at them: points (slide_id, path, label, x_qp, y_qp, bounds_x, bounds_y).

    Points are moved by the bounds of their slide and read at `target` microns a pixel. Each tile has its place in its
    label's montage, its mean and share of dark pixels, whether it is too dark, and its pixels, or the read's error.
    """
    import numpy as np
    from pyspark.sql import types as T

    place = F.concat_ws(":", "slide_id", F.col("x_qp").cast("string"), F.col("y_qp").cast("string"))
    chosen = summary.montage(points.withColumn("point", place), ["label"], "point", n, seed, columns)
    chosen = chosen.withColumns({f"{c}0": (F.col(f"{c}_qp") + F.coalesce(F.col(f"bounds_{c}"), F.lit(0))).cast("int") for c in "xy"})
    kept = ["label", "slot", "grid_row", "grid_col", "slide_id", "x_qp", "y_qp", "x0", "y0"]
    made = [("mean", T.DoubleType()), ("black_frac", T.DoubleType()), ("dark", T.BooleanType()), ("h", T.IntegerType()), ("w", T.IntegerType()), ("rgb", T.BinaryType()), ("error", T.StringType())]

    def run(frames):
        import pandas as pd

        for frame in frames:
            rows = []
            for row in frame.to_dict("records"):
                got = dict.fromkeys(k for k, _ in made) | {"h": out, "w": out}
                try:
                    slide = open_slide(row["path"])
                    p = slide.properties()
                    mpp = (float(p["openslide.mpp-x"]) + float(p["openslide.mpp-y"])) / 2
                    rgb = plugins.read_around(slide, row["x0"], row["y0"], mpp, target, out)
                    mean, black = float(rgb.mean()), float((rgb.mean(-1) <= 5).mean())
                    got |= {"mean": mean, "black_frac": black, "dark": mean < 5 or black >= 0.8, "rgb": rgb.astype(np.uint8).tobytes()}
                except Exception as e:  # shown as a gap
                    got["error"] = f"{type(e).__name__}: {' '.join(str(e).split())[:400]}"
                rows.append({k: row[k] for k in kept} | got)
            yield pd.DataFrame(rows, columns=[*kept, *(k for k, _ in made)])

    return map_pandas(chosen.select(*kept, "path"), run, T.StructType([*(chosen.schema[c] for c in kept), *(T.StructField(k, v) for k, v in made)]))


def training_points(slides: DataFrame, annotations: DataFrame, labels: dict[str, int], spacing: float = 56.0, per_class: int = 5000, least: int = 50, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Labelled grid points of annotated polygons: slides (slide_id, mpp, w, h), annotations (slide_id, class_name, rings).

    Points of ignored classes are left out, each class of a slide keeps its first points by x and y, and slides with too few
    points of every class are dropped.
    """
    step = F.greatest(F.lit(1), F.bround(F.lit(spacing) / F.col("mpp")).cast("int"))
    points = geo.grid(slides.withColumn("step", step), "w", "h", "step")
    out = None
    for name, label in labels.items():
        one = geo.points_in_polygons(points, annotations.where(F.col("class_name") == name), ["slide_id"]).withColumn("label", F.lit(label))
        out = one if out is None else out.unionByName(one)
    if ignore:
        out = geo.points_in_polygons(out, annotations.where(F.col("class_name").isin(*ignore)), ["slide_id"], "left_anti")
    from ..functions.ranks import top_per_key

    out = top_per_key(out, ["slide_id", "label"], [F.col("x"), F.col("y")], per_class)
    enough = out.groupBy("slide_id", "label").agg(F.count("*").alias("n")).groupBy("slide_id").agg(F.max("n").alias("n")).where(F.col("n") >= least)
    return out.join(enough.select("slide_id"), "slide_id", "left_semi").select("slide_id", F.col("x").alias("x_qp"), F.col("y").alias("y_qp"), "label", F.col("mpp").alias("mpp0"))


def reference_tiles(tries: DataFrame, by: str, slot: str, attempt: str, ok: str, most: int = 30) -> DataFrame:
    """Of each slot of each image the first accepted one of at most `most` tries."""
    good = tries.where(F.col(ok) & (F.col(attempt) < most))
    row = F.struct(*(F.col(c) for c in tries.columns))
    return good.groupBy(by, slot).agg(F.min_by(row, F.col(attempt)).alias("__r")).select("__r.*")
