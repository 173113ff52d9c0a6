"""What reads slides, normalises, classifies and embeds: small protocols, with deterministic stand-ins for tests."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from typing import Protocol

import numpy as np
from pyspark.sql import DataFrame

from ..functions.shipping import map_pandas


class SlideReader(Protocol):
    """An open slide; made once per slide and task."""

    def levels(self) -> list[tuple[int, int, float]]: ...

    def properties(self) -> dict[str, str]: ...

    def read(self, x0: int, y0: int, level: int, w: int, h: int) -> np.ndarray: ...


class Classifier(Protocol):
    def predict(self, tiles: np.ndarray) -> np.ndarray: ...


class Encoder(Protocol):
    dim: int

    def encode(self, tiles: np.ndarray) -> np.ndarray: ...


class SyntheticSlide:
    """A slide of two stained discs on a bright ground, made from its name."""

    def __init__(self, path: str, size: int = 2048):
        self.seed = int(hashlib.md5(path.encode()).hexdigest()[:8], 16)
        self.size = size

    def levels(self):
        return [(self.size >> k, self.size >> k, float(1 << k)) for k in (0, 2, 4)]

    def properties(self):
        return {"openslide.mpp-x": "0.25", "openslide.mpp-y": "0.25"}

    def read(self, x0, y0, level, w, h):
        ds = self.levels()[level][2]
        y, x = np.mgrid[:h, :w] * ds
        x, y = x + x0, y + y0
        out = np.full((h, w, 3), 245, np.int64)
        for k, colour in enumerate(((150, 90, 160), (200, 120, 170))):
            cx, cy = (self.seed >> 4 * k) % (self.size // 2) + self.size // 4, (self.seed >> 4 * k + 8) % (self.size // 2) + self.size // 4
            disc = (x - cx) ** 2 + (y - cy) ** 2 < (self.size / 5) ** 2
            out[disc] = np.array(colour) + ((x[disc] * 7 + y[disc] * 13 + self.seed) % 41).astype(np.int64)[:, None] - 20
        out[(x < 0) | (y < 0) | (x >= self.size) | (y >= self.size)] = 255
        return np.clip(out, 0, 255).astype(np.uint8)


class StandInClassifier:
    """The share of purple as a probability."""

    def predict(self, tiles):
        x = tiles.astype(np.float64)
        return np.clip(((x[..., 0] + x[..., 2]) / 2 - x[..., 1]).mean((1, 2)) / 80, 0, 1)


class StandInEncoder:
    """Channel means and deviations by quarter."""

    dim = 24

    def encode(self, tiles):
        n, h, w, _ = tiles.shape
        parts = [tiles[:, a : a + h // 2, b : b + w // 2].reshape(n, -1, 3) for a in (0, h // 2) for b in (0, w // 2)]
        return np.concatenate([f for p in parts for f in (p.mean(1), p.std(1))], axis=1).astype(np.float32)


def device(wanted: str = "auto", available: tuple[str, ...] = ()) -> str:
    """The device for a model: the one wanted if it is there, by itself the first of cuda and mps, else the CPU."""
    order = ("cuda", "mps") if wanted == "auto" else (wanted,)
    return next((d for d in order if d in available), "cpu")


def read_around(slide: SlideReader, x: float, y: float, mpp: float, target: float, out: int) -> np.ndarray:
    """A tile of out x out pixels at `target` microns a pixel around a point, read inside the canvas; 1 pixel at least is read."""
    from ..operators import raster as R

    width, height, _ = slide.levels()[0]
    size = min(max(1, round(out * target / mpp)), width, height)
    x0, y0 = (min(max(0, round(v - size / 2)), n - size) for v, n in ((x, width), (y, height)))
    return R.resize_bilinear(slide.read(x0, y0, 0, size, size), out, out)


def read_point(slide: SlideReader, x: float, y: float, size: int, shift: tuple[int, int] = (0, 0)) -> np.ndarray:
    """One read of size x size pixels around an annotation's point, moved by the bounds of the slide."""
    return slide.read(round(x) + shift[0] - size // 2, round(y) + shift[1] - size // 2, 0, size, size)


def read_tiles(patches: DataFrame, open_slide: Callable[[str], SlideReader], size: int = 224, read: int = 448, keep: tuple[str, ...] = ("slide_uid", "patch_id", "x0", "y0")) -> DataFrame:
    """patches (path, x0, y0 and keep) with h, w, rgb, or with an error where a read failed; each task opens a slide once."""
    from pyspark.sql import types as T

    from ..operators import raster as R

    names = [*keep, "h", "w", "rgb", "error"]
    fields = [patches.schema[c] for c in keep] + [T.StructField("h", T.IntegerType()), T.StructField("w", T.IntegerType()), T.StructField("rgb", T.BinaryType()), T.StructField("error", T.StringType())]

    def run(frames):
        import pandas as pd

        path, slide = None, None
        for frame in frames:
            rows = []
            for row in frame.to_dict("records"):
                out = {k: row[k] for k in keep} | {"h": size, "w": size, "rgb": None, "error": None}
                try:
                    if row["path"] != path:
                        path, slide = row["path"], open_slide(row["path"])
                    out["rgb"] = R.resize_area(slide.read(int(row["x0"]), int(row["y0"]), 0, read, read), size, size).tobytes()
                except Exception as e:  # a failed read is counted, not fatal
                    out["error"] = f"{type(e).__name__}: {' '.join(str(e).split())[:400]}"
                rows.append(out)
            yield pd.DataFrame(rows, columns=names)

    cols = list(dict.fromkeys(["path", *keep, "x0", "y0"]))
    return map_pandas(patches.select(*cols).sortWithinPartitions("path"), run, T.StructType(fields))


def normalise_tiles(tiles: DataFrame, make: Callable[[], object], keep: tuple[str, ...] = ("slide_uid", "patch_id", "x0", "y0")) -> DataFrame:
    """tiles (keep, h, w, rgb, error) brought to the stains of a normaliser, made once per task; what fails has an error and no pixels."""
    names = [*keep, "h", "w", "rgb", "error"]

    def run(frames):
        normaliser = make()
        for frame in frames:
            frame = frame.copy()
            pixels, errors = [], []
            for h, w, data, error in frame[["h", "w", "rgb", "error"]].itertuples(index=False):
                if data is not None and error is None:
                    try:
                        data = normaliser.normalize(np.frombuffer(data, np.uint8).reshape(int(h), int(w), 3)).tobytes()
                    except Exception as e:  # counted like a failed read
                        data, error = None, f"normalise: {type(e).__name__}: {' '.join(str(e).split())[:400]}"
                pixels.append(data)
                errors.append(error)
            frame["rgb"], frame["error"] = pixels, errors
            yield frame[names]

    tiles = tiles.select(*names)
    return map_pandas(tiles, run, tiles.schema)


def score_tiles(tiles: DataFrame, make: Callable[[], Classifier], batch: int = 256, keep: tuple[str, ...] = ("slide_uid", "patch_id", "x0", "y0")) -> DataFrame:
    """keep, tumor_prob and error of tiles (h, w, rgb); a model is made once per task, failed tiles have no probability."""
    return _batched(tiles, lambda model, x: model.predict(x).astype(float).tolist(), make, batch, keep, "tumor_prob", "double")


def encode_tiles(tiles: DataFrame, make: Callable[[], Encoder], batch: int = 128, keep: tuple[str, ...] = ("slide_uid", "patch_id")) -> DataFrame:
    """keep, feature and error of tiles (h, w, rgb)."""
    return _batched(tiles, lambda model, x: [v.tolist() for v in model.encode(x)], make, batch, keep, "feature", "array<float>")


def _batched(tiles, apply, make, batch, keep, name, kind):
    from pyspark.sql import types as T

    schema = T.StructType([*(tiles.schema[c] for c in keep), T.StructField(name, T.DoubleType() if kind == "double" else T.ArrayType(T.FloatType())), T.StructField("error", T.StringType())])

    def run(frames):
        import pandas as pd

        model = make()
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                good = [d is not None and e is None for d, e in zip(part["rgb"], part["error"])]
                out = [None] * len(part)
                if any(good):
                    x = np.stack([np.frombuffer(d, np.uint8).reshape(int(h), int(w), 3) for d, h, w, g in zip(part["rgb"], part["h"], part["w"], good) if g])
                    got = iter(apply(model, x))
                    out = [next(got) if g else None for g in good]
                yield pd.DataFrame({**{k: part[k].tolist() for k in keep}, name: out, "error": part["error"].tolist()}, columns=[*keep, name, "error"])

    return map_pandas(tiles.select(*keep, "h", "w", "rgb", "error"), run, schema)


def slide_levels(slides: DataFrame, open_slide: Callable[[str], SlideReader]) -> DataFrame:
    """(slide_uid, level, width, height, downsample, mpp, error) of each slide; one that cannot be opened has a row with its error."""
    def run(frames):
        import pandas as pd

        for frame in frames:
            rows = []
            for uid, path in frame[["slide_uid", "path"]].itertuples(index=False):
                try:
                    s = open_slide(path)
                    p = s.properties()
                    mpp = (float(p["openslide.mpp-x"]) + float(p["openslide.mpp-y"])) / 2 if "openslide.mpp-x" in p and "openslide.mpp-y" in p else None
                    rows += [(uid, k, w, h, d, mpp, None) for k, (w, h, d) in enumerate(s.levels())]
                except Exception as e:  # recorded as the slide's status
                    rows.append((uid, None, None, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["slide_uid", "level", "width", "height", "downsample", "mpp", "error"])

    return map_pandas(slides.select("slide_uid", "path"), run, "slide_uid string, level int, width int, height int, downsample double, mpp double, error string")


def thumbnails(slides: DataFrame, open_slide: Callable[[str], SlideReader], target: float = 32.0, keep: tuple[str, ...] = ()) -> DataFrame:
    """(img, h, w, rgb, level, downsample, error, keep...): each slide's level that is nearest to a downsample, whole."""
    kinds = dict(slides.dtypes)

    def run(frames):
        import pandas as pd

        for frame in frames:
            rows = []
            for uid, path, *kept in frame[["slide_uid", "path", *keep]].itertuples(index=False):
                try:
                    s = open_slide(path)
                    k, (w, h, d) = min(enumerate(s.levels()), key=lambda v: abs(v[1][2] - target))
                    rows.append((uid, h, w, s.read(0, 0, k, w, h).tobytes(), k, d, None, *kept))
                except Exception as e:  # recorded as the slide's status
                    rows.append((uid, None, None, None, None, None, f"{type(e).__name__}: {e}", *kept))
            yield pd.DataFrame(rows, columns=["img", "h", "w", "rgb", "level", "downsample", "error", *keep])

    return map_pandas(slides.select("slide_uid", "path", *(c for c in keep if c != "path")), run, "img string, h int, w int, rgb binary, level int, downsample double, error string" + "".join(f", `{c}` {kinds[c]}" for c in keep))
