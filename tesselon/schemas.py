"""Table schemas, and one helper that brings a table to a schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_KINDS = {"STRING": T.StringType(), "INT": T.IntegerType(), "LONG": T.LongType(), "DOUBLE": T.DoubleType(), "BOOLEAN": T.BooleanType(), "BINARY": T.BinaryType(), "ARRAY<FLOAT>": T.ArrayType(T.FloatType())}


def _schema(text: str) -> T.StructType:
    """A schema from 'name KIND, ...'; needs no session."""
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in (part.split() for part in text.split(","))])


SLIDES = _schema("path STRING, center STRING, center_root STRING, slide_id STRING, slide_uid STRING, slide_relpath STRING")
LEVELS = _schema("slide_uid STRING, level INT, width INT, height INT, downsample DOUBLE")
PIXELS = _schema("img STRING, y INT, x INT, r INT, g INT, b INT")
RASTERS = _schema("img STRING, h INT, w INT, rgb BINARY")
MASKS = _schema("img STRING, h INT, w INT, mask BINARY")
QC_POOL = _schema(
    """slide_uid STRING, patch_id LONG, x_mask INT, y_mask INT, x0 INT, y0 INT, tissue_frac DOUBLE, focus DOUBLE,
    brightness DOUBLE, qc_artifact_frac DOUBLE, qc_rbc_frac DOUBLE, adipose_proxy DOUBLE"""
)
PATCH_FEATURES = _schema(
    """slide_uid STRING, patch_id LONG, h_mean DOUBLE, h_p90 DOUBLE, e_mean DOUBLE, blood_score DOUBLE, texture DOUBLE,
    white_frac DOUBLE, artifact_frac DOUBLE, rbc_frac DOUBLE"""
)
SCORED = _schema("slide_uid STRING, patch_id LONG, x0 INT, y0 INT, tumor_prob DOUBLE")
MASK_SUMMARY = _schema(
    """slide_id STRING, slide_uid STRING, slide_relpath STRING, center STRING, mask_frac DOUBLE, mask_frac_effective DOUBLE,
    fallback_used BOOLEAN, sparse_canvas_mode BOOLEAN, mask_status STRING, mask_status_effective STRING,
    status_basis STRING, profile_used STRING, error_type STRING, error_message STRING"""
)
QC_SUMMARY = _schema(
    """slide_uid STRING, candidates_after_mask LONG, qc_pass LONG, selected_count LONG, good_count LONG, typeA LONG,
    typeB LONG, typeC LONG, typeD LONG, mean_blood_score DOUBLE, mean_rbc_frac DOUBLE, median_cell_rich DOUBLE"""
)
TRAIN_COORDS = _schema("slide_id STRING, wsi_path STRING, x_qp INT, y_qp INT, label INT, mpp0 DOUBLE, bounds_x INT, bounds_y INT, bounds_w INT, bounds_h INT")
PATCH_INDEX = _schema("slide_id STRING, x INT, y INT, label INT, mpp DOUBLE, read_px INT, png_path STRING")
PREDICTIONS = _schema("row_id LONG, y_true INT, y_prob DOUBLE")
HARD_EXAMPLES = _schema("slide_id STRING, x INT, y INT, label INT, png_path STRING, y_true INT, y_prob DOUBLE, y_pred INT, epoch INT")
FEATURES = _schema("slide_uid STRING, patch_id LONG, feature ARRAY<FLOAT>")


def conform(df: DataFrame, schema: T.StructType, aliases: dict[str, tuple[str, ...]] | None = None, required: tuple[str, ...] = ()) -> DataFrame:
    """df with exactly the columns of schema, found by trimmed lower-case name or by the first alias that is there.

    Missing columns become null unless they are required, text that is no number becomes null, and NaN becomes null.
    """
    have = {c.strip().lower(): c for c in reversed(df.columns)}
    out = []
    for f in schema.fields:
        name = next((have[a] for a in (f.name.lower(), *(x.lower() for x in (aliases or {}).get(f.name, ()))) if a in have), None)
        if name is None and f.name in required:
            raise ValueError(f"column {f.name} is missing; there are {', '.join(df.columns)}")
        if name is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        kind, col = df.schema[name].dataType, F.col(f"`{name}`")
        if isinstance(kind, T.StringType) and not isinstance(f.dataType, T.StringType):
            col = col.try_cast(f.dataType)
        else:
            col = col.cast(f.dataType)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            col = F.nanvl(col, F.lit(None).cast(f.dataType))
        out.append(col.alias(f.name))
    return df.select(*out)
