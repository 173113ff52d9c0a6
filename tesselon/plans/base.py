"""Registration of queries, and the roles that the test tables stand in for.

The test tables hold no images. A patch is an event (its slide the user, its score value / 500, its type from the kind of
event), a labelled patch is a labelled document (its slide the source), a feature is an embedding, and pixels are a small
image made from whole-number arithmetic.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, sf_dir) under its name, with the same result in SQL."""
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(slide, patch, prob, value, kind, k, type) of every event; some have no prob, some a NaN."""
    e = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "view", "A").when(F.col("event_type") == "click", "B").when(F.col("event_type") == "purchase", "C").otherwise("D")
    k = F.get_json_object("props", "$.k").cast("int")
    prob = F.when(F.col("event_id") % 97 == 5, float("nan")).when(F.col("event_id") % 89 != 7, F.col("value") / 500)
    return e.select(F.col("user_id").alias("slide"), F.col("event_id").alias("patch"), prob.alias("prob"), "value", F.col("event_type").alias("kind"), k.alias("k"), kind.alias("type"))


PATCHES = """patches AS (SELECT user_id AS slide, event_id AS patch, CASE WHEN event_id % 97 <> 5 AND event_id % 89 <> 7 THEN value / 500 END AS prob, value, event_type AS kind, CAST(json_extract_string(props, '$.k') AS INT) AS k,
  CASE event_type WHEN 'view' THEN 'A' WHEN 'click' THEN 'B' WHEN 'purchase' THEN 'C' ELSE 'D' END AS type FROM events)"""


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(slide, patch, label, n_chars) of every labelled document."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return table(spark, sf_dir, "labels").join(d, "doc_id").select(F.col("source").alias("slide"), F.col("doc_id").alias("patch"), F.col("quality").alias("label"), "n_chars")


LABELLED = "labelled AS (SELECT source AS slide, doc_id AS patch, quality AS label, n_chars FROM labels JOIN documents USING (doc_id))"

IMAGES, SIDE = 4, 24


def pixels(spark: SparkSession, images: int = IMAGES, side: int = SIDE) -> DataFrame:
    """(img, y, x, r, g, b): a stained patch with a pen stroke and red cells on a bright ground, by arithmetic."""
    n = side * side
    p = spark.range(images * n).select(F.floor(F.col("id") / n).cast("int").alias("img"), F.floor(F.col("id") % n / side).cast("int").alias("y"), (F.col("id") % side).cast("int").alias("x"))
    mix = (F.col("x") * 7 + F.col("y") * 13 + F.col("img") * 5) % 23
    inside = F.col("x").between(4, side - 5) & F.col("y").between(4, side - 5)
    pen = F.col("y").between(9, 10) & (F.col("img") % 2 == 0)
    red = inside & ((F.col("x") + 2 * F.col("y") + F.col("img")) % 9 == 0)
    def c(stained, ink, cell, ground):
        return F.when(pen, F.lit(ink) + mix % 5).when(red, F.lit(cell) + mix).when(inside, F.lit(stained) + mix * 2).otherwise(F.lit(ground) - mix % 7).cast("int")
    return p.select("img", "y", "x", c(130, 30, 190, 245).alias("r"), c(70, 140, 60, 243).alias("g"), c(140, 60, 80, 246).alias("b"))


def _colour(stained: int, ink: int, cell: int, ground: int) -> str:
    return f"""CAST(CASE WHEN pen THEN {ink} + mix % 5 WHEN red THEN {cell} + mix WHEN inside THEN {stained} + mix * 2 ELSE {ground} - mix % 7 END AS INT)"""


PIXELS = f"""raw AS (SELECT CAST(id // {SIDE * SIDE} AS INT) AS img, CAST(id % {SIDE * SIDE} // {SIDE} AS INT) AS y, CAST(id % {SIDE} AS INT) AS x FROM (SELECT unnest(range({IMAGES * SIDE * SIDE})) AS id)),
marked AS (SELECT *, (x * 7 + y * 13 + img * 5) % 23 AS mix, x BETWEEN 4 AND {SIDE - 5} AND y BETWEEN 4 AND {SIDE - 5} AS inside, y BETWEEN 9 AND 10 AND img % 2 = 0 AS pen FROM raw),
cells AS (SELECT *, inside AND (x + 2 * y + img) % 9 = 0 AS red FROM marked),
pixels AS (SELECT img, y, x, {_colour(130, 30, 190, 245)} AS r, {_colour(70, 140, 60, 243)} AS g, {_colour(140, 60, 80, 246)} AS b FROM cells)"""
