"""Shared storage for intermediate tables, and connected components over edge tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.shipping import map_arrow

ROW_GROUP = 16 << 20  # bytes that a task holds back before it writes them
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_own_dir: dict[str, str] = {}
_made: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where none is named, one of our own, but only if all of Spark is one process."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    return _local_dir(spark.sparkContext.applicationId, spark.sparkContext.master)


def _local_dir(app: str, master: str) -> str:
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
    if app not in _own_dir:
        _own_dir[app] = "file://" + tempfile.mkdtemp(prefix="tesselon-")
    return _own_dir[app]


def written(df: DataFrame, name: str, free: bool = False) -> tuple[DataFrame, str]:
    """Write df as Parquet in the shared folder, which cuts its lineage, and read it back.

    With free its shuffle files go as soon as it is written, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    before = spark.conf.get(_FREE, None)
    if free:
        spark.conf.set(_FREE, "true")
    try:
        df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    finally:
        if free:
            spark.conf.unset(_FREE) if before is None else spark.conf.set(_FREE, before)
    return spark.read.schema(df.schema).parquet(path), path


def dropped(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def clear(spark: SparkSession) -> None:
    """Delete every intermediate table of this application; results that have not been written yet need them."""
    for path in _made.pop(spark.sparkContext.applicationId, []):
        dropped(spark, path)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> tuple[DataFrame, str]:
    """Label every node of an undirected edge table (u long, v long) with the smallest node it can reach.

    Alternating large-star and small-star rounds: each round is two aggregations by node, whose partial sums
    keep hot nodes small before the shuffle, and two joins that adaptive execution may split. Each round's edges
    are written to the shared folder. Self loops and nulls are ignored; repeated edges count once.
    Returns (node, component) for the nodes that are not their own component, and the path it is written to.
    """
    spark = edges.sparkSession
    e = edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    e, path = written(_forest(e), "edges")
    state = None
    for _ in range(max_rounds):
        # Large star: every larger neighbour of a node is tied to the smallest node around it.
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: every node and its smaller neighbours are tied to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        new, new_path = written(small, "edges")
        now = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        dropped(spark, path)
        e, path = new, new_path
        if now == state or not now[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")), path
        state = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _forest(edges: DataFrame) -> DataFrame:
    """Edges of a spanning forest for each run of rows: fewer edges with the same components."""

    def shrink(batches):
        import pyarrow as pa

        parent: dict[int, int] = {}

        def find(x):
            root = x
            while (up := parent.get(root, root)) != root:
                root = up
            while x != root:
                parent[x], x = root, parent.get(x, x)
            return root

        def out():
            pairs = [(x, find(x)) for x in parent]
            pairs = [p for p in pairs if p[0] != p[1]]
            parent.clear()
            return pa.RecordBatch.from_pydict({"u": pa.array([p[0] for p in pairs], pa.int64()), "v": pa.array([p[1] for p in pairs], pa.int64())})

        for b in batches:
            for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                a, c = find(u), find(v)
                if a != c:
                    parent[max(a, c)] = min(a, c)
                    parent.setdefault(min(a, c), min(a, c))
            if len(parent) > 2_000_000:  # bounds the memory of a task; the rounds join what is cut here
                yield out()
        yield out()

    return map_arrow(edges, shrink, "u long, v long")
