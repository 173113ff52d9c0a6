"""Incremental runs: new files of scores are taken in once, re-gated for the slides that they touch, and merged."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.summary import read_current, upsert, write_version


def upsert_stream(stream: DataFrame, root: str, keys: list[str], order: str, checkpoint: str, summarise: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Merge everything that is available into the table at root and stop; a batch that is replayed changes nothing.

    Each micro-batch becomes a new version of the table, last write wins, in a batch the row that is last in `order`. summarise turns a batch into rows first.
    """
    def merge(batch: DataFrame, _: int) -> None:
        rows = summarise(batch) if summarise else batch
        old = read_current(batch.sparkSession, root)
        write_version(upsert(old if old is not None else rows.limit(0), rows, keys, order), root)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def files(spark: SparkSession, path: str, schema: T.StructType, form: str = "parquet", per_batch: int | None = None) -> DataFrame:
    """A stream of a folder's files, each taken once."""
    r = spark.readStream.schema(schema)
    return (r.option("maxFilesPerTrigger", per_batch) if per_batch else r).format(form).load(path)
