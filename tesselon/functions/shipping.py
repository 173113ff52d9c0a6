"""Python functions on executors: the package goes along, so that they need no installation of it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_sent: set[str] = set()
_LIMIT, _UNSET, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", 2 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once per application, and keep Arrow batches small.

    Batches are limited by rows, which long texts make large; where the session leaves their limit by bytes at its
    default, it becomes BATCH_BYTES, so that a Python worker's memory doesn't depend on the texts. One row may be longer.
    """
    if spark.conf.get(_LIMIT, None) in (None, _UNSET):
        spark.conf.set(_LIMIT, BATCH_BYTES)
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    at = os.path.join(tempfile.mkdtemp(prefix="tesselon-"), f"{os.path.basename(top)}.zip")
    with zipfile.ZipFile(at, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(top)))
    context.addPyFile(at)
    _sent.add(context.applicationId)


def map_pandas(df: DataFrame, function: Callable, schema) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInPandas(function, schema)


def map_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)
