"""Running stages one after another: settings from YAML, the stage list, resume, failures and timings."""

from __future__ import annotations

import dataclasses
import logging
import os
import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .stages import Settings

log = logging.getLogger("tesselon")
STAGES = ("mask", "qc", "gate", "tumor", "uni")
TIMINGS = T.StructType([T.StructField("stage", T.StringType()), T.StructField("code", T.IntegerType()), T.StructField("seconds", T.DoubleType()), T.StructField("message", T.StringType())])


def stage_list(text: str | None, known: Iterable[str] = STAGES) -> list[str]:
    """Comma-separated stages in the given order; none means all, an unknown one is an error."""
    known = list(known)
    wanted = [s.strip().lower() for s in (text or "").split(",") if s.strip()]
    if unknown := [s for s in wanted if s not in known]:
        raise ValueError(f"unknown stages: {', '.join(unknown)}; known: {', '.join(known)}")
    return wanted or known


def settings(given: dict, profile: str = "default") -> Settings:
    """Settings from nested maps: sections are the fields of Settings, a mask section is laid under the named profile."""
    from ..operators.masks import configured

    base = Settings()
    values = {}
    names = {f.name for f in dataclasses.fields(Settings)}
    for key, value in given.items():
        if key not in names:
            raise ValueError(f"no such section: {key}")
        now = getattr(base, key)
        if key == "mask":
            continue
        values[key] = dataclasses.replace(now, **value) if dataclasses.is_dataclass(now) else value
    return dataclasses.replace(base, mask=configured(profile, **{k: tuple(v) if isinstance(v, list) else v for k, v in given.get("mask", {}).items()}), **values)


def read_settings(path: str, profile: str = "default") -> Settings:
    import yaml

    with open(path) as f:
        return settings(yaml.safe_load(f) or {}, profile)


def summary_path(root: str, other: str, prefix: str, name: str = "summary.csv") -> str:
    """Where a stage's summary goes: in the folder of another stage's under a prefix, so that neither replaces the other."""
    same = os.path.normpath(root) == os.path.normpath(other)
    return f"{root.rstrip('/')}/{prefix}_{name}" if same else f"{root.rstrip('/')}/{name}"


def run_stages(spark: SparkSession, stages: dict[str, Callable[[], object]], wanted: list[str], go_on: bool = True, may_fail: Iterable[str] = ("gate",)) -> tuple[int, DataFrame]:
    """Run the wanted stages in their order; returns the first failure's code and one row for each stage that ran.

    A stage fails by an exception (code 2) or by returning False (code 1). Failures of the stages in may_fail are recorded
    but do not count; without go_on the first one that counts ends the run.
    """
    rows, code = [], 0
    for name in (s for s in stages if s in wanted):
        began, own, message = time.time(), 0, ""
        log.info("stage %s", name)
        try:
            own = 1 if stages[name]() is False else 0
        except Exception as e:  # recorded, and fatal only if asked for
            own, message = 2, f"{type(e).__name__}: {' '.join(str(e).split())[:400]}"
            log.error("stage %s: %s", name, message)
        rows.append((name, own, time.time() - began, message))
        if own and name not in may_fail:
            code = code or own
            if not go_on:
                break
    return code, spark.createDataFrame(rows, TIMINGS)
