"""The query catalogue: every query by name, and its SQL where SQL can express it."""

from __future__ import annotations

from . import q_metrics, q_more, q_pixels, q_relational, q_scalar, q_select, q_slides  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
