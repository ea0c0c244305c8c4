"""All registered queries."""

from __future__ import annotations

from . import (  # noqa: F401
    feature_queries, fit_queries, model_queries, relational_queries, report_queries,
    storage_queries, synth_queries,
    transform_queries)
from .registry import ORACLES, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracles() -> dict:
    return dict(ORACLES)
