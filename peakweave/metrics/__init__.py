"""Metrics as distributed aggregates."""

from peakweave.metrics.core import Metric, evaluate, get, register

__all__ = ["Metric", "evaluate", "get", "register"]
